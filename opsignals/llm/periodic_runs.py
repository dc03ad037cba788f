"""Periodic runs of words (operator 11), from branching tandem repeats in an enhanced suffix array.

A run is a stretch of words with a smallest period q and at least max(6, 4q) words that keeps the
period and cannot be longer. A run ends in a square, two equal halves of q words, whose suffix and
the one q words on share q words exactly: a branching tandem repeat. These are found without a
tree: for each LCP interval of depth q the suffixes of all children but the largest are taken, and
the inverse suffix array tells whether the suffix q words on is in the interval but in another child,
or the suffix q words back in the largest. Rotating such a square to the left as far as words stay
equal gives the run; squares whose period is a multiple of a run's that ends there are part of it.

Only repeated words need a suffix array: each five words within a run occur again in their document,
so words in no five that occur twice are cut out, and a unique mark takes the place of each gap. That
changes no run. Five words are compared by hash, where equal hashes of other words cost time only.
The arrays of all documents of a slice are built together by prefix doubling; words of different
documents are different there.

Words are stretches of bytes other than blank, \\t, \\n, \\v, \\f and \\r. A null text has no words and
an empty one neither: no runs, four nulls, digests of nothing. A null id takes part unplanted.
Repeated rows and ids stay as they are, other columns are left behind, an empty table gives an empty
result. One document is held by one task whole, however long (about 200 bytes a word).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from opsignals.llm.common import slices, small_batches, table, texts
from opsignals.llm.words import mixed

GRAM, SHORTEST, PERIODS = 5, 6, 4
SLICE = 3 << 20
_AT_ONCE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_SCHEMA = """doc_id long, n_runs long, start long, length long, period long, exponent_milli long,
             runs_sha256 string, collapsed_sha256 string"""


def split_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where each text's words begin (one more at the end), a code for each word, and all texts with
    one blank between words: their bytes and where each text begins."""
    column = column.cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]] if bounds[-1] > bounds[0] else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    solid = ~_SPACE[data]
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    stops[:-1] &= ~solid[1:]
    # A text's first and last byte end a word though another text goes on beside them.
    inner = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    begins[inner] = solid[inner]
    stops[inner - 1] = solid[inner - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    rows = np.searchsorted(start, bounds)
    sizes = np.concatenate(([0], np.cumsum(stop - start)))
    letters = np.ascontiguousarray(data[solid])
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(letters)])
    codes = words.dictionary_encode().indices.to_numpy() if len(start) else np.empty(0, np.int32)
    between = np.ones(len(start), bool)
    between[rows[1:][np.diff(rows) > 0] - 1] = False
    joined = data.copy()
    joined[stop[between]] = 0x20
    solid[stop[between]] = True
    counts = np.diff(rows)
    offsets = np.concatenate(([0], np.cumsum(sizes[rows[1:]] - sizes[rows[:-1]] + np.maximum(counts - 1, 0))))
    return rows, codes, joined[solid], offsets


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) where the words from a on repeat those p words from a, or None: one id in ten."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(b"%d" % doc_id)
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def repeated_words(rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The words that are in five words which occur twice in their text."""
    n = len(codes) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    value = mixed(owner.astype(np.uint64)[:n] + np.uint64(1))
    for j in range(GRAM):
        value = mixed(value + codes[j : j + n].astype(np.uint64) + np.uint64(j))
    value = value[owner[:n] == owner[GRAM - 1 :]]
    place = np.flatnonzero(owner[:n] == owner[GRAM - 1 :])
    ordered = np.sort(value)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.empty(0, np.int64)
    seen = np.zeros(1 << 16, bool)
    seen[twice >> np.uint64(48)] = True
    may = np.flatnonzero(seen[value >> np.uint64(48)])
    at = np.minimum(np.searchsorted(twice, value[may]), len(twice) - 1)
    place = place[may[twice[at] == value[may]]]
    edge = np.zeros(len(codes) + 1, np.int32)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + GRAM, -1)
    return np.flatnonzero(np.cumsum(edge[:-1]))


def marked_out(rows: np.ndarray, codes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words at ``places`` as numbers that differ between texts, with a unique number after each
    unbroken stretch, and the place of each (-1 for the marks)."""
    owner = np.searchsorted(rows, places, "right")
    last = np.concatenate((np.diff(places) != 1, [True]))
    last[:-1] |= owner[1:] != owner[:-1]
    after = np.flatnonzero(last) + 1
    number = owner * (int(codes.max()) + 1) + codes[places]
    top = int(number.max()) + 1
    return np.insert(number, after, top + np.arange(len(after))), np.insert(places, after, -1)


def suffix_array(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse, and the words that a suffix shares with the one before it. The last
    value must occur once. Prefix doubling: only groups of equal beginnings are sorted again."""
    n = len(values)
    sa = np.argsort(values, kind="stable")
    head = np.concatenate(([True], values[sa][1:] != values[sa][:-1]))
    place = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, place, 0))
    ranks, split = [], np.full(n, -1, np.int64)
    active = place[~(head & np.append(head[1:], True))]
    while len(active):
        ranks.append(rank)
        reach = 1 << (len(ranks) - 1)
        s = sa[active]
        key = rank[s] * n + rank[s + reach]
        order = np.argsort(key, kind="stable")
        s, key = s[order], key[order]
        sa[active] = s
        head = np.concatenate(([True], key[1:] != key[:-1]))
        split[active[head & (rank[s] != active)]] = len(ranks) - 1
        fresh = rank.copy()
        fresh[s] = np.maximum.accumulate(np.where(head, active, 0))
        rank = fresh
        active = active[~(head & np.append(head[1:], True))]
    # Neighbours that round k told apart share 2**k words and what their rests share, which is less.
    lcp = np.zeros(n, np.int64)
    order = np.argsort(-split, kind="stable")
    ends = np.searchsorted(-split[order], np.arange(-len(ranks), 1), "right")[::-1]
    shared = np.zeros(n, np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        begun, now = int(ends[k + 1]), int(ends[k])
        p, more = order[:begun], shared[:begun]
        equal = ranks[k][sa[p - 1] + more] == ranks[k][sa[p] + more]
        more[equal] += 1 << k
        shared[begun:now] = 1 << k
    lcp[order] = shared
    return sa, rank, lcp


def lcp_intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each border between neighbours: the next border that isn't deeper, the interval it is of
    (its first border), and the border where that interval begins."""
    depth = lcp.tolist()
    n = len(depth)
    depth[0] = -1
    following, interval, begins = [n] * n, [0] * n, [0] * n
    stack = [0]
    for p in range(1, n):
        x = depth[p]
        top = stack[-1]
        while depth[top] > x:
            following[stack.pop()] = p
            top = stack[-1]
        if depth[top] == x:
            following[stack.pop()] = p
            interval[p], begins[p] = interval[top], begins[top]
        else:
            interval[p], begins[p] = p, top
        stack.append(p)
    return np.array(following), np.array(interval), np.array(begins)


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the branching tandem repeats, some thousands of children at a time."""
    following, interval, begins = lcp_intervals(lcp)
    border = np.flatnonzero(lcp > 0)
    opening = border[interval[border] == border]
    # An interval's first child ends at its first border, the others begin at one each.
    low = np.concatenate((begins[opening], border))
    high = np.concatenate((opening, following[border]))
    of = np.concatenate((opening, interval[border]))
    end = np.zeros(len(lcp), np.int64)
    np.maximum.at(end, of, high)
    order = np.lexsort((low, low - high, of))
    low, high, of = low[order], high[order], of[order]
    largest = np.concatenate(([True], of[1:] != of[:-1])) if len(of) else np.empty(0, bool)
    at = np.flatnonzero(largest)
    big = at[np.cumsum(largest) - 1] if len(at) else at
    small = np.flatnonzero(~largest)
    sizes = high[small] - low[small]
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(0, int(sizes.sum()) + _AT_ONCE, _AT_ONCE))
    for a, b in zip(np.unique(cuts)[:-1], np.unique(cuts)[1:]):
        part, size = small[a:b], sizes[a:b]
        child = np.repeat(part, size)
        first = np.cumsum(size) - size
        suffix = sa[np.arange(int(size.sum())) - np.repeat(first, size) + low[child]]
        depth = lcp[of[child]]
        # Forward: the suffix a period on is in the interval, in another child.
        there = isa[suffix + depth]
        hit = (there >= begins[of[child]]) & (there < end[of[child]]) & ((there < low[child]) | (there >= high[child]))
        yield suffix[hit], depth[hit]
        # Back: the suffix a period before is in the largest child.
        before = suffix - depth
        inside = before >= 0
        there = isa[np.maximum(before, 0)]
        hit = inside & (there >= low[big[child]]) & (there < high[big[child]])
        yield before[hit], depth[hit]


def rotated(values: np.ndarray, place: int, period: int) -> int:
    """Where a square's period begins to hold: it is turned to the left while words stay equal."""
    step = 8
    while place > 0:
        low = max(0, place - step)
        other = np.flatnonzero(values[low:place] != values[low + period : place + period])
        if len(other):
            return low + int(other[-1]) + 1
        place, step = low, step * 2
    return 0


def runs_of(values: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, stop, period) of each run of max(6, 4 * period) words or more."""
    sa, isa, lcp = suffix_array(values)
    places, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for place, period in branching_squares(sa, isa, lcp):
        # The first turns leave few.
        for back in (1, 2):
            fits = place >= back
            place, period = place[fits], period[fits]
            fits = values[place - back] == values[place - back + period]
            place, period = place[fits], period[fits]
        places.append(place)
        periods.append(period)
    place, period = np.concatenate(places), np.concatenate(periods)
    order = np.lexsort((place, period))
    found: list[tuple[int, int, int]] = []
    ending: dict[int, list[tuple[int, int]]] = {}
    for i, q in zip(place[order].tolist(), period[order].tolist(), strict=True):
        stop = i + 2 * q
        if any(q % r == 0 and s <= i for s, r in ending.get(stop, ())):
            continue
        start = rotated(values, i, q)
        if stop - start >= max(SHORTEST, PERIODS * q):
            found.append((start, stop, q))
            ending.setdefault(stop, []).append((start, q))
    return found


def _runs_by_text(rows: np.ndarray, codes: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text that has any, by start and period."""
    places = repeated_words(rows, codes)
    if not len(places):
        return {}
    values, place = marked_out(rows, codes, places)
    out: dict[int, list[tuple[int, int, int]]] = {}
    for start, stop, period in runs_of(values):
        first = int(place[start])
        text = int(np.searchsorted(rows, first, "right")) - 1
        out.setdefault(text, []).append((first - int(rows[text]), stop - start, period))
    return {text: sorted(found, key=lambda r: (r[0], r[2])) for text, found in out.items()}


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def periodic_runs(docs: DataFrame, *, plant: bool = False) -> DataFrame:
    """A row for each document: how many runs it has, its longest run, digests of all of them and of
    the text without the words that any run repeats. ``plant`` makes one text in ten periodic first."""
    small_batches(docs.sparkSession)
    names = [c.split()[0] for c in _SCHEMA.split(",")]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            rows, codes, joined, offsets = split_bytes(batch.column("text"))
            codes = codes.copy()
            ids, source = batch.column("doc_id").to_pylist(), {}
            for t, doc_id in enumerate(ids):
                made = planted(doc_id, int(rows[t + 1] - rows[t])) if plant else None
                if made:
                    a, p = made
                    taken = np.arange(int(rows[t + 1] - rows[t]))
                    taken[a:] = a + (taken[a:] - a) % p
                    source[t] = taken
                    codes[rows[t] : rows[t + 1]] = codes[rows[t] : rows[t + 1]][taken]
            found = _runs_by_text(rows, codes)
            out = []
            for t, doc_id in enumerate(ids):
                runs, taken = found.get(t, []), source.get(t)
                text = joined[offsets[t] : offsets[t + 1]].tobytes()
                if runs or taken is not None:
                    words = text.split(b" ") if text else []
                    taken = np.arange(len(words)) if taken is None else taken
                    edge = np.zeros(len(words) + 1, np.int64)
                    for start, length, period in runs:
                        edge[start + period] += 1
                        edge[start + length] -= 1
                    text = b" ".join([words[i] for i in taken[np.cumsum(edge[:-1]) == 0].tolist()])
                longest = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
                milli = 1000 * longest[1] // longest[2] if runs else None
                lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()
                out.append((doc_id, len(runs), *longest, milli, _sha(lines), _sha(text)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return texts(docs).mapInArrow(scan, _SCHEMA)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True)
