"""Periodic runs against a plain scan over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from opsignals.llm import periodic_runs
from opsignals.llm.periodic_runs import lcp_intervals, planted, split_bytes, suffix_array


def brute_runs(words):
    n, spans = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                spans.setdefault((i, j + q), q)  # the smallest period comes first
            i = max(j, i + 1) if j > i else i + 1
    return sorted((a, b - a, q) for (a, b), q in spans.items())


def brute(doc_id, text, plant):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    longest = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    lines = "".join(f"{a},{length},{q}\n" for a, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def made_texts():
    rng = random.Random(5)
    texts = ["", None, "one", "  a  a a\ta\na\x0ba  ", "a a a a a", "a a a a a a", "\x0c\r\n "]
    for _ in range(250):
        kind = rng.random()
        alphabet = ["a", "b", "c", "über", "é\xa0x", "a\x1cb"][: rng.randint(1, 6)]
        words = [rng.choice(alphabet) for _ in range(rng.randint(0, 60))]
        if kind < 0.6:
            at, q, times = rng.randint(0, len(words)), rng.randint(1, 7), rng.randint(3, 9)
            period = [rng.choice(alphabet) for _ in range(q)]
            words[at:at] = (period * times)[: rng.randint(1, q * times)]
        if kind < 0.2:
            words += words[-7:] * rng.randint(2, 5)
        texts.append(rng.choice([" ", "  ", "\n"]).join(words))
    texts += ["x " * 4000, "tick tock " * 2000, "a b c d e f g " * 3 + "a b c d", ("aba ab " * 3 + "c ") * 40]
    return texts


@pytest.mark.parametrize("plant", [False, True])
def test_equal_to_a_plain_scan(documents, odd_rows, plant):
    texts = made_texts()
    rows = odd_rows + [(1000 + i, t) for i, t in enumerate(texts)] + [(None, "a " * 40), (-10, "b " * 40)]
    got = periodic_runs.periodic_runs(documents(rows), plant=plant)
    want = [brute(*r, plant) for r in rows if len((r[1] or "").split()) < 3000]
    found = [tuple(r) for r in got.collect()]
    long_ids = {r[0] for r in rows if len((r[1] or "").split()) >= 3000}
    assert sorted((r for r in found if r[0] not in long_ids), key=repr) == sorted(want, key=repr)
    assert len(found) == len(rows)
    assert sum(r[1] > 0 for r in found) > 60
    if not plant:
        longest = {r[0]: r[2:6] for r in found if r[0] in long_ids}
        at = 1000 + len(texts) - 4
        assert longest[at] == (0, 4000, 1, 4_000_000) and longest[at + 1] == (0, 4000, 2, 2_000_000)


def test_empty_table(documents):
    assert periodic_runs.periodic_runs(documents([])).collect() == []


def test_words_are_cut_at_the_six_bytes_only():
    texts = ["a b", "", "c\x85d e \xa0f", None, " g", "h ", "i"]
    rows, codes, joined, offsets = split_bytes(pa.array([t or "" for t in texts]))
    assert np.diff(rows).tolist() == [2, 0, 2, 0, 1, 1, 1] and len(set(codes.tolist())) == 7
    parts = [joined[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])]
    assert parts == ["a b", "", "c\x85d e \xa0f", "", "g", "h", "i"]


def test_suffix_array_and_lcp_are_those_of_a_plain_sort():
    rng = random.Random(8)
    for alphabet in (1, 2, 5):
        for n in (1, 2, 3, 17, 200):
            values = [rng.randint(1, alphabet) for _ in range(n)] + [99]
            sa, isa, lcp = suffix_array(np.array(values))
            want = sorted(range(n + 1), key=lambda i: values[i:])
            assert sa.tolist() == want and [want[r] for r in isa] == list(range(n + 1))

            def shared(i, j):
                k = 0
                while max(i, j) + k <= n and values[i + k] == values[j + k]:
                    k += 1
                return k

            assert lcp.tolist()[1:] == [shared(i, j) for i, j in zip(want, want[1:])]


def test_intervals_by_definition():
    rng = random.Random(9)
    lcp = np.array([0] + [rng.randint(0, 4) for _ in range(60)])
    following, interval, begins = lcp_intervals(lcp)
    for p in range(1, len(lcp)):
        after = next((q for q in range(p + 1, len(lcp)) if lcp[q] <= lcp[p]), len(lcp))
        before = next((q for q in range(p - 1, 0, -1) if lcp[q] < lcp[p]), 0)
        first = next(q for q in range(before + 1, p + 1) if lcp[q] == lcp[p])
        assert (following[p], begins[p], interval[p]) == (after, before, first)


def test_planting():
    assert planted(None, 5) is None and planted(3, 0) is None
    ids = [i for i in range(300) if planted(i, 50)]
    assert all(zlib.crc32(str(i).encode()) % 10 == 0 for i in ids) and ids
