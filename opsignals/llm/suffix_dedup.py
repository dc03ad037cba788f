"""Suffix-array dedup of repeated byte strings (operator 2), by a distributed difference cover.

A byte goes if a string of ``length`` bytes over it also starts earlier: in a document of smaller
id, or earlier in the same one. Each suffix is named by its first ``length`` bytes, suffixes are
sorted by name over all tasks, and neighbours of one name are one string, whose first place stays.

Naming follows the difference cover modulo three. Text is read in words of four bytes; of three
places a word apart two are sampled. Sampled triples get names, the names are combined again and
again along their own chain (the recursion), and the places left over take their first word and the
name of the sampled place after it. A name is a fingerprint and not a rank among sorted triples: it
is the same for equal strings on every executor, so no level needs an exchange, and suffixes are
sorted by fingerprints of 80 bits instead of by the alphabet, which deduplication never looks at.

Most text repeats nowhere. Equal texts are compared by digest first: all but the first go as a
whole. Of the others, places are drawn that any repeated string must share (the least fingerprint of
``GRAM`` bytes within it), and only strings around such a fingerprint that occurs twice are sorted.
A task sends a fingerprint, and later a name, once however often it has it, so a passage that a
third of all documents share costs each task one entry.

A null text is an empty one. Null ids count as smaller than all others. Rows of one id are ordered by
their digest; of equal rows one counts as first. Other columns are left behind. Spans are in bytes.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opsignals.llm.common import few_rows, slices, small_batches, table, tasks, texts, written
from opsignals.llm.words import mixed

LENGTH = 100
GRAM = 56
SLICE = 4 << 20
_NAMED_AT_ONCE = 1 << 19
_LEAST = -(1 << 63)
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_SEEDS = (np.uint64(0), np.uint64(0x165667B19E3779F9))


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def _word_names(data: np.ndarray, seed: np.uint64) -> np.ndarray:
    """A name for the four bytes at each place but the last three."""
    wide = data.astype(np.uint64)
    words = wide[:-3] | wide[1:-2] << np.uint64(8) | wide[2:-1] << np.uint64(16) | wide[3:] << np.uint64(24)
    words += seed + np.uint64(1)
    for shift, odd in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
        words ^= words >> np.uint64(shift)
        words *= np.uint64(odd)
    words ^= words >> np.uint64(32)
    return words


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """A fingerprint of the ``size`` bytes (a multiple of four) at each place."""
    base, names, number, out, done = _BASES[0], _word_names(data, _SEEDS[0]), 1, None, 0
    left = size // 4
    while left:
        if left & 1:
            part = names[4 * done :] if out is None else names[4 * done :][: len(out)]
            out = part if out is None else out[: len(part)] * _power(base, number) + part
            done += number
        left >>= 1
        if left:
            names = names[: -4 * number] * _power(base, number) + names[4 * number :]
            number *= 2
    out = out ^ (out >> np.uint64(29))
    return (out * _BASES[1])[: max(0, len(data) - size + 1)]


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    return pick(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def drawn_places(marks: np.ndarray, width: int) -> np.ndarray:
    """The places whose mark is the least of some ``width`` marks in a row."""
    least = _sliding(marks, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate((edge, least, edge)), width, np.maximum) == marks)


def suffix_names(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Names (64 and 16 bits) of the ``length`` bytes (a multiple of four, 100 here) at each place."""
    n = len(data) - length + 1
    halves = []
    for base, seed in zip(_BASES, _SEEDS, strict=True):
        words = _word_names(data, seed)
        padded = np.concatenate((words, np.zeros(-len(words) % 12 + 12, np.uint64)))
        # Rows of three words' places: columns 0-3 are the places left over, 4-11 the sampled ones,
        # and the next place of a sampled chain is in the next row.
        rows = len(padded) // 12 - 1
        triples = (padded[:-8] * base + padded[4:-4]) * base + padded[8:]
        chain = np.concatenate((triples, np.zeros(8, np.uint64))).reshape(-1, 12)[:rows, 4:]
        count, left, names, done = 1, length // 12, None, 0
        while left:  # the recursion: names of names along the chain
            if left & 1:
                part = chain[done:]
                names = part if names is None else names[: len(part)] * _power(base, 3 * count) + part[: len(names)]
                done += count
            left >>= 1
            if left:
                chain = chain[:-count] * _power(base, 3 * count) + chain[count:]
                count *= 2
        words_in = 3 * (length // 12)
        rest = length // 4 - words_in
        out = np.empty((len(names), 12), np.uint64)
        full = np.concatenate((padded, np.zeros(4 * words_in + 24, np.uint64)))
        # Sampled places: their chain's name, then what is left of the length.
        sampled = names
        for k in range(rest):
            sampled = sampled * base + full[4 * (words_in + k) :][: 12 * len(names)].reshape(-1, 12)[:, 4:]
        out[:, 4:] = sampled
        # Places left over: their first word, then the name of the sampled place after it.
        head = padded[: 12 * len(names)].reshape(-1, 12)[:, :4] * _power(base, words_in) + names[:, :4]
        for k in range(rest - 1):
            head = head * base + full[4 * (words_in + 1 + k) :][: 12 * len(names)].reshape(-1, 12)[:, :4]
        out[:, :4] = head
        halves.append(out.reshape(-1)[:n])
    first, second = halves
    return first ^ (first >> np.uint64(31)), (second >> np.uint64(48)).astype(np.uint16)


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight together: of sorted numbers the upper ones then compress to nothing."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def _unplaned(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def _batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns.values()], list(columns))


def _by(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, list[dict]]]:
    """A partition's rows by a column. A partition has about one bucket, which is all it holds."""
    held: dict[int, list[dict]] = defaultdict(list)
    for batch in batches:
        for row in batch.to_pylist():
            held[row[column]].append(row)
    for value in sorted(held):
        yield value, held.pop(value)


# What tasks send about drawn places: fingerprints in order, the text each is of and its place there.
_DRAWN = "bucket int, docs binary, marks binary, doc binary, place binary"


def repeated_places(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """digest (64 bits of a text's SHA-256) and places (32 bits each) around which it may repeat."""
    spark = docs.sparkSession
    buckets = tasks(spark)
    width = length - GRAM + 1

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            seen, marks, owners, places = {}, [], [], []
            for text in batch.column("text").to_pylist():
                data = text.encode()
                if len(data) < length:
                    continue
                digest = int.from_bytes(hashlib.sha256(data).digest()[:8], "big", signed=True)
                if digest in seen:
                    continue
                seen[digest] = len(seen)
                mark = grams(np.frombuffer(data, np.uint8), GRAM)
                at = drawn_places(mark, width)
                # Least values are small ones: mixed again, they spread over the buckets.
                marks.append(mixed(mark[at]))
                places.append(at.astype(np.uint32))
                owners.append(np.full(len(at), seen[digest], np.uint32))
            if not seen:
                continue
            docs_, mark, owner, place = np.array(list(seen), np.int64), np.concatenate(marks), np.concatenate(owners), np.concatenate(places)
            order = np.argsort(mark, kind="stable")
            mark, owner, place = mark[order], owner[order], place[order]
            new = np.concatenate(([True], mark[1:] != mark[:-1]))
            twice = ~new | np.concatenate((~new[1:], [False]))
            # What repeats within the task is known here; it still tells other tasks.
            yield _sent(-1, docs_, mark[:0], owner[twice], place[twice])
            mark, owner, place = mark[new], owner[new], place[new]
            bucket = (mark >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in range(buckets):
                part = slice(cuts[b], cuts[b + 1])
                if cuts[b] < cuts[b + 1]:
                    yield _sent(b, docs_, mark[part], owner[part], place[part])

    def _sent(bucket: int, docs_: np.ndarray, mark: np.ndarray, owner: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        used, owner = np.unique(owner, return_inverse=True)
        row = [bucket, docs_[used].tobytes(), _planes(mark), _planes(owner.astype(np.uint16 if len(used) < 1 << 16 else np.uint32)), _planes(place)]
        kinds = [pa.int32()] + [pa.binary()] * 4
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], ["bucket", "docs", "marks", "doc", "place"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by(batches, "bucket"):
            if bucket < 0:
                for row in rows:
                    yield from _places_of([_opened(row)])
                continue
            parts = [_opened(row) for row in rows]
            mark, doc = np.concatenate([p[1] for p in parts]), np.concatenate([p[0] for p in parts])
            place = np.concatenate([p[2] for p in parts])
            order = np.lexsort((doc, mark))
            mark, doc, place = mark[order], doc[order], place[order]
            # Texts of one digest are one text; another digest, or another place, makes a repeat.
            new = np.concatenate(([True], mark[1:] != mark[:-1]))
            run = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            other = (doc != doc[first][run]) | (place != place[first][run])
            kept = np.bincount(run, weights=other)[run] > 0
            yield from _places_of([(doc[kept], mark[:0], place[kept])])

    def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place = _unplaned(row["place"], "<u4")
        kind = "<u2" if len(row["doc"]) == 2 * len(place) else "<u4"
        return np.frombuffer(row["docs"], "<i8")[_unplaned(row["doc"], kind)], _unplaned(row["marks"], "<u8"), place

    def _places_of(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        """What is found, by the part that gathers a document's places: a row a part at most."""
        for doc, _, place in found:
            part = (doc.view(np.uint64) >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)
            order = np.lexsort((doc, part))
            cuts = np.searchsorted(part[order], np.arange(buckets + 1))
            for t in np.flatnonzero(np.diff(cuts)).tolist():
                own = order[cuts[t] : cuts[t + 1]]
                columns = [([t], pa.int32()), ([_planes(doc[own])], pa.binary()), ([place[own].tobytes()], pa.binary())]
                yield _batch(dict(zip(("part", "docs", "places"), columns, strict=True)))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by(batches, "part"):
            doc = np.concatenate([_unplaned(r["docs"], "<i8") for r in rows])
            place = np.concatenate([np.frombuffer(r["places"], "<u4") for r in rows])
            order = np.lexsort((place, doc))
            doc, place = doc[order], place[order]
            cuts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1], [True])))
            for i in range(0, len(cuts) - 1, 1000):
                ends = cuts[i : i + 1001]
                out = [np.unique(place[a:b]).tobytes() for a, b in zip(ends, ends[1:])]
                yield _batch({"digest": (doc[ends[:-1]], pa.int64()), "places": (out, pa.binary())})

    sent = texts(docs).select("text").mapInArrow(draw, _DRAWN)
    # Rows with what a task knows already (bucket -1) are many and need nobody: they're dealt out freely.
    dealt = sent.repartition(buckets, F.when(F.col("bucket") < 0, F.xxhash64("docs")).otherwise(F.col("bucket")))
    found = dealt.mapInArrow(compare, "part int, docs binary, places binary").repartition(buckets, "part")
    with few_rows(spark, 16):
        return written(found.mapInArrow(gather, "digest long, places binary"), "repeated-places")


def _windows(n: int, places: bytes, length: int) -> np.ndarray:
    """Whether the string at each place of a text of n bytes holds one of the places' fingerprints."""
    at = np.frombuffer(places, "<u4").astype(np.int64)
    edge = np.zeros(n - length + 2, np.int32)
    np.add.at(edge, np.clip(at - (length - GRAM), 0, n - length + 1), 1)
    np.add.at(edge, np.minimum(at + 1, n - length + 1), -1)
    return np.cumsum(edge)[:-1] > 0


def _named(blob: bytes, sizes: np.ndarray, places: list[bytes], length: int):
    """Of a slice of texts: places (in the joined bytes) that are sorted, and their names. Texts are
    named half a megabyte at a time, as names in the making take a hundred bytes for each of text."""
    starts = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(blob, np.uint8)
    out: list[tuple] = []
    i = 0
    while i < len(sizes):
        j = i + 1
        while j < len(sizes) and starts[j + 1] - starts[i] <= _NAMED_AT_ONCE:
            j += 1
        a, b = int(starts[i]), int(starts[j])
        held = np.zeros(b - a, bool)
        for k in range(i, j):
            at = int(starts[k]) - a
            held[at : at + int(sizes[k]) - length + 1] = _windows(int(sizes[k]), places[k], length)
        at = np.flatnonzero(held)
        first, second = suffix_names(data[a:b], length)
        out.append(((at + a).astype(np.uint32), first[at], second[at]))
        i = j
    at, first, second = (np.concatenate(column) for column in zip(*out, strict=True))
    return starts, at, first, second


def _sorted_names(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by name, equal names by place, and where a new name begins."""
    order = np.argsort(first, kind="stable")
    same = first[order[1:]] == first[order[:-1]]
    if (same & (second[order[1:]] != second[order[:-1]])).any():
        order = np.lexsort((second, first))
        same = first[order[1:]] == first[order[:-1]]
    new = np.concatenate(([True], ~(same & (second[order[1:]] == second[order[:-1]])))) if len(order) else np.empty(0, bool)
    return order, new


def _text_of(row: dict) -> bytes:
    return pa.decompress(row["bytes"], decompressed_size=sum(row["sizes"]), codec="zstd", asbytes=True)


_SLICED = "slice long, ids array<long>, shas array<binary>, sizes array<long>, places array<binary>, bytes binary"


def _sliced(docs: DataFrame, length: int) -> DataFrame:
    """Slices of the texts that may repeat, in order of documents, so an earlier slice has the
    earlier place. (One step to a function: a finished step's shuffle files may then be cleaned.)"""
    buckets = tasks(docs.sparkSession)
    places = repeated_places(docs, length)
    rows = texts(docs).select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha"))
    firsts = rows.groupBy("sha").agg(F.min(F.coalesce("doc_id", F.lit(_LEAST))).alias("at"))
    digest = F.conv(F.substring(F.hex("sha"), 1, 16), 16, -10).cast("long")
    wanted = firsts.withColumn("digest", digest).join(places, "digest").select("at", "sha", "places")
    whole = texts(docs).select(
        F.coalesce("doc_id", F.lit(_LEAST)).alias("at"), F.unhex(F.sha2("text", 256)).alias("sha"), "text", F.lit(None).cast("binary").alias("places")
    )
    marked = wanted.select("at", "sha", F.lit(None).cast("string").alias("text"), "places")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, asked, held, size = TaskContext.get().partitionId() << 32, None, [], 0

        def joined() -> pa.RecordBatch:
            ids, shas, data, places = (list(column) for column in zip(*held, strict=True))
            kinds = ((ids, pa.int64()), (shas, pa.binary()), ([len(d) for d in data], pa.int64()), (places, pa.binary()))
            blob = pa.compress(b"".join(data), codec="zstd", asbytes=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), *(pa.array([v], pa.list_(k)) for v, k in kinds), pa.array([blob], pa.binary())],
                ["slice", "ids", "shas", "sizes", "places", "bytes"],
            )

        for batch in batches:
            text = batch.column("text")
            keys = zip(*(batch.column(c).to_pylist() for c in ("at", "sha", "places")), strict=True)
            for i, (at, sha, places) in enumerate(keys):
                if places is not None:
                    asked = at, sha, places
                elif asked and asked[:2] == (at, sha):
                    held.append((at, sha, text[i].as_py().encode(), asked[2]))
                    size += len(held[-1][2])
                    asked = None  # rows equal to it aren't the first
                    if size >= SLICE:
                        yield joined()
                        number, held, size = number + 1, [], 0
        if held:
            yield joined()

    # One exchange brings texts into their order and to the places that are asked for: what is asked
    # comes just before the text.
    ordered = whole.unionByName(marked).repartitionByRange(buckets, "at", "sha")
    ordered = ordered.sortWithinPartitions("at", "sha", F.col("places").isNull())
    return written(ordered.mapInArrow(pack, _SLICED), "slices")


def _judged(sliced: DataFrame, length: int) -> DataFrame:
    """slice, bucket and, for its names of that bucket in order, whether an earlier slice has them."""
    spark, buckets = sliced.sparkSession, tasks(sliced.sparkSession)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, at, first, second = _named(_text_of(row), np.array(row["sizes"]), row["places"], length)
                order, new = _sorted_names(first, second)
                first, second = first[order[new]], second[order[new]]
                bucket = (first >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(cuts)).tolist():
                    part = slice(cuts[b], cuts[b + 1])
                    yield _batch({"bucket": ([b], pa.int32()), "slice": ([row["slice"]], pa.int64()), "first": ([_planes(first[part])], pa.binary()), "second": ([_planes(second[part])], pa.binary())})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by(batches, "bucket"):
            rows.sort(key=lambda r: r["slice"])
            first = [_unplaned(r["first"], "<u8") for r in rows]
            order, new = _sorted_names(np.concatenate(first), np.concatenate([_unplaned(r["second"], "<u2") for r in rows]))
            later = np.empty(len(order), bool)
            later[order] = ~new
            cuts = np.cumsum([0, *map(len, first)])
            bits = [np.packbits(later[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
            yield _batch({"slice": ([r["slice"] for r in rows], pa.int64()), "bucket": ([bucket] * len(rows), pa.int32()), "bits": (bits, pa.binary())})

    with few_rows(spark, 2):
        sent = sliced.mapInArrow(name, "bucket int, slice long, first binary, second binary")
        dealt = sent.repartition(buckets, "bucket")
        return written(dealt.mapInArrow(compare, "slice long, bucket int, bits binary"), "later-names")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, sha (of the text), spans (array of start and stop) and kept (the bytes left) of every
    text that has a part to lose. Texts that are later copies of a whole text aren't among them."""
    spark = docs.sparkSession
    small_batches(spark)
    buckets = tasks(spark)
    sliced = _sliced(docs, length)
    judged = _judged(sliced, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text = _text_of(row)
                starts, at, first, second = _named(text, np.array(row["sizes"]), row["places"], length)
                order, new = _sorted_names(first, second)
                heads = order[new]
                bucket = (first[heads] >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                later = np.zeros(len(heads), bool)
                for part in row["judged"]:
                    a, b = cuts[part["bucket"]], cuts[part["bucket"] + 1]
                    later[a:b] = np.unpackbits(np.frombuffer(part["bits"], np.uint8), count=b - a)
                gone = np.ones(len(order), bool)
                gone[heads] = later
                edge = np.zeros(len(text) + 1, np.int32)
                edge[at[gone]] += 1
                edge[at[gone] + np.uint32(length)] -= 1
                covered = np.cumsum(edge[:-1]) > 0
                out = defaultdict(list)
                for doc, sha, a, b in zip(row["ids"], row["shas"], starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    own = covered[a:b]
                    if own.any():
                        turns = np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8))).reshape(-1, 2)
                        out["doc_id"].append(None if doc == _LEAST else doc)
                        out["sha"].append(sha)
                        out["spans"].append([{"start": int(x), "stop": int(y)} for x, y in turns])
                        out["kept"].append(np.frombuffer(text, np.uint8)[a:b][~own].tobytes())
                kinds = {"doc_id": pa.int64(), "sha": pa.binary(), "spans": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), "kept": pa.binary()}
                yield _batch({c: (out[c], k) for c, k in kinds.items()})

    # At most a row per bucket for each slice.
    parts = judged.groupBy("slice").agg(F.collect_list(F.struct("bucket", "bits")).alias("judged"))
    schema = "doc_id long, sha binary, spans array<struct<start:long,stop:long>>, kept binary"
    with few_rows(spark, 2):
        return written(sliced.join(parts, "slice").mapInArrow(cut, schema), "spans")


def later_copies(docs: DataFrame) -> DataFrame:
    """doc_id, sha, n_bytes, copies (equal rows) and whether the first of them is the text's first."""
    rows = texts(docs).select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes"))
    grouped = rows.groupBy("doc_id", "sha").agg(F.max("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("copies"))
    firsts = grouped.groupBy("sha").agg(F.min(F.coalesce("doc_id", F.lit(_LEAST))).alias("at"))
    joined = grouped.join(firsts, "sha")
    return joined.select("doc_id", "sha", "n_bytes", "copies", (F.coalesce("doc_id", F.lit(_LEAST)) == F.col("at")).alias("is_first"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of docs with ``text`` less its repeated bytes; a character cut in two goes whole. A
    later copy of a whole text keeps its row, with an empty text if it had ``LENGTH`` bytes."""
    lost = repeated_spans(docs).select(F.coalesce("doc_id", F.lit(_LEAST)).alias("at"), "sha", "kept")
    rows = later_copies(docs)
    later = rows.filter((~F.col("is_first") | (F.col("copies") > 1)) & (F.col("n_bytes") >= LENGTH))
    later = later.select(F.coalesce("doc_id", F.lit(_LEAST)).alias("at"), "sha", "is_first")
    # The caller's row travels as one column, so none of its names can clash.
    keyed = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("at"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("sha"),
    )
    joined = keyed.join(lost, ["at", "sha"], "left").join(later, ["at", "sha"], "left")
    copy = F.row_number().over(W.partitionBy("at", "sha").orderBy(F.lit(0)))
    left = F.replace(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("\ufffd"), F.lit(""))
    gone = F.col("is_first").isNotNull() & ~(F.col("is_first") & (F.col("copy") == 1))
    new = F.when(gone, F.lit("")).when(F.col("kept").isNotNull(), left).otherwise(F.col("row.text"))
    return joined.withColumn("copy", copy).select(*[(new if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lost = repeated_spans(docs).select(
        "doc_id",
        "sha",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]).alias("lost"),
        F.size("spans").cast("long").alias("spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    rows = later_copies(docs)
    each = rows.join(lost, rows.doc_id.eqNullSafe(lost.doc_id) & (rows.sha == lost.sha), "left").select(
        rows.doc_id, rows.sha, "n_bytes", "is_first", "lost", "spans", "kept_sha256", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
    )
    gone = ~(F.col("is_first") & (F.col("copy") == 1)) & (F.col("n_bytes") >= LENGTH)
    return each.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("lost", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex(rows.sha)))).alias("kept_sha256"),
    )
