"""Documents packed into windows by best-fit decreasing (operator 5).

A document's ids, with the end id, are cut into full windows and one shorter rest. Rests of one
length can stand for each other, so best-fit decreasing needs only how many there are of each: the
driver gets at most one row per length, and a segment tree indexed by remaining capacity finds the
tightest open window for each run of equal rests. What comes out are runs: the rests of a length
with ranks from a to b go to consecutive windows, at one offset. Ranks within a length are counted
per task and summed, so a length that a third of all rows share is no burden.

A null text is an empty one, whose piece is the end id alone. Repeated ids and texts keep their
pieces; ``part`` and ``ord`` tell pieces of equal documents apart. Other columns are left behind.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opsignals.llm.common import slices, small_batches, table, texts, written
from opsignals.llm.tokens import library_memo, tokenizer_file

WINDOW = 4096
_PIECES = "doc_id long, start long, length long, doc_tokens long, part int, ord long, ids binary"


class Packed(NamedTuple):
    """pieces: doc_id, start, length, doc_tokens, part, ord, ids. places: part, length, ord, sequence_id,
    offset. (part, length, ord) is the key of both."""

    pieces: DataFrame
    places: DataFrame


class TightestWindow:
    """Segment tree over capacities 0..size: which have an open window."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        i = capacity + self.leaves
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def least(self, capacity: int) -> int | None:
        """The smallest capacity of at least this much that is open."""
        i = capacity + self.leaves
        while not self.open[i]:
            while i & 1:  # a right child: nothing further right under this parent
                i //= 2
                if i <= 1:
                    return None
            i += 1
        while i < self.leaves:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.leaves


def best_fit_decreasing(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, number, first window, offset) for so many pieces of each length."""
    tree, runs, windows = TightestWindow(window), [], 0
    room: dict[int, list[tuple[int, int]]] = {}  # remaining capacity: ranges of windows

    def add(capacity: int, first: int, number: int) -> None:
        if capacity and number:
            room.setdefault(capacity, []).append((first, number))
            tree.set(capacity, True)

    for length in sorted((n for n in counts if counts[n]), reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.least(length)
            if capacity is None:
                capacity, first = window, windows
                number = -(-left // (window // length))
                windows += number
            else:
                first, number = room[capacity].pop()
                if not room[capacity]:
                    tree.set(capacity, False)
            # A window that has taken one piece is the tightest for the next, until it's too tight.
            per = capacity // length
            full = min(number, left // per)
            for each, at, some in ((per, first, full), (min(per, left - per * full), first + full, int(number > full and left > per * full))):
                for k in range(each if some else 0):
                    runs.append((length, rank + k * some, some, at, window - capacity + k * length))
                add(capacity - each * length, at, some)
                rank, left, number, first = rank + each * some, left - each * some, number - some, at + some
            add(capacity, first, number)
    return runs


def token_pieces(docs: DataFrame, path: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """Every document's ids cut into pieces; ``ord`` numbers pieces of a length within a task."""
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, part, seen = library_memo(path), TaskContext.get().partitionId(), Counter()
        # The larger a slice, the fewer of its chunks are looked up.
        for batch in slices(batches, "text", 12 << 20):
            flat, ends = memo.ids(batch.column("text"))
            rows = []
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                ids = np.append(flat[a:b], np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    rows.append((doc, start, len(piece), len(ids), part, seen[len(piece)], piece.tobytes()))
                    seen[len(piece)] += 1
            kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "start", "length", "doc_tokens", "part", "ord", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return texts(docs).mapInArrow(cut, _PIECES)


def pack(docs: DataFrame, path: str, end_id: int, window: int = WINDOW) -> Packed:
    """Pieces of all documents and the place of each. Full windows are sequences by themselves."""
    pieces = written(token_pieces(docs, path, end_id, window), "pieces")
    per_task = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = per_task.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    # At most one row per length up to the window, whatever the number of documents.
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    full = counts.pop(window, 0)
    runs = best_fit_decreasing(counts, window)
    used = 1 + max((first + number - 1 for _, _, number, first, _ in runs), default=-1)
    runs = sorted([*runs, *([(window, 0, full, used, 0)] if full else [])])
    plan = np.array(runs, dtype=np.int64).reshape(-1, 5)
    keys = plan[:, 0] << 44 | plan[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        ranks = rank.to_numpy(np.int64)
        run = np.searchsorted(keys, length.to_numpy(np.int64) << 44 | ranks, side="right") - 1
        found = plan[run]
        return pd.DataFrame({"sequence_id": found[:, 3] + ranks - found[:, 1], "offset": found[:, 4]})

    ranked = pieces.select("part", "length", "ord").join(bases.select("part", "length", "base"), ["part", "length"])
    placed = ranked.withColumn("place", place("length", F.col("base") + F.col("ord")))
    return Packed(pieces, placed.select("part", "length", "ord", "place.sequence_id", "place.offset"))


def packed_rows(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """A row for each piece: where it comes from, a checksum of its ids, and its place."""
    pieces, places = pack(docs, path, end_id)
    digests = pieces.select("part", "length", "ord", "doc_id", "start", "doc_tokens", F.crc32("ids").alias("ids_crc32"))
    joined = digests.join(places, ["part", "length", "ord"])
    return joined.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def packed_ids(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """:func:`packed_rows` with the ids themselves, as little-endian unsigned 32-bit integers: a sequence
    is its pieces in order of ``offset``."""
    pieces, places = pack(docs, path, end_id)
    joined = pieces.withColumn("ids_crc32", F.crc32("ids")).join(places, ["part", "length", "ord"])
    return joined.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_rows(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2)
