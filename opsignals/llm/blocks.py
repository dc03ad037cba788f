"""Vectors packed into blocks, and a set of queries held against them block by block.

A block is one row: a key, the ids and a matrix of up to ``rows`` vectors. Rows are dealt out by
ranges of (key, order, id), so a key or a vector that a third of all rows share fills many blocks in
many tasks. A block of queries meets a block of candidates in a join on their numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsignals.llm.common import few_rows, tasks, written

_SCHEMA = "block long, key long, size long, low double, high double, ids binary, matrix binary"


def finite_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector (array of double) of the rows that have an id and a vector of finite components."""
    v = F.col(vector).cast("array<double>")
    inf = F.lit(float("inf"))
    fine = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < inf), F.lit(False)))
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vector"))
    return rows.filter(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & fine)


def packed(vectors: DataFrame, key: Column, order: Column, rows: int, name: str) -> DataFrame:
    """Blocks of ``rows`` vectors of one length and one key, in descending order of ``order``;
    low and high are the bounds of ``order`` in a block. vectors: vec_id, vector."""
    spark = vectors.sparkSession

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            nonlocal at, held
            ids = np.array([r[1] for r in held], "<i8")
            matrix = np.array([r[3] for r in held], "<f8")
            orders = [r[2] for r in held]
            row = [at, held[0][0], matrix.shape[1], min(orders), max(orders), ids.tobytes(), matrix.tobytes()]
            kinds = [pa.int64()] * 3 + [pa.float64()] * 2 + [pa.binary()] * 2
            at, held = at + 1, []
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], ["block", "key", "size", "low", "high", "ids", "matrix"])

        for batch in batches:
            lists = batch.column("vector")
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "vec_id", "ord")), lists.to_pylist()):
                if held and (len(held) == rows or row[0] != held[0][0] or len(row[3]) != len(held[0][3])):
                    yield block()
                held.append(row)
        if held:
            yield block()

    keyed = vectors.select(key.cast("long").alias("key"), order.cast("double").alias("ord"), "vec_id", "vector")
    by = [F.asc("key"), F.size("vector").asc(), F.desc("ord"), F.asc("vec_id")]
    dealt = keyed.repartitionByRange(tasks(spark), *by).sortWithinPartitions(*by)
    return written(dealt.mapInArrow(pack, _SCHEMA), name)


def against(
    queries: DataFrame,
    candidates: DataFrame,
    pairs: DataFrame,
    search: Callable[[dict, dict], tuple[np.ndarray, np.ndarray, np.ndarray]],
    name: str,
) -> DataFrame:
    """query_id, vec_id and score that ``search`` finds in each pair (q, block) of blocks."""
    spark = queries.sparkSession
    q = queries.select([F.col(c).alias("q" if c == "block" else f"q_{c}") for c in queries.columns])
    met = pairs.join(q, "q").join(candidates, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                one = {k[2:]: v for k, v in row.items() if k.startswith("q_")}
                ids, others, scores = search(_opened(one), _opened({k: v for k, v in row.items() if k[:2] != "q_"}))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(others, pa.int64()), pa.array(scores)], ["query_id", "vec_id", "score"])

    kind = "long" if name.endswith("products") else "double"
    with few_rows(spark, 8):
        return written(met.mapInArrow(run, f"query_id long, vec_id long, score {kind}"), name)


def _opened(block: dict) -> dict:
    ids = np.frombuffer(block["ids"], "<i8")
    return block | {"ids": ids, "matrix": np.frombuffer(block["matrix"], "<f8").reshape(len(ids), -1)}


def best(rows: np.ndarray, ids: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the ``k`` least of their row by (key, id)."""
    order = np.lexsort((ids, keys, rows))
    first = np.searchsorted(rows[order], np.arange(rows.max() + 1 if len(rows) else 0))
    place = np.arange(len(order)) - first[rows[order]]
    return order[place < k]
