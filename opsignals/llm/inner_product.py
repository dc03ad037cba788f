"""Exact largest inner products by norm-bucketed retrieval (operator 8).

Vectors are ordered by length and cut into buckets. Each query is first held against the bucket of
the longest vectors of its dimension, which gives it a threshold: its k-th best product there. Every
other bucket then asks for a cosine of at least threshold / (query's length * longest length in the
bucket). Over 1 the bucket is skipped for the query; where it is small, only vectors long enough
are kept (length pruning); where it is large, a vector must also have its coordinates in the range
that such a cosine leaves for the query's largest coordinates (coordinate pruning). What is left is
verified by its product. Pruning is exact, and products are integers.

Vectors that are null, empty or hold a null or non-finite component take no part, nor do rows
without an id; zero vectors do. Vectors meet those of their own dimension. An id that occurs twice
among queries is searched once, by its least vector; a candidate with the query's id is its own row.
Repeated candidates count each. Components beyond 2**52 after scaling are cut to it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opsignals.llm.blocks import against, best, finite_vectors, packed
from opsignals.llm.common import small_batches, table, written

BUCKET, QUERY_BLOCK = 2048, 256
COORDINATE_COSINE, FOCUS = 0.45, 3
_EXACT = 1 << 53


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of integer-valued matrices, exact: in doubles while sums stay under 2**53,
    else in Python's integers, cut to 64 bits."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if largest < _EXACT:
        return (queries @ vectors.T).astype(np.int64)
    whole = queries.astype(np.int64).astype(object) @ vectors.astype(np.int64).astype(object).T
    return np.clip(whole, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def survivors(query: np.ndarray, length: float, threshold: float, vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows of a bucket (longest first) whose product with the query may reach ``threshold``."""
    if threshold <= 0 or not length:
        return np.arange(len(vectors))
    slack = 1e-9
    enough = int(np.searchsorted(-lengths, -(threshold / length) * (1 - slack), side="right"))
    if not enough:
        return np.arange(0)
    cosine = min(1.0, threshold / (length * lengths[0]))
    if cosine < COORDINATE_COSINE:
        return np.arange(enough)
    kept = np.arange(enough)
    for f in np.argsort(-np.abs(query))[:FOCUS]:
        share = query[f] / length
        spread = np.sqrt(max(0.0, (1 - cosine**2) * (1 - share**2)))
        part = vectors[kept, f] / lengths[kept]
        low, high = cosine * share - spread - slack, cosine * share + spread + slack
        # A range that reaches past the coordinate's own pole has no bound on that side.
        high = np.inf if share > cosine else high
        low = -np.inf if -share > cosine else low
        kept = kept[(part >= low) & (part <= high)]
    return kept


def largest_products(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` largest products of each query with all other
    rows, ties to the smaller id. Both have vec_id and vector, of integers held as doubles."""
    spark = vectors.sparkSession
    small_batches(spark)
    squared = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    buckets = packed(vectors, F.size("vector"), F.sqrt(squared), BUCKET, "buckets")
    once = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = packed(once, F.size("vector"), F.sqrt(squared), QUERY_BLOCK, "queries")

    def search(query: dict, bucket: dict):
        found, rows = [], []
        matrix, ids = bucket["matrix"], bucket["ids"]
        lengths = np.sqrt((matrix * matrix).sum(axis=1))
        q_lengths = np.sqrt((query["matrix"] * query["matrix"]).sum(axis=1))
        marks = np.frombuffer(query["marks"], "<i8") if query.get("marks") else np.full(len(query["ids"]), -1 << 62)
        possible = np.flatnonzero((marks <= 0) | (marks <= q_lengths * lengths[0] * (1 + 1e-9)))
        kept = {int(i): survivors(query["matrix"][i], q_lengths[i], float(marks[i]), matrix, lengths) for i in possible}
        full = [i for i in kept if len(kept[i]) * 4 > len(ids)]
        dense = dict(zip(full, products(query["matrix"][full], matrix), strict=True)) if full else {}
        for i, at in kept.items():
            score = dense[i][at] if i in dense else products(query["matrix"][i : i + 1], matrix[at])[0]
            fine = (score >= marks[i]) & (ids[at] != query["ids"][i])
            at, score = at[fine], score[fine]
            if len(score) > 4 * k:
                top = score >= np.partition(score, len(score) - k)[len(score) - k]
                at, score = at[top], score[top]
            rows.append(np.full(len(at), i))
            found.append((ids[at], score))
        if not rows:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        row, vec, score = np.concatenate(rows), np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        top = best(row, vec, -score, k)
        return query["ids"][row[top]], vec[top], score[top]

    longest = buckets.groupBy("key").agg(F.max_by("block", F.struct("high", "size", -F.col("block"))).alias("block"))
    first = asked.select(F.col("block").alias("q"), "key").join(longest, "key").select("q", "block")
    seeds = against(asked, buckets, first, search, "seed-products")
    in_order = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    marks = seeds.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") == k).select("query_id", F.col("score").alias("mark"))
    marked = with_marks(asked, marks)
    # Blocks of queries against blocks of vectors: their number is the queries' by the rows', over
    # half a million, and a bucket too short for all of a block's queries isn't asked.
    others = (
        marked.select(F.col("block").alias("q"), "key", "reach")
        .join(buckets.select("block", "key", "high"), "key")
        .join(longest.select("block"), "block", "left_anti")
        .filter(F.col("high") * (1 + 1e-9) >= F.col("reach"))
        .select("q", "block")
    )
    found = seeds.unionByName(against(marked.drop("reach"), buckets, others, search, "products"))
    return found.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def with_marks(asked: DataFrame, marks: DataFrame) -> DataFrame:
    """The blocks of queries with each query's threshold, and the least length that can matter."""
    spark = asked.sparkSession

    def unpack(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), row["block"])), pa.array(ids), pa.array(np.arange(len(ids)))], ["block", "query_id", "at"])

    def pack(key, frame):
        import pandas as pd

        frame = frame.sort_values("at")
        return pd.DataFrame({"block": [key[0]], "marks": [frame["mark"].to_numpy("<i8").tobytes()]})

    each = asked.select("block", "ids").mapInArrow(unpack, "block long, query_id long, at long")
    joined = each.join(marks, "query_id", "left").select("block", "at", F.coalesce("mark", F.lit(-1 << 62)).alias("mark"))
    packed_marks = joined.groupBy("block").applyInPandas(pack, "block long, marks binary")  # QUERY_BLOCK rows each

    def reach(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                count = len(row["ids"]) // 8
                matrix = np.frombuffer(row["matrix"], "<f8").reshape(count, -1)
                mark = np.frombuffer(row["marks"], "<i8").astype(float)
                lengths = np.sqrt((matrix * matrix).sum(axis=1))
                least = np.where((mark > 0) & (lengths > 0), mark / np.maximum(lengths, 1e-300), 0.0).min()
                yield pa.RecordBatch.from_pylist([row | {"reach": float(least)}], schema=batch.schema.append(pa.field("reach", pa.float64())))

    schema = f"{asked.schema.simpleString()[7:-1].replace(':', ' ')}, marks binary, reach double".replace("bigint", "long")
    return written(asked.join(packed_marks, "block").mapInArrow(reach, schema), "marked")


def op8_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound = float(1 << 52)
    scaled = F.transform("vector", lambda x: F.greatest(F.least(F.floor(x * 256).cast("double"), F.lit(bound)), F.lit(-bound)))
    vectors = finite_vectors(table(spark, sf_dir, "embeddings")).select("vec_id", scaled.alias("vector"))
    return largest_products(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)
