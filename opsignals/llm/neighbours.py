"""Approximate nearest neighbours by learned partitions (operator 1).

On a sample of at most ``SAMPLE`` rows a graph of nearest neighbours is built and cut into balanced
parts: halves along the main direction, refined by moving nodes to the part most of their neighbours
are in, as far as its size allows. A small network learns to tell a vector's neighbours' parts from
the vector. Every row is filed under its most probable part; a query is sent to its most probable
parts until they hold ``mass`` of its probability, and all rows there are ranked by their exact
distance. The number of parts follows from the number of rows, up to ``MOST_PARTS``.

Rows that are null, zero, without id or hold a null or non-finite component take no part. Vectors of
another dimension than most rows have are ranked against all of their own dimension. Repeated rows
are candidates each; a candidate with the query's id is its own row, and an id that occurs twice
among queries is searched once, by its least vector. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opsignals.llm.blocks import against, best, finite_vectors, packed
from opsignals.llm.common import small_batches, table

SAMPLE, GRAPH_DEGREE = 6000, 10
ROWS_PER_PART, MOST_PARTS = 2000, 64
MASS, LEAST_PARTS = 0.98, 2
BLOCK, QUERY_BLOCK = 2048, 256


class Router(NamedTuple):
    """A network with one hidden layer over centred, scaled vectors; gives a probability to each part."""

    mean: np.ndarray
    scale: float
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: np.ndarray

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        hidden = np.maximum((vectors - self.mean) / self.scale @ self.inner + self.inner_bias, 0)
        z = hidden @ self.outer + self.outer_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def neighbour_graph(points: np.ndarray, degree: int) -> np.ndarray:
    """Each point's nearest other points, a block of rows at a time."""
    squares = (points * points).sum(axis=1)
    out = []
    for i in range(0, len(points), 512):
        d = squares[None] - 2 * points[i : i + 512] @ points.T
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        out.append(np.argpartition(d, min(degree, len(points) - 2), axis=1)[:, :degree])
    return np.concatenate(out)


def balanced_parts(points: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.1, passes: int = 12) -> np.ndarray:
    """A part for each point: sizes within ``slack`` of equal, few edges between parts."""
    rng = np.random.default_rng(1)
    part = np.zeros(len(points), np.int64)
    todo = [(np.arange(len(points)), 0, parts)]
    while todo:
        at, first, number = todo.pop()
        if number == 1 or len(at) < 2:
            part[at] = first
            continue
        centred = points[at] - points[at].mean(axis=0)
        along = centred @ np.linalg.svd(centred[:2000], full_matrices=False)[2][0]
        left = number // 2
        order = np.argsort(along, kind="stable")
        cut = len(at) * left // number
        todo += [(at[order[:cut]], first, left), (at[order[cut:]], first + left, number - left)]
    most = int(np.ceil(slack * len(points) / parts))
    sizes = np.bincount(part, minlength=parts)
    links = [set(row) for row in graph.tolist()]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            links[j].add(i)
    near = [np.fromiter(s, np.int64, len(s)) for s in links]
    for _ in range(passes):
        moved = 0
        for i in rng.permutation(len(points)):
            votes = np.bincount(part[near[i]], minlength=parts)
            votes[(sizes >= most) & (np.arange(parts) != part[i])] = -1
            to = int(votes.argmax())
            if votes[to] > votes[part[i]]:
                sizes[part[i]] -= 1
                sizes[to] += 1
                part[i] = to
                moved += 1
        if moved < len(points) // 500:
            break
    return part


def learned_router(points: np.ndarray, target: np.ndarray, hidden: int = 96, epochs: int = 40) -> Router:
    """Cross-entropy against ``target`` (a row of part shares per point), by Adam."""
    rng = np.random.default_rng(2)
    mean, scale = points.mean(axis=0), float(points.std()) or 1.0
    x = (points - mean) / scale
    weights = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, target.shape[1])), np.zeros(target.shape[1])]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 128):
            at = order[i : i + 128]
            inner = np.maximum(x[at] @ weights[0] + weights[1], 0)
            z = inner @ weights[2] + weights[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (p / p.sum(axis=1, keepdims=True) - target[at]) / len(at)
            back = dz @ weights[2].T * (inner > 0)
            slopes = [x[at].T @ back + 1e-4 * weights[0], back.sum(axis=0), inner.T @ dz + 1e-4 * weights[2], dz.sum(axis=0)]
            step += 1
            for w, g, m, v in zip(weights, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Router(mean, scale, *weights)


def fit_router(vectors: DataFrame, size: int, parts: int, sample: int = SAMPLE) -> Router:
    """From at most ``sample`` rows of dimension ``size``, drawn by a hash of their ids."""
    n = vectors.filter(F.size("vector") == size).count()
    draw = F.shiftrightunsigned(F.xxhash64("vec_id", F.lit("sample")), 11) / float(1 << 53)
    some = vectors.filter((F.size("vector") == size) & (draw < 1.5 * sample / n))
    rows = some.orderBy(F.xxhash64("vec_id", F.lit("sample")), "vec_id").limit(sample).select("vector").toPandas()
    points = np.stack(rows["vector"].to_numpy())
    parts = max(1, min(parts, len(points) // (2 * GRAPH_DEGREE)))
    if parts == 1:
        return learned_router(points, np.ones((len(points), 1)), epochs=1)
    graph = neighbour_graph(points, GRAPH_DEGREE)
    part = balanced_parts(points, graph, parts)
    shares = np.zeros((len(points), parts))
    np.add.at(shares, (np.repeat(np.arange(len(points)), graph.shape[1]), part[graph].ravel()), 1.0)
    shares[np.arange(len(points)), part] += 1.0
    return learned_router(points, shares / shares.sum(axis=1, keepdims=True))


def nearest(vectors: DataFrame, queries: DataFrame, k: int, mass: float = MASS) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the ``k`` nearest rows found.
    Both have vec_id and vector (array of double)."""
    spark = vectors.sparkSession
    small_batches(spark)
    by_size = vectors.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    top = by_size.orderBy(F.desc("n"), "size").first()
    if top is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = top["size"]
    router = fit_router(vectors, size, min(MOST_PARTS, max(1, round(top["n"] / ROWS_PER_PART))))

    def probable(share: float, least: int):
        @F.pandas_udf("array<int>")
        def parts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                out = np.empty(len(batch), object)
                own = np.array([len(v) == size for v in batch], bool)
                for i in np.flatnonzero(~own):
                    out[i] = [-1]
                if own.any():
                    p = router.probabilities(np.stack(batch[own].to_numpy()))
                    order = np.argsort(-p, axis=1, kind="stable")
                    before = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1) - np.take_along_axis(p, order, axis=1)
                    number = np.maximum(least, (before < share).sum(axis=1))
                    for i, row, m in zip(np.flatnonzero(own), order, number, strict=True):
                        out[i] = row[:m].tolist()
                yield pd.Series(out)

        return parts("vector")

    filed = vectors.withColumn("part", F.element_at(probable(0.0, 1), 1))
    once = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    sent = once.select("vec_id", "vector", F.explode(probable(mass, LEAST_PARTS)).alias("part"))
    # Another dimension is a part of its own, below all others.
    part = F.when(F.col("part") < 0, -F.size("vector")).otherwise(F.col("part"))
    candidates = packed(filed, part, F.lit(0), BLOCK, "parts")
    asked = packed(sent, part, F.lit(0), QUERY_BLOCK, "queries")

    def search(query: dict, block: dict):
        q, c, ids = query["matrix"], block["matrix"], block["ids"]
        rough = (q * q).sum(axis=1)[:, None] - 2 * q @ c.T + (c * c).sum(axis=1)[None]
        rough[query["ids"][:, None] == ids[None]] = np.inf
        least = np.partition(rough, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
        slack = 1e-9 * ((q * q).sum(axis=1) + (c * c).sum(axis=1).max())
        row, at = np.nonzero((rough <= np.where(np.isfinite(least), least + slack, np.inf)[:, None]) & np.isfinite(rough))
        exact = np.sqrt(((q[row] - c[at]) ** 2).sum(axis=1))
        kept = best(row, ids[at], exact, k)
        return query["ids"][row[kept]], ids[at[kept]], exact[kept]

    pairs = asked.select(F.col("block").alias("q"), "key").join(candidates.select("block", "key"), "key").select("q", "block")
    found = against(asked, candidates, pairs, search, "distances")
    in_order = W.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op1_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = finite_vectors(table(spark, sf_dir, "embeddings")).filter(F.exists("vector", lambda x: x != 0))
    return nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)
