"""Searches against brute force, the classifier against held-out labels, the pipeline end to end."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opsignals.llm import inner_product, neighbours, quality
from opsignals.llm.blocks import finite_vectors
from opsignals.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, score string, part string, key string, block string"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=12)).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(700)]  # a vector that a third share
    rows += [(3000 + 50 * i, rng.normal(size=5).tolist()) for i in range(8)]  # another dimension
    rows += [(4000, None), (4050, []), (4100, [0.0] * 12), (4150, [1.0] * 11 + [float("nan")]), (4200, [1.0] * 11 + [None])]
    rows += [(None, rows[1][1]), (5000, [float("inf")] * 12), (100, rows[100][1]), (7, rows[7][1])]
    return spark.createDataFrame([(i, v, "s", "p", "k", "b") for i, v in rows], SCHEMA)


def usable(table, zero=True):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in table.collect() if r.vec_id is not None and r.embedding and None not in r.embedding]
    return [(i, v) for i, v in rows if np.isfinite(v).all() and (zero or v.any())]


def test_largest_products_are_exact(spark, vectors):
    found = finite_vectors(vectors).select("vec_id", F.transform("vector", lambda x: F.floor(x * 256).cast("double")).alias("vector"))
    got = {}
    for r in inner_product.largest_products(found, found.filter("vec_id % 50 = 0"), 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    rows = [(i, np.floor(256 * v).astype(int)) for i, v in usable(vectors)]
    queries = {i: v for i, v in rows if i % 50 == 0}
    assert set(got) == {q for q in queries if any(len(v) == len(queries[q]) and i != q for i, v in rows)}
    for q, v in queries.items():
        scores = sorted((-int(v @ w), i) for i, w in rows if i != q and len(w) == len(v))[:5]
        assert sorted(got[q]) == [(n, i, -s) for n, (s, i) in enumerate(scores, 1)]


def test_large_components_stay_exact():
    big = np.array([[2.0**40, -(2.0**41), 3.0]])
    assert inner_product.products(big, big)[0, 0] == min((1 << 80) + (1 << 82) + 9, (1 << 63) - 1)
    assert inner_product.products(big[:, 2:], big[:, 2:])[0, 0] == 9


@pytest.mark.parametrize("seed", range(3))
def test_pruning_loses_nothing(seed):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(500, 8)) * rng.random((500, 1)) * 100
    lengths = np.sqrt((vectors**2).sum(axis=1))
    vectors, lengths = vectors[np.argsort(-lengths)], np.sort(lengths)[::-1]
    for query in rng.normal(size=(20, 8)):
        products = vectors @ query
        mark = np.sort(products)[-5]
        kept = inner_product.survivors(query, np.sqrt(query @ query), mark, vectors, lengths)
        assert set(np.flatnonzero(products >= mark)) <= set(kept.tolist())


def test_neighbours_are_near(spark, vectors):
    found = finite_vectors(vectors).filter(F.exists("vector", lambda x: x != 0))
    got = {}
    for r in neighbours.nearest(found, found.filter("vec_id % 100 = 0"), 10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    rows = usable(vectors, zero=False)
    queries = {i: v for i, v in rows if i % 100 == 0}
    hits = total = 0
    for q, v in queries.items():
        want = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in rows if i != q and len(w) == len(v))[:10]
        own = sorted(got.get(q, []))
        assert [r[0] for r in own] == list(range(1, len(own) + 1)) and own == sorted(own, key=lambda r: (r[1], r[2]))
        hits += len({i for _, _, i in own} & {i for _, i in want})
        total += len(want)
    assert hits >= 0.95 * total
    empty = found.filter("false")
    assert neighbours.nearest(empty, empty, 10).count() == 0
    assert inner_product.largest_products(empty, empty, 5).count() == 0


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(9)
    points = np.concatenate([rng.normal(size=(100, 4)) + 8 * k for k in range(4)])
    graph = neighbours.neighbour_graph(points, 5)
    part = neighbours.balanced_parts(points, graph, 4)
    assert np.bincount(part).max() <= 110
    assert (part[graph] == part[:, None]).mean() > 0.9


def test_quality_on_held_out_labels(spark):
    rows = quality.op10_quality(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    held = rows.join(labels, "doc_id").filter("held_out").collect()
    assert len(held) > 50 and np.mean([r.predicted == r.quality for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.collect())


def test_quality_of_odd_tables(spark, documents, odd_rows):
    docs = documents(odd_rows)
    labels = spark.createDataFrame([(1, 1), (5, 1), (7, 0), (8, 0), (8, 1), (9, None), (None, 1), (77, 0)], "doc_id long, label int")
    for known in (labels, labels.filter("label = 1"), labels.filter("false")):
        scored = quality.score_quality(docs, quality.fit_quality(docs, known), "_score")
        assert scored.columns == [*docs.columns, "_score"] and scored.count() == len(odd_rows)
        assert all(0 <= r._score <= 1 for r in scored.collect())
    none = documents([])
    assert quality.score_quality(none, quality.fit_quality(none, labels), "_score").count() == 0


def test_hinge_weights_separate():
    rng = np.random.default_rng(1)
    positive = rng.random(400) < 0.8
    rows = [np.unique(np.concatenate((rng.integers(0, 50, 8), [60 if p else 61]))) for p in positive]
    weights, bias = quality.descend(rows, np.ones(64), positive)
    assert all((weights[r].sum() / np.sqrt(len(r)) + bias > 0) == p for r, p in zip(rows, positive))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_pipeline_stages_follow_one_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, steps = docs.count(), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.schema.names == docs.schema.names
        steps.append(out.count())
        docs = out
    assert before > steps[0] > steps[1] == steps[2] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
