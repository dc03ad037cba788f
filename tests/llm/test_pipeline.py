"""Each stage of the pipeline against brute force on the stage's own input, and its odd inputs."""

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from opsignals.llm import near_dups, quality
from opsignals.llm.common import written
from opsignals.llm.queries import QUERIES
from opsignals.llm.tokens import tokenizer_file
from test_dedup import brute_spans

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
NAMES = ["_at", "_score", "_node", "_copy", "_number", "_sha", "_kept", "at", "sha", "kept", "row", "node", "copy", "score", "number", "is_first"]


@pytest.fixture(scope="module")
def tables(spark):
    """What each stage is given, and what the last one returns, over documents with columns that clash."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit(f"own {c}") for c in NAMES})
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def rows_of(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


def test_columns_of_the_caller_come_through(tables):
    for df in tables[1:-1]:
        assert df.columns == tables[0].columns
        assert df.select(NAMES).distinct().collect() == [tuple(f"own {c}" for c in NAMES)]


def test_quality_keeps_what_the_classifier_accepts(spark, tables):
    scored = QUERIES["op10_quality"](spark, SF).collect()
    assert set(rows_of(tables[1])) == {r.doc_id for r in scored if r.predicted == 1} and len(scored) > len(rows_of(tables[1])) > 0


def test_one_document_of_each_class_stays(tables):
    texts = sorted(rows_of(tables[1]).items())
    idf = near_dups.scaled_idf(*near_dups.document_frequency(tables[1]))
    keys, weights, ends = near_dups.weighted_runs(pa.array([t for _, t in texts]), idf)
    sets = [(keys[a:b], weights[a:b]) for a, b in zip(ends, ends[1:])]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        alike = texts[i][1] == texts[j][1] or (len(sets[i][0]) and len(sets[j][0]) and near_dups.weighted_jaccard(sets[i], sets[j]) >= 0.8)
        if alike:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    assert sorted(rows_of(tables[2])) == [texts[i][0] for i in range(len(texts)) if find(i) == i]
    assert len(rows_of(tables[2])) < len(texts)


def test_repeated_bytes_are_cut(tables):
    left = rows_of(tables[3])
    for doc, text, gone in brute_spans(list(rows_of(tables[2]).items())):
        data = np.frombuffer(text.encode(), np.uint8)[~gone].tobytes()
        assert left[doc] == data.decode(errors="replace").replace("�", "")


def test_sequences_hold_all_ids_of_what_is_left(tables):
    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    pieces = tables[4].collect()
    for doc, text in rows_of(tables[3]).items():
        own = sorted((p for p in pieces if p.doc_id == doc), key=lambda p: p.start)
        ids = np.frombuffer(b"".join(bytes(p.ids) for p in own), "<u4").tolist()
        assert ids == [*library.encode(text, add_special_tokens=False).ids, 2] and {p.doc_tokens for p in own} == {len(ids)}
    for _, of_sequence in itertools.groupby(sorted(pieces, key=lambda p: (p.sequence_id, p.offset)), key=lambda p: p.sequence_id):
        at = 0
        for piece in of_sequence:
            assert piece.offset == at
            at += piece.length
        assert at <= 4096
    used = sum(p.length for p in pieces)
    assert used <= 4096 * (1 + max(p.sequence_id for p in pieces)) < used + 2 * 4096


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, node string")


@pytest.mark.parametrize("name", STAGES)
def test_an_empty_table_stays_empty(spark, empty, name):
    out = STAGES[name](spark, empty, SF)
    assert out.collect() == [] and (name == "packing" or out.columns == empty.columns)


@pytest.mark.parametrize("labels", [[], [(i, 1) for i in range(50)], [(i, 0) for i in range(50)]])
def test_without_two_kinds_of_labels_all_documents_stay(spark, tmp_path, labels):
    spark.createDataFrame(labels, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.LongType())])).write.parquet(
        str(tmp_path / "labels.parquet")
    )
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert corpus_pipeline.keep_quality(spark, docs, str(tmp_path)).count() == docs.count()


def test_null_texts_and_ids_pass_the_stages(spark, empty):
    rows = [(None, None, "en", "s", 0, "x"), (1, None, None, None, None, None), (1, None, None, None, None, None), (2, "word " * 40_000, "en", "s", 1, "y")]
    docs = spark.createDataFrame(rows, empty.schema)
    assert sorted(str(r.doc_id) for r in STAGES["near_duplicates"](spark, docs, SF).collect()) == ["2", "None"]
    cut = STAGES["repeats"](spark, docs, SF).collect()
    assert len(cut) == 4 and {r.doc_id: r.n_chars for r in cut}[2] < 250
    assert hashlib.sha256(b"").hexdigest() and quality.ACCEPT == 0.7
    assert STAGES["packing"](spark, docs, SF).filter("doc_id IS NULL").count() == 1
