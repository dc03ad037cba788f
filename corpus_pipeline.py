"""From raw documents to packed training sequences, in four stages of the training-data operators.

Each stage takes the table that the one before it wrote. The first three keep the columns of
``documents``; the last returns a row for each piece of a packed sequence, with its token ids. Null
texts count as empty, repeated rows are near-duplicates of one another, further columns are carried
along whatever their names, and an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsignals.llm.common import table, written
from opsignals.llm.near_dups import one_of_each
from opsignals.llm.packing import packed_ids
from opsignals.llm.quality import ACCEPT, fit_quality, held_out, score_quality
from opsignals.llm.suffix_dedup import without_repeats
from opsignals.llm.tokens import tokenizer_file


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the labels of three quarters, accepts. With no
    labels, or labels of one kind only, there is nothing to tell documents apart by: all stay."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    learn = labels.filter(~held_out(F.col("doc_id")))
    fitted = fit_quality(docs.filter(~held_out(F.col("doc_id"))), learn)
    if not fitted.learnt:
        return docs
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    kept = score_quality(rows, fitted, "score").filter(F.col("score") >= ACCEPT)
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 100 bytes and more that an earlier one has."""
    short = without_repeats(docs)
    return short.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else short


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 4096: a row for each piece of a document, with its ids and its place."""
    return packed_ids(docs, tokenizer_file("word_bpe_49k.json"), end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("packing", pack_sequences),
]

# SQL has no classifier, no weighted sampling and no byte-pair merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
