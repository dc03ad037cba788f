"""Token counts through a digest cache (operator 7).

The cache is a Parquet table of (content digest, tokenizer digest, number of tokens). Texts are
normalised by what the tokenizer can't see, digested, and joined to it; one text of each missing
digest is encoded, and its count appended. A tokenizer file that changes has another digest and so
other entries.

A null text counts as an empty one. Repeated ids and repeated texts keep a row each. A cache row
that was written twice (two jobs at once) counts once. Other columns are left behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsignals.llm.common import shared_folder, slices, small_batches, table, texts, written
from opsignals.llm.tokens import library_memo, tokenizer_file

CACHE = "content binary, tokenizer string, n_tokens long"
LIMIT = 2048


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def normalised(text: Column, drops_space: bool) -> Column:
    """Runs of blanks as one space, for tokenizers that drop white space; else the text itself."""
    return F.trim(F.regexp_replace(text, "[ \\t\\r\\n]+", " ")) if drops_space else text


def cached(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """The stored counts of one tokenizer; none if there is no cache yet."""
    try:
        stored = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException:
        stored = spark.createDataFrame([], CACHE)
    return stored.filter(F.col("tokenizer") == tokenizer).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, path: str, cache: str, drops_space: bool = True) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every whole text; ``cache`` gains what it lacked."""
    spark = docs.sparkSession
    small_batches(spark)
    version = tokenizer_digest(path)
    whole = texts(docs)
    same = normalised(F.col("text"), drops_space)
    keyed = written(
        whole.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.unhex(F.sha2(same, 256)).alias("content")), "digests"
    )
    missing = (
        keyed.groupBy("content")
        .agg(F.min(F.struct("doc_id")).alias("first"))
        .join(cached(spark, cache, version), "content", "left_anti")
        .select("first.doc_id", F.col("content").alias("wanted"))
    )
    # A repeated id may carry several texts, so the digest decides; equal rows come one after the other.
    one = whole.join(missing, whole.doc_id.eqNullSafe(missing.doc_id)).filter(
        F.unhex(F.sha2(same, 256)) == F.col("wanted")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, last = library_memo(path), None
        for batch in slices(batches, "text"):
            wanted = batch.column("wanted").to_pylist()
            batch = batch.take(pa.array([i for i, w in enumerate(wanted) if w != (wanted[i - 1] if i else last)], pa.int64()))
            last = wanted[-1]
            ends = memo.ids(batch.column("text"))[1]
            yield pa.RecordBatch.from_arrays([batch.column("wanted"), pa.array(np.diff(ends), pa.int64())], ["content", "n_tokens"])

    counted = one.select("wanted", "text").mapInArrow(count, "content binary, n_tokens long")
    counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    return keyed.join(cached(spark, cache, version), "content").select("doc_id", "n_bytes", "n_tokens")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(
        table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), shared_folder(spark, "token-counts")
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
