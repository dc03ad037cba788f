"""What the operators share: the given tables, written tables in the shared folder, small batches."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsignals.shipping import ship
from opsignals.streaming.state import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids and whole texts; a null text is an empty one. Further columns stay behind."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends there, and a lost executor
    costs a read. Ids drawn before it stay what they are."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """For jobs with Python workers: they get this package, and batches of fewer rows than Spark's
    10,000, as texts are kilobytes."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 6 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``limit`` bytes of the named text or binary column: small ones
    are joined, large ones cut. A batch holds one row at least, and no empty batch comes out."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            if size and size + (n or 0) > limit:
                yield pa.concat_batches([*held, batch.slice(at, i - at)])
                held, size, at = [], 0, i
                pa.default_memory_pool().release_unused()
            size += n or 0
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield pa.concat_batches(held)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sha256_hex(column: Column) -> Column:
    return F.sha2(column, 256)


@contextmanager
def few_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of so few rows to Python workers, for what is run and written inside: rows of megabytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    small_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)
