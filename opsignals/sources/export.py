"""Signals as JSON documents in the shape of their endpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsignals.operators.running import running, sequence_segment, time_segment

SECONDS, MILLIS = "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
# Endpoint, the keys that are written even when null, and the time format.
ENDPOINTS = {
    "errors": ("events", ("release", "server_name"), SECONDS),
    "changes": ("changes", (), MILLIS),
    "perf_samples": ("performance_samples", ("release",), SECONDS),
    "metrics": ("custom_metrics", ("release",), SECONDS),
    "infra_metrics": ("infrastructure_metrics", (), SECONDS),
    "spans": ("spans", ("parent_span_id", "release"), MILLIS),
}
# Fixed value: most entries in one payload.
MAX_ITEMS = 1000


def item_json(df: DataFrame, signal: str, columns: Sequence[str]) -> Column:
    """One record as JSON. Spark leaves nulls out, so a key that must show an explicit null is
    put back in front of the closing brace."""
    _, explicit, fmt = ENDPOINTS[signal]
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def field(name: str) -> Column:
        is_time = isinstance(kinds[name], (T.TimestampType, T.TimestampNTZType))
        return (F.date_format(name, fmt) if is_time else F.col(name)).alias(name)

    body = F.to_json(F.struct(*[field(c) for c in columns]))
    nulls = F.array_compact(
        F.array(*[F.when(F.col(c).isNull(), F.lit(f'"{c}":null')) for c in columns if c in explicit])
        if any(c in explicit for c in columns)
        else F.array().cast("array<string>")
    )
    inner = F.substring(body, 2, F.length(body) - 2)
    parts = F.concat(F.when(inner != "", F.array(inner)).otherwise(F.array().cast("array<string>")), nulls)
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))


def single_documents(df: DataFrame, signal: str, columns: Sequence[str]) -> DataFrame:
    """Events and changes: one document each."""
    return df.select(
        F.lit(ENDPOINTS[signal][0]).alias("endpoint"),
        item_json(df, signal, columns).alias("document"),
        F.lit(1).cast("long").alias("items"),
    )


def batched_documents(
    df: DataFrame,
    signal: str,
    columns: Sequence[str],
    batch: Sequence[str],
    order: Sequence[str],
    *,
    wrapper: str,
    segment: Column | None = None,
    max_items: int = MAX_ITEMS,
) -> DataFrame:
    """Samples and metrics: ``{"samples": [..]}``, at most ``max_items`` records a document.

    Records are numbered within their batch by a running sum, so a batch of any size is cut
    into documents of bounded size and no group is collected whole.
    """
    segment = time_segment(order[0]) if segment is None else segment
    items = df.select(*dict.fromkeys([*batch, *order]), item_json(df, signal, columns).alias("item"))
    numbered = running(items, batch, order, segment, {"number": ("sum", F.lit(1).cast("long"))})
    part = F.floor((F.col("number") - 1) / max_items).alias("part")
    listed = numbered.groupBy(*batch, part).agg(
        F.sort_array(F.collect_list(F.struct("number", "item"))).alias("rows"), F.count(F.lit(1)).alias("items")
    )
    joined = F.array_join(F.transform("rows", lambda r: r["item"]), ",")
    return listed.select(
        F.lit(ENDPOINTS[signal][0]).alias("endpoint"),
        F.concat(F.lit(f'{{"{wrapper}":['), joined, F.lit("]}")).alias("document"),
        "items",
    )


def trace_documents(spans: DataFrame, columns: Sequence[str], *, max_items: int = MAX_ITEMS) -> DataFrame:
    """``{"trace_id": .., "spans": [..]}``, the root first, the others as recorded. A trace of more
    than ``max_items`` spans becomes several documents of one id, so none is collected whole."""
    items = spans.select(
        "trace_id", (~F.col("is_root")).alias("child"), "seq", "span_id", item_json(spans, "spans", columns).alias("item")
    )
    # Traces of one document are grouped as they are: their spans are shuffled once and not numbered. The
    # others are known by a table of at most one row for each max_items spans, so none is shuffled whole.
    long = spans.groupBy("trace_id").count().filter(F.col("count") > max_items).select(F.col("trace_id").alias("long"))
    is_long = F.col("trace_id").eqNullSafe(F.col("long"))
    whole = items.join(F.broadcast(long), is_long, "left_anti")
    whole = whole.groupBy("trace_id").agg(
        F.sort_array(F.collect_list(F.struct("child", "seq", "span_id", "item"))).alias("rows"), F.count(F.lit(1)).alias("items")
    )
    segment = F.when(F.col("child"), F.greatest(sequence_segment("seq"), F.lit(0))).otherwise(-1)
    order = ["child", "seq", "span_id"]
    cut = items.join(F.broadcast(long), is_long, "left_semi")
    numbered = running(cut, ["trace_id"], order, segment, {"number": ("sum", F.lit(1).cast("long"))})
    parts = numbered.groupBy("trace_id", F.floor((F.col("number") - 1) / max_items).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("number", "item"))).alias("rows"), F.count(F.lit(1)).alias("items")
    )

    def joined(listed: DataFrame) -> DataFrame:
        return listed.select("trace_id", F.array_join(F.transform("rows", lambda r: r["item"]), ",").alias("spans"), "items")

    listed = joined(whole).unionByName(joined(parts))
    head = F.to_json(F.struct("trace_id"))  # escapes the id; a null one is left out
    head = F.when(F.col("trace_id").isNull(), "{").otherwise(F.concat(F.substring(head, 1, F.length(head) - 1), F.lit(",")))
    return listed.select(
        F.lit("spans").alias("endpoint"),
        F.concat(head, F.lit('"spans":['), F.col("spans"), F.lit("]}")).alias("document"),
        "items",
    )


def wire_export(documents: DataFrame, path: str, *, mode: str = "append") -> None:
    """Writes documents as JSON lines, one folder per endpoint."""
    documents.select("endpoint", F.col("document").alias("value")).write.mode(mode).partitionBy("endpoint").text(path)


_MANIFEST = "endpoint string, documents long, items long, characters long, batch string"


def export_batch(documents: DataFrame, path: str, batch: str) -> bool:
    """Writes a batch of documents once: gzipped JSON lines by endpoint in ``<path>/documents/batch=<batch>``, and
    then what it holds in ``<path>/manifest/batch=<batch>``, which is what makes it part of the export.

    A batch that is in the manifest is left as it is, and False returned. One that failed half-way
    has no manifest, isn't read, and is replaced when it is written again.
    """
    spark = documents.sparkSession
    if not committed(spark, path).filter(F.col("batch") == batch).isEmpty():
        return False
    folder = f"{path}/documents/batch={batch}"
    # Items are counted while the documents are written, not by evaluating them again.
    seen = Observation()
    totals = [F.sum(F.when(F.col("endpoint") == e, F.col("items"))).alias(e) for e in sorted({v[0] for v in ENDPOINTS.values()})]
    lines = documents.observe(seen, *totals).select("endpoint", F.col("document").alias("value"))
    lines.write.mode("overwrite").partitionBy("endpoint").text(folder, compression="gzip")
    items = F.create_map(*[F.lit(x) for e, n in seen.get.items() for x in (e, n or 0)])
    written = spark.read.schema("value string, endpoint string").text(folder).groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.length("value")).alias("characters")
    )
    held = written.select("endpoint", "documents", items[F.col("endpoint")].alias("items"), "characters")
    held.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/batch={batch}")
    return True


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The manifest: endpoint, documents, items, characters and batch of what was exported."""
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def exported(spark: SparkSession, path: str) -> DataFrame:
    """endpoint, batch and value (a JSON document) of all batches that the manifest holds."""
    lines = spark.read.schema("value string, batch string, endpoint string").text(f"{path}/documents")
    return lines.join(committed(spark, path).select("batch").distinct(), "batch", "left_semi")
