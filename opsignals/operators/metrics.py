"""Metric rows validated, batched and totalled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsignals.operators.running import first_n

# Fixed values.
PERIOD = "60 seconds"
_JSON_NUMBER = r"\A-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?\z"


def _number_and_reason(df: DataFrame, value: str) -> tuple[Column, Column]:
    kind = df.schema[value].dataType
    c = F.col(value)
    if isinstance(kind, T.StringType):  # JSON text: only a bare number is one
        token = F.btrim(c, F.lit(" \t\r\n"))
        number = F.when(token.rlike(_JSON_NUMBER), token.try_cast("double"))
        reason = F.when(c.isNull() | (token == "null"), "missing").when(number.isNull(), "not a number")
    elif isinstance(kind, T.NumericType):
        number = c.cast("double")
        reason = F.when(c.isNull(), "missing")
    else:
        number = F.lit(None).cast("double")
        reason = F.when(c.isNull(), "missing").otherwise("not a number")
    finite = ~F.isnan(number) & (F.abs(number) < float("inf"))
    return number, F.coalesce(reason, F.when(~finite, "not finite"))


def metric_validate(metrics: DataFrame, value: str = "value") -> DataFrame:
    """Every row with its value as a double and, for the dropped ones, a ``reason``: missing,
    not a number (a boolean or text is not one), or not finite. One pass, no filter."""
    number, reason = _number_and_reason(metrics, value)
    return metrics.withColumn("reason", reason).withColumn(
        value, F.when(F.col("reason").isNull(), number)
    )


def valid_metrics(metrics: DataFrame, value: str = "value") -> DataFrame:
    return metric_validate(metrics, value).filter(F.col("reason").isNull()).drop("reason")


def metric_batches(
    metrics: DataFrame,
    buffer=("environment", "release"),
    *,
    period: str = PERIOD,
    cap: int,
    order=("recorded_at", "seq"),
) -> DataFrame:
    """Valid entries with the batch they go out in: the first ``cap`` of a buffer and period."""
    placed = valid_metrics(metrics).withColumn("batch_started_at", F.window(order[0], period)["start"])
    return first_n(placed, [*buffer, "batch_started_at"], order, cap)


def metric_batch_counts(
    metrics: DataFrame, buffer=("environment", "release"), *, period: str = PERIOD, cap: int, ts="recorded_at"
) -> DataFrame:
    """Entries kept and dropped per batch: a count and a comparison, no ranking."""
    counted = (
        valid_metrics(metrics)
        .groupBy(F.window(ts, period).alias("w"), *buffer)
        .agg(F.count(F.lit(1)).alias("entries"))
    )
    return counted.select(
        *buffer,
        F.col("w.start").alias("batch_started_at"),
        F.least("entries", F.lit(cap)).cast("long").alias("kept"),
        F.greatest(F.col("entries") - cap, F.lit(0)).cast("long").alias("dropped"),
    )


def metric_totals(metrics: DataFrame, dimensions=("metric_name", "environment", "release")) -> DataFrame:
    """Exact count and sum per metric and day; summed as decimals, so order never matters."""
    return (
        valid_metrics(metrics)
        .groupBy(*dimensions, F.to_date("recorded_at").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("entries"),
            F.sum(F.col("value").cast("decimal(28,6)")).alias("total"),
        )
    )


def infra_rollup(readings: DataFrame, order=("recorded_at", "seq")) -> DataFrame:
    """Readings per host and metric: lowest, highest, average and latest. An empty host falls
    back to the server's name, and that to empty text."""
    host = F.coalesce(F.nullif("hostname", F.lit("")), "server_name", F.lit(""))
    return (
        valid_metrics(readings)
        .groupBy(host.alias("host"), "metric_name")
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
            F.avg("value").alias("average"),
            F.max_by("value", F.struct(*order)).alias("latest"),
        )
    )
