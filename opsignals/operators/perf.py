"""Timings rolled up into samples, and samples merged, measured and subtracted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsignals.functions import latency, routes
from opsignals.operators import delivery

DIMENSIONS = ("transaction_name", "environment", "release")
QUANTILES = (0.5, 0.95, 0.99)


def _largest(duration: Column) -> Column:
    # A maximum starts at 0, and a NaN never becomes one.
    return F.greatest(F.lit(0.0), F.max(F.when(~F.isnan(duration), duration)))


def _sample_columns(duration: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("request_count"),
        F.sum(duration).alias("duration_sum_ms"),
        F.coalesce(_largest(duration), F.lit(0.0)).alias("max_duration_ms"),
        *latency.count_per_bucket(duration),
    ]


def perf_rollup(timings: DataFrame, period: str = "60 seconds", dimensions=DIMENSIONS) -> DataFrame:
    """Count, sum, maximum and latency histogram per transaction, environment, release and
    period: one hash aggregate, combined before the shuffle. Works on streams as well."""
    duration = F.col("duration_ms")
    rolled = (
        timings.filter(duration.isNotNull())
        .groupBy(F.window("ts", period).alias("period"), *dimensions)
        .agg(*_sample_columns(duration))
    )
    return rolled.select(
        *dimensions,
        F.col("period.start").alias("period_started_at"),
        F.col("period.end").alias("period_ended_at"),
        "request_count",
        "duration_sum_ms",
        "max_duration_ms",
        latency.as_histogram().alias("histogram"),
    )


def perf_rollup_strict(timings: DataFrame, period: str = "60 seconds", dimensions=DIMENSIONS) -> DataFrame:
    """:func:`perf_rollup` after names are reduced, so all raw paths of a route share a row."""
    reduced = timings.withColumn("transaction_name", routes.strict_name(F.col("transaction_name")))
    return perf_rollup(reduced, period, dimensions)


def latency_histogram(timings: DataFrame, dimensions=("transaction_name",)) -> DataFrame:
    """Counts per latency bucket, empty buckets absent."""
    counted = (
        timings.filter(F.col("duration_ms").isNotNull())
        .groupBy(*dimensions)
        .agg(*latency.count_per_bucket(F.col("duration_ms")))
    )
    return counted.select(*dimensions, latency.as_histogram().alias("histogram"))


def _merged(samples: DataFrame, dimensions) -> DataFrame:
    histogram = F.col("histogram")
    return samples.groupBy(*dimensions).agg(
        F.min("period_started_at").alias("period_started_at"),
        F.max("period_ended_at").alias("period_ended_at"),
        F.sum("request_count").alias("request_count"),
        F.sum("duration_sum_ms").alias("duration_sum_ms"),
        _largest(F.col("max_duration_ms")).alias("max_duration_ms"),
        *latency.sum_per_bucket(histogram),
    )


def histogram_merge(samples: DataFrame, dimensions=DIMENSIONS) -> DataFrame:
    """Samples of many periods, hosts or releases added up: one aggregate over nine sums."""
    merged = _merged(samples, dimensions)
    return merged.withColumn("histogram", latency.as_histogram()).drop(*latency.bucket_columns())


def histogram_percentiles(samples: DataFrame, dimensions=("transaction_name",), quantiles=QUANTILES) -> DataFrame:
    """Percentiles to bucket width from merged histograms. The last, open bucket reports the
    largest duration seen."""
    merged = _merged(samples, dimensions)
    counts = [F.col(f"`{c}`") for c in latency.bucket_columns()]
    total = reduce(lambda a, b: a + b, counts)
    return merged.select(
        *dimensions,
        "request_count",
        *[
            latency.quantile_bound(counts, total, q, F.col("max_duration_ms")).alias(f"p{round(q * 100)}")
            for q in quantiles
        ],
    )


def perf_carry_over(samples: DataFrame, flushes: DataFrame, dimensions=DIMENSIONS, **ledger) -> DataFrame:
    """Samples of a failed flush merged into the next one.

    ``flushes`` is the delivery log of the sample queues (``queue, seq, ts, status``);
    ``samples`` carry the ``queue`` and ``seq`` of their flush. A delivered, rejected or fifth
    failed flush closes a group. One row per closed group and name, with the flush and the outcome
    that closed it.
    """
    grouped = delivery.closed_groups(delivery.retry_ledger(flushes, **ledger))
    member_of = grouped.select("queue", "seq", "closing_seq", "closed_as")
    return histogram_merge(
        samples.join(member_of, ["queue", "seq"]), ("queue", "closing_seq", "closed_as", *dimensions)
    )


def perf_remaining(current: DataFrame, sent: DataFrame, dimensions=("transaction_name",)) -> DataFrame:
    """Tallies minus what was sent: floored at 0, spent labels and empty rows removed, the
    maximum kept as it is because it can't be subtracted."""
    gone = sent.select(
        *[F.col(d).alias(f"sent_{d}") for d in dimensions],
        F.col("request_count").alias("sent_count"),
        F.col("duration_sum_ms").alias("sent_sum"),
        F.col("histogram").alias("sent_histogram"),
    )
    # A release may be null, and null is a release here.
    same = reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"sent_{d}")) for d in dimensions])
    joined = current.join(gone, same, "left")
    was_sent = F.col("sent_count").isNotNull()

    def less(a: Column, b: Column) -> Column:
        return F.greatest(F.lit(0), a - F.coalesce(b, F.lit(0)))

    left_over = F.map_zip_with("histogram", "sent_histogram", lambda _, now, out: less(F.coalesce(now, F.lit(0)), out))
    remaining = joined.select(
        *dimensions,
        less(F.col("request_count"), F.col("sent_count")).cast("long").alias("request_count"),
        F.greatest(F.lit(0.0), F.col("duration_sum_ms") - F.coalesce("sent_sum", F.lit(0.0))).alias("duration_sum_ms"),
        "max_duration_ms",
        F.when(was_sent & F.col("sent_histogram").isNotNull(), F.map_filter(left_over, lambda _, n: n > 0))
        .otherwise(F.col("histogram"))
        .alias("histogram"),
        was_sent.alias("was_sent"),
    )
    # Only what was part of the send can be used up.
    return remaining.filter(~F.col("was_sent") | (F.col("request_count") > 0)).drop("was_sent")
