"""Delivery attempts judged: outcomes, reasons and the retry ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsignals.operators.running import chained, time_segment

# Fixed value: failed attempts in a row before a batch is dropped.
MAX_FAILURES = 5


def outcome(status: Column) -> Column:
    return (
        F.when(status.between(200, 299), "delivered")
        .when(status.between(400, 499) & ~status.isin(408, 429), "rejected")
        .otherwise("failed")
    )


def drop_reason(status: Column) -> Column:
    code = F.concat(F.lit("HTTP "), status.cast("string"))
    return (
        F.when(outcome(status) == "rejected", F.concat(F.lit("rejected by the server ("), code, F.lit(")")))
        .when(status == 0, "the server could not be reached")
        .otherwise(F.concat(F.lit("the server answered "), code))
    )


def delivery_outcomes(attempts: DataFrame) -> DataFrame:
    """Attempts per endpoint, outcome and reason; a delivered attempt has no reason."""
    status = F.col("status")
    judged = attempts.select(
        "endpoint",
        outcome(status).alias("outcome"),
        F.when(outcome(status) != "delivered", drop_reason(status)).alias("reason"),
    )
    return judged.groupBy("endpoint", "outcome", "reason").agg(F.count(F.lit(1)).alias("attempts"))


def retry_ledger(
    attempts: DataFrame,
    *,
    max_failures: int = MAX_FAILURES,
    order=("ts", "seq"),
    segment: Column | None = None,
    carry_in: DataFrame | None = None,
) -> DataFrame:
    """Every attempt with its streak of failures in its queue, the state it leads to and why.

    Every ``max_failures``-th failure since the last attempt that did not fail drops the batch and
    starts the count again. A stretch of attempts is summed up by its failures, its resets and the
    failures before its last reset; these combine over stretches, so the ledger needs one pass.
    ``carry_in`` (``queue, failures, resets, failures_at_reset``) continues an earlier run.
    """
    segment = time_segment(order[0]) if segment is None else segment
    judged = attempts.withColumn("outcome", outcome(F.col("status")))
    failed = F.col("outcome") == "failed"
    counted = chained(
        judged, ["queue"], order, segment,
        {"__failed": failed.cast("long"), "__reset": (~failed).cast("long"), "__base": F.lit(None).cast("long")},
        local=[
            {"__run": lambda upto, _: F.sum("__failed").over(upto)},
            {"__at": lambda upto, _: F.max(F.when(F.col("__reset") == 1, F.col("__run"))).over(upto)},
        ],
        summary={"failures": F.sum("__failed"), "resets": F.sum("__reset"), "failures_at_reset": F.max("__at")},
        carry=[
            {"__failed": lambda w: F.sum("__of_failures").over(w), "__reset": lambda w: F.sum("__of_resets").over(w)},
            {"__base": lambda w: F.max(F.coalesce("__failed", F.lit(0)) + F.col("__of_failures_at_reset")).over(w)},
        ],
        final=[
            {"failures": lambda upto, _: F.sum("__failed").over(upto), "resets": lambda upto, _: F.sum("__reset").over(upto)},
            {
                "failures_at_reset": lambda _, before: F.max(
                    F.when(F.col("is_carry"), F.col("__base")).when(F.col("__reset") == 1, F.col("failures"))
                ).over(before)
            },
        ],
        carry_in=carry_in,
    )
    run = F.col("failures") - F.coalesce("failures_at_reset", F.lit(0))
    streak = F.when(failed, (run - 1) % max_failures + 1).otherwise(0)
    state = F.when(failed, F.when(F.col("streak") == max_failures, "dropped").otherwise("kept")).otherwise(
        F.col("outcome")
    )
    return (
        counted.withColumn("streak", streak.cast("int"))
        .withColumn("state", state)
        .withColumn("reason", F.when(F.col("state").isin("rejected", "dropped"), drop_reason(F.col("status"))))
    )


def closed_groups(judged: DataFrame, *, max_failures: int = MAX_FAILURES) -> DataFrame:
    """The flushes of a ledger with the flush that emptied their buffer and how it ended; flushes
    still waiting for one are left out.

    A group is part of an island: its failures in steps of ``max_failures``, the last step with
    the attempt that ended the island. It has at most ``max_failures`` flushes, so the window
    over it is tiny.
    """
    failed = F.col("outcome") == "failed"
    run = F.col("failures") - F.coalesce("failures_at_reset", F.lit(0))
    grouped = judged.withColumns(
        {
            "__island": F.col("resets") - (~failed).cast("long"),
            "__step": F.floor((run - failed.cast("long")) / max_failures),
        }
    )
    of_group = Window.partitionBy("queue", "__island", "__step")
    closes = F.col("state") != "kept"
    return (
        grouped.withColumn("closing_seq", F.max(F.when(closes, F.col("seq"))).over(of_group))
        .withColumn("closed_as", F.max(F.when(closes, F.col("state"))).over(of_group))
        .filter(F.col("closing_seq").isNotNull())
        .drop("__island", "__step")
    )
