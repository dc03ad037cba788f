"""Recorded changes: cleaned, deduplicated and set next to what followed them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsignals.functions.text import ascii_trim
from opsignals.operators.running import running, time_segment

# Fixed values.
KINDS = ("feature_flag", "config", "migration", "infrastructure", "dependency", "other")


def change_normalize(
    changes: DataFrame, *, environment: str = "production", now: Column | None = None, max_title: int | None = None
) -> DataFrame:
    """Titles trimmed, never blank, and cut only to a given ``max_title`` (clients send 200); unknown kinds are ``other``;
    environment and time have defaults; details only if a non-empty object (JSON text or map)."""
    title = ascii_trim(F.col("title"))
    details = F.col("details")
    if dict(changes.dtypes)["details"].startswith("map"):
        kept = F.when(F.size(details) > 0, details)
    else:
        kept = F.when(F.size(F.json_object_keys(details)) > 0, details)
    now = F.current_timestamp() if now is None else now
    return (
        changes.filter(title != "")
        .withColumn("kind", F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise("other"))
        .withColumn("title", title if max_title is None else F.substring(title, 1, max_title))
        .withColumn("environment", F.coalesce("environment", F.lit(environment)))
        .withColumn("occurred_at", F.coalesce(F.col("occurred_at"), now))
        .withColumn("details", kept)
    )


def change_dedupe(changes: DataFrame, order=("occurred_at", "seq")) -> DataFrame:
    """The first row of every idempotency id, and every row without one.

    A grouped minimum rather than a ranking: copies of a hot id are reduced before the shuffle.
    """
    names = changes.columns
    rest = [c for c in names if c not in order]
    whole = F.struct(*order, *rest)
    first = (
        changes.filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.min_by(whole, F.struct(*order)).alias("first"))
        .select("first.*")
        .select(*names)
    )
    return first.unionByName(changes.filter(F.col("id").isNull()))


def change_impact(
    changes: DataFrame,
    errors: DataFrame,
    samples: DataFrame,
    *,
    interval: str = "1 hour",
    slow_ms: float = 1000.0,
    segment_minutes: int = 1,
) -> DataFrame:
    """Errors and slow samples in the interval before and after each change, per environment.

    No pairs are formed. Signals and the three edges of each change (start, change, end) lie on
    one timeline per environment; a running count at the edges gives every interval by
    subtraction. Signals are counted per instant first, so the timeline stays short.
    ``change_id`` tells the changes apart; signals without an environment form one of their own.
    """
    span = F.expr(f"INTERVAL {interval}")
    counted = (
        errors.select("environment", F.col("occurred_at").alias("at"), F.lit(1).alias("e"), F.lit(0).alias("s"))
        .unionByName(
            samples.filter(F.col("max_duration_ms") >= slow_ms).select(
                "environment", F.col("period_started_at").alias("at"), F.lit(0).alias("e"), F.lit(1).alias("s")
            )
        )
        .groupBy("environment", "at")
        .agg(F.sum("e").alias("e"), F.sum("s").alias("s"))
    )
    edges = changes.select(
        "environment",
        "change_id",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("edge"), at.alias("at"))
                    for name, at in (
                        ("start", F.col("occurred_at") - span),
                        ("change", F.col("occurred_at")),
                        ("end", F.col("occurred_at") + span),
                    )
                ]
            )
        ).alias("x"),
    ).select("environment", "change_id", "x.edge", "x.at")
    # Edges sort before the signals of the same instant: an interval holds its start, not its end.
    timeline = counted.withColumn("is_signal", F.lit(1)).unionByName(
        edges.withColumn("is_signal", F.lit(0)), allowMissingColumns=True
    )
    order = ["at", "is_signal", "change_id", "edge"]
    seen = running(
        timeline,
        ["environment"],
        order,
        time_segment("at", segment_minutes),
        {"errors_seen": ("sum", F.coalesce("e", F.lit(0))), "slow_seen": ("sum", F.coalesce("s", F.lit(0)))},
    ).filter(F.col("is_signal") == 0)

    def at_edge(column: str, edge: str) -> Column:
        return F.max(F.when(F.col("edge") == edge, F.col(column)))

    counts = seen.groupBy("change_id").agg(
        (at_edge("errors_seen", "change") - at_edge("errors_seen", "start")).alias("errors_before"),
        (at_edge("errors_seen", "end") - at_edge("errors_seen", "change")).alias("errors_after"),
        (at_edge("slow_seen", "change") - at_edge("slow_seen", "start")).alias("slow_before"),
        (at_edge("slow_seen", "end") - at_edge("slow_seen", "change")).alias("slow_after"),
    )
    return changes.join(counts, "change_id")
