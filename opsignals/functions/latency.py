"""Latency buckets: the fixed upper bounds, and columns over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive upper bounds in milliseconds, then everything above.
BOUNDS_MS = (50, 100, 250, 500, 1000, 2500, 5000, 10000)
LABELS = tuple(str(b) for b in BOUNDS_MS) + ("inf",)


def bucket(duration_ms: Column) -> Column:
    """The label of the bucket a duration falls in; NaN compares above all, so 'inf'."""
    pairs = zip(BOUNDS_MS, LABELS, strict=False)
    first, *rest = [(duration_ms <= bound, label) for bound, label in pairs]
    chain = reduce(lambda acc, p: acc.when(p[0], p[1]), rest, F.when(*first))
    return chain.otherwise("inf")


def count_per_bucket(duration_ms: Column) -> list[Column]:
    """One conditional count per label: a fixed-width histogram in a single hash aggregate."""
    label = bucket(duration_ms)
    return [F.count(F.when(label == name, 1)).alias(f"le_{name}") for name in LABELS]


def sum_per_bucket(histogram: Column) -> list[Column]:
    """Adds up ``map<label, count>`` columns, one output column per label."""
    return [F.sum(F.coalesce(histogram[name], F.lit(0))).alias(f"le_{name}") for name in LABELS]


def bucket_columns() -> list[str]:
    return [f"le_{name}" for name in LABELS]


def as_histogram(column=F.col) -> Column:
    """The ``le_*`` columns as ``map<label, count>`` without the empty buckets."""
    entries = F.array(*[F.struct(F.lit(n).alias("key"), column(f"le_{n}").alias("value")) for n in LABELS])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"] > 0))


def histogram_text(histogram: Column) -> Column:
    """``50:2,250:1`` in bucket order, for display and comparison."""
    parts = [F.when(histogram[n] > 0, F.concat(F.lit(n + ":"), histogram[n].cast("string"))) for n in LABELS]
    return F.array_join(F.array_compact(F.array(*parts)), ",")


def quantile_bound(counts: list[Column], total: Column, q: float, largest: Column) -> Column:
    """Upper bound of the first bucket whose running count reaches ``q`` of the total; the
    open last bucket reports ``largest``. Nine columns wide, so no window is needed."""
    running = F.lit(0)
    out = None
    for bound, count in zip([*BOUNDS_MS, None], counts, strict=True):
        running = running + count
        value = largest if bound is None else F.lit(float(bound))
        reached = running >= F.lit(q) * total
        out = F.when(reached, value) if out is None else out.when(reached, value)
    return out
