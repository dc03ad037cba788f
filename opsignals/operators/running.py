"""Running aggregates over an ordered group that may be far larger than one task.

A plain window sends a whole group to one task. Here a group is cut into segments (a minute
of time, a stretch of sequence numbers):

1. each segment is summarised by an ordinary aggregate, combined map-side;
2. a window over the summaries alone, one row per segment, gives what every segment starts with;
3. that carry goes in as the first row of its segment, and one window per (group, segment)
   finishes the job.

Step 2 handles at most one row per segment of a group, so its size follows the time span and
not the number of signals. No task ever holds more than one segment of detail rows, the wide
rows are shuffled once, and results are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SEGMENT = "__segment"
_FIRST = -(2**62)  # of the segment that an earlier run left
_IS_ROW = "__is_row"


def time_segment(ts: str | Column, minutes: int = 1) -> Column:
    """Number of the time slice a timestamp falls in; one minute unless the data is sparse."""
    c = F.col(ts) if isinstance(ts, str) else ts
    # A timestamp without zone counts on its own clock: through the session's zone, the hour
    # skipped in spring would run backwards.
    local = F.unix_date(c.cast("date")).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    seconds = F.when(F.typeof(c) == "timestamp_ntz", local).otherwise(F.unix_seconds(c.cast("timestamp")))
    return F.floor(seconds / (60 * minutes)).cast("long")


def sequence_segment(seq: str | Column, length: int = 100_000) -> Column:
    c = F.col(seq) if isinstance(seq, str) else seq
    return F.floor(c / length).cast("long")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Column,
    aggregates: Mapping[str, tuple[str, Column]],
    *,
    include_current: bool = True,
    carry_in: DataFrame | None = None,
) -> DataFrame:
    """``df`` with one column per aggregate over the rows of its group up to the current one.

    An aggregate is ``(kind, column)`` with kind ``sum``, ``max`` or ``last`` (latest non-null;
    wrap a value in a struct when null is a value). ``order`` must order a group totally and
    ``segment`` must never decrease along it. ``carry_in`` (the keys and one column per
    aggregate) is what a group starts with, when an earlier run left something.
    """
    keys, order = list(keys), list(order)
    names = list(aggregates)
    inputs = {n: f"__in_{n}" for n in names}
    rows = df.select("*", segment.alias(SEGMENT), *[aggregates[n][1].alias(inputs[n]) for n in names])

    position = F.struct(*order)

    def summarise(n: str) -> Column:
        value = F.col(inputs[n])
        kind = aggregates[n][0]
        if kind == "sum":
            return F.sum(value)
        if kind == "max":
            return F.max(value)
        return F.max_by(value, F.when(value.isNotNull(), position))

    def over(n: str, w) -> Column:
        kind = aggregates[n][0]
        value = F.col(inputs[n])
        if kind == "sum":
            return F.sum(value).over(w)
        if kind == "max":
            return F.max(value).over(w)
        return F.last(value, ignorenulls=True).over(w)

    summaries = rows.groupBy(*keys, SEGMENT).agg(*[summarise(n).alias(inputs[n]) for n in names])
    if carry_in is not None:
        # An earlier run is one more segment, before all others.
        first = carry_in.select(
            *keys, F.lit(_FIRST).cast("long").alias(SEGMENT), *[F.col(n).alias(inputs[n]) for n in names]
        )
        summaries = summaries.unionByName(first)
    earlier = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carries = summaries.select(
        *keys, SEGMENT, *[over(n, earlier).alias(inputs[n]) for n in names], F.lit(0).alias(_IS_ROW)
    )
    laid_out = rows.withColumn(_IS_ROW, F.lit(1)).unionByName(carries, allowMissingColumns=True)
    upto = (
        Window.partitionBy(*keys, SEGMENT)
        .orderBy(_IS_ROW, *order)
        .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    )
    done = laid_out.select("*", *[over(n, upto).alias(n) for n in names])
    return done.filter(F.col(_IS_ROW) == 1).drop(_IS_ROW, SEGMENT, *inputs.values())


# Columns by name, each from the window it is taken over; a later step sees an earlier one's columns.
Step = Mapping[str, Callable[[WindowSpec], Column]]


def _steps(df: DataFrame, steps: Sequence[Step], *windows: WindowSpec) -> DataFrame:
    for step in steps:
        df = df.select("*", *[column(*windows).alias(name) for name, column in step.items()])
    return df


def segment_summaries(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], local: Sequence[Step], summary: Mapping[str, Column]
) -> DataFrame:
    """One row per (group, segment) of rows that have ``SEGMENT``. ``local`` are columns over the rows
    of the segment up to the current one, or before it; ``summary`` aggregates them where they are."""
    upto = Window.partitionBy(*keys, SEGMENT).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    return _steps(df, local, upto, before).groupBy(*keys, SEGMENT).agg(*[c.alias(n) for n, c in summary.items()])


def chained(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Column,
    inputs: Mapping[str, Column],
    *,
    local: Sequence[Step],
    summary: Mapping[str, Column],
    carry: Sequence[Step],
    final: Sequence[Step],
    carry_in: DataFrame | None = None,
) -> DataFrame:
    """``df`` with the columns of ``final``, where one running aggregate rests on another.

    The parts of a group are summarised so that summaries combine: ``local`` and ``summary`` turn a
    segment into one row, ``carry`` combines the rows of all earlier segments of the group, and what it
    names like an input goes in as the first row of the segment (``is_carry`` tells it from others).
    ``final`` then runs over that row and the segment's own. However long the chain, the narrow inputs
    are shuffled once for the summaries and the rows once. ``carry_in`` has the keys and the columns of
    ``summary``: one more segment, before all others. Steps are called with the window up to the
    current row and the one before it; steps of ``carry`` with the window over all earlier segments.
    """
    keys, order = list(keys), list(order)
    rows = df.select("*", segment.alias(SEGMENT), *[c.alias(n) for n, c in inputs.items()])
    narrow = rows.select(*dict.fromkeys([*keys, SEGMENT, *order, *inputs]))
    summaries = segment_summaries(narrow, keys, order, local, summary)
    if carry_in is not None:
        first = carry_in.select(*keys, F.lit(_FIRST).cast("long").alias(SEGMENT), *summary)
        summaries = summaries.unionByName(first)
    earlier = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    combined = _steps(summaries.withColumnsRenamed({n: f"__of_{n}" for n in summary}), carry, earlier)
    made = {name for step in carry for name in step}
    carries = combined.select(*keys, SEGMENT, *[n for n in inputs if n in made], F.lit(True).alias("is_carry"))
    laid_out = rows.withColumn("is_carry", F.lit(False)).unionByName(carries, allowMissingColumns=True)
    upto = (
        Window.partitionBy(*keys, SEGMENT)
        .orderBy(F.desc("is_carry"), *order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    done = _steps(laid_out, final, upto, upto.rowsBetween(Window.unboundedPreceding, -1))
    return done.filter(~F.col("is_carry")).drop("is_carry", SEGMENT, *inputs)


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, *, salts: int = 32) -> DataFrame:
    """The first ``n`` rows of every group.

    Ranked twice: first per (group, salt), so a hot group is spread over ``salts`` tasks and
    Spark drops rows beyond ``n`` before the shuffle, then per group over at most
    ``n * salts`` survivors.
    """
    if n <= 0:
        return df.limit(0)
    rank = "__rank"
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    for group in ([*keys, "__salt"], list(keys)):
        w = Window.partitionBy(*group).orderBy(*order)
        salted = salted.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n).drop(rank)
    return salted.drop("__salt")
