"""The batch jobs on streams: event time and watermarks in place of a flush timer."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from opsignals.operators import delivery, metrics, perf
from opsignals.streaming.state import CarriedState, GrowingState


def write_parquet(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Runs a stream over everything there is, then stops; restartable from its checkpoint."""
    return (
        df.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def write_updates(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Runs an aggregation over everything there is; each micro-batch writes the rows that it
    changed, open periods included, to ``<out>/batch=<n>``. :func:`latest` reads them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def latest(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Each key's row as the newest micro-batch that changed it wrote it."""
    rows = spark.read.parquet(out)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("row"))
    return newest.select(*keys, "row.*")


def _newest(rows: DataFrame, time: str):
    """One value: the newest time there is, or None."""
    return rows.agg(F.max(time)).first()[0]


def stream_perf_rollup(timings: DataFrame, *, delay: str = "1 minute", period: str = "60 seconds") -> DataFrame:
    """The rollup with histogram per tumbling period: one stateful aggregation, emitted when the
    watermark closes the period."""
    return perf.perf_rollup(timings.withWatermark("ts", delay), period)


def stream_change_dedupe(changes: DataFrame, *, delay: str = "1 day") -> DataFrame:
    """One row per idempotency id within the watermark, the first to arrive, at once; rows without
    one pass through. :func:`stream_first_changes` takes the first in event time instead."""
    timed = changes.withWatermark("occurred_at", delay)
    return (
        timed.filter(F.col("id").isNotNull())
        .dropDuplicatesWithinWatermark(["id"])
        .unionByName(timed.filter(F.col("id").isNull()))
    )


def stream_first_changes(
    changes: DataFrame, *, order=("change_id",), delay: str = "1 day", horizon: str = "30 days"
) -> DataFrame:
    """The first row of each idempotency id in event time, whichever copy arrives first: id, the
    horizon it is known for and ``change``, for :func:`write_updates`; :func:`first_changes` reads it.

    State is the smallest row seen per id and horizon, combined before the shuffle, so an id that a
    third of all rows have is one row per task. It is kept until the watermark passes the horizon.
    ``order`` decides between copies of one time. Rows without an id are left out: they are all kept.
    """
    first = F.min_by(F.struct(*changes.columns), F.struct("occurred_at", *order))
    return (
        changes.filter(F.col("id").isNotNull())
        .withWatermark("occurred_at", delay)
        .groupBy("id", F.window("occurred_at", horizon).alias("horizon"))
        .agg(first.alias("change"))
        .select("id", F.col("horizon.start").alias("known_from"), "change")
    )


def first_changes(spark: SparkSession, out: str, *, order=("change_id",)) -> DataFrame:
    """One row per id of what :func:`stream_first_changes` wrote: copies on both sides of the end of
    a horizon count as one as well."""
    known = latest(spark, out, ["id", "known_from"])
    place = F.struct("change.occurred_at", *[f"change.{c}" for c in order])
    return known.groupBy("id").agg(F.min_by("change", place).alias("change")).select("change.*")


def stream_trace_capture(
    spans: DataFrame,
    out: str,
    state: str,
    checkpoint: str,
    *,
    threshold_ms: float = 1000.0,
    expire: timedelta = timedelta(days=1),
    salts: int = 8,
) -> StreamingQuery:
    """Holds the spans of a trace until its root comes; a slow root releases all of them and those
    that come after it, a fast one discards all.

    A join of two streams, spans and roots, on the trace: Spark keeps either side by key in its state
    store, a micro-batch touches the traces it has rows of, and what a watermark has passed is dropped
    from the state. A span and its root may start half of ``expire`` apart, and rows may come out of
    order by the other half. A span that no root came for is given up when the newest span of all is
    ``expire`` newer and goes to ``<state>/expired``. Spans are dealt out by trace and one of ``salts``
    numbers, and a root goes to each of them, so a trace of a third of all spans is held in ``salts``
    parts. Of several roots of a trace the first decides.

    Input: trace_id, started_at, is_root, duration_ms and whatever else a span has.
    """
    half = int(expire.total_seconds() * 500)
    plain = [f.name for f in spans.schema if f.dataType.simpleString()[:3] != "map"]
    timed = spans.select(
        F.struct("*").alias("span"),
        "trace_id",
        F.col("started_at").cast("timestamp").alias("at"),
        F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int").alias("salt"),
    ).withWatermark("at", f"{half} milliseconds")
    # The condition names the time, so it stays behind the watermark: roots alone, which are few, would
    # hold the watermark back.
    roots = (
        timed.filter(F.when(F.col("span.is_root"), F.col("at")).isNotNull())
        .select(
            F.col("trace_id").alias("root_of"),
            F.col("at").alias("root_at"),
            (F.col("span.duration_ms") >= threshold_ms).alias("is_slow"),
        )
        .dropDuplicatesWithinWatermark(["root_of"])
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("root_salt"))
    )
    apart = F.expr(f"INTERVAL '{half / 1000:.3f}' SECOND")
    judged = timed.join(
        roots,
        (F.col("trace_id") == F.col("root_of"))
        & (F.col("salt") == F.col("root_salt"))
        & (F.col("root_at") >= F.col("at") - apart)
        & (F.col("root_at") <= F.col("at") + apart),
        "left_outer",
    ).select("span", "is_slow")

    def write(batch: DataFrame, batch_id: int) -> None:
        # The join is evaluated once, for both outputs.
        batch.persist()
        batch.filter("is_slow").select("span.*").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        batch.filter("is_slow IS NULL").select("span.*").write.mode("overwrite").parquet(f"{state}/expired/batch={batch_id}")
        batch.unpersist()

    return (
        judged.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


_COUNTS = "queue STRING, failures LONG, resets LONG, failures_at_reset LONG"


class _Ledger:
    """What the ledger of a stream keeps: the counts of each queue, the attempts that wait for their
    time, and up to when attempts were judged.

    Waiting attempts stay in the folder of the micro-batch that brought them and are never written
    again: those judged are the ones up to the time judged, so a later micro-batch reads the stretch
    between two times from the folders that reach into it.
    """

    def __init__(self, spark: SparkSession, out: str, state: str, schema: StructType):
        self.spark, self.out, self.state, self.schema = spark, out, state, schema
        self.counts = GrowingState(spark, f"{state}/counts", _COUNTS, ["queue"])
        self.progress = CarriedState(spark, f"{state}/progress", "brought_by LONG, newest TIMESTAMP, judged_upto TIMESTAMP")

    def before(self, batch_id: int) -> tuple[datetime | None, dict[int, datetime]]:
        """The time judged up to, and the newest time of each folder that reaches beyond it."""
        rows = self.progress.before(batch_id).collect()
        return (rows[0].judged_upto if rows else None), {r.brought_by: r.newest for r in rows if r.brought_by is not None}

    def waiting(self, folders: dict[int, datetime], after: datetime | None, upto: datetime | None) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.state}/held/batch={n}" for n in sorted(folders)])
        time = F.col("ts").cast("timestamp")
        rows = rows if after is None else rows.filter(time > F.lit(after))
        return rows if upto is None else rows.filter(time <= F.lit(upto))

    def judge(self, rows: DataFrame, batch_id: int) -> None:
        folder = f"{self.out}/batch={batch_id}"
        delivery.retry_ledger(rows, carry_in=self.counts.before(batch_id)).write.mode("overwrite").parquet(folder)
        # All three only grow, so their largest value is the latest one.
        reset_here = F.when(F.col("outcome") != "failed", F.col("failures"))
        judged = self.spark.read.parquet(folder).select(
            "queue", "failures", "resets", F.greatest(reset_here, "failures_at_reset").alias("failures_at_reset")
        )
        touched = judged.groupBy("queue").agg(*[F.max(c).alias(c) for c in ("failures", "resets", "failures_at_reset")])
        self.counts.save(batch_id, touched)


def stream_retry_ledger(
    attempts: DataFrame, out: str, state: str, checkpoint: str, *, delay: timedelta = timedelta(minutes=10)
) -> StreamingQuery:
    """The ledger on a stream, in event time. Attempts are held until the newest one is ``delay``
    later, then judged in order, from the counts that earlier ones left; a hot queue is spread over
    segments as in batch. What comes after its time was judged goes to ``<state>/late``, unjudged.
    :func:`finish_retry_ledger` judges what a stream that has ended still holds."""
    kept = _Ledger(attempts.sparkSession, out, state, attempts.schema)

    def judge(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        upto, folders = kept.before(batch_id)
        time = F.col("ts").cast("timestamp")
        in_time = F.lit(True) if upto is None else F.coalesce(time > F.lit(upto), F.lit(True))
        newest = _newest(batch.filter(in_time).select(time.alias("ts")), "ts")
        latest_of_all = max((t for t in (newest, *folders.values()) if t is not None), default=None)
        end = upto if latest_of_all is None else max(latest_of_all - delay, upto or latest_of_all - delay)
        ready = F.lit(False) if end is None else time <= F.lit(end)
        batch.filter(~in_time).write.mode("overwrite").parquet(f"{state}/late/batch={batch_id}")
        batch.filter(in_time & ~F.coalesce(ready, F.lit(False))).write.mode("overwrite").parquet(f"{state}/held/batch={batch_id}")
        kept.judge(kept.waiting(folders, upto, end).unionByName(batch.filter(in_time & ready)), batch_id)
        folders = {n: t for n, t in (folders | ({batch_id: newest} if newest else {})).items() if t > end}
        rows = [(n, t, end) for n, t in folders.items()] or [(None, None, end)]
        kept.progress.save(batch_id, batch.sparkSession.createDataFrame(rows, kept.progress.schema).coalesce(1))
        batch.unpersist()

    return (
        attempts.writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finish_retry_ledger(spark: SparkSession, out: str, state: str) -> None:
    """Judges the attempts that an ended stream still holds, as ``<out>/batch=<last + 1>``. Called
    again, it does the same again."""
    try:
        schema = spark.read.parquet(f"{state}/held").drop("batch").schema
    except AnalysisException:  # nothing ever came
        return
    last = spark.read.parquet(f"{state}/progress").agg(F.max("batch")).first()[0]
    kept = _Ledger(spark, out, state, schema)
    upto, folders = kept.before(last + 1)
    if folders:
        kept.judge(kept.waiting(folders, upto, None), last + 1)


def stream_metric_batches(
    entries: DataFrame,
    out: str,
    state: str,
    checkpoint: str,
    *,
    buffer=("environment", "release"),
    period: str = metrics.PERIOD,
    cap: int,
    delay_seconds: int = 600,
) -> StreamingQuery:
    """Valid entries written with their batch, capped over micro-batches, and what each
    micro-batch kept and dropped (``<out>/entries``, ``<out>/counts``).

    What a batch has already taken is carried as one count per open batch; a new micro-batch
    keeps at most what is left. A batch that ended before the newest batch began, by more than the
    delay, is closed: its count is forgotten, and entries that come for it later are dropped and
    counted.
    """
    keys = [*buffer, "batch_started_at"]
    ddl = ", ".join(f"{b} STRING" for b in buffer) + ", batch_started_at TIMESTAMP, taken LONG"
    carried = CarriedState(entries.sparkSession, state, ddl)

    def place(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = carried.before(batch_id).persist()
        end = F.col("batch_started_at") + F.expr(f"INTERVAL {period}")
        newest = _newest(before, "batch_started_at")
        closed = F.lit(False) if newest is None else end < F.lit(newest - timedelta(seconds=delay_seconds))
        fresh = batch.withColumn("recorded_at", F.col("recorded_at").cast("timestamp")).persist()
        # At most cap rows per batch are left, so ranking them against what is taken is small.
        kept = metrics.metric_batches(fresh, buffer, period=period, cap=cap)
        joined = kept.join(before, [kept[k].eqNullSafe(before[k]) for k in keys], "left").select(
            kept["*"], F.coalesce(before["taken"], F.lit(0)).alias("taken")
        )
        position = F.row_number().over(Window.partitionBy(*keys).orderBy("recorded_at", "seq"))
        fits = joined.withColumn("position", position).filter(~closed & (F.col("position") + F.col("taken") <= cap))
        entries_folder = f"{out}/entries/batch={batch_id}"
        fits.drop("position", "taken").write.mode("overwrite").parquet(entries_folder)

        # What came is counted once and what was kept read back; both are a row per batch then.
        seen = metrics.metric_batch_counts(fresh, buffer, period=period, cap=2**62).select(*keys, F.col("kept").alias("seen"))
        taken = spark.read.schema(fits.schema).parquet(entries_folder).groupBy(*keys).agg(F.count(F.lit(1)).alias("taken"))
        counts_folder = f"{out}/counts/batch={batch_id}"
        counted = seen.join(taken, [seen[k].eqNullSafe(taken[k]) for k in keys], "left").select(
            *[seen[k] for k in keys],
            F.coalesce("taken", F.lit(0)).alias("kept"),
            (F.col("seen") - F.coalesce("taken", F.lit(0))).alias("dropped"),
        )
        counted.write.mode("overwrite").parquet(counts_folder)

        counted = spark.read.schema(counted.schema).parquet(counts_folder).filter("kept > 0").select(*keys, F.col("kept").alias("taken"))
        after = counted.unionByName(before).groupBy(*keys).agg(F.sum("taken").alias("taken")).persist()
        newest = _newest(after, "batch_started_at")
        open_still = after if newest is None else after.filter(end >= F.lit(newest - timedelta(seconds=delay_seconds)))
        carried.save(batch_id, open_still)
        for df in (after, fresh, before):
            df.unpersist()

    return (
        entries.writeStream.foreachBatch(place)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

