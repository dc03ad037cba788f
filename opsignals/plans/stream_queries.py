"""The streaming jobs over the given tables, each run to completion and read back."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsignals.operators import perf
from opsignals.plans.queries import _CARRY_SQL, _VALID_METRICS, _money, _stamp, query
from opsignals.plans.views import VIEWS
from opsignals.streaming import jobs
from opsignals.streaming.state import shared_folder


_DISORDER = timedelta(days=2)


def _events(spark, sf_dir) -> DataFrame:
    """The events table as a stream of four micro-batches. Their times overlap by a day, so rows come
    out of order and carried state is used. Each quarter is written by as many tasks as the session
    shuffles with and read as one micro-batch."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    day = F.unix_date(F.col("ts").cast("date")) + F.pmod(F.xxhash64("event_id"), F.lit(2))
    first, last = events.agg(F.min(day), F.max(day)).first()
    folder, files = shared_folder(spark, "events"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    for k in range(4):
        share = events.filter(F.lit(False)) if first is None else events.filter(
            F.floor((day - first) * 4 / (last - first + 1)) == k
        )
        share.repartition(files).write.mode("append").parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _stream_view(spark, sf_dir, name: str, time: str) -> DataFrame:
    rows = spark.sql(VIEWS[name], events=_events(spark, sf_dir))
    return rows.withColumn(time, F.col(time).cast("timestamp"))


def _written(spark, df: DataFrame, name: str) -> DataFrame:
    folder = shared_folder(spark, name)
    jobs.write_parquet(df, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


@query(
    "stream_perf_rollup",
    """SELECT transaction_name, environment, release,
              strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS period_started_at,
              count(*) AS request_count, round(sum(duration_ms), 2) AS duration_sum_ms,
              round(max(duration_ms), 2) AS max_duration_ms
       FROM timings GROUP BY ALL""",
    ("timings",),
)
def stream_perf_rollup(spark, sf_dir):
    rolled = jobs.stream_perf_rollup(_stream_view(spark, sf_dir, "timings", "ts"), delay="2 days", period="1 hour")
    folder = shared_folder(spark, "perf-rollup")
    jobs.write_updates(rolled, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    # Periods still open at the end are there too, as they stand.
    return jobs.latest(spark, f"{folder}/out", [*perf.DIMENSIONS, "period_started_at"]).select(
        *perf.DIMENSIONS,
        _stamp("period_started_at").alias("period_started_at"),
        "request_count",
        _money("duration_sum_ms").alias("duration_sum_ms"),
        _money("max_duration_ms").alias("max_duration_ms"),
    )


@query(
    "stream_change_dedupe",
    """SELECT id, arg_min(change_id, (occurred_at, change_id)) AS change_id FROM changes WHERE id IS NOT NULL GROUP BY id
       UNION ALL SELECT id, change_id FROM changes WHERE id IS NULL""",
    ("changes",),
)
def stream_change_dedupe(spark, sf_dir):
    rows = _stream_view(spark, sf_dir, "changes", "occurred_at")
    folder = shared_folder(spark, "change-dedupe")
    firsts = jobs.stream_first_changes(rows, delay="3 days")
    jobs.write_updates(firsts, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    without = _written(spark, rows.filter(F.col("id").isNull()).select("id", "change_id"), "changes-without-id")
    return jobs.first_changes(spark, f"{folder}/out").select("id", "change_id").unionByName(without)


_TRACE_STEPS = """SELECT CAST(event_id AS STRING) AS trace_id, CAST(ts AS TIMESTAMP) AS ended_at, value * 60 AS duration_ms,
    event_type FROM {events} WHERE event_type IN ('purchase', 'signup')"""


@query(
    "stream_trace_capture",
    """WITH roots AS (SELECT CAST(event_id AS VARCHAR) AS trace_id, value * 60 AS duration_ms
                      FROM events WHERE event_type = 'purchase')
       SELECT trace_id, CAST(minutes AS INTEGER) AS minutes
       FROM roots, (VALUES (0), (5), (30), (90)) AS m(minutes) WHERE duration_ms >= 1000""",
)
def stream_trace_capture(spark, sf_dir):
    # A purchase is the root of three earlier steps; a signup's steps never get a root.
    steps = spark.sql(_TRACE_STEPS, events=_events(spark, sf_dir))
    spans = steps.select("*", F.explode(F.array(*[F.lit(m) for m in (0, 5, 30, 90)])).alias("minutes")).select(
        "trace_id",
        "minutes",
        (F.col("ended_at") - F.make_dt_interval(mins=F.col("minutes"))).alias("started_at"),
        ((F.col("minutes") == 0) & (F.col("event_type") == "purchase")).alias("is_root"),
        "duration_ms",
    )
    folder = shared_folder(spark, "trace-capture")
    jobs.stream_trace_capture(
        spans, f"{folder}/out", f"{folder}/state", f"{folder}/checkpoint", expire=2 * _DISORDER
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("trace_id", "minutes")


@query(
    "stream_retry_ledger",
    _CARRY_SQL + "SELECT queue, seq, status, outcome, CAST(streak AS INTEGER) AS streak, state FROM ledger",
    ("attempts",),
)
def stream_retry_ledger(spark, sf_dir):
    folder = shared_folder(spark, "retry-ledger")
    attempts = _stream_view(spark, sf_dir, "attempts", "ts")
    jobs.stream_retry_ledger(
        attempts, f"{folder}/out", f"{folder}/state", f"{folder}/checkpoint", delay=_DISORDER
    ).awaitTermination()
    jobs.finish_retry_ledger(spark, f"{folder}/out", f"{folder}/state")
    ledger = spark.read.parquet(f"{folder}/out")
    return ledger.select("queue", "seq", "status", "outcome", "streak", "state")


@query(
    "stream_metric_batches",
    f""", ranked AS (SELECT *, date_trunc('day', recorded_at) AS day,
                            row_number() OVER (PARTITION BY environment, release, date_trunc('day', recorded_at)
                                               ORDER BY recorded_at, seq) AS rn
                     FROM {_VALID_METRICS})
       SELECT environment, release, strftime(day, '%Y-%m-%d %H:%M:%S') AS batch_started_at,
              CAST(count(CASE WHEN rn <= 15 THEN 1 END) AS BIGINT) AS kept,
              CAST(count(CASE WHEN rn > 15 THEN 1 END) AS BIGINT) AS dropped
       FROM ranked GROUP BY ALL""",
    ("metrics",),
)
def stream_metric_batches(spark, sf_dir):
    folder = shared_folder(spark, "metric-batches")
    entries = _stream_view(spark, sf_dir, "metrics", "recorded_at")
    jobs.stream_metric_batches(
        entries, f"{folder}/out", f"{folder}/state", f"{folder}/checkpoint", period="1 day", cap=15
    ).awaitTermination()
    counts = spark.read.parquet(f"{folder}/out/counts")
    totals = counts.groupBy("environment", "release", "batch_started_at").agg(
        F.sum("kept").alias("kept"), F.sum("dropped").alias("dropped")
    )
    return totals.withColumn("batch_started_at", _stamp("batch_started_at"))
