"""Streams equal their batch jobs, over several files and across a restart."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsignals.operators import metrics, perf
from opsignals.sources.schemas import SIGNALS
from opsignals.streaming import jobs
from opsignals.streaming.state import CarriedState, GrowingState, shared_folder
from test_running import ledger_loop

T0 = datetime(2024, 5, 1, 12, 0, 0)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


class Inbox:
    """A folder of Parquet files that arrive one after the other."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.count = spark, str(path), schema, 0

    def put(self, rows):
        self.count += 1
        df = self.spark.createDataFrame(rows, self.schema).coalesce(1)
        df.write.mode("append").parquet(self.path)
        time.sleep(0.05)  # files are taken in order of their time

    def stream(self):
        schema = self.spark.createDataFrame([], self.schema).schema
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def test_ledger_over_files_and_a_restart(spark, tmp_path):
    rng = random.Random(4)
    rows = [
        ("hot" if rng.random() < 0.5 else f"q{i % 4}", i, at(i * 7), "e", 0, rng.choice([200, 503, 503, 503, 0, 422]))
        for i in range(400)
    ]
    inbox = Inbox(spark, tmp_path / "in", SIGNALS["attempts"])
    out, state, checkpoint = (str(tmp_path / n) for n in ("out", "state", "checkpoint"))

    def run():
        jobs.stream_retry_ledger(inbox.stream(), out, state, checkpoint, delay=timedelta(minutes=5)).awaitTermination()

    rows[80:100] = rows[99:79:-1]  # out of order, within the delay, over two files
    inbox.put(rows[:90])
    inbox.put(rows[90:200])
    run()
    inbox.put(rows[200:210])
    inbox.put(rows[210:])
    inbox.put([("hot", 9999, at(8), "e", 0, 200)])  # long after its time was judged
    run()
    jobs.finish_retry_ledger(spark, out, state)
    got = {r.seq: (r.streak, r.state) for r in spark.read.parquet(out).collect()}
    assert got == ledger_loop([(q, s, ts, status) for q, s, ts, _, _, status in rows])
    assert [r.seq for r in spark.read.parquet(f"{state}/late").collect()] == [9999]


def test_metric_batches_keep_their_cap_over_files(spark, tmp_path):
    rows = [("m", float(i), "production", None, at(i % 120), i) for i in range(300)]
    rows += [("m", float("nan"), "production", None, at(3), 999)]
    inbox = Inbox(spark, tmp_path / "in", SIGNALS["metrics"])
    out, state, checkpoint = (str(tmp_path / n) for n in ("out", "state", "checkpoint"))
    for part in (rows[:100], rows[100:130], rows[130:]):
        inbox.put(part)
    jobs.stream_metric_batches(inbox.stream(), out, state, checkpoint, cap=60).awaitTermination()
    counts = spark.read.parquet(f"{out}/counts").groupBy("batch_started_at").agg(F.sum("kept"), F.sum("dropped"))
    want = metrics.metric_batch_counts(spark.createDataFrame(rows, SIGNALS["metrics"]), cap=60)
    assert sorted(map(tuple, counts.collect())) == sorted(
        map(tuple, want.select("batch_started_at", "kept", "dropped").collect())
    )
    entries = spark.read.parquet(f"{out}/entries")
    assert entries.count() == 120 and entries.filter("seq = 999").count() == 0


def test_a_batch_that_runs_again_sees_the_same_state(spark, tmp_path):
    carried = CarriedState(spark, str(tmp_path / "s"), "queue STRING, n LONG")
    assert carried.before(0).count() == 0
    carried.save(0, spark.createDataFrame([("q", 1)], "queue STRING, n LONG"))
    for _ in range(2):
        before = carried.before(1)
        carried.save(1, before.withColumn("n", F.col("n") + 1))
    assert carried.before(2).first().n == 2


def test_rollup_emits_closed_periods_once_with_late_rows(spark, tmp_path):
    schema = SIGNALS["timings"]
    inbox = Inbox(spark, tmp_path / "in", schema)
    first = [("a", 10.0, at(1), "p", None), ("a", 70.0, at(61), "p", None)]
    late = [("a", 30.0, at(30), "p", None), ("a", 20000.0, at(100), "p", None)]  # within the delay
    last = [("a", 1.0, at(1000), "p", None), ("b", 1.0, at(5000), "p", None)]
    for rows in (first, late, last):
        inbox.put(rows)
    out = str(tmp_path / "out")
    rolled = jobs.stream_perf_rollup(inbox.stream(), delay="5 minutes")
    jobs.write_parquet(rolled, out, str(tmp_path / "checkpoint")).awaitTermination()
    got = sorted((r.period_started_at, r.request_count, r.max_duration_ms, r.histogram) for r in spark.read.parquet(out).collect())
    batch = perf.perf_rollup(spark.createDataFrame(first + late + last[:1], schema))
    want = sorted((r.period_started_at, r.request_count, r.max_duration_ms, r.histogram) for r in batch.collect())
    assert got == want and len(got) == 3


def test_changes_pass_once_per_id(spark, tmp_path):
    schema = "change_id long, id string, occurred_at timestamp"
    inbox = Inbox(spark, tmp_path / "in", schema)
    inbox.put([(1, "a", at(0)), (2, None, at(1))])
    inbox.put([(3, "a", at(60)), (4, None, at(1)), (5, "b", at(2))])
    out = str(tmp_path / "out")
    kept = jobs.stream_change_dedupe(inbox.stream(), delay="1 hour")
    jobs.write_parquet(kept, out, str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(r.change_id for r in spark.read.parquet(out).collect()) == [1, 2, 4, 5]


def test_counts_of_a_batch_outlive_the_start_of_the_next(spark, tmp_path):
    day = 86_400
    inbox = Inbox(spark, tmp_path / "in", SIGNALS["metrics"])
    out, state, checkpoint = (str(tmp_path / n) for n in ("out", "state", "checkpoint"))
    inbox.put([("m", 1.0, "p", None, at(i), i) for i in range(10)] + [("m", 1.0, "p", None, at(day), 50)])
    inbox.put([("m", 1.0, "p", None, at(100 + i), 100 + i) for i in range(10)])
    inbox.put([("m", 1.0, "p", None, at(4 * day), 200)])
    inbox.put([("m", 1.0, "p", None, at(300), 300)])  # its batch is closed
    jobs.stream_metric_batches(inbox.stream(), out, state, checkpoint, period="1 day", cap=15).awaitTermination()
    counts = spark.read.parquet(f"{out}/counts").groupBy("batch_started_at").agg(F.sum("kept").alias("k"), F.sum("dropped").alias("d"))
    assert sorted((r.k, r.d) for r in counts.collect()) == [(1, 0), (1, 0), (15, 6)]


def test_whole_traces_are_released_or_discarded(spark, tmp_path):
    schema = "trace_id string, span_id string, started_at timestamp, is_root boolean, duration_ms double"
    spans = Inbox(spark, tmp_path / "spans", schema)
    hour = 3600
    spans.put([("slow", "s1", at(0), False, 1.0), ("fast", "f1", at(0), False, 1.0), ("never", "n1", at(0), False, 1.0)])
    spans.put([("slow", "s2", at(2 * hour), False, 1.0), ("fast", "f0", at(0), True, 999.0)])
    spans.put([("slow", "s0", at(1), True, 1000.0), ("fast", "f2", at(3), False, 1.0)])
    spans.put([("slow", "s3", at(2 * hour), False, 1.0), ("other", "o1", at(9 * hour), False, 1.0)])
    out, state, checkpoint = (str(tmp_path / n) for n in ("out", "state", "checkpoint"))
    jobs.stream_trace_capture(spans.stream(), out, state, checkpoint, expire=timedelta(hours=6)).awaitTermination()
    assert sorted(r.span_id for r in spark.read.parquet(out).collect()) == ["s0", "s1", "s2", "s3"]
    assert [r.span_id for r in spark.read.parquet(f"{state}/expired").collect()] == ["n1"]


def test_open_periods_are_there_as_they_stand(spark, tmp_path):
    inbox = Inbox(spark, tmp_path / "in", SIGNALS["timings"])
    inbox.put([("a", 10.0, at(1), "p", None)])
    inbox.put([("a", 30.0, at(30), "p", None), ("a", 5.0, at(70), "p", None)])
    out = str(tmp_path / "out")
    jobs.write_updates(jobs.stream_perf_rollup(inbox.stream()), out, str(tmp_path / "checkpoint")).awaitTermination()
    rows = jobs.latest(spark, out, [*perf.DIMENSIONS, "period_started_at"]).collect()
    assert sorted((r.request_count, r.max_duration_ms) for r in rows) == [(1, 5.0), (2, 30.0)]


def test_state_lives_in_the_folder_the_session_names(spark, tmp_path):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class Session:
        def __init__(self, value, master):
            self.conf = Conf(value)
            self.sparkContext = type("Context", (), {"master": master})()

    assert shared_folder(Session("/shared/x/", "yarn"), "n").startswith("/shared/x/n-")
    with pytest.raises(ValueError):
        shared_folder(Session(None, "yarn"), "n")


def test_the_first_change_in_event_time_wins(spark, tmp_path):
    schema = "change_id long, id string, occurred_at timestamp, details map<string,string>"
    inbox = Inbox(spark, tmp_path / "in", schema)
    inbox.put([(1, "a", at(600), {}), (2, None, at(1), {}), (9, "c", at(50), {}), (8, "c", at(50), {})])
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        firsts = jobs.stream_first_changes(inbox.stream(), delay="1 hour", horizon="1 day")
        jobs.write_updates(firsts, out, checkpoint).awaitTermination()

    run()
    inbox.put([(3, "a", at(60), {"k": "v"}), (5, "b", at(2), {})])
    inbox.put([(4, "a", at(700), {}), (6, "b", at(90_000), {})])  # the next horizon
    run()
    got = {r.id: (r.change_id, r.details) for r in jobs.first_changes(spark, out).collect()}
    assert got == {"a": (3, {"k": "v"}), "b": (5, {}), "c": (8, {})}


def test_growing_state_is_written_as_it_is_touched(spark, tmp_path):
    state = GrowingState(spark, str(tmp_path / "s"), "queue STRING, n LONG", ["queue"], whole=3)
    want = {}
    for batch in range(8):
        for _ in range(2):  # run again after a failure
            assert {r.queue: r.n for r in state.before(batch).collect()} == want
            touched = {f"q{batch % 3}": batch}
            state.save(batch, spark.createDataFrame(list(touched.items()), "queue STRING, n LONG"))
        want |= touched
    sizes = [spark.read.parquet(f"{tmp_path}/s/batch={n}").count() for n in range(8)]
    assert sizes == [1, 1, 1, 3, 1, 1, 3, 1]


def test_traces_survive_a_restart_and_a_hot_one_is_spread(spark, tmp_path):
    schema = "trace_id string, span_id string, started_at timestamp, is_root boolean, duration_ms double, data map<string,string>"
    spans = Inbox(spark, tmp_path / "spans", schema)
    out, state, checkpoint = (str(tmp_path / n) for n in ("out", "state", "checkpoint"))

    def run():
        jobs.stream_trace_capture(spans.stream(), out, state, checkpoint, expire=timedelta(hours=6), salts=4).awaitTermination()

    spans.put([("hot", f"h{i}", at(i), False, 1.0, {"k": "v"}) for i in range(100)] + [("b", "b1", at(5), False, 1.0, {})])
    run()
    spans.put([("hot", "root", at(0), True, 2000.0, {}), ("b", "b0", at(0), True, 1.0, {})])
    spans.put([("hot", "late", at(9), False, 1.0, None), ("hot", "root", at(0), True, 2000.0, {})])
    run()
    got = sorted(r.span_id for r in spark.read.parquet(out).collect())
    assert got == sorted([*[f"h{i}" for i in range(100)], "late", "root", "root"])
    assert spark.read.parquet(f"{state}/expired").count() == 0
