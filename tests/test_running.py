"""Segmented running aggregates against a plain loop, with one hot key."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsignals.operators.delivery import retry_ledger
from opsignals.operators.running import first_n, running, sequence_segment, time_segment


def timeline(seed, n=1500):
    rng = random.Random(seed)
    start = datetime(2024, 3, 10, 1, 0, 0)
    rows = []
    for seq in range(n):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 40)}"
        ts = start + timedelta(seconds=rng.choice([0, 1, 30, 59, 60, 61, 3600, 7200]) + rng.randint(0, 200))
        value = rng.choice([None, rng.randint(-5, 9)])
        rows.append((key, seq, ts, value))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("include_current", [True, False])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_running_matches_a_loop(spark, include_current, kind):
    rows = timeline(3)
    df = spark.createDataFrame(rows, f"key string, seq long, ts {kind}, v int").repartition(5)
    out = running(
        df, ["key"], ["ts", "seq"], time_segment("ts"),
        {
            "total": ("sum", F.col("v")),
            "top": ("max", F.col("v")),
            "latest": ("last", F.col("v")),
            "latest_any": ("last", F.struct("v")),
        },
        include_current=include_current,
    )
    got = {r.seq: (r.total, r.top, r.latest, r.latest_any and r.latest_any.v) for r in out.collect()}
    want = {}
    state = {}
    for key, seq, _, v in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        seen = state.setdefault(key, [])
        if include_current:
            seen.append(v)
        known = [x for x in seen if x is not None]
        want[seq] = (
            sum(known) if known else None,
            max(known, default=None),
            known[-1] if known else None,
            seen[-1] if seen else None,
        )
        if not include_current:
            seen.append(v)
    assert got == want


def test_no_task_gets_more_than_a_segment_of_a_hot_key(spark):
    df = spark.range(10_000).select(F.lit("hot").alias("key"), F.col("id").alias("seq"))
    out = running(df, ["key"], ["seq"], sequence_segment("seq", 100), {"n": ("sum", F.lit(1))})
    assert out.filter(F.col("n") != F.col("seq") + 1).count() == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        largest = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert largest < 6_000


def test_time_segments_never_run_backwards(spark):
    # The hour that does not exist in this zone on this day.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        times = [datetime(2024, 3, 10, 1, 59), datetime(2024, 3, 10, 2, 30), datetime(2024, 3, 10, 3, 0)]
        df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
        segments = [r.s for r in df.select("ts", time_segment("ts").alias("s")).sort("ts").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert segments == sorted(segments) and len(set(segments)) == 3


def test_first_n_keeps_exactly_the_first_of_each_group(spark):
    rows = timeline(5)
    df = spark.createDataFrame(rows, "key string, seq long, ts timestamp, v int")
    got = {(r.key, r.seq) for r in first_n(df, ["key"], ["ts", "seq"], 7, salts=4).collect()}
    want = set()
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[1]))
        want |= {(key, r[1]) for r in mine[:7]}
    assert got == want
    assert first_n(df, ["key"], ["seq"], 0).count() == 0


def ledger_loop(rows, limit=5):
    streak, want = {}, {}
    for queue, seq, _, status in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        if 200 <= status < 300:
            outcome = "delivered"
        elif 400 <= status < 500 and status not in (408, 429):
            outcome = "rejected"
        else:
            outcome = "failed"
        if outcome != "failed":
            streak[queue] = 0
            want[seq] = (0, outcome)
            continue
        streak[queue] = streak.get(queue, 0) + 1
        want[seq] = (streak[queue], "dropped" if streak[queue] == limit else "kept")
        if streak[queue] == limit:
            streak[queue] = 0
    return want


def test_the_ledger_matches_a_loop(spark):
    rng = random.Random(11)
    rows = [
        (key, seq, ts, rng.choice([200, 503, 503, 503, 0, 429, 408, 301, 422]))
        for key, seq, ts, _ in timeline(8, 3000)
    ]
    df = spark.createDataFrame(rows, "queue string, seq long, ts timestamp, status int").repartition(6)
    got = {r.seq: (r.streak, r.state) for r in retry_ledger(df).collect()}
    assert got == ledger_loop(rows)
