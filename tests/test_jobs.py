"""Each job on a few rows whose result is worked out by hand."""

import json
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from opsignals.functions import sqltext
from opsignals.functions.latency import histogram_text
from opsignals.operators import changes, delivery, errors, metrics, perf, privacy, statements, traces
from opsignals.sources import export, scan
from opsignals.sources.schemas import SIGNALS

T0 = datetime(2024, 5, 1, 12, 0, 0)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def timings(spark, *rows):
    data = [(name, ms, at(s), "production", "r1") for name, ms, s in rows]
    return spark.createDataFrame(data, SIGNALS["timings"])


def test_rollup_counts_sums_and_starts_its_maximum_at_zero(spark):
    nan = float("nan")
    df = timings(spark, ("users", 10.0, 1), ("users", 30.0, 2), ("users", 5.0, 61), ("neg", -4.0, 1), ("nan", nan, 1),
                 ("nan", 7.0, 2), ("none", None, 1))
    got = {
        (r.transaction_name, r.period_started_at): (r.request_count, r.duration_sum_ms, r.max_duration_ms, r.histogram)
        for r in perf.perf_rollup(df).collect()
    }
    assert got[("users", at(0))] == (2, 40.0, 30.0, {"50": 2})
    assert got[("users", at(60))] == (1, 5.0, 5.0, {"50": 1})
    assert got[("neg", at(0))] == (1, -4.0, 0.0, {"50": 1})
    assert got[("nan", at(0))][2:] == (7.0, {"50": 1, "inf": 1})
    assert len(got) == 4


def test_merged_parts_equal_the_whole_and_percentiles_read_buckets(spark):
    values = [10.0, 40.0, 120.0, 700.0, 12000.0]
    df = timings(spark, *[("a", v, 40 * i) for i, v in enumerate(values)])
    whole = perf.latency_histogram(df).first().histogram
    assert whole == {"50": 2, "250": 1, "1000": 1, "inf": 1}
    samples = perf.perf_rollup(df)
    merged = perf.histogram_merge(samples).first()
    assert merged.histogram == whole and merged.request_count == sum(whole.values()) == 5
    assert merged.period_ended_at > merged.period_started_at == at(0)
    p = perf.histogram_percentiles(samples).first()
    assert (p.p50, p.p95, p.p99) == (250.0, 12000.0, 12000.0)


def test_strict_rollup_joins_the_paths_of_a_route(spark):
    df = timings(spark, ("GET /people/42", 1.0, 0), ("GET /people/43", 2.0, 1), ("/people/x/y?z", 3.0, 2),
                 ("Orders#create", 4.0, 3), ("GET /u/:id", 5.0, 4))
    got = {r.transaction_name: r.request_count for r in perf.perf_rollup_strict(df).collect()}
    assert got == {"GET /people/:path": 2, "/people/:path": 1, "Orders#create": 1, "GET /u/:id": 1}


def tally(spark, *rows):
    return spark.createDataFrame(
        rows,
        "transaction_name string, request_count long, duration_sum_ms double, max_duration_ms double,"
        " histogram map<string,long>",
    )


def test_remaining_is_what_was_not_sent(spark):
    now = tally(spark, ("x", 2, 35.0, 25.0, {"50": 2}), ("new", 1, 7.0, 7.0, {"50": 1}), ("done", 1, 3.0, 3.0, {"50": 1}))
    sent = tally(spark, ("x", 1, 10.0, 10.0, {"50": 1, "inf": 4}), ("done", 1, 4.0, 3.0, {"50": 1}))
    got = {r.transaction_name: tuple(r)[1:] for r in perf.perf_remaining(now, sent).collect()}
    assert got == {"x": (1, 25.0, 25.0, {"50": 1}), "new": (1, 7.0, 7.0, {"50": 1})}
    released = [d.withColumn("release", F.lit(None).cast("string")) for d in (now, sent)]
    again = perf.perf_remaining(*released, ("transaction_name", "release"))
    assert {r.transaction_name: r.request_count for r in again.collect()} == {"x": 1, "new": 1}


def test_a_failed_flush_goes_into_the_next(spark):
    log = [("q", i, at(i), s) for i, s in enumerate([503, 200, 500, 422, 503, 503, 503, 503, 503, 503])]
    flushes = spark.createDataFrame(log, "queue string, seq long, ts timestamp, status int")
    samples = spark.createDataFrame(
        [("q", i, "a", at(i), at(i + 1), 1, 10.0 * i, 10.0 * i, {"50": 1}) for i in range(10)],
        "queue string, seq long, transaction_name string, period_started_at timestamp, period_ended_at timestamp,"
        " request_count long, duration_sum_ms double, max_duration_ms double, histogram map<string,long>",
    )
    got = sorted(
        (r.closing_seq, r.closed_as, r.request_count, r.period_started_at, r.period_ended_at)
        for r in perf.perf_carry_over(samples, flushes, ("transaction_name",)).collect()
    )
    assert got == [
        (1, "delivered", 2, at(0), at(2)),
        (3, "rejected", 2, at(2), at(4)),
        (8, "dropped", 5, at(4), at(9)),
    ]


def test_outcomes_and_reasons(spark):
    codes = [200, 204, 400, 413, 408, 429, 500, 301, 0]
    df = spark.createDataFrame([("e", c) for c in codes], "endpoint string, status int")
    got = {(r.outcome, r.reason): r.attempts for r in delivery.delivery_outcomes(df).collect()}
    assert got[("delivered", None)] == 2
    assert got[("rejected", "rejected by the server (HTTP 413)")] == 1
    assert got[("failed", "the server could not be reached")] == 1
    assert sum(n for (o, _), n in got.items() if o == "failed") == 5


def test_metric_values(spark):
    texts = ["3", " -2.5e1 ", "null", None, "true", '"12"', "1e999", "NaN", "{}", "012"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, value string")
    got = {r.i: (r.value, r.reason) for r in metrics.metric_validate(df).collect()}
    assert got[0] == (3.0, None) and got[1] == (-25.0, None)
    assert [got[i][1] for i in range(2, 10)] == [
        "missing", "missing", "not a number", "not a number", "not finite", "not a number", "not a number", "not a number",
    ]
    doubles = spark.createDataFrame([(1.0,), (float("nan"),), (float("-inf"),), (None,)], "value double")
    assert metrics.valid_metrics(doubles).count() == 1
    assert metrics.valid_metrics(spark.createDataFrame([(True,)], "value boolean")).count() == 0


def test_batches_keep_the_first_entries_of_a_period(spark):
    rows = [("m", float(i), "production", None, at(0), i) for i in range(1050)]
    rows += [("m", 1.0, "production", None, at(60), 2000), ("m", float("nan"), "production", None, at(1), 3000)]
    df = spark.createDataFrame(rows, SIGNALS["metrics"])
    kept = metrics.metric_batches(df, cap=1000).collect()
    assert sorted(r.seq for r in kept) == [*range(1000), 2000]
    counts = {r.batch_started_at: (r.kept, r.dropped) for r in metrics.metric_batch_counts(df, cap=1000).collect()}
    assert counts == {at(0): (1000, 50), at(60): (1, 0)}
    totals = metrics.metric_totals(df).first()
    assert totals.entries == 1051 and float(totals.total) == sum(range(1050)) + 1


def test_host_falls_back_to_the_server_and_latest_is_by_time(spark):
    rows = [("cpu", 1.0, "h", None, at(0), 0), ("cpu", 9.0, "", "srv", at(5), 1), ("cpu", 3.0, None, "srv", at(9), 2),
            ("cpu", 4.0, "", None, at(1), 3)]
    df = spark.createDataFrame(rows, SIGNALS["infra_metrics"])
    got = {r.host: (r.readings, r.lowest, r.highest, r.average, r.latest) for r in metrics.infra_rollup(df).collect()}
    assert got == {"h": (1, 1.0, 1.0, 1.0, 1.0), "srv": (2, 3.0, 9.0, 6.0, 3.0), "": (1, 4.0, 4.0, 4.0, 4.0)}


def test_changes_are_cleaned(spark):
    rows = [
        (1, "config", "\v  Raised\n", None, None, '{"a":1}'),
        (2, "Config", "é" * 250, "staging", at(3), "{}"),
        (3, "config", " \t\f\r\n", None, None, None),
        (4, "", "x", None, None, "[1]"),
    ]
    df = spark.createDataFrame(
        rows, "change_id int, kind string, title string, environment string, occurred_at timestamp, details string"
    )
    got = {r.change_id: tuple(r)[1:] for r in changes.change_normalize(df, now=F.lit(at(99))).collect()}
    assert got == {
        1: ("config", "Raised", "production", at(99), '{"a":1}'),
        2: ("other", "é" * 250, "staging", at(3), None),
        4: ("other", "x", "production", at(99), None),
    }
    short = changes.change_normalize(df, now=F.lit(at(99)), max_title=200).filter("change_id = 2").first()
    assert short.title == "é" * 200


def test_the_first_of_an_id_wins_and_rows_without_one_stay(spark):
    rows = [(1, "a", at(5), 1), (2, "a", at(3), 2), (3, None, at(1), 3), (4, None, at(1), 4), (5, "b", at(0), 5)]
    df = spark.createDataFrame(rows, "change_id int, id string, occurred_at timestamp, seq long")
    assert sorted(r.change_id for r in changes.change_dedupe(df).collect()) == [2, 3, 4, 5]


def test_impact_counts_half_open_intervals(spark):
    ch = spark.createDataFrame([(1, "p", at(3600)), (2, "q", at(0)), (3, "p", at(3600)), (4, None, at(0))], "change_id long, environment string, occurred_at timestamp")
    er = spark.createDataFrame(
        [("p", at(s)) for s in (0, 1, 3599, 3600, 3600, 7199, 7200)], "environment string, occurred_at timestamp"
    )
    sa = spark.createDataFrame(
        [("p", at(3600), 5000.0), ("p", at(10), 999.0), ("p", at(10), 1000.0)],
        "environment string, period_started_at timestamp, max_duration_ms double",
    )
    got = {r.change_id: (r.errors_before, r.errors_after, r.slow_before, r.slow_after)
           for r in changes.change_impact(ch, er, sa).collect()}
    assert got == {1: (3, 3, 1, 1), 2: (0, 0, 0, 0), 3: (3, 3, 1, 1), 4: (0, 0, 0, 0)}


def span_events(spark, *rows):
    data = [("t", None, i, op, sid, sid, "service", at(i), 1.0, {}) for i, (op, sid) in enumerate(rows)]
    return spark.createDataFrame(data, SIGNALS["span_events"])


def test_a_span_belongs_under_what_was_open_when_it_started(spark):
    ev = span_events(spark, ("open", "charge"), ("leaf", "sql"), ("open", "inner"), ("leaf", "deep"), ("close", "inner"),
                     ("close", "charge"), ("leaf", "after"), ("open", "never closed"), ("leaf", "under it"),
                     ("close", "lost opening"))
    header = f"00-{'a' * 32}-{'b' * 16}-01"
    roots = spark.createDataFrame(
        [("t", "root", header, "GET /", at(0), 9.0)],
        "trace_id string, span_id string, traceparent string, name string, started_at timestamp, duration_ms double",
    )
    from opsignals.operators.running import sequence_segment

    for length in (1, 2, 100):
        tree = traces.span_tree(ev, roots, segment=sequence_segment("seq", length))
        got = {r.span_id: r.parent_span_id for r in tree.collect()}
        assert got == {
            "root": "b" * 16, "charge": "root", "sql": "charge", "inner": "charge", "deep": "inner", "after": "root",
            "under it": "never closed", "lost opening": "root",
        }


def test_a_close_before_its_opening_closes_nothing(spark):
    ev = span_events(spark, ("open", "outer"), ("close", "late"), ("leaf", "one"), ("close", "later"), ("open", "inner"), ("leaf", "two"),
                     ("open", "late"), ("leaf", "three"), ("close", "inner"), ("open", "last"), ("leaf", "four"), ("close", "last"),
                     ("close", "outer"), ("open", "later"), ("leaf", "five"))
    header = f"00-{'a' * 32}-{'b' * 16}-01"
    roots = spark.createDataFrame(
        [("t", "root", header, "GET /", at(0), 5000.0)],
        "trace_id string, span_id string, traceparent string, name string, started_at timestamp, duration_ms double",
    )
    from opsignals.operators.running import sequence_segment

    want = {
        "outer": ("root", 12), "late": ("inner", 1), "one": ("outer", 2), "later": ("root", 3), "inner": ("outer", 8), "two": ("inner", 5),
        "three": ("inner", 7), "last": ("outer", 11), "four": ("last", 10), "five": ("root", 14),
    }
    for length in (1, 2, 5, 100):
        segment = sequence_segment("seq", length)
        tree = traces.span_tree(ev, roots, segment=segment).filter("NOT is_root")
        assert {r.span_id: (r.parent_span_id, r.seq) for r in tree.collect()} == want
        kept = traces.captured_traces(ev, roots, cap=4, segment=segment).filter("NOT is_root")
        assert {r.span_id: (r.parent_span_id, r.seq) for r in kept.collect()} == {s: want[s] for s in ("late", "one", "later")}


def spans(spark, rows):
    return spark.createDataFrame(
        [(t, s, s, "db" if root else "service", ms, seq, root) for t, s, ms, seq, root in rows],
        "trace_id string, span_id string, name string, kind string, duration_ms double, seq long, is_root boolean",
    )


def test_a_trace_keeps_its_root_and_the_first_spans_recorded(spark):
    rows = [("t", "root", 5.0, 10_000, True)] + [("t", f"s{i}", 1.0, i, False) for i in range(700)]
    kept = {r.span_id for r in traces.span_cap(spans(spark, rows), cap=500).collect()}
    assert kept == {"root", *[f"s{i}" for i in range(499)]}


def test_a_trace_is_kept_when_its_root_reaches_the_threshold(spark):
    rows = [("slow", "a", 1000.0, 1, True), ("slow", "b", 1.0, 2, False), ("fast", "c", 999.999, 1, True), ("fast", "d", 5000.0, 2, False)]
    df = spans(spark, rows)
    assert {r.span_id for r in traces.trace_capture(df).collect()} == {"a", "b"}
    assert traces.trace_capture(df, enabled=False).count() == 0


def test_spans_are_cleaned_and_strictly_reduced(spark):
    rows = [
        ("SELECT p", "database", 1.005, {"db.system": " MySQL\n", "db.statement": 'a = "x" AND b = 4', "who": "jo"}),
        ("q", "database", 1.0, {"db.system": "  ", "db.statement": " "}),
        ("q", "db", 1.0, {"db.statement": "a = 4"}),
        ("GET https://h.example.org/p/1", "http", 2.344, None),
    ]
    df = spark.createDataFrame(rows, "name string, kind string, duration_ms double, data map<string,string>")
    plain = [(r.name, r.kind, r.duration_ms, r.data) for r in traces.span_normalize(df).collect()]
    assert plain[0] == ("SELECT p", "database", round(1.005 * 100) / 100, {"db.system": "mysql", "db.statement": "a = ? AND b = ?", "who": "jo"})
    assert plain[1][3] == {} and plain[2][1:] == ("other", 1.0, {"db.statement": "a = 4"})
    assert plain[3][1:] == ("http", 2.34, {})
    strict = [(r.name, r.data) for r in traces.span_normalize(df, strict=True).collect()]
    assert strict[0] == ("SELECT p", {"db.system": "mysql", "db.statement": "a = ? AND b = ?"})
    assert strict[3] == ("GET h.example.org", {})


def trace_rows(spark, *rows):
    return spark.createDataFrame(
        [(f"t{i}", th, i, "n", f"h{i}", at(a), at(b)) for i, (th, a, b) in enumerate(rows)], SIGNALS["traces"]
    )


def test_a_nested_trace_joins_the_outer_one(spark):
    df = trace_rows(spark, ("x", 0, 100), ("x", 10, 50), ("x", 60, 90), ("x", 100, 120), ("y", 20, 30))
    got = {r.own_trace_id: (r.trace_id, r.kind, r.traceparent) for r in traces.trace_collapse(df).collect()}
    assert got == {
        "t0": ("t0", "controller", "h0"), "t1": ("t0", "service", None), "t2": ("t0", "service", None),
        "t3": ("t3", "controller", "h3"), "t4": ("t4", "controller", "h4"),
    }


def test_roots_meet_the_span_that_called_them(spark):
    t, s = "a" * 32, "b" * 16
    schema = "trace_id string, span_id string, name string, service string, traceparent string"
    roots = spark.createDataFrame([("own1", "r1", "x", "A", f"00-{t}-{s}-01"), ("own2", "r2", "y", "B", "00-nope"), ("own3", "r3", "z", "C", None)], schema)
    callers = spark.createDataFrame([(t, s, "POST /pay", "shop", None)], schema)
    got = {r.span_id: (r.trace_id, r.parent_span_id, r.caller_service) for r in traces.traceparent_stitch(roots, callers).collect()}
    assert got == {"r1": (t, s, "shop"), "r2": ("own2", None, None), "r3": ("own3", None, None)}


def test_calls_are_named_by_host_and_headers_go_to_targets(spark):
    urls = ["https://api.Example.com/x?token=1", "http://badexample.com/", "https://example.com", "nope", "http://1.2.3.4:9/"]
    df = spark.createDataFrame([("post" if i else None, u, 2.0) for i, u in enumerate(urls)], "method string, url string, duration_ms double")
    calls = {r.call: r.calls for r in traces.outbound_calls(df).collect()}
    assert calls == {"GET api.example.com": 1, "POST badexample.com": 1, "POST example.com": 1, "POST unknown": 1, "POST 1.2.3.4": 1}

    def sent(*args, **kw):
        return {r.host for r in traces.propagation_audit(df, *args, **kw).filter("sent").collect()}

    assert sent([".EXAMPLE.com"]) == {"api.example.com", "example.com"}
    assert sent([""]) == sent([]) == set()
    assert sent([], [r"^\d+\."]) == {"1.2.3.4"}
    assert len(sent(None)) == 5 and sent(None, enabled=False) == set()
    table = spark.createDataFrame([(".EXAMPLE.com", None), ("", None), (None, r"^\d+\.")], "host string, pattern string")
    assert sent(table) == {"api.example.com", "example.com", "1.2.3.4"} and sent(table.filter("false")) == set()


def test_thousands_of_patterns_meet_the_hosts_they_may_match(spark):
    rng = random.Random(7)
    names = [f"{rng.choice(['api', 'www', 'cdn', 'x'])}{rng.randint(0, 400)}.{rng.choice(['shop', 'example', 'a-b'])}.{rng.choice(['com', 'org', 'io'])}" for _ in range(400)]
    df = spark.createDataFrame([("GET", f"https://{n}/p", 1.0) for n in names], "method string, url string, duration_ms double")
    patterns = [rf"^api{i}\.example\.com$" for i in range(9900)] + [rf"never{i}" for i in range(100)]
    odd = [
        r"^\d", r"[xw]\d{2,3}\.shop", r"(shop|example)\.io", r"cdn7?1\.", r"www1+\.a-b", r"a\-b\.(?:com)?org", r"(?i)WWW3.\.", r"x[0-4]{3}\.(ex)ample",
        r"(.)\1\.io$", r"api\d+\.shop\.com|zzz", r"^x(?=9)", r"\bwww99\b", r"shopp*\.c.m$", r"Upper", r"ww{2}40", r"cdn\d\.", r"\\dx", r"a.*b\.io",
    ]
    for chosen in (patterns, odd, patterns + odd, odd[8:9], [r"cdn7?1\."], [r"www1+\.a-b"], [r"shopp*\.c.m$"], [r"ww{2}40"]):
        table = spark.createDataFrame([(None, p) for p in chosen], "host string, pattern string")
        audit = traces.propagation_audit(df, table)
        want = {n for p in map(re.compile, chosen) for n in set(names) if p.search(n)}
        assert {r.host for r in audit.filter("sent").collect()} == want, chosen[:5]
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def user(i):
    return Row(id=i, email=None, username=None)


ERROR_SCHEMA = SIGNALS["errors"]


def error(spark, *rows):
    base = {"exception_class": "E", "message": "m", "backtrace": [], "environment": "production", "context": {}, "tags": {}}
    names = [f.name for f in spark.createDataFrame([], ERROR_SCHEMA).schema]
    data = [tuple({**base, **r}.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, ERROR_SCHEMA)


def test_an_error_takes_the_user_set_before_it(spark):
    er = error(
        spark,
        {"error_id": 1, "thread_id": "a", "seq": 5, "occurred_at": at(100)},
        {"error_id": 2, "thread_id": "a", "seq": 6, "occurred_at": at(200)},
        {"error_id": 3, "thread_id": "a", "seq": 7, "occurred_at": at(200), "user": user("own")},
        {"error_id": 4, "thread_id": "b", "seq": 8, "occurred_at": at(200)},
        {"error_id": 5, "thread_id": "a", "seq": 0, "occurred_at": at(1)},
    )
    st = spark.createDataFrame([("a", 1, at(2), user("u1")), ("a", 2, at(150), None)], SIGNALS["set_user"])
    got = {r.error_id: r.user and r.user.id for r in errors.user_asof(er, st).collect()}
    assert got == {1: "u1", 2: None, 3: "own", 4: None, 5: None}


def crumbs(spark, *rows):
    return spark.createDataFrame([(th, i, at(s), op, "c", f"m{i}", "info", {}) for i, (th, s, op) in enumerate(rows)], SIGNALS["breadcrumbs"])


def test_a_trail_is_the_last_crumbs_since_the_last_clear(spark):
    bc = crumbs(spark, ("a", 1, "add"), ("a", 2, "add"), ("a", 3, "clear"), ("a", 4, "add"), ("a", 70, "add"), ("a", 140, "add"), ("b", 1, "add"))
    er = error(
        spark,
        {"error_id": 1, "thread_id": "a", "seq": 99, "occurred_at": at(2)},
        {"error_id": 2, "thread_id": "a", "seq": 99, "occurred_at": at(3)},
        {"error_id": 3, "thread_id": "a", "seq": 99, "occurred_at": at(500)},
        {"error_id": 4, "thread_id": "c", "seq": 99, "occurred_at": at(500)},
    )
    def trails(limit=30, **kw):
        kw["limit"] = limit
        return {r.error_id: [b.message for b in r.breadcrumbs] for r in errors.breadcrumb_trail(er, bc, **kw).collect()}

    assert trails() == {1: ["m0", "m1"], 2: [], 3: ["m3", "m4", "m5"], 4: []}
    assert trails(limit=2) == {1: ["m0", "m1"], 2: [], 3: ["m4", "m5"], 4: []}
    assert trails(strict=True) == {1: [], 2: [], 3: [], 4: []}


def test_an_error_carries_the_trace_open_on_its_thread(spark):
    tr = trace_rows(spark, ("x", 0, 100), ("x", 10, 50), ("y", 0, 10))
    er = error(spark, *[{"error_id": i, "thread_id": th, "seq": i, "occurred_at": at(s)}
                        for i, (th, s) in enumerate([("x", 0), ("x", 20), ("x", 100), ("x", 101), ("y", 11), ("z", 1)])])
    got = {r.error_id: r.trace_id for r in errors.error_trace_asof(er, tr).collect()}
    assert got == {0: "t0", 1: "t0", 2: "t0", 3: None, 4: None, 5: None}


def test_errors_of_all_services_meet_their_trace(spark):
    er = error(spark, *[{"error_id": i, "trace_id": t, "service": s} for i, (t, s) in enumerate([("t", "b"), ("t", "a"), ("t", "a"), (None, "a"), ("u", "a")])])
    sp = spans(spark, [("t", "1", 2.0, 1, True), ("t", "2", 3.0, 2, False)])
    got = {r.trace_id: (r.errors, r.services, r.spans, r.total_ms) for r in errors.error_trace_link(er, sp).collect()}
    assert got == {"t": (3, ["a", "b"], 2, 5.0), "u": (1, ["a"], None, None)}


def test_issues_group_by_what_does_not_vary(spark):
    rows = [("no row 1", "u1", 0), ("no row 22", "u1", 9), ("no row 3", "u2", 5), ("no row x", None, 1)]
    er = error(spark, *[{"error_id": i, "message": m, "user": user(u), "occurred_at": at(s)} for i, (m, u, s) in enumerate(rows)])
    got = {r["sample"]: (r.events, r.users, r.first_seen, r.last_seen) for r in errors.issue_groups(er).collect()}
    assert got == {"no row <n>": (3, 2, at(0), at(9)), "no row x": (1, 0, at(1), at(1))}


def test_frames_are_read_from_text(spark):
    text = "\n".join(["0  app  0x1f  run(int, char) + 12", "junk", "1   libc.so  0xAb start + 3"] + ["2 app 0x1 loop + 1"] * 200)
    late = "\n".join(["x"] * 128 + ["9 app 0x1 too_late + 1"])
    df = spark.createDataFrame([(1, text), (2, text), (3, late)], "error_id int, backtrace_text string")
    got = {(r.image, r.symbol): (r.errors, r.in_app) for r in errors.frame_rollup(df, executable="app").collect()}
    first = {("app", "run(int, char)"): (2, True), ("libc.so", "start"): (2, False), ("app", "loop"): (2, True)}
    assert got == {**first, ("app", "too_late"): (1, True)}
    cut = errors.frame_rollup(df, executable="app", max_lines=128).collect()
    assert {(r.image, r.symbol): (r.errors, r.in_app) for r in cut} == first


def test_the_nearest_cause_with_a_statement_wins(spark):
    def chain(*causes):
        return {"causes": [Row(what=w, statement=s) for w, s in causes]}

    marker = "error, while compiling:  SELECT 1 \n"
    er = error(
        spark,
        {"error_id": 1, **chain(("a", "CALL x(1)"))},
        {"error_id": 2, **chain(("a", ""), (marker, None), ("b", "CALL y(1)"))},
        {"error_id": 3, **chain(("a", None), ("while compiling:  ", ""))},
        {"error_id": 4, **chain(*[("a", "")] * 6, ("b", "CALL z(1)"))},
        {"error_id": 5, **chain(*[("a", "")] * 5, ("b", "CALL z(1)"))},
    )
    got = {r.error_id: r.statement for r in errors.cause_chain_sql(er).collect()}
    assert got == {1: "CALL x(1)", 2: "SELECT 1", 4: "CALL z(1)", 5: "CALL z(1)"}
    near = er.select("error_id", errors.nearest_statement(F.col("causes"), max_depth=sqltext.CLIENT_CAUSES).alias("s"))
    assert {r.error_id: r.s for r in near.collect()} == {1: "CALL x(1)", 2: "SELECT 1", 3: None, 4: None, 5: "CALL z(1)"}


def test_an_event_is_assembled_redacted_and_made_strict(spark):
    er = error(spark, {
        "error_id": 1, "thread_id": "x", "seq": 9, "occurred_at": at(20), "message": "no row 8 for jo@mail.example.com",
        "statement": "SELECT * FROM people WHERE name = 'Jo'", "context": {"error_code": "E42", "name": "Jo", "nested": '{"a": [{"pwd": ["x"]}, "jo@mail.example.com", 1.10]}'},
        "tags": {"apiKey": "k", "mail": "jo@mail.example.com"},
        "backtrace": [Row(file="f jo@mail.example.com", line=None, method="m", in_app=True)],
    })
    st = spark.createDataFrame([("x", 1, at(2), Row(id="42", email="jo@mail.example.com", username="jo"))], SIGNALS["set_user"])
    bc = spark.createDataFrame([("x", 2, at(3), "add", "c", "mail jo@mail.example.com", "info", {"password": "p", "n": "1"})], SIGNALS["breadcrumbs"])
    tr = trace_rows(spark, ("x", 0, 100))
    full = errors.event_assemble(er, st, bc, tr, max_breadcrumbs=30, sql_statement=True).first()
    assert full.message == "no row 8 for [EMAIL FILTERED]"
    assert full.sql_statement == "SELECT * FROM people WHERE name = ?" and full.sql_objects.relations == ["people"]
    assert full.breadcrumbs[0].message == "mail [EMAIL FILTERED]" and full.breadcrumbs[0].data == {"password": "[FILTERED]", "n": "1"}
    assert full.tags == {"apiKey": "[FILTERED]", "mail": "[EMAIL FILTERED]"}
    assert full.context["nested"] == '{"a":[{"pwd":"[FILTERED]"},"[EMAIL FILTERED]",1.10]}'
    assert full.backtrace[0].file == "f [EMAIL FILTERED]"
    assert full.user.email == "jo@mail.example.com" and full.trace_id == "t0"

    strict = errors.event_assemble(er, st, bc, tr, max_breadcrumbs=30, strict=True, allowed=["error_code", "nested", "missing"]).first().asDict(True)
    import hashlib

    assert strict["message"] == ""
    assert strict["message_fingerprint"] == hashlib.sha256(b"no row <n> for [EMAIL FILTERED]").hexdigest()[:32]
    assert strict["context"] == {"error_code": "E42"} and strict["tags"] is None and strict["user"] == {"id": "42"}
    assert "breadcrumbs" not in strict and "sql_statement" not in strict and strict["sql_objects"]["relations"] == ["people"]
    bare = errors.event_assemble(er, st, bc, tr, max_breadcrumbs=30, sql_objects=False, redact=False).first().asDict(True)
    assert "sql_objects" not in bare and bare["message"].endswith("jo@mail.example.com")


def test_hits_are_counted_by_source(spark):
    df = spark.createDataFrame([("a", "x@y.org and z@y.org"), ("a", "plain"), ("b", "[EMAIL FILTERED] 123-45-6789")], "s string, t string")
    got = {(r.s, r.label): (r.hits, r.rows, r.rows_hit) for r in privacy.pii_audit(df, "t", "s").collect()}
    assert got[("a", "EMAIL")] == (2, 2, 1) and got[("b", "EMAIL")] == (0, 1, 1) and got[("b", "SSN")] == (1, 1, 1)


def test_secrets_are_hidden_by_key_at_any_depth(spark):
    body = {"user": {"password": "x", "note": "mail jo@y.org", "token": None}, "items": [{"api_key": [1, 2]}, "a@b.org"], "n": 4111111111111111, "b": True}
    df = spark.createDataFrame([(json.dumps(body),), (None,), ("not json a@b.org",)], "body string")
    out = [r.body for r in privacy.sensitive_key_redact(df, "body", json_text=True).collect()]
    assert json.loads(out[0]) == {
        "user": {"password": "[FILTERED]", "note": "mail [EMAIL FILTERED]", "token": None},
        "items": [{"api_key": "[FILTERED]"}, "[EMAIL FILTERED]"], "n": 4111111111111111, "b": True,
    }
    assert out[1:] == [None, "not json [EMAIL FILTERED]"]
    typed = spark.createDataFrame(
        [(Row(password="x", pin=None, notes=["a@b.org"], extra={"cvv": "1", "k": "a@b.org", "secret": None}, n=3),)],
        "c struct<password:string,pin:string,notes:array<string>,extra:map<string,string>,n:int>",
    )
    row = privacy.sensitive_key_redact(typed, "c").first().c
    assert row.password == "[FILTERED]" and row.notes == ["[EMAIL FILTERED]"] and row.n == 3
    assert row.extra == {"cvv": "[FILTERED]", "k": "[EMAIL FILTERED]", "secret": None}


def test_statements_and_touchpoints(spark):
    df = spark.createDataFrame(
        [("SELECT a FROM t WHERE x = 1", None, 2.0), ("SELECT a FROM t WHERE x = 22", None, 5.0), ("CALL p(1)", "mysql", 1.0), (" ", None, 1.0)],
        "statement string, db_system string, duration_ms double",
    )
    got = {r.statement: (r.calls, r.total_ms, r.max_ms) for r in statements.sql_digest(df).collect()}
    assert got == {"SELECT a FROM t WHERE x = ?": (2, 7.0, 5.0), "CALL p(?)": (1, 1.0, 1.0)}
    touched = {(r.name, r.object_kind, r.operation): r.errors for r in statements.sql_touchpoints(df).collect()}
    assert touched == {("t", "relation", "SELECT"): 2, ("p", "procedure", "CALL"): 1}


def test_the_gate_lets_enabled_projects_through(spark):
    projects = spark.createDataFrame(
        [(1, True, True, None), (2, True, False, None), (3, True, True, ["qa"]), (4, False, True, ["qa"])], SIGNALS["projects"]
    )
    rows = [(p, e) for p in (1, 2, 3, 4, 5) for e in ("production", "qa", None)]
    df = spark.createDataFrame(rows, "project_id long, environment string")
    assert {tuple(r) for r in scan.signal_gate(df, projects).collect()} == {(1, "production"), (3, "qa")}


def test_scans_keep_bad_lines(spark, tmp_path):
    lines = ['{"transaction_name":"a","duration_ms":1.5}', '{"transaction_name":"b","duration_ms":', '{"duration_ms":"x"}']
    (tmp_path / "in.json").write_text("\n".join(lines))
    df = scan.signal_scan(spark, "timings", str(tmp_path), fmt="json").cache()
    assert df.filter("_corrupt_record IS NULL").count() == 1 and df.filter("_corrupt_record IS NOT NULL").count() == 2
    out = str(tmp_path / "pq")
    df.drop("_corrupt_record").write.parquet(out)
    assert scan.signal_scan(spark, "timings", out).filter("transaction_name = 'a'").first().duration_ms == 1.5


def test_scanned_signals_pass_the_gate_and_the_jobs(spark, tmp_path):
    """From files to the gate to a job, for every signal that the gate knows."""
    projects = spark.createDataFrame([(1, True, True, ["production"])], SIGNALS["projects"])
    for name in SIGNALS:
        (tmp_path / name).mkdir()
        (tmp_path / name / "in.json").write_text('{"project_id":1,"environment":"production"}\n{"project_id":2}\n')
        df = scan.signal_scan(spark, name, str(tmp_path / name), fmt="json")
        if {"project_id", "environment"} <= set(df.columns):
            assert scan.signal_gate(df, projects).count() == 1, name
    lines = ['{"metric_name":"m","value":%s,"project_id":1,"environment":"production"}' % v for v in ("1.5", "true", '"12"', "null", "[1]")]
    (tmp_path / "metrics" / "in.json").write_text("\n".join([*lines, '{"metric_name":"m","project_id":1,"environment":"production"}']))
    df = scan.signal_gate(scan.signal_scan(spark, "metrics", str(tmp_path / "metrics"), fmt="json"), projects)
    reasons = sorted(str(r.reason) for r in metrics.metric_validate(df).collect())
    assert reasons == ["None", "missing", "missing", "not a number", "not a number", "not a number"]
    assert [r.value for r in metrics.valid_metrics(df).collect()] == [1.5]


@pytest.mark.parametrize("release", ["r1", None])
def test_documents_show_explicit_nulls_and_leave_the_rest_out(spark, tmp_path, release):
    rows = [("m", float(i), "production", release, at(i), i) for i in range(5)]
    df = spark.createDataFrame(rows, SIGNALS["metrics"])
    docs = export.batched_documents(df, "metrics", ["metric_name", "value", "release", "recorded_at"], ["environment"],
                                    ["recorded_at", "seq"], wrapper="metrics", max_items=2)
    parsed = sorted((json.loads(r.document)["metrics"] for r in docs.collect()), key=lambda m: m[0]["value"])
    assert [[e["value"] for e in p] for p in parsed] == [[0.0, 1.0], [2.0, 3.0], [4.0]]
    assert parsed[0][0] == {"metric_name": "m", "value": 0.0, "release": release, "recorded_at": "2024-05-01T12:00:00Z"}
    export.wire_export(docs, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).groupBy("endpoint").count().first() == ("custom_metrics", 3)
    ch = spark.createDataFrame([("config", "x", None)], "kind string, title string, id string")
    assert json.loads(export.single_documents(ch, "changes", ["kind", "title", "id"]).first().document) == {"kind": "config", "title": "x"}


def test_histogram_text_is_in_bucket_order(spark):
    df = spark.createDataFrame([({"inf": 1, "50": 2, "2500": 3},)], "h map<string,long>")
    assert df.select(histogram_text(F.col("h")).alias("t")).first().t == "50:2,2500:3,inf:1"


def test_a_batch_of_documents_is_exported_once(spark, tmp_path):
    path = str(tmp_path / "export")
    rows = [("m", float(i), "production", "r", at(i), i) for i in range(5)]
    df = spark.createDataFrame(rows, SIGNALS["metrics"])
    docs = export.batched_documents(df, "metrics", ["metric_name", "value"], ["environment"], ["recorded_at", "seq"], wrapper="metrics", max_items=2)
    assert export.committed(spark, path).isEmpty()
    # A batch that failed before its manifest is neither read nor added to.
    docs.select("endpoint", F.col("document").alias("value")).write.partitionBy("endpoint").text(f"{path}/documents/batch=a")
    assert export.export_batch(docs, path, "b") and export.exported(spark, path).count() == 3
    assert export.export_batch(docs, path, "a") and not export.export_batch(docs, path, "a")
    assert sorted(map(tuple, export.committed(spark, path).select("batch", "endpoint", "documents", "items").collect())) == [
        ("a", "custom_metrics", 3, 5), ("b", "custom_metrics", 3, 5),
    ]
    read = [json.loads(r.value)["metrics"] for r in export.exported(spark, path).filter("batch = 'a'").collect()]
    assert sorted(e["value"] for m in read for e in m) == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_traces_of_any_length_are_written_small(spark, tmp_path):
    sizes = {"a": 1, "b": 3, "c": 4, "d": 200, None: 5}
    rows = [(t, f"{t}-{i}", i * 10**6 if i else -1, f"GET /{i}", i == 0) for t, n in sizes.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "trace_id string, span_id string, seq long, name string, is_root boolean")
    docs = export.trace_documents(df, ["span_id", "name"], max_items=3)
    got = {}
    for r in docs.collect():
        d = json.loads(r.document)
        assert r.items == len(d["spans"]) <= 3
        got.setdefault(d.get("trace_id"), []).append([x["span_id"] for x in d["spans"]])
    assert {t: sorted(p, key=lambda x: int(x[0].split("-")[1])) for t, p in got.items()} == {
        t: [[f"{t}-{i}" for i in range(k, min(k + 3, n))] for k in range(0, n, 3)] for t, n in sizes.items()
    }
    path = str(tmp_path / "export")
    assert export.export_batch(docs.coalesce(1), path, "a")
    files = list((tmp_path / "export" / "documents").rglob("part-*"))
    written = export.committed(spark, path).first()
    assert sum(f.stat().st_size for f in files) < written.characters / 3
    assert sorted(r.value for r in export.exported(spark, path).collect()) == sorted(r.document for r in docs.collect())
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan  # short traces are told apart before they are shuffled


def test_a_breadcrumb_is_redacted_once_however_many_errors_show_it(spark):
    er = error(spark, *[{"error_id": i, "thread_id": "a", "seq": 10 + i, "occurred_at": at(10 + i)} for i in range(3)])
    mailed = crumbs(spark, ("a", 1, "add")).withColumn("message", F.lit("to jo@mail.example.com"))
    st, tr = (spark.createDataFrame([], SIGNALS[s]) for s in ("set_user", "traces"))
    full = errors.event_assemble(er, st, mailed, tr, max_breadcrumbs=30)
    assert [[b.message for b in r.breadcrumbs] for r in full.collect()] == [["to [EMAIL FILTERED]"]] * 3
    assert "transform(breadcrumbs#" not in full._jdf.queryExecution().analyzed().toString()


def test_sketches_of_parts_add_up_to_the_whole(spark):
    rng = random.Random(3)
    rows = [("E", f"code {rng.randint(0, 9)} at 0xff{i:04x}" if i % 3 else "plain", f"u{rng.randint(0, 4000)}", at(i)) for i in range(9000)]
    df = spark.createDataFrame(rows, "exception_class string, message string, u string, occurred_at timestamp")
    whole = {r.message_fingerprint: r for r in errors.issue_groups(df, user="u", lg_k=12).collect()}
    parts = [errors.issue_groups(df.filter(F.pmod(F.hash("u", "message"), F.lit(3)) == k), user="u", lg_k=12) for k in range(3)]
    merged = {r.message_fingerprint: r for r in errors.merge_issue_groups(parts[0].union(parts[1]).union(parts[2])).collect()}
    exact = {r.message_fingerprint: r for r in errors.issue_groups(df, user="u").collect()}
    for key, row in exact.items():
        for other in (whole[key], merged[key]):
            assert (other.events, other.first_seen, other.last_seen, other.sample) == (row.events, row.first_seen, row.last_seen, row.sample)
            assert abs(other.users - row.users) <= 0.05 * row.users  # four standard errors
        assert abs(merged[key].users - whole[key].users) <= 0.02 * row.users


def test_users_of_parts_add_up_exactly(spark):
    df = spark.range(60000).select(
        F.lit("E").alias("exception_class"), F.lit("plain").alias("message"), F.concat(F.lit("u"), F.col("id") % 30000).alias("u"),
        F.timestamp_seconds("id").alias("occurred_at"),
    )
    parts = [errors.issue_users(df.filter(F.pmod(F.hash("occurred_at"), F.lit(3)) == k), user="u") for k in range(3)]
    merged = errors.merge_issue_users(parts[0].union(parts[1]).union(parts[2])).collect()
    assert [(r.events, r.users) for r in merged] == [(60000, 30000)]
    whole = errors.issue_groups(df, user="u").select(merged[0].__fields__).collect()
    assert merged == whole


def test_the_merged_issues_count_users_exactly(spark, tmp_path):
    from __spark_entry__ import queries

    spark.range(240000).select(
        F.col("id").alias("event_id"), F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(CAST(id % 7 AS INT))").alias("ts"),
        (F.col("id") % 120000).alias("user_id"), F.lit("error").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    got = queries()["issue_groups_merged"](spark, str(tmp_path)).collect()
    # Ids divisible by three name a user; a quarter, a quarter and half of them are of each class.
    assert sum(r.events for r in got) == 240000
    assert {r.exception_class: r.users for r in got} == {"TimeoutError": 10000, "ValueError": 10000, "IOError": 20000}


def test_a_thousand_errors_of_one_thread_cost_a_list_each(spark):
    er = error(spark, *[{"error_id": i, "thread_id": "a", "seq": 2000 + i, "occurred_at": at(400 + i % 200)} for i in range(1000)])
    steps = [("a", s, "clear" if s == 150 else "add") for s in range(0, 300, 2)]
    trail = errors.breadcrumb_trail(er, crumbs(spark, *steps), limit=30)
    kept = [f"m{i}" for i, (_, s, _) in enumerate(steps) if s > 150][-30:]
    assert {tuple(b.message for b in r.breadcrumbs) for r in trail.collect()} == {tuple(kept)} and trail.count() == 1000
    plan = trail._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and trail.columns == [*[c for c in er.columns if c != "breadcrumbs"], "breadcrumbs"]


def test_whole_trails_equal_a_loop(spark):
    rng = random.Random(12)
    steps = [(rng.choice("abc"), i * 7 % 400 + i, rng.choice(["add"] * 9 + ["clear"])) for i in range(400)]
    er = error(spark, *[{"error_id": i, "thread_id": rng.choice("abcd"), "seq": 1000 + i, "occurred_at": at(rng.randint(0, 800))} for i in range(200)])
    for limit in (1, 3, 50):
        got = {r.error_id: [b.message for b in r.breadcrumbs] for r in errors.breadcrumb_trail(er, crumbs(spark, *steps), limit=limit).collect()}
        want = {}
        for e in er.select("error_id", "thread_id", "seq", "occurred_at").collect():
            mine = []
            for i, (thread, s, op) in sorted(enumerate(steps), key=lambda x: (x[1][1], x[0])):
                if thread == e.thread_id and (at(s), i) < (e.occurred_at, e.seq):
                    mine = [] if op == "clear" else [*mine, f"m{i}"]
            want[e.error_id] = mine[-limit:]
        assert got == want


def test_captured_traces_equal_the_four_jobs_one_after_another(spark):
    rng = random.Random(6)
    header = f"00-{'a' * 32}-{'b' * 16}-01"
    events, roots = [], []
    for t in range(60):
        trace, seq, stack = f"t{t}", 0, []
        roots.append((trace, f"{trace}-root", header, "GET /", at(t), rng.choice([10.0, 1000.0, 5000.0])))
        for i in range(300 if t == 7 else rng.randint(0, 25)):
            seq += rng.randint(1, 9)
            kind = rng.choice(["service", "http", "odd"])
            if stack and rng.random() < 0.4:
                sid = stack.pop()
                events.append((trace, None, seq, "close", sid, sid, kind, at(seq), rng.random(), {}))
            else:
                sid = f"{trace}-{i}"
                op = rng.choice(["open", "leaf"])
                stack += [sid] if op == "open" else []
                events.append((trace, None, seq, op, sid, sid, kind, at(seq), rng.random(), {}))
    ev = spark.createDataFrame(events, SIGNALS["span_events"])
    ro = spark.createDataFrame(roots, "trace_id string, span_id string, traceparent string, name string, started_at timestamp, duration_ms double")
    parent = {}
    for trace in {e[0] for e in events}:
        stack = [f"{trace}-root"]
        for _, _, _, op, sid, *_ in sorted((e for e in events if e[0] == trace), key=lambda e: e[2]):
            if op == "close":
                stack.pop()
            else:
                parent[sid] = stack[-1]
                stack += [sid] if op == "open" else []
    from opsignals.operators.running import sequence_segment

    for length in (3, 40, 10**6):
        segment = sequence_segment("seq", length)
        tree = traces.span_tree(ev, ro, segment=segment)
        found = {r.span_id: r.parent_span_id for r in tree.filter("NOT is_root").collect()}
        assert found == {s: p for s, p in parent.items() if s in {e[4] for e in events if e[3] != "open"}}
        want = traces.span_normalize(traces.span_cap(traces.trace_capture(tree), cap=8))
        got = traces.captured_traces(ev, ro, cap=8, segment=segment)
        assert sorted(map(str, got.select(sorted(got.columns)).collect())) == sorted(map(str, want.select(sorted(got.columns)).collect()))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"\bExchange hashpartitioning\(trace_id#\d+, \d+\)", plan)) == 1


@pytest.mark.parametrize("whole", [None, 150, 0])
def test_whole_traces_and_traces_in_segments_have_the_same_spans(spark, whole):
    rng = random.Random(8)
    header = f"00-{'a' * 32}-{'b' * 16}-01"
    events, roots, want = [], [], {}
    for t in range(40):
        trace, stack, pending, n = f"t{t}", [], [], rng.sample(range(4000), 700)
        if t % 9:
            roots.append((trace, f"{trace}-root", header, "GET /", at(t), rng.choice([10.0, 5000.0])))
        under = lambda: stack[-1] if stack else f"{trace}-root" if t % 9 else None  # noqa: B023, E731
        for i, seq in enumerate(sorted(n[: 600 if t == 7 else rng.randint(1, 25)])):
            sid, draw = f"{trace}-{i}", rng.random()
            op = "close" if draw < 0.45 else "open" if draw < 0.7 or pending else "leaf"
            if op == "close" and stack and draw < 0.3:
                sid = stack.pop()
                want[sid] = (under(), seq)
            elif op == "close":  # comes before its opening, which may never come
                pending.append((sid, seq))
                continue
            elif op == "open" and pending:
                sid, closed = pending.pop(rng.randrange(len(pending)))
                want[sid] = (under(), closed)
                events.append((trace, None, closed, "close", sid, f"c {sid}", "http", at(closed), 2.0, {"seq": str(closed)}))
            elif op == "leaf":
                want[sid] = (under(), seq)
            else:
                stack.append(sid)
            events.append((trace, None, seq, op, sid, f"{op[0]} {sid}", "service", at(seq), 1.0, {"seq": str(seq)}))
    ev = spark.createDataFrame(events, SIGNALS["span_events"])
    ro = spark.createDataFrame(roots, "trace_id string, span_id string, traceparent string, name string, started_at timestamp, duration_ms double")
    from opsignals.operators.running import sequence_segment

    segment = sequence_segment("seq", 300)
    got = traces.span_tree(ev, ro, segment=segment, whole=whole).filter("NOT is_root").collect()
    # What belongs to a close comes from it, wherever its opening was.
    facts = {e[4]: (e[5], e[6], e[8], e[9]) for e in events if e[3] != "open"}
    assert sorted((r.span_id, r.parent_span_id, r.seq, (r.name, r.kind, r.duration_ms, r.data)) for r in got) == sorted(
        ((s, *w, facts[s]) for s, w in want.items()), key=lambda r: r[0]
    )
    kept = traces.captured_traces(ev, ro, cap=8, segment=segment, whole=whole).filter("NOT is_root").collect()
    slow = {r[0] for r in roots if r[5] >= 1000}
    first = [s for t in slow for s in sorted((s for s in want if s.startswith(f"{t}-")), key=lambda s: want[s][1])[:7]]
    assert {(r.span_id, r.parent_span_id, r.seq) for r in kept} == {(s, *want[s]) for s in first} and len(kept) == len(first)


def shuffled_rows(plan):
    """Rows that the exchanges of an executed plan wrote, without those of its subqueries."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_rows(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(shuffled_rows(plan.children().apply(i)) for i in range(plan.children().size()))


def test_the_spans_of_whole_traces_are_shuffled_once(spark):
    rows = [("open", "outer"), ("close", "late"), ("open", "inner"), ("leaf", "one"), ("open", "late"), ("close", "inner"), ("close", "outer")]
    roots = spark.createDataFrame(
        [("t", "root", None, "GET /", at(0), 9.0)],
        "trace_id string, span_id string, traceparent string, name string, started_at timestamp, duration_ms double",
    )
    tree = traces.span_tree(span_events(spark, *rows), roots)
    assert {r.span_id: r.parent_span_id for r in tree.collect()} == {"root": None, "outer": "root", "inner": "outer", "one": "inner", "late": "inner"}
    # Each event and the root once: no trace is long, so nothing is done for segments.
    assert shuffled_rows(tree._jdf.queryExecution().executedPlan()) == len(rows) + 1
