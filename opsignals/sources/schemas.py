"""One explicit schema per signal table."""

from __future__ import annotations

CORRUPT = "_corrupt_record"

_USER = "STRUCT<id STRING, email STRING, username STRING>"

SIGNALS = {
    "errors": f"""error_id LONG, thread_id STRING, seq LONG, occurred_at TIMESTAMP, exception_class STRING,
        message STRING, backtrace ARRAY<STRUCT<file: STRING, line: INT, method: STRING, in_app: BOOLEAN>>,
        environment STRING, release STRING, server_name STRING, service STRING, context MAP<STRING, STRING>,
        tags MAP<STRING, STRING>, user {_USER}, statement STRING,
        causes ARRAY<STRUCT<what: STRING, statement: STRING>>, trace_id STRING, sdk_name STRING""",
    "set_user": f"thread_id STRING, seq LONG, ts TIMESTAMP, user {_USER}",
    "breadcrumbs": """thread_id STRING, seq LONG, ts TIMESTAMP, op STRING, category STRING, message STRING,
        level STRING, data MAP<STRING, STRING>""",
    "timings": "transaction_name STRING, duration_ms DOUBLE, ts TIMESTAMP, environment STRING, release STRING",
    "perf_samples": """transaction_name STRING, environment STRING, release STRING, period_started_at TIMESTAMP,
        period_ended_at TIMESTAMP, request_count LONG, duration_sum_ms DOUBLE, max_duration_ms DOUBLE,
        histogram MAP<STRING, LONG>""",
    "span_events": """trace_id STRING, thread_id STRING, seq LONG, op STRING, span_id STRING, name STRING,
        kind STRING, started_at TIMESTAMP, duration_ms DOUBLE, data MAP<STRING, STRING>""",
    "spans": """trace_id STRING, span_id STRING, parent_span_id STRING, name STRING, kind STRING,
        started_at TIMESTAMP, duration_ms DOUBLE, environment STRING, release STRING, service STRING, seq LONG,
        is_root BOOLEAN, data MAP<STRING, STRING>""",
    "traces": """trace_id STRING, thread_id STRING, seq LONG, root_name STRING, traceparent STRING,
        started_at TIMESTAMP, ended_at TIMESTAMP""",
    "metrics": """metric_name STRING, value DOUBLE, environment STRING, release STRING, recorded_at TIMESTAMP,
        seq LONG""",
    "infra_metrics": """metric_name STRING, value DOUBLE, hostname STRING, server_name STRING,
        recorded_at TIMESTAMP, seq LONG""",
    "changes": """change_id LONG, id STRING, kind STRING, title STRING, environment STRING,
        occurred_at TIMESTAMP, seq LONG, details MAP<STRING, STRING>, service STRING, actor STRING, url STRING""",
    "attempts": "queue STRING, seq LONG, ts TIMESTAMP, endpoint STRING, batch_id LONG, status INT",
    "projects": "project_id LONG, has_dsn BOOLEAN, has_key BOOLEAN, enabled_environments ARRAY<STRING>",
}


SIGNALS["targets"] = "service STRING, host STRING, pattern STRING, is_exact BOOLEAN"

# What the gate and the delivery jobs need beside a signal's own fields.
_ALL = "project_id LONG"
_MORE = {"perf_samples": ", queue STRING, seq LONG"}
_WITHOUT_PROJECT = ("projects", "targets")
# Columns that may hold any JSON value: scanned JSON keeps them as JSON text, so that a job can tell
# 12 from "12" and from true.
ANY_JSON = {"metrics": ("value",), "infra_metrics": ("value",)}


def schema(signal: str) -> str:
    """The columns of a signal's table. A table that lacks some of them has nulls there."""
    own = SIGNALS[signal] + _MORE.get(signal, "")
    if signal in _WITHOUT_PROJECT or "project_id" in own:
        return own
    return f"{own}, {_ALL}"


def schema_with_corrupt(signal: str) -> str:
    """The same for JSON, with a column for lines that don't fit."""
    own = schema(signal)
    for column in ANY_JSON.get(signal, ()):
        own = own.replace(f"{column} DOUBLE", f"{column} VARIANT")
    return f"{own}, {CORRUPT} STRING"
