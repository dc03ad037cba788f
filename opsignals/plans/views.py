"""Signals derived from the given tables, as SQL that Spark and an ANSI engine both read.

A view only relabels rows of the whole table; it holds none of the work the jobs do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

_ENV = "CASE event_id % 3 WHEN 0 THEN 'production' WHEN 1 THEN 'staging' ELSE 'development' END"
_RELEASE = "CASE event_id % 4 WHEN 1 THEN 'r1' WHEN 2 THEN 'r2' WHEN 3 THEN 'r3' END"
_THREAD = "CAST(user_id AS STRING)"
# Increasing along an order's lines, and no two alike.
_LINE_SEQ = (
    "(l_linenumber * 100000000000000000 + l_partkey * 100000000000 + l_suppkey * 10000000"
    " + CAST(round(l_extendedprice * 100) AS BIGINT))"
)
_LINE_ID = f"CAST(l_orderkey AS STRING) || '-' || CAST({_LINE_SEQ} AS STRING)"
_LINE_KIND = """CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'database' WHEN 'AO' THEN 'http'
    WHEN 'NF' THEN 'db' WHEN 'NO' THEN 'redis' WHEN 'RF' THEN 'service' ELSE 'job' END"""

VIEWS = {
    "timings": f"""
        SELECT event_id AS seq, 'GET /' || event_type || '/' || {_THREAD} AS transaction_name,
               event_type AS route, value * 60 AS duration_ms, ts, {_ENV} AS environment, {_RELEASE} AS release,
               user_id % 25 AS project_id
        FROM {{events}}""",
    "timing_lines": """
        SELECT event_type,
               '{{"transaction_name":"' || event_type || '","duration_ms":'
               || CASE WHEN event_id % 9 = 0 THEN 'oops' ELSE CAST(value AS STRING) END
               || CASE WHEN event_id % 10 = 1 THEN '' ELSE '}}' END AS line
        FROM {events}""",
    "errors": f"""
        SELECT event_id AS error_id, {_THREAD} AS thread_id, event_id AS seq, ts AS occurred_at,
               CASE event_id % 4 WHEN 0 THEN 'TimeoutError' WHEN 1 THEN 'ValueError' ELSE 'IOError' END
                   AS exception_class,
               'user ' || {_THREAD} || ' (u' || {_THREAD} || '@mail.example.com) failed: "' || props
               || '" after ' || CAST(event_id AS STRING) || ' ms at 0x00ff' || CAST(event_id AS STRING) AS message,
               {_ENV} AS environment, {_RELEASE} AS release, 'svc-' || CAST(user_id % 5 AS STRING) AS service,
               CASE WHEN event_id % 3 = 0 THEN {_THREAD} END AS own_user,
               CASE WHEN event_id % 2 = 0 THEN 'E' || CAST(event_id % 50 AS STRING) END AS error_code,
               CASE event_id % 3
                   WHEN 0 THEN 'UPDATE accounts SET n = ' || CAST(event_id AS STRING) || ' WHERE id = 7'
                   WHEN 1 THEN 'EXEC dbo.sp_close @id = ' || CAST(user_id AS STRING)
                   ELSE '' END AS statement,
               CAST(CAST(floor(event_id / 4) AS BIGINT) AS STRING) AS trace_id
        FROM {{events}} WHERE event_type = 'error'""",
    "document_errors": """
        SELECT doc_id AS error_id, source AS exception_class, text AS message, CAST(doc_id % 7 AS STRING) AS user_id
        FROM {documents}""",
    "backtraces": """
        SELECT event_id AS error_id,
               '0   app-' || CAST(user_id % 3 AS STRING) || '   0x00ab12  handle_'
               || CAST(event_id % 20 AS STRING) || ' + 12' || chr(10) || 'not a frame' || chr(10)
               || repeat('4  libc.so.6  0x7f01 std::loop(int) + 4' || chr(10), CAST(event_id % 200 AS INTEGER))
               || '9  app-main  0xdeadBEEF main + 88' AS backtrace_text
        FROM {events} WHERE event_type = 'error'""",
    "set_user": f"""
        SELECT {_THREAD} AS thread_id, event_id AS seq, ts,
               CASE WHEN event_id % 7 <> 0 THEN 'u' || CAST(event_id AS STRING) END AS user_id
        FROM {{events}} WHERE event_type = 'signup'""",
    "breadcrumbs": f"""
        SELECT {_THREAD} AS thread_id, event_id AS seq, ts,
               CASE WHEN event_type = 'purchase' AND event_id % 5 = 0 THEN 'clear' ELSE 'add' END AS op,
               event_type AS category, event_type || ' ' || CAST(event_id AS STRING) AS message
        FROM {{events}} WHERE event_type IN ('click', 'view', 'purchase')""",
    "traces": f"""
        SELECT {_THREAD} AS thread_id, event_id AS seq, 't' || CAST(event_id AS STRING) AS trace_id,
               event_type AS root_name, 'h' || CAST(event_id AS STRING) AS traceparent, ts AS started_at,
               CASE event_id % 3 WHEN 0 THEN ts + INTERVAL '6' HOUR WHEN 1 THEN ts + INTERVAL '24' HOUR
                    ELSE ts + INTERVAL '2' HOUR END AS ended_at
        FROM {{events}} WHERE event_type IN ('click', 'view')""",
    "child_spans": f"""
        SELECT CAST(l_orderkey AS STRING) AS trace_id, {_LINE_ID} AS span_id, {_LINE_SEQ} AS seq,
               'line ' || CAST(l_linenumber AS STRING) AS name, {_LINE_KIND} AS kind, l_shipdate AS started_at,
               l_quantity * 33.333 AS duration_ms, 'svc-' || l_returnflag AS service,
               CASE l_linenumber % 4 WHEN 0 THEN ' MySQL ' WHEN 1 THEN 'PostgreSQL' WHEN 2 THEN '  ' END AS db_system,
               'SELECT * FROM lineitem WHERE l_partkey = ' || CAST(l_partkey AS STRING) || ' AND flag = "'
               || l_returnflag || '"' AS statement
        FROM {{lineitem}}""",
    "root_spans": """
        SELECT CAST(o_orderkey AS STRING) AS trace_id, 'root-' || CAST(o_orderkey AS STRING) AS span_id,
               'GET /orders/' || CAST(o_orderkey AS STRING) AS name, o_orderdate AS started_at,
               o_totalprice / 200 AS duration_ms, 'svc-' || substring(o_orderpriority, 1, 1) AS service,
               CASE o_orderkey % 6
                   WHEN 0 THEN '00-nope'
                   WHEN 1 THEN NULL
                   WHEN 2 THEN '00-' || lpad(CAST(o_custkey AS STRING), 32, '0') || '-'
                               || lpad(CAST(o_custkey + 7 AS STRING), 16, '0') || '-01-tail'
                   WHEN 3 THEN ' cc-' || lpad(CAST(o_custkey AS STRING), 32, '0') || '-'
                               || lpad(CAST(o_custkey + 7 AS STRING), 16, '0') || '-01-tail'
                   ELSE '00-' || lpad(CAST(o_custkey AS STRING), 32, '0') || '-'
                               || lpad(CAST(o_custkey + 7 AS STRING), 16, '0') || '-01' END AS traceparent
        FROM {orders}""",
    "caller_spans": """
        SELECT lpad(CAST(c_custkey AS STRING), 32, '0') AS trace_id,
               lpad(CAST(c_custkey + 7 AS STRING), 16, '0') AS span_id,
               'POST /customers/' || CAST(c_nationkey AS STRING) AS name,
               'shop-' || CAST(c_nationkey AS STRING) AS service
        FROM {customer}""",
    "span_events": f"""
        SELECT CAST(l_orderkey AS STRING) AS trace_id, {_LINE_ID} AS span_id, 2 * {_LINE_SEQ} AS seq,
               CASE WHEN l_linenumber <= 4 THEN 'open' ELSE 'leaf' END AS op,
               'line ' || CAST(l_linenumber AS STRING) AS name, {_LINE_KIND} AS kind, l_shipdate AS started_at,
               l_quantity AS duration_ms
        FROM {{lineitem}}
        UNION ALL
        SELECT CAST(l_orderkey AS STRING), {_LINE_ID},
               CASE WHEN l_returnflag = 'R' THEN 2 * {_LINE_SEQ} + 1
                    ELSE 2000000000000000000 - 2 * {_LINE_SEQ} END,
               'close', 'line ' || CAST(l_linenumber AS STRING), {_LINE_KIND}, l_shipdate, l_quantity
        FROM {{lineitem}} WHERE l_linenumber <= 4""",
    "metrics": f"""
        SELECT event_id AS seq, event_type AS metric_name,
               CASE event_id % 11 WHEN 0 THEN 'null' WHEN 1 THEN 'true' WHEN 2 THEN '"12"' WHEN 3 THEN '1e999'
                    WHEN 4 THEN NULL ELSE CAST(value AS STRING) END AS value,
               {_ENV} AS environment, {_RELEASE} AS release, ts AS recorded_at
        FROM {{events}}""",
    "infra_metrics": """
        SELECT event_id AS seq, event_type AS metric_name,
               CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value,
               CASE user_id % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'host-' || CAST(user_id % 10 AS STRING) END
                   AS hostname,
               CASE WHEN user_id % 4 <> 0 THEN 'srv-' || CAST(user_id % 4 AS STRING) END AS server_name,
               ts AS recorded_at
        FROM {events}""",
    "changes": f"""
        SELECT event_id AS change_id, event_id AS seq,
               CASE WHEN event_id % 6 <> 0 THEN {_THREAD} || '-' || CAST(CAST(ts AS DATE) AS STRING) END AS id,
               CASE event_id % 5 WHEN 0 THEN 'config' WHEN 1 THEN 'migration' ELSE 'deploy' END AS kind,
               'change ' || CAST(event_id AS STRING) AS title, {_ENV} AS environment, ts AS occurred_at
        FROM {{events}} WHERE event_type = 'purchase'""",
    "document_changes": """
        SELECT doc_id AS change_id,
               CASE doc_id % 5 WHEN 0 THEN 'config' WHEN 1 THEN 'feature_flag' WHEN 2 THEN 'Config'
                    WHEN 3 THEN '' ELSE 'deploy' END AS kind,
               CASE WHEN doc_id % 13 = 0 THEN chr(9) || '  ' || chr(10) ELSE chr(10) || '  ' || text || chr(9) END
                   AS title,
               CASE WHEN doc_id % 2 = 0 THEN 'staging' END AS environment,
               CASE doc_id % 4 WHEN 0 THEN '{{}}' WHEN 1 THEN '[1]' WHEN 2 THEN '{{"flag":true}}' END AS details,
               CASE WHEN doc_id % 3 = 0 THEN '2024-01-15 10:20:30' END AS occurred_text
        FROM {documents}""",
    "statements": """
        SELECT CASE o_orderkey % 7
                   WHEN 0 THEN 'SELECT * FROM orders WHERE o_custkey = ' || CAST(o_custkey AS STRING)
                               || ' AND s = ''' || o_orderstatus || ''''
                   WHEN 1 THEN 'INSERT INTO audit.log (a, b) VALUES (' || CAST(o_orderkey AS STRING) || ', '''
                               || o_orderpriority || ''')'
                   WHEN 2 THEN 'EXEC dbo.sp_refund @id = ' || CAST(o_orderkey AS STRING)
                   WHEN 3 THEN 'SELECT * FROM orders o JOIN public.customer c ON c.id = o.id WHERE o.id = '
                               || CAST(o_orderkey AS STRING)
                   WHEN 4 THEN 'CALL refund_order(' || CAST(o_orderkey AS STRING) || ')'
                   WHEN 5 THEN 'UPDATE "Order Items" SET qty = ' || CAST(o_custkey AS STRING) || ' WHERE flag = "'
                               || o_orderstatus || '"'
                   ELSE '  ' END AS statement,
               CASE o_custkey % 3 WHEN 0 THEN 'MySQL' WHEN 1 THEN 'postgresql' END AS db_system,
               o_totalprice AS duration_ms
        FROM {orders}""",
    "attempts": """
        SELECT event_type AS queue, event_id AS seq, ts, 'api/' || event_type AS endpoint,
               CASE event_id % 13 WHEN 0 THEN 200 WHEN 1 THEN 503 WHEN 2 THEN 503 WHEN 3 THEN 429 WHEN 4 THEN 0
                    WHEN 5 THEN 408 WHEN 6 THEN 301 WHEN 7 THEN 503 WHEN 8 THEN 500 WHEN 9 THEN 422
                    WHEN 10 THEN 503 WHEN 11 THEN 502 ELSE 202 END AS status
        FROM {events}""",
    "calls": """
        SELECT CASE page_id % 3 WHEN 0 THEN 'get' WHEN 1 THEN '' ELSE 'POST' END AS method, url,
               CAST(length(html) AS DOUBLE) AS duration_ms
        FROM {pages}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A signal view over the Parquet tables; Catalyst inlines it, so pruning reaches the scan."""
    sql = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def with_views(*names: str) -> str:
    """The same views as the ``WITH`` clause of a plain SQL query."""
    plain = {t: t for t in TABLES}
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].format(**plain)})" for n in names) + "\n"
