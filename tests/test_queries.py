"""Every registered query against its SQL on the small tables, and the shape of its plan."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from opsignals.plans.views import TABLES
from tools.check import rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sql, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # A third of all rows may share one key: no pairs, and Python only where nothing else can.
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if not name.startswith("op"):
        assert ("Python" in plan) == (name in ("sensitive_key_redact", "event_assemble"))
    got = rows_of(df.columns, df.collect())
    cur = sql.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cur.fetchall())


def test_every_query_has_its_sql():
    assert {n for n in QUERIES if n[:2] != "op" and n != "pipeline"} <= set(ORACLES)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


def test_the_rollup_reads_four_columns_and_shuffles_once(spark):
    df = QUERIES["perf_rollup"](spark, SF)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    executed = df._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan.split("ReadSchema")[1]
    assert executed.count("Exchange hashpartitioning") == 1


def test_filters_reach_the_scan(spark):
    plan = QUERIES["user_asof"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,error)" in plan and "EqualTo(event_type,signup)" in plan


@pytest.mark.parametrize("name", ["captured_traces", "span_tree"])
def test_span_queries_equal_their_sql_on_copies_with_shifted_keys(spark, tmp_path, name):
    # Large part keys put closes before openings. No two numbers of a trace are alike: no ORDER BY leaves a tie.
    con = duckdb.connect()
    part = """CASE k WHEN 0 THEN l_partkey + 499900 WHEN 1 THEN l_partkey + 999900 WHEN 2 THEN l_partkey + 1180000
        WHEN 3 THEN l_partkey + 2500000 ELSE l_partkey * 40000 END"""
    changed = {
        "lineitem": f"l_orderkey + 1000000 * k AS l_orderkey, {part} AS l_partkey, l_suppkey + 59000 AS l_suppkey",
        "orders": "o_orderkey + 1000000 * k AS o_orderkey, o_custkey + 15000 * k AS o_custkey",
    }
    for t, columns in changed.items():
        copies = f"SELECT * REPLACE ({columns}) FROM '{SF}/{t}.parquet', (SELECT unnest(range(5)) AS k)"
        con.execute(f"COPY (SELECT * EXCLUDE (k) FROM ({copies})) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    df = QUERIES[name](spark, str(tmp_path))
    cur = con.execute(ORACLES[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in cur.description], cur.fetchall())
