"""Every registered query against its SQL on DuckDB, at the smallest scale."""

import os
import re

import pytest

from sampledata.oracle import all_sql
from sampledata.queries import all_queries

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="sample data not present")
QUERIES, SQL = all_queries(), all_sql()


def _sorted(rows):
    return sorted(rows, key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = _sorted(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'").fetchall()
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    rows = result.fetchall()
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == _sorted(tuple(r[i] for i in order) for r in rows)


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n.startswith(("rpt_", "dq_", "join_", "win_", "agg_"))])
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert word not in plan


@pytest.mark.parametrize("name", ["rpt_po_gr", "rpt_po_gr_dc"])
def test_one_partitioning_by_order_number_serves_all_joins(spark, name):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    by_order = [keys for keys in re.findall(r"hashpartitioning\(([^)]*)\)", plan) if "POM_RefNo" in keys or "POC_RefNo" in keys]
    assert by_order and all("Item" not in keys and "Line" not in keys for keys in by_order)
