"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from recurra.plans.catalog import queries
from recurra.plans.oracles import oracle_sql
from recurra.sources.derived import SOURCES

FOLDER = Path("/root/testdata/sf0.001")
SQL = oracle_sql()
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")

# Joins without a key: only ever with the one row of a global aggregate (or its few ranks).
WITH_SCALARS = {
    "active_month_start", "arpu_histogram", "arpu_summary", "customer_month_mrr", "metrics_table", "mrr_waterfall",
    "cleaning_log", "nrr_gap_value", "reconcile_metrics", "reconcile_mrr", "revenue_at_risk", "tenure_histogram", "tenure_summary",
}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in SOURCES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(queries()) == set(SQL)


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["month", "new_mrr", "expansion_mrr", "contraction_mrr", "total_mrr"]


@pytest.mark.parametrize("name", queries())
def test_query(spark, duck, name):
    df = queries()[name](spark, str(FOLDER))
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    expected = sorted(repr(dict(sorted(zip(columns, r)))) for r in cursor.fetchall())
    found = sorted(repr(dict(sorted(r.asDict().items()))) for r in df.collect())
    assert found == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "Python" not in plan
    assert name in WITH_SCALARS or "BroadcastNestedLoopJoin" not in plan


def test_rank_steps_read_the_counts_once_each(spark):
    """One read for the totals, one for each of the four steps."""
    plan = queries()["arpu_summary"](spark, str(FOLDER))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 5


def test_scans_read_only_the_columns_needed(spark):
    plan = queries()["active_customers_by_month"](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == [
        "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz"
    ]


def test_customer_facts_are_placed_once(spark):
    """Merged ranges move twice, exploded months never: the window and both groupings reuse the placement."""
    df = queries()["fact_mrr_waterfall"](spark, str(FOLDER))
    plan = df._jdf.queryExecution().executedPlan().toString()
    moves = re.findall(r"Exchange hashpartitioning\(([a-z_]+)#", plan)
    assert moves.count("customer_id") == 2
    assert plan.index("Generate explode") < plan.index("Exchange hashpartitioning(customer_id")
