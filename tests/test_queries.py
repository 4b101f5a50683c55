"""Every registered query against its SQL counterpart on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from bindings import registry
from bindings.check import TABLES, rows_of
from tests.conftest import SF

QUERIES, SQL = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(SQL[name])
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows_of(cols, cur.fetchall())


def test_queries_without_sql_are_the_model_ones():
    assert set(QUERIES) - set(SQL) == {"intent_model", "intent_calibrated", "scored_messages"}


def test_plans_hold_no_cross_products(spark):
    for name in ("similar_cases", "triage_rates", "brand_scorecard", "reply_graph_audit", "rule_table_join"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_entry(spark):
    assert {r["system"] for r in entry.entry(spark).collect()} == {"constant", "keyword", "hybrid"}
