"""Every registered query against its DuckDB statement, or at least runnable."""

import pytest

import __spark_entry__ as entry
from martlet.plans.registry import QUERIES as RETAIL
from tools.compare import compare, connect

QUERIES = entry.queries()
SQL = entry.oracle_sql()
WITHOUT_SQL = {"l07_clv_metrics", "l08_clv_scores", "l10_forecast_metrics", "u02_ltv_by_id",
               "l09_churn_metrics"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(RETAIL) - set(SQL) == WITHOUT_SQL


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_same_result(name, spark, sf_dir, duck):
    assert compare(duck, QUERIES[name](spark, sf_dir), SQL[name]) is None


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns
