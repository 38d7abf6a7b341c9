"""Shapes of the physical plans, and results under heavy skew."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from martlet.plans import views
from martlet.plans.registry import QUERIES
from martlet.sources.mart import Mart

REPORTS = [n for n in QUERIES if re.match(r"[vqrb]\d|l0[1-6]|c0|e[01]\d_", n)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plan as if no table were small."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", REPORTS)
def test_no_pair_joins(name, spark, sf_dir):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("view", list(views.ALL.values()))
def test_views_need_no_broadcast_and_no_single_task(view, mart, no_broadcast):
    plan = plan_of(view(mart))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan
    assert "Window" not in plan
    assert "Expand" not in plan  # distinct counts are two-step aggregates


def test_scans_read_needed_columns_only(mart):
    plan = plan_of(views.monthly_sales_summary(mart))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = next(s for s in schemas if "l_orderkey" in s)
    assert set(re.findall(r"(l_\w+):", lineitem)) == {
        "l_orderkey", "l_partkey", "l_quantity", "l_discount"}


def test_date_filter_reaches_the_order_scan(mart):
    from martlet.plans import reports

    names = ("q06_sales_overview", "q07_daily_sales", "q08_rep_performance", "q11_monthly_comparison",
             "e10_sales_commission", "e10_payroll_with_commission")
    for plan in (plan_of(QUERIES[n](mart)) for n in names):
        assert re.search(r"PushedFilters: \[[^\]]*o_orderdate", plan)


class MovedMart(Mart):
    """Orders from decades before and after the given ones."""

    def table(self, name):
        df = super().table(name)
        if name != "orders":
            return df
        moved = F.when(F.col("o_orderkey") % 3 == 0, F.add_months("o_orderdate", -420)).when(
            F.col("o_orderkey") % 3 == 1, F.add_months("o_orderdate", 420)
        ).otherwise(F.col("o_orderdate").cast("date"))
        return df.withColumn("o_orderdate", moved.cast(df.schema["o_orderdate"].dataType))


def test_no_sale_is_outside_the_calendar(spark, sf_dir):
    given, moved = Mart(spark, sf_dir), MovedMart(spark, sf_dir)
    for view in (views.monthly_sales_summary, views.quarterly_sales_performance, views.sales_trend_analysis):
        column = next(c for c in view(given).columns if "revenue" in c)
        total = [view(m).agg(F.sum(F.col(column).cast("decimal(30,2)"))).first()[0] for m in (given, moved)]
        assert total[0] == total[1]
    assert moved.date_dim.filter("year_number < 1995 OR year_number > 2029").count() > 0


def test_category_totals_cover_all_products(mart):
    from martlet.plans import reports

    totals = reports.category_totals(mart).agg(F.sum("total_revenue")).first()[0]
    shares = reports.category_share(mart).agg(F.sum("total_revenue")).first()[0]
    assert abs(totals - shares) < 0.01


def test_a_cycle_in_a_hierarchy_is_named(spark):
    from martlet.operators.lookup import paths

    rows = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 4, "c"), (4, 3, "d")], "k long, up long, n string")
    with pytest.raises(ValueError, match="3"):
        paths(rows, "k", "up", "n")


class SkewedMart(Mart):
    """A third of all lines belong to one product, one order and one rep."""

    def table(self, name):
        df = super().table(name)
        if name != "lineitem":
            return df
        hot = F.col("l_linenumber") % 3 == 0
        return df.withColumns(
            {c: F.when(hot, F.lit(5)).otherwise(F.col(c)).cast("bigint")
             for c in ("l_orderkey", "l_partkey", "l_suppkey")})


@pytest.mark.parametrize("view", list(views.ALL.values()))
def test_views_are_right_under_skew(view, spark, sf_dir, no_broadcast):
    """Sums of a view over skewed lines equal the plain sum of the lines."""
    m = SkewedMart(spark, sf_dir)
    got = view(m)
    column = next((c for c in got.columns if c in ("total_revenue", "total_spent", "daily_revenue")))
    if "period_type" in got.columns:
        got = got.filter("period_type = 'Year to Date'")
        want = m.sales().filter(F.year("order_date") == 2001)
    else:
        want = m.sales()
    total = got.agg(F.sum(F.round(F.col(column) * 100).cast("bigint"))).first()[0]
    assert total == want.agg(F.sum("line_c")).first()[0]


class HotKeyMart(Mart):
    """A third of all lines carry one value of ``column``, read by several tasks."""

    column = "l_partkey"

    def table(self, name):
        df = super().table(name)
        if name != "lineitem":
            return df
        hot = F.col("l_linenumber") % 3 == 0
        key = F.when(hot, F.lit(5)).otherwise(F.col(self.column)).cast("bigint")
        return df.withColumn(self.column, key).repartition(8)


@pytest.mark.parametrize("column,view", [
    ("l_partkey", views.top_products_by_revenue),
    ("l_partkey", views.monthly_sales_summary),
    ("l_suppkey", views.territory_sales_analysis),
    ("l_orderkey", views.sales_rep_performance),
])
def test_hot_keys_are_split_over_tasks(column, view, spark, no_broadcast):
    low = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        m = HotKeyMart(spark, "/root/testdata/sf0.1")
        m.column = column
        df = view(m)
        df.collect()
        assert "skew=true" in plan_of(df)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
