"""The nine BI views.

Shape shared by all of them: add measures up per order (or per order and the
dimension key), so that orders can be counted instead of counted distinct; add
the partial rows up per customer where distinct customers are asked for; only then
group by the reported attributes and join the calendar or a dimension. Each step
is a map-side-combined aggregate, so a hot key shrinks before it is shuffled.
Views carry no ORDER BY; the caller sorts what it shows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import day
from martlet.functions.money import amount, mean_amount, percent
from martlet.plans import calendar
from martlet.sources.mart import Mart, Span, line_totals

MEASURES = ("units", "revenue_c", "cost_c", "profit_c", "n_lines")


def add_up(*more: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in (*MEASURES, *more)]


def money(column: str, name: str) -> Column:
    return amount(column).alias(name)


def avg_line(name: str = "avg_order_value") -> Column:
    return mean_amount("revenue_c", "n_lines").alias(name)


def margin() -> Column:
    return percent("profit_c", "revenue_c").alias("profit_margin_percent")


def per_day(m: Mart, span: Span | None = None) -> DataFrame:
    """Measures and order count by order date."""
    return m.order_sales(span).groupBy("order_date").agg(
        *add_up(), F.count(F.lit(1)).alias("n_orders")
    )


def with_calendar(m: Mart, df: DataFrame) -> DataFrame:
    """Calendar attributes of each row's order date, derived from the date itself, so
    that no day lies outside; rows without a date have none and are left out."""
    dated = df.filter("order_date IS NOT NULL")
    return calendar.describe(dated.withColumn("date_actual", F.col("order_date")))


def monthly_sales_summary(m: Mart) -> DataFrame:
    return (
        with_calendar(m, per_day(m))
        .groupBy("year_number", "month_number", "month_name")
        .agg(*add_up("n_orders"))
        .select(
            "year_number",
            "month_number",
            "month_name",
            F.col("n_orders").alias("total_orders"),
            F.col("units").alias("total_units_sold"),
            money("revenue_c", "total_revenue"),
            money("cost_c", "total_cost"),
            money("profit_c", "total_profit"),
            avg_line(),
            margin(),
        )
    )


def quarterly_sales_performance(m: Mart) -> DataFrame:
    by_customer = (
        m.order_sales()
        .groupBy(F.trunc("order_date", "quarter").alias("order_date"), "customer_id")
        .agg(*add_up(), F.count(F.lit(1)).alias("n_orders"))
    )
    by_quarter = by_customer.groupBy("order_date").agg(
        *add_up("n_orders"), F.count(F.lit(1)).alias("n_customers")
    )
    return with_calendar(m, by_quarter).select(
        "year_number",
        "quarter_number",
        "quarter_name",
        F.col("n_orders").alias("total_orders"),
        F.col("n_customers").alias("unique_customers"),
        money("revenue_c", "total_revenue"),
        money("profit_c", "total_profit"),
        avg_line(),
        mean_amount("revenue_c", "n_customers").alias("revenue_per_customer"),
    )


def by_rep(m: Mart, span: Span | None = None) -> DataFrame:
    """Measures, orders and distinct customers per sales rep key."""
    return (
        m.rep_sales(span)
        .groupBy("sales_rep_key", "customer_id")
        .agg(*add_up(), F.count(F.lit(1)).alias("n_orders"))
        .groupBy("sales_rep_key")
        .agg(*add_up("n_orders"), F.count(F.lit(1)).alias("n_customers"))
    )


def sales_rep_performance(m: Mart) -> DataFrame:
    return by_rep(m).join(m.reps, "sales_rep_key").select(
        "sales_rep_name",
        "territory_name",
        "region",
        F.col("n_orders").alias("total_orders"),
        F.col("n_customers").alias("unique_customers"),
        money("revenue_c", "total_revenue"),
        money("profit_c", "total_profit"),
        avg_line(),
        mean_amount("revenue_c", "n_orders").alias("avg_order_size"),
        margin(),
    )


def territory_sales_analysis(m: Mart) -> DataFrame:
    place = ["territory_name", "region", "country"]
    reps = m.reps.select("sales_rep_key", *place)
    measures = (
        m.sales(None, reps, "sales_rep_key")
        .groupBy("order_id", *place)
        .agg(F.min("customer_id").alias("customer_id"), *line_totals())
        .groupBy(*place, "customer_id")
        .agg(*add_up(), F.count(F.lit(1)).alias("n_orders"))
        .groupBy(*place)
        .agg(*add_up("n_orders"), F.count(F.lit(1)).alias("n_customers"))
    )
    # A rep is active when any priced line names it; one narrow scan, one row per
    # rep after the map side.
    selling = m.items.select("sales_rep_key").distinct()
    active = selling.join(reps, "sales_rep_key").groupBy(*place).agg(
        F.count(F.lit(1)).alias("active_sales_reps")
    )
    return measures.join(active, place).select(
        *place,
        "active_sales_reps",
        F.col("n_orders").alias("total_orders"),
        F.col("n_customers").alias("unique_customers"),
        money("revenue_c", "total_revenue"),
        money("profit_c", "total_profit"),
        mean_amount("revenue_c", "active_sales_reps").alias("revenue_per_rep"),
        mean_amount("revenue_c", "n_customers").alias("revenue_per_customer"),
    )


def by_product_group(m: Mart, keys: list[str], span: Span | None = None) -> DataFrame:
    """Measures, distinct orders and price sum per group of product attributes.

    Lines are added up per (group, order) before the group itself.
    """
    return (
        m.lines_with(keys, span)
        .groupBy(*keys, "order_id")
        .agg(*line_totals(), F.sum("price_c").alias("price_c"))
        .groupBy(*keys)
        .agg(*add_up("price_c"), F.count(F.lit(1)).alias("n_orders"))
    )


def top_products_by_revenue(m: Mart) -> DataFrame:
    keys = ["product_name", "category_name", "supplier_name", "product_line"]
    return by_product_group(m, keys).select(
        *keys,
        F.col("units").alias("total_units_sold"),
        money("revenue_c", "total_revenue"),
        money("profit_c", "total_profit"),
        mean_amount("price_c", "n_lines").alias("avg_selling_price"),
        F.col("n_orders").alias("orders_count"),
        margin(),
    )


def by_customer(m: Mart, span: Span | None = None) -> DataFrame:
    """Measures, order count and first/last order date per customer."""
    return m.order_sales(span).groupBy("customer_id").agg(
        *add_up(),
        F.count(F.lit(1)).alias("n_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def customer_sales_summary(m: Mart) -> DataFrame:
    return by_customer(m).join(m.customer_dim, "customer_id").select(
        "customer_name",
        "customer_type",
        "segment_name",
        "billing_city",
        "billing_country",
        F.col("n_orders").alias("total_orders"),
        F.col("units").alias("total_units_purchased"),
        money("revenue_c", "total_spent"),
        avg_line(),
        "first_order_date",
        "last_order_date",
        F.datediff("last_order_date", "first_order_date").alias("customer_lifespan_days"),
    )


def sales_trend_analysis(m: Mart, span: Span | None = None) -> DataFrame:
    return with_calendar(m, per_day(m, span)).select(
        "date_actual",
        "day_of_week_name",
        "month_name",
        "quarter_name",
        "year_number",
        "is_weekend",
        "is_holiday",
        F.col("n_orders").alias("daily_orders"),
        money("revenue_c", "daily_revenue"),
        money("profit_c", "daily_profit"),
        avg_line(),
    )


def category_performance(m: Mart) -> DataFrame:
    measures = by_product_group(m, ["category_name"])
    sold = m.items.select("product_key").distinct().join(
        m.products.select("product_key", "category_name"), "product_key"
    )
    products = sold.groupBy("category_name").agg(F.count(F.lit(1)).alias("products_in_category"))
    return measures.join(products, "category_name").select(
        "category_name",
        "products_in_category",
        F.col("n_orders").alias("total_orders"),
        F.col("units").alias("total_units_sold"),
        money("revenue_c", "total_revenue"),
        money("profit_c", "total_profit"),
        mean_amount("price_c", "n_lines").alias("avg_unit_price"),
        margin(),
        mean_amount("revenue_c", "products_in_category").alias("revenue_per_product"),
    )


def executive_kpi_dashboard(m: Mart) -> DataFrame:
    """Current month, quarter and year to date in one pass.

    Only orders of the year are read on. Each row is tagged with the one to three
    periods it falls in, and each period is one group of the same aggregates.
    """
    now = day(m.as_of)
    d = F.col("order_date")
    year = F.date_format(now, "yyyy")

    def period(kind: str, name: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), name.alias("name"))

    quarter = F.concat(year, F.lit("-Q"), F.quarter(now).cast("string"))
    periods = F.array_compact(
        F.array(
            F.when(
                F.trunc(d, "month") == F.trunc(now, "month"),
                period("Current Month", F.date_format(now, "yyyy-MM")),
            ),
            F.when(
                F.trunc(d, "quarter") == F.trunc(now, "quarter"),
                period("Current Quarter", quarter),
            ),
            period("Year to Date", year),
        )
    )
    span = Span(date(m.as_of.year, 1, 1), date(m.as_of.year, 12, 31))
    measures = (
        m.order_sales(span)
        .withColumn("period", F.explode(periods))
        .groupBy("period", "customer_id")
        .agg(*add_up(), F.count(F.lit(1)).alias("n_orders"))
        .groupBy("period")
        .agg(*add_up("n_orders"), F.count(F.lit(1)).alias("n_customers"))
    )
    products = (
        m.placed(span)
        .select("product_key", F.explode(periods).alias("period"))
        .distinct()
        .groupBy("period")
        .agg(F.count(F.lit(1)).alias("products_sold"))
    )
    return measures.join(products, "period").select(
        F.col("period.type").alias("period_type"),
        F.col("period.name").alias("period_name"),
        F.col("n_orders").alias("total_orders"),
        F.col("n_customers").alias("unique_customers"),
        money("revenue_c", "total_revenue"),
        money("profit_c", "total_profit"),
        avg_line(),
        margin(),
        "products_sold",
    )


ALL = {
    "v01_monthly_sales_summary": monthly_sales_summary,
    "v02_quarterly_sales_performance": quarterly_sales_performance,
    "v03_sales_rep_performance": sales_rep_performance,
    "v04_territory_sales_analysis": territory_sales_analysis,
    "v05_top_products_by_revenue": top_products_by_revenue,
    "v06_customer_sales_summary": customer_sales_summary,
    "v07_sales_trend_analysis": sales_trend_analysis,
    "v08_category_performance": category_performance,
    "v09_executive_kpi_dashboard": executive_kpi_dashboard,
}


def register_views(m: Mart) -> None:
    """Make every BI view available to ``spark.sql`` under its plain name."""
    for key, view in ALL.items():
        view(m).createOrReplaceTempView("vw_" + key.split("_", 1)[1])
