"""Dashboard queries: parameterised reports over the star schema.

Date ranges filter the order headers, below every join and aggregate. Each report
returns a lazy frame; top-k reports order by measure with a key as tiebreak, which
Spark runs as a per-partition top-k plus a merge.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.money import amount, half_up, mean_amount, percent
from martlet.functions.text import currency_text, number_text, percent_text
from martlet.operators.series import first_step, total_over, waterfall
from martlet.plans import views
from martlet.plans.views import add_up, avg_line, margin, money
from martlet.sources.mart import Mart, Span

START, END = date(2000, 1, 1), date(2000, 12, 31)
LATEST = date(9999, 12, 31)


def kpi(m: Mart, period_type: str = "Current Month") -> DataFrame:
    return views.executive_kpi_dashboard(m).filter(F.col("period_type") == period_type)


def sales_trend(m: Mart, days: int = 30) -> DataFrame:
    """Daily trend since ``as_of - days``; the filter sits on the order scan."""
    span = Span(m.as_of - timedelta(days=days), LATEST)
    return views.sales_trend_analysis(m, span).select(
        "date_actual", "daily_revenue", "daily_orders", "avg_order_value", "is_weekend",
        "is_holiday",
    )


def top_categories(m: Mart, limit: int = 10) -> DataFrame:
    return (
        views.category_performance(m)
        .select(
            "category_name", "total_revenue", "total_profit", "profit_margin_percent",
            "total_units_sold",
        )
        .orderBy(F.desc("total_revenue"), "category_name")
        .limit(limit)
    )


def territory_performance(m: Mart) -> DataFrame:
    return (
        views.territory_sales_analysis(m)
        .select(
            "territory_name", "region", "country", "total_revenue", "total_orders",
            "unique_customers", "revenue_per_customer",
        )
        .orderBy(F.desc("total_revenue"), "territory_name")
    )


def territory_rollup(m: Mart) -> DataFrame:
    """Revenue per territory with region subtotals and the grand total."""
    by_rep = m.lines.groupBy("sales_rep_key").agg(F.sum("line_c").alias("revenue_c"))
    return (
        by_rep.join(m.reps, "sales_rep_key")
        .rollup("region", "territory_name")
        .agg(F.sum("revenue_c").alias("revenue_c"), F.grouping_id().alias("level"))
        .select(
            "region", "territory_name", F.col("level").cast("bigint").alias("level"),
            money("revenue_c", "total_revenue"),
        )
    )


def sales_overview(m: Mart, start: date = START, end: date = END) -> DataFrame:
    """Eight global KPIs of a date range, as one row."""
    span = Span(start, end)
    by_customer = views.by_customer(m, span)
    overall = by_customer.agg(*add_up("n_orders"), F.count(F.lit(1)).alias("n_customers"))
    # Distinct products as a two-step aggregate that meets the totals in a union of
    # two one-row frames, folded back into one row.
    products = (
        m.items_in(span)
        .select("product_key")
        .distinct()
        .agg(F.count(F.lit(1)).alias("products_sold"))
    )
    both = overall.unionByName(products, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        F.col("n_orders").alias("total_orders"),
        F.col("n_customers").alias("unique_customers"),
        money("revenue_c", "total_revenue"),
        money("profit_c", "total_profit"),
        avg_line(),
        F.col("units").alias("total_units_sold"),
        "products_sold",
        margin(),
    )


def daily_sales(m: Mart, start: date = START, end: date = END) -> DataFrame:
    return views.with_calendar(m, views.per_day(m, Span(start, end))).select(
        "date_actual",
        "day_of_week_name",
        "is_weekend",
        "is_holiday",
        F.col("n_orders").alias("daily_orders"),
        money("revenue_c", "daily_revenue"),
        money("profit_c", "daily_profit"),
        avg_line(),
        F.col("units").alias("units_sold"),
    )


def rep_performance(m: Mart, start: date = START, end: date = END) -> DataFrame:
    return views.by_rep(m, Span(start, end)).join(m.reps, "sales_rep_key").select(
        "sales_rep_name",
        "territory_name",
        "region",
        F.col("n_orders").alias("total_orders"),
        F.col("n_customers").alias("unique_customers"),
        money("revenue_c", "total_revenue"),
        money("profit_c", "total_profit"),
        avg_line(),
        margin(),
    )


def _products(m: Mart, start: date, end: date) -> DataFrame:
    keys = ["product_name", "category_name", "supplier_name"]
    return views.by_product_group(m, keys, Span(start, end)).select(
        *keys,
        F.col("units").alias("total_units_sold"),
        money("revenue_c", "total_revenue"),
        money("profit_c", "total_profit"),
        mean_amount("price_c", "n_lines").alias("avg_selling_price"),
        F.col("n_orders").alias("orders_count"),
        margin(),
    )


def _by_revenue(*tiebreak: str) -> list:
    return [F.desc("total_revenue"), *tiebreak]


def product_performance(
    m: Mart, start: date = START, end: date = END, limit: int = 20
) -> DataFrame:
    return (
        _products(m, start, end)
        .orderBy(*_by_revenue("product_name", "category_name", "supplier_name"))
        .limit(limit)
    )


def customer_analysis(m: Mart, start: date = START, end: date = END) -> DataFrame:
    customers = m.customer_dim.select("customer_id", "segment_name", "customer_type")
    return (
        views.by_customer(m, Span(start, end))
        .join(customers, "customer_id")
        .groupBy("segment_name", "customer_type")
        .agg(*add_up("n_orders"), F.count(F.lit(1)).alias("n_customers"))
        .select(
            "segment_name",
            "customer_type",
            F.col("n_customers").alias("customer_count"),
            F.col("n_orders").alias("total_orders"),
            money("revenue_c", "total_revenue"),
            avg_line(),
            mean_amount("revenue_c", "n_customers").alias("revenue_per_customer"),
        )
    )


def monthly_comparison(m: Mart, year: int = 2000) -> DataFrame:
    span = Span(date(year, 1, 1), date(year, 12, 31))
    return (
        views.with_calendar(m, views.per_day(m, span))
        .groupBy("month_number", "month_name")
        .agg(*add_up("n_orders"))
        .select(
            "month_number",
            "month_name",
            money("revenue_c", "monthly_revenue"),
            money("profit_c", "monthly_profit"),
            F.col("n_orders").alias("monthly_orders"),
            avg_line(),
        )
    )


def _daily(m: Mart) -> DataFrame:
    return views.with_calendar(m, views.per_day(m, Span(START, END)))


def _means(df: DataFrame, key: Column) -> DataFrame:
    """Mean daily orders and revenue per group of days."""
    return (
        df.groupBy(key)
        .agg(
            F.sum("n_orders").alias("n_orders"),
            F.sum("revenue_c").alias("revenue_c"),
            F.count(F.lit(1)).alias("n_days"),
        )
        .select(
            "day_group",
            amount(half_up(F.col("n_orders") * 100, "n_days")).alias("avg_daily_orders"),
            mean_amount("revenue_c", "n_days").alias("avg_daily_revenue"),
        )
    )


def by_day_of_week(m: Mart) -> DataFrame:
    return _means(_daily(m), F.col("day_of_week_name").alias("day_group"))


def weekend_vs_weekday(m: Mart) -> DataFrame:
    label = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    return _means(_daily(m), label.alias("day_group"))


def holiday_vs_regular(m: Mart) -> DataFrame:
    """Empty when the range has no holiday: nothing to compare."""
    label = F.when(F.col("is_holiday"), "Holiday").otherwise("Regular Day")
    means = _means(_daily(m), label.alias("day_group")).withColumn(
        "is_holiday", (F.col("day_group") == "Holiday").cast("int")
    )
    return (
        means.withColumn("holidays", total_over("is_holiday"))
        .filter("holidays > 0")
        .drop("holidays", "is_holiday")
    )


def top_reps(m: Mart, n: int = 10) -> DataFrame:
    return rep_performance(m).orderBy(*_by_revenue("sales_rep_name")).limit(n)


def top_products_revenue(m: Mart, n: int = 10) -> DataFrame:
    return product_performance(m).orderBy(
        *_by_revenue("product_name", "category_name", "supplier_name")
    ).limit(n)


def top_products_units(m: Mart, n: int = 10) -> DataFrame:
    return _products(m, START, END).orderBy(
        F.desc("total_units_sold"), "product_name", "category_name", "supplier_name"
    ).limit(n)


def category_totals(m: Mart) -> DataFrame:
    """Second aggregate, over the rows of all products."""
    def total(column: str) -> Column:
        return F.sum(F.col(column).cast("decimal(18,2)")).cast("double").alias(column)

    return (
        _products(m, START, END)
        .groupBy("category_name")
        .agg(
            total("total_revenue"),
            total("total_profit"),
            F.sum("total_units_sold").alias("total_units_sold"),
        )
    )


def _shares(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("all_c", total_over("revenue_c")).select(
        key, money("revenue_c", "total_revenue"), percent("revenue_c", "all_c").alias("share_percent")
    )


def category_share(m: Mart) -> DataFrame:
    sums = views.by_product_group(m, ["category_name"], Span(START, END))
    return _shares(sums, "category_name")


def segment_share(m: Mart) -> DataFrame:
    by_customer = views.by_customer(m, Span(START, END))
    sums = (
        by_customer.join(m.customer_dim.select("customer_id", "segment_name"), "customer_id")
        .groupBy("segment_name")
        .agg(F.sum("revenue_c").alias("revenue_c"))
    )
    return _shares(sums, "segment_name")


def segments_by_value(m: Mart) -> DataFrame:
    return customer_analysis(m).orderBy(
        F.desc("revenue_per_customer"), "segment_name", "customer_type"
    )


def categories_by_revenue(m: Mart) -> DataFrame:
    return category_totals(m).orderBy(F.desc("total_revenue"), "category_name")


def sales_heatmap(m: Mart) -> DataFrame:
    """Revenue by month (rows) and day of week (columns)."""
    names = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
    cells = _daily(m).groupBy("month_number", "day_of_week_name").agg(
        F.sum("revenue_c").alias("revenue_c")
    )
    wide = cells.groupBy("month_number").pivot("day_of_week_name", names).agg(F.first("revenue_c"))
    return wide.select("month_number", *[money(n, n.lower()) for n in names])


def revenue_quartiles(m: Mart) -> DataFrame:
    """Quartiles of daily revenue per day of week, for box plots.

    One value per calendar day, so the exact percentile state stays small.
    """
    q = F.percentile("revenue_c", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        _daily(m)
        .groupBy("day_of_week_name")
        .agg(q.alias("q"), F.min("revenue_c").alias("lo"), F.max("revenue_c").alias("hi"))
        .select(
            "day_of_week_name",
            money("lo", "lowest"),
            *[amount(F.round(F.col("q")[i])).alias(n) for i, n in enumerate(("q1", "median", "q3"))],
            money("hi", "highest"),
        )
    )


def profit_waterfall(m: Mart) -> DataFrame:
    """Monthly profit steps with the running total, closed by the year's total."""
    months = _daily(m).groupBy(F.col("month_number").alias("step")).agg(
        F.sum("profit_c").alias("value_c")
    )
    closing = months.agg(F.lit(13).alias("step"), F.sum("value_c").alias("value_c"))
    steps = waterfall(months, "step", "value_c").unionByName(
        closing.withColumn("running_total", F.col("value_c"))
    )
    return steps.select(
        "step",
        F.when(F.col("step") == 13, "total").otherwise("relative").alias("measure"),
        money("value_c", "value"),
        money("running_total", "running_total"),
    )


def order_funnel(m: Mart) -> DataFrame:
    """Orders placed, processed and shipped, as percent of the first step."""
    steps = F.array(
        F.struct(F.lit(1).alias("step"), F.lit("Placed").alias("stage")),
        F.when(
            F.col("status") != "PENDING",
            F.struct(F.lit(2).alias("step"), F.lit("Processed").alias("stage")),
        ),
        F.when(
            F.col("status") == "SHIPPED",
            F.struct(F.lit(3).alias("step"), F.lit("Shipped").alias("stage")),
        ),
    )
    counts = (
        m.orders.select(F.explode(F.array_compact(steps)).alias("s"))
        .groupBy("s.step", "s.stage")
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )
    return counts.withColumn("first_n", first_step(counts, "step", "n_orders")).select(
        "step", "stage", "n_orders", percent("n_orders", "first_n").alias("percent_of_first")
    )


def kpi_report(m: Mart) -> DataFrame:
    """The KPI rows with display strings."""
    return views.executive_kpi_dashboard(m).select(
        "period_type",
        "period_name",
        currency_text("total_revenue").alias("revenue_text"),
        currency_text("total_profit").alias("profit_text"),
        number_text("total_orders").alias("orders_text"),
        number_text("unique_customers").alias("customers_text"),
        currency_text("avg_order_value").alias("avg_order_text"),
        percent_text("profit_margin_percent").alias("margin_text"),
    )


def territory_report(m: Mart) -> DataFrame:
    return views.territory_sales_analysis(m).select(
        "territory_name",
        currency_text("total_revenue").alias("total_revenue"),
        "total_orders",
        currency_text("revenue_per_customer").alias("revenue_per_customer"),
    )


ALL = {
    "q01_kpi": kpi,
    "q02_sales_trend": lambda m: sales_trend(m, 30),
    "q03_top_categories": top_categories,
    "q04_territory_performance": territory_performance,
    "q05_territory_rollup": territory_rollup,
    "q06_sales_overview": sales_overview,
    "q07_daily_sales": daily_sales,
    "q08_rep_performance": rep_performance,
    "q09_product_performance": product_performance,
    "q10_customer_analysis": customer_analysis,
    "q11_monthly_comparison": monthly_comparison,
    "q12_by_day_of_week": by_day_of_week,
    "q13_weekend_vs_weekday": weekend_vs_weekday,
    "q14_holiday_vs_regular": holiday_vs_regular,
    "q15_top_reps": top_reps,
    "q15_top_products_revenue": top_products_revenue,
    "q15_top_products_units": top_products_units,
    "q16_category_totals": category_totals,
    "q17_category_share": category_share,
    "q17_segment_share": segment_share,
    "q18_segments_by_value": segments_by_value,
    "q18_categories_by_revenue": categories_by_revenue,
    "q19_sales_heatmap": sales_heatmap,
    "q19_revenue_quartiles": revenue_quartiles,
    "q19_profit_waterfall": profit_waterfall,
    "q19_order_funnel": order_funnel,
    "r01_kpi_report": kpi_report,
    "r01_territory_report": territory_report,
}
