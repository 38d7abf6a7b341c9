"""Views the requirements name beyond the nine BI views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import day
from martlet.functions.money import ratio
from martlet.operators import ledger
from martlet.plans.views import add_up, avg_line, margin, money, per_day
from martlet.session import fresh_path
from martlet.sources.mart import Mart
from martlet.streaming import windows


def yearly_sales_summary(m: Mart) -> DataFrame:
    """The monthly summary by year."""
    by_year = per_day(m).filter("order_date IS NOT NULL").groupBy(
        F.year("order_date").alias("year_number")
    )
    return by_year.agg(*add_up("n_orders")).select(
        "year_number",
        F.col("n_orders").alias("total_orders"),
        F.col("units").alias("total_units_sold"),
        money("revenue_c", "total_revenue"),
        money("cost_c", "total_cost"),
        money("profit_c", "total_profit"),
        avg_line(),
        margin(),
    )


def stock_flow(m: Mart, sold: DataFrame) -> DataFrame:
    """Stock movements behind the sales of each product and day: what is shipped leaves
    the stock, on the first of the next month as much is received, and every first of
    July each seventh product is counted and set back to its opening stock."""
    refilled = F.add_months(F.trunc("shipped_date", "month"), 1)
    flows = sold.select(
        "product_id",
        F.explode(
            F.array(
                F.struct(F.col("shipped_date").alias("move_date"), (-F.col("units")).alias("quantity")),
                F.struct(refilled.alias("move_date"), F.col("units").alias("quantity")),
            )
        ).alias("flow"),
    ).select(
        "product_id", "flow.move_date", F.lit(1).cast("bigint").alias("seq"), "flow.quantity",
        F.lit("RECEIPT").alias("transaction_type"),
    )
    counts = m.inventory.filter(F.col("product_id") % 7 == 0).select(
        "product_id",
        F.explode(
            F.sequence(day(date(1995, 7, 1)), day(m.as_of), F.expr("interval 1 year"))
        ).alias("move_date"),
        F.lit(0).cast("bigint").alias("seq"),
        F.col("quantity_on_hand").alias("quantity"),
        F.lit(ledger.SETTING).alias("transaction_type"),
    )
    return flows.unionByName(counts)


def inventory_turnover(m: Mart, start: date | None = None, end: date | None = None) -> DataFrame:
    """Units shipped, average stock and turnover of every product in a span of days
    (the year before the report date by default).

    Average stock is weighted by time: closing stocks of all days over the number of
    days. Turnover is what was shipped by it, days of supply the days by turnover;
    turnover is NULL without stock above zero, days of supply without
    anything shipped.
    """
    start = start or date(m.as_of.year - 1, 1, 1)
    end = end or date(m.as_of.year - 1, 12, 31)
    n_days = (end - start).days + 1
    sold = (
        m.items.filter("shipped_date IS NOT NULL")
        .groupBy(F.col("product_key").alias("product_id"), "shipped_date")
        .agg(F.sum("quantity").alias("units"))
    )
    opening = m.inventory.select("product_id", F.col("quantity_on_hand").alias("opening"))
    stock = ledger.stock_days(stock_flow(m, sold), ["product_id"], opening, start, end)
    shipped = (
        sold.filter(F.col("shipped_date").between(day(start), day(end)))
        .groupBy("product_id")
        .agg(F.sum("units").alias("units"))
    )
    named = m.products.select(
        "product_id", "product_number", "product_name", "category_name", "unit_cost_c"
    )
    units = F.coalesce("units", F.lit(0))
    return (
        stock.join(shipped, "product_id", "left")
        .join(named, "product_id")
        .withColumn("units", units)
        .withColumn("n_days", F.lit(n_days).cast("bigint"))
        .select(
            "product_number",
            "product_name",
            "category_name",
            F.col("units").alias("units_shipped"),
            money(F.col("units") * F.col("unit_cost_c"), "cost_of_goods"),
            ratio("stock_days", "n_days", 2).alias("average_stock"),
            ratio(F.col("stock_days") * F.col("unit_cost_c"), F.col("n_days") * 100, 2).alias(
                "average_stock_value"
            ),
            ratio(
                F.col("units") * F.col("n_days"),
                F.when(F.col("stock_days") > 0, F.col("stock_days")),
                4,
            ).alias("turnover_ratio"),
            ratio("stock_days", "units", 2).alias("days_of_supply"),
        )
    )


def event_days(m: Mart) -> DataFrame:
    """Daily totals of the events by type, taken from a stream in two runs: the first
    half of the time, and after a restart the second."""
    # Event times have no zone; as instants of UTC their days are the stream's windows.
    instant = F.to_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    events = m.table("events").select(instant.alias("ts"), "event_type", "value")
    span = events.select(F.unix_micros("ts").alias("t")).agg(F.min("t"), F.max("t")).first()
    middle = (span[0] + span[1]) // 2 if span[0] is not None else 0
    stage, target, state = (fresh_path(m.spark, x) for x in ("events", "event-days", "event-state"))
    early = F.unix_micros("ts") < middle
    for part in (early, F.coalesce(~early, F.lit(True))):
        events.filter(part).write.mode("append").parquet(stage)
        windows.close_days(m.spark, stage, events.schema, target, state)
    days = windows.days_so_far(m.spark, stage, events.schema, target)
    return days.select(
        F.to_date(F.from_utc_timestamp("day", F.current_timezone())).alias("date_actual"),
        "event_type",
        F.col("n_events").alias("daily_events"),
        money("value_c", "daily_value"),
    )


ALL = {
    "v10_yearly_sales_summary": yearly_sales_summary,
    "v11_inventory_turnover": inventory_turnover,
    "v12_event_days": event_days,
}
