"""Single-operator queries: projection, filter, join, aggregate, window, sort, functions.

Each runs one relational building block over whole tables, so that every block can
be checked on its own.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import (
    date_key, day, months_crossed, quarter_end, quarter_start, year_end, years_between,
)
from martlet.functions.draws import draw
from martlet.functions.money import amount, half_up, mean_amount, percent, ratio
from martlet.functions.text import (
    cut, currency_text, digits, flag, is_email, number_text, percent_text, to_type,
)
from martlet.operators import quantiles
from martlet.operators.keys import number_rows, padded
from martlet.operators.lookup import lookup, with_match, without_match
from martlet.operators.series import (
    first_step, full_window_sum, lag_of, ordinal, total_over, waterfall,
)
from martlet.plans import features
from martlet.plans.builds import product_month_grid
from martlet.plans.business import order_requests
from martlet.plans.views import money, per_day
from martlet.sources import raw
from martlet.sources.mart import Mart


def _one(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


# ---- projection and filters ------------------------------------------------------

def projected(m: Mart) -> DataFrame:
    gross = F.col("quantity") * F.col("price_c")
    return m.lines.select(
        "order_id", "line_number", "product_key", "sales_rep_key",
        amount(gross).alias("gross"), money("line_c", "net"),
        amount(gross - F.col("line_c")).alias("saved"),
    )


def filter_after_select(m: Mart) -> DataFrame:
    """The filter sees the cleaned columns, not the raw ones."""
    cleaned = raw.customers(m).select(
        F.trim(F.upper("customer_type")).alias("customer_type"),
        F.trim(F.upper("customer_number")).alias("customer_number"),
    )
    return cleaned.filter(
        (F.col("customer_type") == "INDIVIDUAL") & F.col("customer_number").isNotNull()
    )


def null_tests(m: Mart) -> DataFrame:
    return m.customer_master.filter(
        F.col("company_name").isNull() & F.col("last_name").isNull()
        & F.col("first_name").isNotNull()
    ).select("customer_id", "first_name")


def comparisons(m: Mart) -> DataFrame:
    q, d = F.col("quantity"), F.col("discount_pct")
    return m.items.filter(
        (q > 10) & (q <= 40) & (d >= 2) & (d < 9) & (F.col("line_number") != 3)
    ).groupBy("line_number").agg(_one(), F.sum("quantity").alias("units"))


def in_lists(m: Mart) -> DataFrame:
    return m.orders.filter(
        F.col("status").isin("SHIPPED", "PENDING") & ~F.month("order_date").isin(1, 7, 12)
    ).groupBy("status", F.month("order_date").alias("month")).agg(_one())


def between_dates(m: Mart) -> DataFrame:
    keys = date_key("order_date").between(19990301, 19990531)
    dates = F.col("order_date").between(day(date(1998, 2, 1)), day(date(1999, 4, 30)))
    return m.orders.filter(keys & dates).select("order_id", "order_date")


def email_pattern(m: Mart) -> DataFrame:
    return raw.customers(m).groupBy(is_email("email").alias("is_valid")).agg(_one())


def like_patterns(m: Mart) -> DataFrame:
    name = F.col("product_name")
    return m.products.filter(name.like("%ring") & ~name.like("red%")).select(
        "product_key", "product_name"
    )


def boolean_filter(m: Mart) -> DataFrame:
    return m.date_dim.filter("is_holiday").join(
        m.orders, F.col("date_actual") == F.col("order_date")
    ).groupBy("holiday_name").agg(_one("n_orders"))


def case_labels(m: Mart) -> DataFrame:
    """Searched, simple and nested case."""
    size = F.when(F.col("quantity") < 10, "small").when(F.col("quantity") < 30, "medium")
    nested = F.when(
        F.col("discount_pct") > 0, F.when(F.col("discount_pct") > 5, "deep").otherwise("light")
    ).otherwise("none")
    return m.items.groupBy(
        size.otherwise("large").alias("size"), nested.alias("discount"),
        F.when(F.col("line_number") == 1, "first").otherwise("other").alias("place"),
    ).agg(_one())


def null_guards(m: Mart) -> DataFrame:
    """COALESCE, NULLIF and a division that must not meet a zero."""
    c = m.customer_master
    return c.select(
        "customer_id",
        F.coalesce("company_name", "last_name", F.lit("unnamed")).alias("name"),
        F.nullif(F.col("status"), F.lit("ACTIVE")).alias("exception_status"),
        ratio(F.col("customer_id"), F.col("customer_id") % 5, 4).alias("guarded"),
    )


def in_subquery(m: Mart) -> DataFrame:
    large = m.items.filter(F.col("quantity") >= 49).select("order_id")
    return with_match(m.orders, large, "order_id").groupBy("status").agg(_one())


def having_alias(m: Mart) -> DataFrame:
    return m.orders.groupBy("customer_id").agg(_one("total_orders")).filter("total_orders > 15")


def probabilistic_filter(m: Mart) -> DataFrame:
    chance = F.when(F.col("segment_name") == "BUILDING", 0.4).when(
        F.col("segment_name") == "MACHINERY", 0.25
    ).otherwise(0.08)
    return m.customers.filter(draw("keep", "customer_id") < chance).select(
        "customer_id", "segment_name"
    )


def relative_dates(m: Mart) -> DataFrame:
    """Orders in each of the usual windows before the report date."""
    now, d = day(m.as_of), F.col("order_date")
    return m.orders.agg(
        F.count_if(d >= day(m.as_of - timedelta(days=30))).alias("last_30_days"),
        F.count_if(F.trunc(d, "month") == F.trunc(now, "month")).alias("this_month"),
        F.count_if(quarter_start(d) == quarter_start(now)).alias("this_quarter"),
        F.count_if(F.year(d) == F.year(now)).alias("this_year"),
        F.count_if(d >= F.add_months(now, -12)).alias("last_12_months"),
    )


# ---- joins -----------------------------------------------------------------------

def fact_by_dimension(m: Mart) -> DataFrame:
    per_rep = m.lines.groupBy("sales_rep_key").agg(F.sum("line_c").alias("revenue_c"))
    return per_rep.join(m.reps, "sales_rep_key").groupBy("region").agg(
        amount(F.sum("revenue_c")).alias("total_revenue")
    )


def left_join(m: Mart) -> DataFrame:
    """Every customer with the number of their orders; none is null."""
    counts = m.orders.groupBy("customer_id").agg(_one("n_orders"))
    return m.customers.select("customer_id").join(counts, "customer_id", "left")


def star_join(m: Mart) -> DataFrame:
    """Fact with calendar, customer, product and rep, reported by their attributes."""
    rows = (
        m.sales()
        .groupBy(F.trunc("order_date", "year").alias("order_date"), "customer_id", "product_key",
                 "sales_rep_key")
        .agg(F.sum("line_c").alias("revenue_c"))
    )
    return (
        rows.join(m.customer_dim.select("customer_id", "segment_name"), "customer_id")
        .join(m.products.select("product_key", "product_line"), "product_key")
        .join(m.reps.select("sales_rep_key", "region"), "sales_rep_key")
        .join(m.date_dim.select("date_actual", "year_number"),
              F.col("order_date") == F.col("date_actual"))
        .groupBy("year_number", "segment_name", "product_line", "region")
        .agg(amount(F.sum("revenue_c")).alias("total_revenue"))
    )


def two_roles(m: Mart) -> DataFrame:
    """The address table as billing and as shipping place of one customer."""
    home = m.addresses.select(F.col("address_id").alias("b"), F.col("country").alias("billed_to"))
    away = m.addresses.select(F.col("address_id").alias("s"), F.col("country").alias("sent_to"))
    return (
        m.customer_master.join(home, F.col("billing_address_id") == F.col("b"))
        .join(away, F.col("shipping_address_id") == F.col("s"))
        .groupBy("billed_to", "sent_to")
        .agg(_one())
    )


def anti_join(m: Mart) -> DataFrame:
    return without_match(
        m.orders, m.items.select("order_id").distinct(), "order_id"
    ).select("order_id", "status")


def semi_join(m: Mart) -> DataFrame:
    latest = m.orders.filter(F.col("order_date") >= day(m.as_of - timedelta(days=7)))
    return with_match(
        m.customers, latest.select("customer_id").distinct(), "customer_id"
    ).select("customer_id", "customer_name")


def dense_grid(m: Mart) -> DataFrame:
    """Every product for every month end, sold or not."""
    return product_month_grid(m).select("product_key", "month_end")


def month_range_join(m: Mart) -> DataFrame:
    """Units per product and month end: product equality plus a date-key range.

    Sales are added up per product and day before the range is tested, and the
    product key carries the join, so no pair of a product with another is formed.
    """
    sold = (
        m.items.join(
            m.orders.filter(F.col("order_date") >= day(date(2000, 8, 1))).select(
                "order_id", "order_date"
            ),
            "order_id",
        )
        .groupBy("product_key", date_key("order_date").alias("sale_key"))
        .agg(F.sum("quantity").alias("quantity"))
    )
    grid = product_month_grid(m).select(
        F.col("product_key").alias("grid_product"),
        date_key("month_end").alias("date_key"),
        date_key(F.trunc("month_end", "month")).alias("month_start_key"),
    )
    joined = grid.join(
        sold,
        (F.col("grid_product") == F.col("product_key"))
        & F.col("sale_key").between(F.col("month_start_key"), F.col("date_key")),
        "left",
    )
    return joined.groupBy(F.col("grid_product").alias("product_key"), "date_key").agg(
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("units_sold")
    )


def period_join(m: Mart) -> DataFrame:
    """Days of sales per rep and pay period: employee equality plus a date range.

    Pay periods are the fortnights of the report date's year that start up to that date.
    """
    first = date(m.as_of.year, 1, 1)
    daily = (
        m.items.join(
            m.orders.filter(F.col("order_date") >= day(first)).select(
                "order_id", "order_date"
            ),
            "order_id",
        )
        .select(F.col("sales_rep_key").alias("rep"), "order_date")
        .distinct()
    )
    periods = F.transform(
        F.sequence(F.lit(0), F.lit((m.as_of - first).days // 14)),
        lambda i: F.date_add(day(first), i * 14),
    )
    pay = m.employees.select("employee_id", F.explode(periods).alias("period_start"))
    return pay.join(
        daily,
        (F.col("employee_id") == F.col("rep"))
        & F.col("order_date").between(F.col("period_start"), F.date_add("period_start", 13)),
    ).groupBy("employee_id", "period_start").agg(_one("days_with_sales"))


def correlated_aggregate(m: Mart) -> DataFrame:
    """Customers with count and newest date of their orders, by one aggregate."""
    per_customer = m.orders.groupBy("customer_id").agg(
        _one("total_orders"), F.max("order_date").alias("last_order_date")
    )
    return m.customers.select("customer_id").join(per_customer, "customer_id", "left").select(
        "customer_id", F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        "last_order_date",
    )


def scalar_lookup(m: Mart) -> DataFrame:
    """Each employee's territory id by the nation's name, and the largest such id."""
    names = m.places.select(
        F.col("nation_name").alias("_name"), F.col("n_nationkey").alias("_id")
    )
    reps = m.reps.select("sales_rep_key", "territory_name")
    return lookup(reps, names, F.col("territory_name") == F.col("_name"), "_id", "territory_id").withColumn(
        "newest_territory", m.places.agg(F.max("n_nationkey")).scalar()
    )


def lookup_with_default(m: Mart) -> DataFrame:
    """Category ids by name over all categories; every fiftieth product names an unknown one."""
    known = m.categories.select(
        F.col("category_id").alias("_id"), F.col("category_name").alias("_name")
    )
    name = F.col("category_name")
    unknown = F.when(F.col("product_key") % 50 == 0, F.concat(F.lit("Old "), name)).otherwise(name)
    return lookup(
        m.products.select("product_key", unknown.alias("category_name")), known,
        F.col("category_name") == F.col("_name"), "_id", "category_id", 1,
    )


def merge_join(m: Mart) -> DataFrame:
    """Full outer join of two versions of a table, each key told apart."""
    old = m.products.filter("supplier_name <> 'Brand#7'").select(
        "product_key", (F.col("price_c") + F.col("product_key") % 3).alias("old_c")
    )
    new = m.products.filter("category_name <> 'PROMO'").select("product_key", "price_c")
    state = (
        F.when(F.col("old_c").isNull(), "insert")
        .when(F.col("price_c").isNull(), "keep")
        .when(F.col("old_c") != F.col("price_c"), "update")
        .otherwise("same")
    )
    return old.join(new, "product_key", "full_outer").select("product_key", state.alias("action"))


# ---- aggregates --------------------------------------------------------------------

def grouped(m: Mart) -> DataFrame:
    return m.date_dim.join(
        m.orders, F.col("date_actual") == F.col("order_date")
    ).groupBy(
        "year_number", "quarter_name", "month_name", "day_of_week_name", "is_weekend",
        "is_holiday", "status",
    ).agg(_one())


def global_totals(m: Mart) -> DataFrame:
    return m.lines.agg(
        _one("n_lines"), F.sum("quantity").alias("units"),
        amount(F.sum("line_c")).alias("revenue"), F.min("shipped_date").alias("first_shipped"),
    )


def counts(m: Mart) -> DataFrame:
    return m.customer_master.agg(
        _one("n_rows"),
        F.count("company_name").alias("n_companies"),
        F.count(F.when(F.col("status") == "ACTIVE", 1)).alias("n_active"),
    )


def distinct_counts(m: Mart) -> DataFrame:
    """Orders, customers and products per status; each by its own two-step count."""
    by_order = m.items.select("order_id").distinct().join(
        m.orders.select("order_id", "customer_id", "status"), "order_id"
    )
    orders = by_order.groupBy("status", "customer_id").agg(_one("k")).groupBy("status").agg(
        F.sum("k").alias("orders"), _one("customers")
    )
    products = (
        m.items.select("order_id", "product_key")
        .join(m.orders.select("order_id", "status"), "order_id")
        .select("status", "product_key").distinct().groupBy("status").agg(_one("products"))
    )
    return orders.join(products, "status")


def distinct_months(m: Mart) -> DataFrame:
    return m.orders.groupBy("customer_id").agg(
        F.count_distinct(F.trunc("order_date", "month")).alias("active_months")
    )


def basic_aggregates(m: Mart) -> DataFrame:
    return m.lines.groupBy("sales_rep_key").agg(
        F.sum("quantity").alias("units"), F.min("quantity").alias("fewest"),
        F.max("quantity").alias("most"), mean_amount(F.sum("line_c"), _one()).alias("mean_line"),
    )


def deviations(m: Mart) -> DataFrame:
    sums = m.lines.groupBy("product_key").agg(
        F.sum("line_c").alias("s"),
        F.sum(features.square("line_c")).alias("ss"), _one(),
    )
    std = F.when(F.col("n") > 1, F.round(features.sample_deviation("ss", "s", "n"), 4))
    return sums.select("product_key", std.alias("line_std"))


def guarded_ratios(m: Mart) -> DataFrame:
    shipped = F.when(F.col("status") == "SHIPPED", F.col("freight")).otherwise(0)
    return m.orders.groupBy("customer_id").agg(
        F.sum(shipped).alias("a"), F.sum("freight").alias("b")
    ).select("customer_id", percent("a", "b").alias("shipped_percent"))


def sum_of_products(m: Mart) -> DataFrame:
    return m.lines.groupBy("line_number").agg(
        amount(F.sum(F.col("quantity") * F.col("price_c"))).alias("gross")
    )


def distinct_rows(m: Mart) -> DataFrame:
    return m.products.select("category_name", "supplier_name", "product_line").distinct()


def exact_median(m: Mart) -> DataFrame:
    """Median income and median price, exact at any size."""
    return m.spark.range(0, 1, 1, 1).select(
        quantiles.median(m.customers, "annual_income").alias("median_income"),
        (quantiles.median(m.lines, "line_c") / 100).alias("median_line"),
    )


def flag_rate(m: Mart) -> DataFrame:
    gone = F.when(F.col("status") == "INACTIVE", 1).otherwise(0)
    return m.customers.groupBy("segment_name").agg(
        ratio(F.sum(gone), _one(), 6).alias("inactive_rate")
    )


def two_level(m: Mart) -> DataFrame:
    """Mean of daily revenue per year."""
    return per_day(m).groupBy(F.year("order_date").alias("year")).agg(
        mean_amount(F.sum("revenue_c"), _one()).alias("mean_daily_revenue")
    )


def region_rollup(m: Mart) -> DataFrame:
    return m.reps.rollup("region", "territory_name").agg(
        _one("n_reps"), F.grouping("territory_name").cast("bigint").alias("is_subtotal")
    )


def quartiles(m: Mart) -> DataFrame:
    """Quartiles of monthly order counts per weekday; one value per month and day."""
    cells = m.orders.groupBy(
        F.dayofweek("order_date").alias("day_of_week"), F.trunc("order_date", "month").alias("mo")
    ).agg(_one())
    q = F.percentile("n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return cells.groupBy("day_of_week").agg(q.alias("q")).select(
        "day_of_week",
        *[F.round(F.col("q")[i], 4).alias(n) for i, n in enumerate(("q1", "median", "q3"))],
    )


def pivoted(m: Mart) -> DataFrame:
    return m.orders.groupBy(F.year("order_date").alias("year")).pivot(
        "status", ["SHIPPED", "PROCESSING", "PENDING"]
    ).agg(_one())


def shares(m: Mart) -> DataFrame:
    sums = m.orders.groupBy("status").agg(F.sum("freight").alias("freight"))
    return sums.withColumn("all_freight", total_over("freight")).select(
        "status", percent("freight", "all_freight").alias("share_percent")
    )


# ---- windows ------------------------------------------------------------------------

def _daily_orders(m: Mart) -> DataFrame:
    return m.orders.groupBy("order_date").agg(_one())


def date_spine(m: Mart) -> DataFrame:
    """Numbered days from the first to the last order, gaps included."""
    span = m.orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    spine = span.select(F.posexplode(F.sequence("lo", "hi")).alias("pos", "day"))
    return spine.join(_daily_orders(m), F.col("day") == F.col("order_date"), "left").select(
        (F.col("pos") + 1).alias("day_number"), "day", F.coalesce("n", F.lit(0)).alias("n_orders")
    )


def order_numbers(m: Mart) -> DataFrame:
    """Zero-padded order numbers by customer, then order."""
    numbered = number_rows(
        m.orders.select("customer_id", "order_id"), ["customer_id", "order_id"], 1, "n"
    )
    return numbered.select(
        "order_id", "customer_id", padded("ORD-", "n", 8).alias("order_number")
    )


def lags(m: Mart) -> DataFrame:
    return _daily_orders(m).select(
        "order_date", "n",
        lag_of("n", 1, "order_date").alias("lag_1"), lag_of("n", 7, "order_date").alias("lag_7"),
    )


def rolling_means(m: Mart) -> DataFrame:
    mean = lambda k: ratio(full_window_sum("n", k, "order_date"), F.lit(k), 4)
    return _daily_orders(m).select(
        "order_date", mean(7).alias("mean_7"), mean(30).alias("mean_30")
    )


def trend(m: Mart) -> DataFrame:
    return _daily_orders(m).select("order_date", ordinal("order_date").alias("trend"))


def running_total(m: Mart) -> DataFrame:
    months = m.orders.groupBy(F.trunc("order_date", "month").alias("month")).agg(_one())
    return waterfall(months, "month", "n")


def share_of_first(m: Mart) -> DataFrame:
    by_size = m.items.groupBy("line_number").agg(_one())
    return by_size.withColumn("first_n", first_step(by_size, "line_number", "n")).select(
        "line_number", "n", percent("n", "first_n").alias("percent_of_first")
    )


# ---- sorting, limits, sets --------------------------------------------------------------

def sorted_rows(m: Mart) -> DataFrame:
    return m.reps.select("region", "territory_name", "sales_rep_name").orderBy(
        F.asc("region"), F.desc("territory_name"), "sales_rep_name"
    )


def first_rows(m: Mart) -> DataFrame:
    """A limit made repeatable by a sort on the key."""
    return m.customers.select("customer_id", "customer_name").orderBy("customer_id").limit(1000)


def top_k(m: Mart) -> DataFrame:
    return m.lines.groupBy("product_key").agg(F.sum("line_c").alias("c")).select(
        "product_key", money("c", "revenue")
    ).orderBy(F.desc("revenue"), "product_key").limit(25)


def largest(m: Mart) -> DataFrame:
    return m.customers.select("customer_id", "annual_income").orderBy(
        F.desc("annual_income"), "customer_id"
    ).limit(10)


def first_or_none(m: Mart) -> DataFrame:
    return m.orders.filter(F.col("status") == "PENDING").orderBy(
        F.desc("order_date"), "order_id"
    ).select("order_id", "order_date").limit(1)


def union_all(m: Mart) -> DataFrame:
    """Three periods before the report date as one report; matched by column name."""
    def part(label: str, months: int) -> DataFrame:
        return m.orders.filter(F.col("order_date") >= F.add_months(day(m.as_of), -months)).agg(
            F.sum("freight").alias("freight"), _one("n_orders")
        ).select("n_orders", F.lit(label).alias("period"), "freight")

    rows = part("month", 1)
    return rows.unionByName(part("quarter", 3)).unionByName(
        part("year", 12).select("period", "n_orders", "freight")
    )


# ---- functions -----------------------------------------------------------------------

def string_functions(m: Mart) -> DataFrame:
    return raw.customers(m).filter("customer_number IS NOT NULL").select(
        F.upper(F.trim("customer_number")).alias("number"),
        F.lower(F.trim("email")).alias("email"),
        digits("phone").alias("digits"),
        F.concat("city", F.lit(", "), "country").alias("place"),
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        F.lpad("postal_code", 8, "0").alias("padded"),
        F.left("state_province", F.lit(3)).alias("initials"),
        cut("address_line_1", 5).alias("cut"),
    )


def cast_functions(m: Mart) -> DataFrame:
    """Safe casts of clean and of broken text."""
    r = raw.products(m)
    return r.select(
        "product_number",
        to_type("unit_price", "decimal(10,2)").cast("double").alias("unit_price"),
        to_type("unit_price", "bigint").alias("whole"),
        to_type("product_number", "date").alias("no_date"),
        to_type("discontinued", "boolean").alias("strict_flag"),
        flag("discontinued", False).alias("loose_flag"),
    )


def date_parts(m: Mart) -> DataFrame:
    d = F.col("order_date")
    return m.orders.select(
        "order_id",
        F.year(d).alias("y"), F.month(d).alias("mo"), F.dayofmonth(d).alias("dom"),
        F.quarter(d).alias("q"), F.dayofweek(d).alias("dow"), F.dayofyear(d).alias("doy"),
        F.weekofyear(d).alias("week"), F.dayname(d).alias("day_name"),
        F.monthname(d).alias("month_name"), date_key(d).alias("date_key"),
        (F.unix_date(d).cast("bigint") * 86400).alias("epoch"),
    )


def date_arithmetic(m: Mart) -> DataFrame:
    d, now = F.col("order_date"), day(m.as_of)
    return m.orders.select(
        "order_id",
        F.date_add(d, 45).alias("plus_days"), F.add_months(d, -2).alias("minus_months"),
        F.add_months(d, 12).alias("plus_year"), F.datediff(now, d).alias("days"),
        months_crossed(d, now).alias("months"), years_between(d, now).alias("years"),
        F.last_day(d).alias("month_end"), quarter_end(d).alias("quarter_end"),
        year_end(d).alias("year_end"), F.trunc(d, "week").alias("week_start"),
        quarter_start(d).alias("quarter_start"),
        F.date_format(F.lit("2001-08-01 10:00:00").cast("timestamp_ntz")
                      - F.expr("INTERVAL 36 HOURS"), "yyyy-MM-dd HH").alias("earlier"),
    )


def format_functions(m: Mart) -> DataFrame:
    """Display texts of small, thousand- and million-sized amounts, and of nothing."""
    income = F.col("annual_income")
    return m.customer_master.select(
        "customer_id",
        currency_text(income).alias("income_text"),
        number_text(income * 1000).alias("large_text"),
        percent_text((F.col("customer_id") % 800) / 8.0).alias("percent_text"),
        F.date_format("registration_date", "yyyyMMddHHmmss").alias("stamp"),
    )


def math_functions(m: Mart) -> DataFrame:
    c = F.col("price_c")
    return m.products.select(
        "product_key",
        half_up(c, F.lit(7)).alias("rounded"),
        F.ceil(c / 700).alias("up"), F.floor(c / 700).alias("down"),
        F.greatest(F.coalesce(F.when(c % 3 == 0, c), F.lit(0)), F.lit(91000)).alias("at_least"),
        F.abs(c - 95000).alias("distance"),
        (F.round(F.sin(c / 100.0), 6) + 0.0).alias("wave"),
    )


def array_functions(m: Mart) -> DataFrame:
    """Order items as an array of structs, sized, indexed, and taken apart again."""
    r = order_requests(m)
    return r.select(
        "request_id",
        F.size("items").cast("bigint").alias("n_items"),
        F.get("items", F.lit(0))["product_id"].alias("first_product"),
        F.aggregate(
            "items", F.lit(0).cast("bigint"), lambda acc, i: acc + i["quantity"]
        ).alias("units"),
    )


def json_functions(m: Mart) -> DataFrame:
    return m.table("events").select(
        F.from_json("props", "k int")["k"].alias("k")
    ).groupBy("k").agg(_one())


def null_functions(m: Mart) -> DataFrame:
    """Fill and drop of missing values."""
    c = m.customer_master.select("customer_id", "annual_income", "last_name", "birth_date")
    return c.na.drop(subset=["birth_date"]).na.fill({"annual_income": 0, "last_name": "?"}).select(
        "customer_id", "annual_income", "last_name"
    )


ALL = {
    "p01_projected": projected,
    "p02_filter_after_select": filter_after_select,
    "p03_null_tests": null_tests,
    "p04_comparisons": comparisons,
    "p05_in_lists": in_lists,
    "p06_between_dates": between_dates,
    "p07_email_pattern": email_pattern,
    "p08_like_patterns": like_patterns,
    "p09_boolean_filter": boolean_filter,
    "p10_case_labels": case_labels,
    "p11_null_guards": null_guards,
    "p12_in_subquery": in_subquery,
    "p13_having_alias": having_alias,
    "p14_probabilistic_filter": probabilistic_filter,
    "p15_relative_dates": relative_dates,
    "j01_fact_by_dimension": fact_by_dimension,
    "j02_left_join": left_join,
    "j03_star_join": star_join,
    "j04_two_roles": two_roles,
    "j05_anti_join": anti_join,
    "j06_semi_join": semi_join,
    "j07_dense_grid": dense_grid,
    "j08_month_range_join": month_range_join,
    "j09_period_join": period_join,
    "j10_correlated_aggregate": correlated_aggregate,
    "j11_scalar_lookup": scalar_lookup,
    "j12_lookup_with_default": lookup_with_default,
    "j14_merge_join": merge_join,
    "a01_grouped": grouped,
    "a02_global_totals": global_totals,
    "a03_counts": counts,
    "a04_distinct_counts": distinct_counts,
    "a05_distinct_months": distinct_months,
    "a06_basic_aggregates": basic_aggregates,
    "a07_deviations": deviations,
    "a08_guarded_ratios": guarded_ratios,
    "a09_sum_of_products": sum_of_products,
    "a10_distinct_rows": distinct_rows,
    "a11_exact_median": exact_median,
    "a12_flag_rate": flag_rate,
    "a13_two_level": two_level,
    "a14_region_rollup": region_rollup,
    "a15_quartiles": quartiles,
    "a16_pivoted": pivoted,
    "a17_shares": shares,
    "w01_date_spine": date_spine,
    "w02_order_numbers": order_numbers,
    "w03_lags": lags,
    "w04_rolling_means": rolling_means,
    "w05_trend": trend,
    "w07_running_total": running_total,
    "w08_share_of_first": share_of_first,
    "t01_sorted_rows": sorted_rows,
    "t02_first_rows": first_rows,
    "t03_top_k": top_k,
    "t04_largest": largest,
    "t05_first_or_none": first_or_none,
    "x01_union_all": union_all,
    "f_string": string_functions,
    "f_cast": cast_functions,
    "f_date_parts": date_parts,
    "f_date_arithmetic": date_arithmetic,
    "f_format": format_functions,
    "f_math": math_functions,
    "f_array": array_functions,
    "f_json": json_functions,
    "f_null": null_functions,
}
