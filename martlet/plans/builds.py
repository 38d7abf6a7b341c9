"""Dimension, fact and derived-table builds."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import date_key, day, months_crossed, years_between
from martlet.functions.draws import draw_int
from martlet.functions.money import amount, half_up, mean_amount, ratio
from martlet.operators import scd2
from martlet.operators.lookup import paths
from martlet.operators.mutate import update_from
from martlet.plans import calendar
from martlet.plans.views import money
from martlet.sources.mart import Mart, Span


# ---- calendar ----------------------------------------------------------------

def order_calendar(m: Mart) -> DataFrame:
    """Calendar of every whole year in which an order was placed."""
    return calendar.covering(m.spark, m.orders, "order_date")


def date_dimension(m: Mart) -> DataFrame:
    return order_calendar(m).drop("holiday_name", "is_holiday")


def holidays(m: Mart) -> DataFrame:
    return order_calendar(m).filter("is_holiday").select(
        "date_key", "date_actual", "day_of_week", "holiday_name"
    )


def extended_dates(m: Mart) -> DataFrame:
    return calendar.extend(order_calendar(m)).select(
        "date_actual", "epoch", "day_suffix", "day_of_quarter", "week_of_month",
        "first_day_of_week", "last_day_of_week", "first_day_of_month", "last_day_of_month",
        "first_day_of_quarter", "last_day_of_quarter", "first_day_of_year", "last_day_of_year",
        "is_weekday",
    )


def calendar_check(m: Mart) -> DataFrame:
    return calendar.verify(order_calendar(m))


# ---- dimensions --------------------------------------------------------------

def customer_source(m: Mart) -> DataFrame:
    """Customer dimension source: display name, age and income bands, segment, and
    the address table joined in two roles."""
    c = m.customer_master
    age = years_between("birth_date", day(m.as_of))
    age_group = F.when(F.col("birth_date").isNull(), "Unknown")
    for limit, label in ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")):
        age_group = age_group.when(age < limit, label)
    income_band = F.when(F.lit(False), "")
    for limit, label in ((30000, "Low"), (75000, "Medium"), (150000, "High")):
        income_band = income_band.when(F.col("annual_income") < limit, label)

    def role(name: str) -> DataFrame:
        return m.addresses.select(
            F.col("address_id").alias(f"{name}_address_id"),
            F.col("city").alias(f"{name}_city"),
            F.col("state_province").alias(f"{name}_state"),
            F.col("country").alias(f"{name}_country"),
        )

    return (
        c.join(m.segments.select("segment_id", "segment_name"), "segment_id", "left")
        .join(role("billing"), "billing_address_id", "left")
        .join(role("shipping"), "shipping_address_id", "left")
        .select(
            "customer_id",
            "customer_number",
            F.coalesce(
                "company_name", F.concat("first_name", F.lit(" "), "last_name")
            ).alias("customer_name"),
            "customer_type",
            "company_name",
            "email",
            "phone",
            "birth_date",
            "gender",
            age_group.otherwise("65+").alias("age_group"),
            "annual_income",
            income_band.otherwise("Very High").alias("income_category"),
            "segment_name",
            *[f"{r}_{p}" for r in ("billing", "shipping") for p in ("city", "state", "country")],
            "registration_date",
            "status",
        )
    )


def product_source(m: Mart) -> DataFrame:
    """Product dimension source; the hierarchy column repeats the category name."""
    return (
        m.product_master.join(m.categories, "category_id", "left")
        .join(m.suppliers, "supplier_id", "left")
        .select(
            "product_id",
            "product_number",
            "product_name",
            "category_name",
            F.col("category_name").alias("category_hierarchy"),
            "supplier_name",
            "supplier_country",
            "unit_price",
            "cost",
            "discontinued",
        )
    )


def initial_customer_dim(m: Mart) -> DataFrame:
    """First load keeps customers that have both a segment and a billing address."""
    joined = m.customer_master.join(m.segments.drop("discount_rate"), "segment_id").join(
        m.addresses.withColumnRenamed("address_id", "billing_address_id"), "billing_address_id"
    )
    return scd2.first_load(
        joined.select(
            F.col("customer_id").alias("customer_key"),
            "customer_id", "customer_number", "customer_type", "company_name", "first_name",
            "last_name", "email", "segment_name", "city", "state_province", "country",
            "registration_date", "status", "annual_income",
            F.col("registration_date").alias("effective_date"),
        )
    )


def initial_product_dim(m: Mart) -> DataFrame:
    joined = m.product_master.join(m.categories, "category_id").join(m.suppliers, "supplier_id")
    return scd2.first_load(
        joined.select(
            F.col("product_id").alias("product_key"),
            "product_id", "product_number", "product_name", "category_name", "supplier_name",
            F.col("unit_price").cast("double").alias("unit_price"),
            F.col("cost").cast("double").alias("cost"),
            "discontinued",
        ),
        m.as_of,
    )


def initial_rep_dim(m: Mart) -> DataFrame:
    reps = sales_reps(m).join(
        m.places.select(
            F.col("n_nationkey").alias("territory_id"), F.col("nation_name").alias("territory_name")
        ),
        "territory_id",
    )
    return scd2.first_load(
        reps.select(
            F.col("sales_rep_id").alias("sales_rep_key"), "sales_rep_id", "employee_id",
            "full_name", "territory_name", "hire_date", "commission_rate",
            F.col("hire_date").alias("effective_date"),
        )
    )


def sales_reps(m: Mart) -> DataFrame:
    """Reps are the employees of the sales department; position sets the rate."""
    rate = (
        F.when(F.col("position_code") == "SR_SALES_REP", 0.08)
        .when(F.col("position_code") == "SALES_REP", 0.05)
        .otherwise(0.10)
    )
    sales = m.positions.filter(F.col("department_code") == "SALES")
    return m.employees.join(sales, "position_id").select(
        F.col("employee_id").alias("sales_rep_id"),
        "employee_id",
        "full_name",
        "territory_id",
        "hire_date",
        rate.alias("commission_rate"),
        "status",
    )


# ---- orders and facts ----------------------------------------------------------

def order_totals_c(m: Mart) -> DataFrame:
    """Subtotal, tax and total of every order in cents; zero without lines."""
    sums = m.lines.groupBy("order_id").agg(F.sum("line_c").alias("sum_c"))
    subtotal = F.coalesce("sum_c", F.lit(0))
    return update_from(
        m.orders,
        sums,
        "order_id",
        subtotal_c=subtotal,
        tax_c=half_up(subtotal * 8, F.lit(100)),
        total_c=half_up(subtotal * 108, F.lit(100)),
    )


def order_totals(m: Mart) -> DataFrame:
    return order_totals_c(m).select(
        "order_id",
        money("subtotal_c", "subtotal"),
        money("tax_c", "tax_amount"),
        money("total_c", "total_amount"),
    )


def customer_totals(m: Mart) -> DataFrame:
    per_customer = order_totals_c(m).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_c").alias("spent_c"),
        F.max("order_date").alias("last_date"),
    )
    return update_from(
        m.customers.select("customer_id", "customer_number"),
        per_customer,
        "customer_id",
        total_orders=F.coalesce("n", F.lit(0)),
        total_spent=amount(F.coalesce("spent_c", F.lit(0))),
        last_order_date=F.col("last_date"),
    )


def allocated_lines(m: Mart) -> DataFrame:
    """Lines of shipped orders with the order's tax and freight split by line share.

    The order subtotal comes from an aggregate joined back on the order, not from a
    window, so an order of any size is split over tasks.
    """
    rows = m.sales().filter(F.col("status") == "SHIPPED")
    subtotals = rows.groupBy("order_id").agg(F.sum("line_c").alias("subtotal_c"))
    order_tax = half_up(F.col("subtotal_c") * 8, F.lit(100))
    share = lambda total: F.coalesce(
        half_up(F.col("line_c").cast("decimal(20,0)") * total, "subtotal_c"), F.lit(0)
    )
    discount = half_up(F.col("quantity") * F.col("price_c") * F.col("discount_pct"), F.lit(100))
    return (
        rows.join(subtotals, "order_id")
        .withColumn("discount_c", discount)
        .withColumn("line_tax_c", share(order_tax))
        .withColumn("line_freight_c", share(F.col("freight") * 100))
        .withColumn("net_c", F.col("line_c") + F.col("line_tax_c") + F.col("line_freight_c"))
    )


def sales_fact(m: Mart) -> DataFrame:
    return allocated_lines(m).select(
        date_key("order_date").alias("order_date_key"),
        F.col("customer_id").alias("customer_key"),
        "product_key",
        "sales_rep_key",
        "order_id",
        "line_number",
        "quantity",
        money("price_c", "unit_price"),
        money("discount_c", "discount_amount"),
        money("line_c", "line_total"),
        money("line_tax_c", "tax_amount"),
        money("line_freight_c", "freight_amount"),
        money("net_c", "net_amount"),
        money("unit_cost_c", "cost"),
        money("profit_c", "profit"),
    )


def customer_ltv(m: Mart) -> DataFrame:
    per_customer = (
        allocated_lines(m)
        .groupBy("order_id", "customer_id")
        .agg(F.sum("net_c").alias("net_c"), F.count(F.lit(1)).alias("n_lines"))
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.sum("net_c").alias("net_c"),
            F.sum("n_lines").alias("n_lines"),
        )
    )
    revenue = F.coalesce("net_c", F.lit(0))
    orders = F.coalesce("n_orders", F.lit(0))
    months = months_crossed("registration_date", day(m.as_of))
    score = F.when(revenue > 5000000, "A").when(revenue > 2000000, "B").when(revenue > 500000, "C")
    risk = F.when((months > 12) & (orders == 0), "High Risk").when(
        (months > 6) & (orders <= 1), "Medium Risk"
    )
    return m.customer_dim.join(per_customer, "customer_id", "left").select(
        date_key(day(m.as_of)).alias("calculation_date_key"),
        "customer_key",
        orders.alias("total_orders"),
        amount(revenue).alias("total_revenue"),
        F.coalesce(mean_amount("net_c", "n_lines"), F.lit(0.0)).alias("average_order_value"),
        months.alias("months_active"),
        amount(half_up(revenue * F.greatest(months, F.lit(1)) * 12, F.lit(10))).alias(
            "predicted_ltv"
        ),
        score.otherwise("D").alias("customer_score"),
        risk.otherwise("Low Risk").alias("risk_segment"),
    )


def month_ends(m: Mart):
    """The last days of the twelve months before ``as_of``, as an array column."""
    now = day(m.as_of)
    first = F.last_day(F.add_months(now, -12))
    ends = F.transform(
        F.sequence(F.lit(0), F.lit(12)), lambda i: F.last_day(F.add_months(first, i))
    )
    return F.filter(ends, lambda d: (d <= now) & (d >= F.add_months(now, -12)))


def product_month_grid(m: Mart) -> DataFrame:
    """Every product with each month end: the report is dense by definition."""
    return m.products.select(
        "product_key", "price_c", "unit_cost_c", F.explode(month_ends(m)).alias("month_end")
    )


def product_performance(m: Mart) -> DataFrame:
    first = (m.as_of.replace(day=1) - timedelta(days=365)).replace(day=1)
    sold = (
        m.sales(Span(first, m.as_of))
        .groupBy("product_key", F.last_day("order_date").alias("month_end"))
        .agg(F.sum("quantity").alias("units"), F.sum("line_c").alias("revenue_c"))
    )
    gain = F.when(F.col("units").isNotNull(), F.col("price_c") - F.col("unit_cost_c")).otherwise(0)
    revenue = F.coalesce("revenue_c", F.lit(0))

    def beats(revenue_floor: int, tenths: int):
        return (revenue > revenue_floor * 100) & (gain * 10 > F.col("price_c") * tenths)

    grade = F.when(beats(10000, 3), "A").when(beats(5000, 2), "B").when(beats(1000, 1), "C")
    key = date_key("month_end")
    return product_month_grid(m).join(sold, ["product_key", "month_end"], "left").select(
        key.alias("date_key"),
        "product_key",
        F.coalesce("units", F.lit(0)).alias("units_sold"),
        amount(revenue).alias("revenue"),
        ratio(gain, "price_c").alias("profit_margin"),
        draw_int("turns", 1, 12, key, "product_key").alias("inventory_turns"),
        (draw_int("returns", 100, 500, key, "product_key") / F.lit(10000.0)).alias("return_rate"),
        (draw_int("liking", 350, 500, key, "product_key") / F.lit(100.0)).alias(
            "customer_satisfaction"
        ),
        grade.otherwise("D").alias("performance_score"),
    )


def customer_analytics(m: Mart) -> DataFrame:
    """Month, customer and segment: orders, amounts and last order."""
    per_month = (
        m.order_sales()
        .groupBy(F.trunc("order_date", "month").alias("month_date"), "customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("revenue_c").alias("revenue_c"),
            F.sum("profit_c").alias("profit_c"),
            F.sum("n_lines").alias("n_lines"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    return per_month.join(
        m.customer_master.select("customer_id", "segment_id"), "customer_id"
    ).select(
        "month_date",
        date_key("month_date").alias("date_key"),
        "customer_id",
        "segment_id",
        "total_orders",
        money("revenue_c", "total_amount"),
        money("profit_c", "total_profit"),
        mean_amount("revenue_c", "n_lines").alias("average_order_value"),
        "last_order_date",
    )


# ---- stock, addresses, staff ----------------------------------------------------

def initial_inventory(m: Mart) -> DataFrame:
    cost = F.col("cost").cast("double")
    return m.product_master.select(
        "product_id",
        F.lit("MAIN").alias("location_code"),
        F.col("units_in_stock").alias("quantity_on_hand"),
        F.col("units_in_stock").alias("quantity_available"),
        F.lit(0).cast("bigint").alias("quantity_allocated"),
        F.col("reorder_level").alias("reorder_point"),
        (F.col("reorder_level") * 5).alias("max_stock_level"),
        day(m.as_of).alias("last_count_date"),
        cost.alias("average_cost"),
        cost.alias("last_cost"),
    )


def inventory_after_shipping(m: Mart) -> DataFrame:
    shipped = m.orders.filter(F.col("status") == "SHIPPED").select("order_id")
    sold = (
        m.items.join(shipped, "order_id", "left_semi")
        .groupBy(F.col("product_key").alias("product_id"))
        .agg(F.sum("quantity").alias("sold"))
    )
    gone = F.coalesce("sold", F.lit(0))
    return update_from(
        m.inventory.drop("last_received_date"),
        sold,
        "product_id",
        quantity_on_hand=F.greatest(F.col("quantity_on_hand") - gone, F.lit(0)),
        quantity_available=F.greatest(F.col("quantity_available") - gone, F.lit(0)),
        last_count_date=day(m.as_of),
    )


def customer_addresses(m: Mart) -> DataFrame:
    """Bridge rows: billing for everyone, shipping where it is another address."""
    roles = F.array(
        F.struct(F.col("billing_address_id").alias("address_id"), F.lit("BILLING").alias("kind")),
        F.when(
            F.col("shipping_address_id") != F.col("billing_address_id"),
            F.struct(
                F.col("shipping_address_id").alias("address_id"), F.lit("SHIPPING").alias("kind")
            ),
        ),
    )
    return m.customer_master.select(
        "customer_id", F.explode(F.array_compact(roles)).alias("r")
    ).select(
        "customer_id",
        "r.address_id",
        F.col("r.kind").alias("address_type"),
        F.lit(True).alias("is_default"),
    )


def managers(m: Mart) -> DataFrame:
    """Employees with their manager's number and name, by self join."""
    boss = m.employees.select(
        F.col("employee_id").alias("manager_id"),
        F.col("employee_number").alias("manager_number"),
        F.col("full_name").alias("manager_name"),
    )
    return m.employees.select("employee_id", "employee_number", "manager_id").join(
        boss, "manager_id", "left"
    )


def reporting_lines(m: Mart) -> DataFrame:
    """Chain of command of every employee, from the top down."""
    return paths(m.employees, "employee_id", "manager_id", "employee_number").withColumn(
        "depth", F.col("depth").cast("bigint")
    )


# ---- merges ----------------------------------------------------------------------

def _previous_customers(m: Mart) -> DataFrame:
    """Customer dimension before the merge: some customers not yet known, some with
    an older income, status or phone, some with an unknown income."""
    key = F.col("customer_id")
    older = (
        customer_source(m)
        .filter(F.col("registration_date") < day(date(1994, 11, 1)))
        .withColumn(
            "annual_income",
            F.when(key % 5 == 0, F.col("annual_income") - 100)
            .when(key % 6 == 1, F.lit(None))
            .otherwise(F.col("annual_income")),
        )
        .withColumn("status", F.when(key % 11 == 3, "PENDING").otherwise(F.col("status")))
        .withColumn("phone", F.when(key % 4 == 1, "000").otherwise(F.col("phone")))
    )
    return scd2.first_load(older, date(2000, 1, 1))


def merged_customers(m: Mart) -> DataFrame:
    return scd2.merge(
        _previous_customers(m),
        customer_source(m),
        "customer_id",
        ["customer_name", "email", "annual_income", "status"],
        m.as_of,
    ).select(
        "customer_id", "customer_name", "email", "phone", "annual_income", "status",
        "effective_date", "expiry_date", "is_current", "version",
    )


def merged_customers_single_pass(m: Mart) -> DataFrame:
    """The same merge under the plain rule: NULL never differs, no successor row."""
    return scd2.merge(
        _previous_customers(m),
        customer_source(m),
        "customer_id",
        ["customer_name", "email", "annual_income", "status"],
        m.as_of,
        null_safe=False,
        single_pass=True,
    ).select("customer_id", "annual_income", "status", "expiry_date", "is_current", "version")


def _versions(m: Mart, when: str | None) -> DataFrame:
    dim = merged_customers(m).select(
        "customer_id", "is_current", "effective_date", "expiry_date", "version"
    )
    found = scd2.with_version(m.orders.select("order_id", "customer_id", "order_date"), dim,
                              "customer_id", when)
    return found.groupBy("version", F.year("order_date").alias("year")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )


def orders_by_version(m: Mart) -> DataFrame:
    """Orders per dimension version that was valid on the order date."""
    return _versions(m, "order_date")


def orders_by_current_version(m: Mart) -> DataFrame:
    return _versions(m, None)


def merged_products(m: Mart) -> DataFrame:
    key = F.col("product_id")
    older = (
        product_source(m)
        .filter(F.col("supplier_name") != "Brand#7")
        .withColumn(
            "unit_price",
            F.when(key % 8 == 3, F.col("unit_price") - 1)
            .otherwise(F.col("unit_price"))
            .cast("decimal(10,2)"),
        )
        .withColumn("discontinued", (key % 12 == 5) | F.col("discontinued"))
    )
    return scd2.merge(
        scd2.first_load(older, date(2000, 1, 1)),
        product_source(m),
        "product_id",
        ["product_name", "unit_price", "cost", "discontinued"],
        m.as_of,
    ).select(
        "product_id", "product_name", "category_name",
        F.col("unit_price").cast("double").alias("unit_price"), "discontinued",
        "effective_date", "expiry_date", "is_current", "version",
    )


ALL = {
    "b01_date_dimension": date_dimension,
    "b02_holidays": holidays,
    "b03_extended_dates": extended_dates,
    "b04_calendar_check": calendar_check,
    "b05_customer_source": customer_source,
    "b06_product_source": lambda m: product_source(m)
    .withColumn("unit_price", F.col("unit_price").cast("double"))
    .withColumn("cost", F.col("cost").cast("double")),
    "b07_initial_customer_dim": initial_customer_dim,
    "b07_initial_product_dim": initial_product_dim,
    "b07_initial_rep_dim": initial_rep_dim,
    "b08_sales_reps": sales_reps,
    "b09_sales_fact": sales_fact,
    "b09_orders_by_version": orders_by_version,
    "b09_orders_by_current_version": orders_by_current_version,
    "b10_order_totals": order_totals,
    "b11_customer_totals": customer_totals,
    "b12_customer_ltv": customer_ltv,
    "b13_product_performance": product_performance,
    "b14_customer_analytics": customer_analytics,
    "b15_initial_inventory": initial_inventory,
    "b16_inventory_after_shipping": inventory_after_shipping,
    "b17_customer_addresses": customer_addresses,
    "b18_managers": managers,
    "j13_reporting_lines": reporting_lines,
    "m07_merged_customers": merged_customers,
    "m07_merged_customers_single_pass": merged_customers_single_pass,
    "m08_merged_products": merged_products,
}
