"""Synthetic orders, items, facts and address assignments.

Every draw is a hash of the row's keys, so the output is the same on every run and
every layout. What is drawn is decided before rows are multiplied: no job expands a
cross product to filter it afterwards.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import date_key, day
from martlet.functions.draws import draw, draw_index, draw_int
from martlet.functions.money import half_up
from martlet.operators.keys import number_rows, padded
from martlet.plans.views import money
from martlet.sources.mart import Mart

ORDERS_PER_CUSTOMER = 5
# Products offered to each synthetic order. A purchase chance applies to each, so
# the number of items grows with the orders, not with orders times products.
ASSORTMENT = 15


def copies_of(customers: DataFrame, n: int, name: str) -> DataFrame:
    """Every customer ``n`` times, numbered from 1 in the column ``name``.

    Customers are a small file that few tasks read, and the draws that follow cost far
    more than reading, so the customers are dealt to all tasks before.
    """
    dealt = customers.repartition("customer_id")
    return dealt.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(n))))


def synth_orders(m: Mart, per_customer: int = ORDERS_PER_CUSTOMER) -> DataFrame:
    """Orders of the past year for every customer, each with a drawn sales rep."""
    reps = number_rows(m.reps.select("sales_rep_key"), ["sales_rep_key"], 0, "rep_no")
    keys = ("customer_id", "copy")
    now = day(m.as_of)
    customers = m.customers.select("customer_id", "customer_name", "billing_city")
    drawn = (
        copies_of(customers, per_customer, "copy")
        .withColumn("order_date", F.date_sub(now, draw_int("age", 1, 365, *keys).cast("int")))
        .withColumn("rep_no", draw_index("rep", m.row_count("supplier"), *keys))
    )
    shipped = F.when(
        draw_int("ships", 1, 10, *keys) <= 8,
        F.date_add("order_date", draw_int("transit", 1, 14, *keys).cast("int")),
    )
    carrier = F.element_at(
        F.array(F.lit("FedEx"), F.lit("UPS"), F.lit("DHL")),
        draw_int("carrier", 1, 3, *keys).cast("int"),
    )
    status = (
        F.when(F.col("shipped_date").isNotNull(), "SHIPPED")
        .when(F.col("order_date") <= F.date_sub(now, 7), "PROCESSING")
        .otherwise("PENDING")
    )
    rows = drawn.join(reps, "rep_no").select(
        "customer_id",
        "copy",
        F.col("sales_rep_key").alias("sales_rep_id"),
        "order_date",
        F.date_add("order_date", draw_int("promise", 7, 21, *keys).cast("int")).alias(
            "required_date"
        ),
        shipped.alias("shipped_date"),
        carrier.alias("ship_via"),
        draw_int("freight", 10, 100, *keys).alias("freight"),
        F.col("customer_name").alias("ship_name"),
        F.col("billing_city").alias("ship_city"),
    ).withColumn("status", status)
    numbered = number_rows(rows, ["customer_id", "copy"], 1, "order_id")
    return numbered.select(
        "order_id",
        padded("ORD", "order_id", 6).alias("order_number"),
        *[c for c in rows.columns if c != "copy"],
    )


def _by_segment(values: dict[int, Column], other: Column) -> Column:
    out = F.when(F.lit(False), other)
    for segment, value in values.items():
        out = out.when(F.col("segment_id") == segment, value)
    return out.otherwise(other)


def synth_order_items(m: Mart, assortment: int = ASSORTMENT) -> DataFrame:
    """Items for every stored order: the segment sets quantity, discount and how
    likely each offered product is bought. Every order is offered ``assortment``
    products, drawn from the whole catalogue."""
    key = ("order_id", "slot")
    quantity = _by_segment(
        {
            1: draw_int("qty", 20, 100, *key),
            2: draw_int("qty", 5, 50, *key),
            3: draw_int("qty", 2, 20, *key),
        },
        draw_int("qty", 1, 5, *key),
    )
    base_pct = F.round(F.col("discount_rate") * 100).cast("bigint")
    discount_pct = _by_segment(
        {1: base_pct + draw_int("disc", 0, 5, *key), 2: base_pct + draw_int("disc", 0, 3, *key)},
        base_pct,
    )
    chance = _by_segment({1: F.lit(40), 2: F.lit(25), 3: F.lit(15)}, F.lit(8))
    offered = (
        m.orders.select("order_id", "customer_id")
        .join(m.customer_master.select("customer_id", "segment_id"), "customer_id")
        .join(m.segments.select("segment_id", "discount_rate"), "segment_id")
        .withColumn("slot", F.explode(F.sequence(F.lit(1), F.lit(assortment))))
        .filter(draw_int("buys", 1, 100, *key) <= chance)
        .withColumn("product_no", draw_index("product", m.row_count("part"), *key))
    )
    products = number_rows(m.prices, ["product_key"], 0, "product_no")
    rows = offered.join(products, "product_no").select(
        "order_id",
        F.col("slot").cast("bigint").alias("slot"),
        F.col("product_key").alias("product_id"),
        quantity.alias("quantity"),
        "price_c",
        discount_pct.alias("pct"),
    )
    line = half_up(F.col("quantity") * F.col("price_c") * (F.lit(100) - F.col("pct")), F.lit(100))
    return rows.select(
        "order_id", "slot", "product_id", "quantity",
        money("price_c", "unit_price"),
        (F.col("pct") / F.lit(100.0)).alias("discount"),
        (line / F.lit(100.0)).alias("line_total"),
    )


def synth_facts(m: Mart, year: int = 2024, draws: int = 3) -> DataFrame:
    """Sample sales of one year: for each customer some drawn (product, day) pairs."""
    key = ("customer_id", "pick")
    first = date(year, 1, 1)
    length = (date(year + 1, 1, 1) - first).days
    products = number_rows(m.prices, ["product_key"], 0, "product_no")
    picked = (
        copies_of(m.customers.select("customer_id"), draws, "pick")
        .withColumn("product_no", draw_index("fact_product", m.row_count("part"), *key))
        .withColumn(
            "order_date",
            F.date_add(day(first), draw_int("fact_day", 0, length - 1, *key).cast("int")),
        )
    )
    quantity = draw_int("fact_qty", 1, 10, *key)
    rows = picked.join(products, "product_no").select(
        "customer_id", "pick", F.col("product_key").alias("product_id"), "order_date",
        quantity.alias("quantity"), "price_c",
        half_up(F.col("price_c") * draw_int("fact_disc", 0, 2000, *key), F.lit(10000)).alias(
            "discount_c"
        ),
    )
    numbered = number_rows(rows, ["customer_id", "product_id", "pick"], 1, "n")
    return (
        numbered.withColumn("line_c", F.col("quantity") * F.col("price_c") - F.col("discount_c"))
        .withColumn("cost_c", F.col("quantity") * half_up(F.col("price_c") * 70, F.lit(100)))
        .withColumn("profit_c", F.col("line_c") - F.col("cost_c"))
        .select(
            padded("ORD-", "n", 8).alias("order_number"),
            date_key("order_date").alias("date_key"),
            "customer_id",
            "product_id",
            F.lit(1).alias("sales_rep_id"),
            F.lit(1).alias("territory_id"),
            F.col("quantity").alias("quantity_ordered"),
            money("price_c", "unit_price"),
            money("discount_c", "discount_amount"),
            money("line_c", "line_total"),
            money("cost_c", "cost_amount"),
            money("profit_c", "profit_amount"),
        )
    )


def assign_addresses(customers: DataFrame, addresses: DataFrame) -> DataFrame:
    """Give each customer one to three addresses, none twice, until they run out.

    Both sides are laid out on one line: customer k takes the addresses numbered
    from the sum of all counts before it. The counts are at most three, so laying
    out customers means numbering (customer, slot) pairs; one equi-join on that
    number then assigns everything.
    """
    wanted = customers.select(
        "customer_id",
        F.explode(
            F.sequence(F.lit(1).cast("bigint"), F.lit(1) + F.col("customer_id") % 3)
        ).alias("slot"),
    )
    slots = number_rows(wanted, ["customer_id", "slot"], 0, "address_no")
    stock = number_rows(addresses, ["address_id"], 0, "address_no")
    first = F.col("address_no") == 0
    return slots.join(stock, "address_no").select(
        "customer_id",
        "address_id",
        "address_type",
        F.substring("state_province", 1, 50).alias("state_province"),
        F.substring("country", 1, 30).alias("country"),
        (first | (draw("default", "address_id") < 0.3)).alias("is_default"),
    )


def address_pool(m: Mart) -> DataFrame:
    """An address per order: where it was sent."""
    return (
        m.orders.select(F.col("order_id").alias("address_id"), "customer_id")
        .join(m.customers.select("customer_id", "billing_city", "billing_country"), "customer_id")
        .select(
            "address_id",
            F.when(F.col("address_id") % 2 == 0, "BILLING").otherwise("SHIPPING").alias(
                "address_type"
            ),
            F.col("billing_city").alias("state_province"),
            F.col("billing_country").alias("country"),
        )
    )


def address_assignment(m: Mart) -> DataFrame:
    return assign_addresses(m.customers, address_pool(m))


def draws(m: Mart) -> DataFrame:
    """The deterministic draw itself, for every customer."""
    return m.customers.select(
        "customer_id",
        F.round(draw("demo", "customer_id"), 9).alias("draw"),
        draw_int("demo_int", 1, 6, "customer_id").alias("die"),
    )


ALL = {
    "g00_draws": draws,
    "g01_synth_orders": synth_orders,
    "g02_synth_order_items": synth_order_items,
    "g03_synth_facts": synth_facts,
    "g04_address_assignment": address_assignment,
}
