"""Data-quality checks over customers, products, stock and orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet import schemas
from martlet.functions.dates import day
from martlet.functions.money import half_up
from martlet.functions.text import EMAIL_PATTERN, is_email, to_type
from martlet.operators import scd2
from martlet.operators.checks import (
    duplicates, expect, filled_percent, issue, merge_issues, missing_columns,
)
from martlet.operators.lookup import without_match
from martlet.sources import raw
from martlet.sources.mart import Mart


def customers(m: Mart) -> DataFrame:
    """Raw customers with their dates typed, as they arrive."""
    return raw.customers(m).select(
        "customer_number", "customer_type", "email", "first_name", "last_name",
        to_type("birth_date", "date").alias("birth_date"),
        to_type("registration_date", "date").alias("registration_date"),
    )


def products(m: Mart) -> DataFrame:
    return raw.products(m).select(
        "product_number", "product_name",
        to_type("unit_price", "decimal(10,2)").alias("unit_price"),
        to_type("cost", "decimal(10,2)").alias("cost"),
    )


def stock(m: Mart) -> DataFrame:
    """Inventory in which every sixtieth product has gone negative."""
    return m.inventory.withColumn(
        "quantity_on_hand",
        F.when(F.col("product_id") % 60 == 0, F.lit(-3)).otherwise(F.col("quantity_on_hand")),
    )


# ---- issues ------------------------------------------------------------------------

def duplicate_emails(m: Mart) -> DataFrame:
    return issue(
        duplicates(customers(m), "email"), "CUSTOMERS", None, "DUPLICATE",
        "Duplicate email addresses found", "HIGH", "email",
    )


def products_without_category(m: Mart) -> DataFrame:
    bad = without_match(m.product_master, m.categories.select("category_id"), "category_id")
    return issue(
        bad, "PRODUCTS", "CATEGORY_ID", "MISSING_VALUE", "Products without valid category",
        "MEDIUM", "product_id",
    )


def negative_stock(m: Mart) -> DataFrame:
    return issue(
        stock(m).filter("quantity_on_hand < 0"), "INVENTORY", "QUANTITY_ON_HAND", "INVALID_VALUE",
        "Negative inventory quantities", "HIGH", "product_id",
    )


def orders_without_items(m: Mart) -> DataFrame:
    # One row per order before the shuffle: an order of any size stays one row.
    bad = without_match(m.orders, m.items.select("order_id").distinct(), "order_id")
    return issue(
        bad, "ORDERS", None, "MISSING_ITEMS", "Orders without order items", "HIGH", "order_id"
    )


CHECKS = (duplicate_emails, products_without_category, negative_stock, orders_without_items)


def validate(m: Mart, known: DataFrame) -> DataFrame:
    found = reduce(DataFrame.unionByName, [check(m) for check in CHECKS])
    return merge_issues(known, found)


def known_issues(m: Mart) -> DataFrame:
    """What an earlier run left: some stock issues still open, some resolved."""
    key = F.col("record_identifier").cast("bigint")
    return negative_stock(m).filter(key % 120 == 0).withColumn(
        "status", F.when(key % 240 == 0, "RESOLVED").otherwise("OPEN")
    )


def validation_run(m: Mart) -> DataFrame:
    """Issue table after the run."""
    return validate(m, known_issues(m))


def validation_summary(m: Mart) -> DataFrame:
    """Open issues after two runs in a row; the second adds none."""
    twice = validate(m, validate(m, known_issues(m)))
    return twice.filter(F.col("status") == "OPEN").groupBy("table_name", "issue_type").agg(
        F.count(F.lit(1)).alias("issues_found")
    )


# ---- counts and ratios ---------------------------------------------------------------

def orphans(m: Mart) -> DataFrame:
    """Rows that refer to nothing: products to suppliers and categories, items to orders."""
    products_ = m.product_master
    pairs = (
        ("products_without_supplier", without_match(products_, m.suppliers.select("supplier_id"), "supplier_id")),
        ("products_without_category", without_match(products_, m.categories.select("category_id"), "category_id")),
        ("items_without_order", without_match(m.items, m.orders.select("order_id"), "order_id")),
    )
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("check_name"), "n_rows")
        for name, df in pairs
    ]
    return reduce(DataFrame.unionByName, counts)


# Lowest accepted share of filled rows, in percent.
CUSTOMER_FILL = {"customer_number": 100, "email": 95, "first_name": 90, "last_name": 90}
PRODUCT_FILL = {"product_number": 100, "product_name": 100, "unit_price": 95}


def _completeness(df: DataFrame, table: str, floors: dict[str, int]) -> DataFrame:
    shares = df.agg(*[filled_percent(c).alias(c) for c in floors])
    return shares.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(table).alias("table_name"),
                        F.lit(c).alias("column_name"),
                        F.col(c).alias("filled_percent"),
                        (F.col(c) >= floor).alias("passed"),
                    )
                    for c, floor in floors.items()
                ]
            )
        )
    )


def completeness(m: Mart) -> DataFrame:
    return _completeness(customers(m), "CUSTOMERS", CUSTOMER_FILL).unionByName(
        _completeness(products(m), "PRODUCTS", PRODUCT_FILL)
    )


def duplicate_numbers(m: Mart) -> DataFrame:
    """Customer and product numbers used more than once."""
    return duplicates(customers(m), "customer_number").select(
        F.lit("CUSTOMERS").alias("table_name"), F.col("customer_number").alias("number"), "n"
    ).unionByName(
        duplicates(products(m), "product_number").select(
            F.lit("PRODUCTS").alias("table_name"), F.col("product_number").alias("number"), "n"
        )
    )


def price_checks(m: Mart) -> DataFrame:
    return products(m).agg(
        F.count_if((F.col("unit_price") <= 0) | (F.col("cost") <= 0)).alias("invalid_prices"),
        F.count_if(F.col("unit_price") < 0).alias("negative_prices"),
    )


def email_checks(m: Mart) -> DataFrame:
    e = F.col("email")
    return customers(m).agg(
        F.count_if(e.isNotNull() & ~is_email("email")).alias("invalid_emails"),
        F.count_if(e.isNotNull() & ~e.like("%@%")).alias("emails_without_at"),
    )


def date_checks(m: Mart) -> DataFrame:
    now, born = day(m.as_of), F.col("birth_date")
    return customers(m).agg(
        F.count_if(
            (born > now) | (born < F.lit("1900-01-01").cast("date"))
            | (F.col("registration_date") > now)
        ).alias("invalid_dates"),
        F.count_if(born.isNull()).alias("unreadable_birth_dates"),
    )


def freshness(m: Mart, days: int = 30) -> DataFrame:
    """Share of all customers that registered in the last days before the report date."""
    recent = F.count_if(F.col("registration_date") >= F.date_sub(day(m.as_of), days))
    return customers(m).agg(
        F.count(F.lit(1)).alias("total_customers"),
        recent.alias("recent_customers"),
        (half_up(recent * 10000, F.count(F.lit(1))) / F.lit(100.0)).alias("recent_percent"),
    )


# Expected number of rows, lowest and highest, by input table.
VOLUMES = {
    "customer": (1000, 100000), "part": (100, 10000), "supplier": (10, 1000),
    "nation": (5, 100), "orders": (100, None), "lineitem": (100, None),
}


def _counts(m: Mart, names) -> DataFrame:
    counts = [
        m.table(n).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(n).alias("table_name"), "n_rows"
        )
        for n in names
    ]
    return reduce(DataFrame.unionByName, counts)


def volumes(m: Mart) -> DataFrame:
    low = F.create_map(*[F.lit(x) for n, (lo, _) in VOLUMES.items() for x in (n, lo)])
    high = F.create_map(
        *[F.lit(x) for n, (_, hi) in VOLUMES.items() for x in (n, hi if hi else 2**62)]
    )
    name = F.col("table_name")
    return _counts(m, VOLUMES).withColumn(
        "in_range", F.col("n_rows").between(low[name], high[name])
    )


def load_status(m: Mart) -> DataFrame:
    """Every input table with its count and whether it is loaded or empty."""
    return _counts(m, schemas.INPUT).withColumn(
        "load_status", F.when(F.col("n_rows") > 0, "LOADED").otherwise("EMPTY")
    )


def conformance(m: Mart) -> DataFrame:
    """Required columns of the canonical tables, with the rows that back them."""
    frames = {
        "sales_fact": m.sales_fact,
        "customer_dim": scd2.first_load(m.customer_dim, m.as_of),
        "product_dim": scd2.first_load(m.products, m.as_of),
        "date_dim": m.date_dim,
        "orders": m.orders,
        "order_items": m.sales_fact.withColumnRenamed("product_key", "product_id"),
    }
    rows = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            F.lit(len(missing_columns(df, schemas.REQUIRED[name]))).alias("n_missing"),
            "n_rows",
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def calendar_coverage(m: Mart) -> DataFrame:
    """Calendar days in the span of the orders, and order days without one."""
    ordered = m.orders.select(F.col("order_date").alias("date_actual")).distinct()
    uncovered = without_match(ordered, m.date_dim.select("date_actual"), "date_actual")
    span = ordered.agg(F.min("date_actual").alias("lo"), F.max("date_actual").alias("hi"))
    inside = m.date_dim.join(span, F.col("date_actual").between(F.col("lo"), F.col("hi")))
    return inside.agg(F.count(F.lit(1)).alias("calendar_days")).withColumn(
        "uncovered_days", uncovered.agg(F.count(F.lit(1))).scalar()
    )


def rule_checks(m: Mart) -> DataFrame:
    """Rows that keep and that break each row rule of the load."""
    by_customer = customers(m).select(
        F.inline(
            F.array(
                F.struct(F.lit("email format").alias("rule_name"), is_email("email").alias("ok")),
                F.struct(
                    F.lit("customer type").alias("rule_name"),
                    F.col("customer_type").isin("INDIVIDUAL", "BUSINESS").alias("ok"),
                ),
            )
        )
    )
    by_product = products(m).select(
        F.lit("price").alias("rule_name"),
        F.coalesce(F.col("unit_price") >= 0, F.lit(False)).alias("ok"),
    )
    return by_customer.unionByName(by_product).groupBy("rule_name", "ok").agg(
        F.count(F.lit(1)).alias("n")
    )


def expectations(m: Mart) -> DataFrame:
    return expect(
        customers(m),
        "CUSTOMERS",
        [
            ("customer_number", "exists"), ("loyalty_level", "exists"),
            ("customer_number", "not_null"), ("customer_number", "unique"),
            ("email", "matches", EMAIL_PATTERN),
            ("customer_type", "one_of", ("INDIVIDUAL", "BUSINESS")),
        ],
    ).unionByName(
        expect(
            products(m),
            "PRODUCTS",
            [
                ("product_number", "unique"), ("product_name", "not_null"),
                ("unit_price", "at_least", 0), ("cost", "at_most", 700),
            ],
        )
    )


ALL = {
    "c01_duplicate_emails": duplicate_emails,
    "c02_products_without_category": products_without_category,
    "c03_negative_stock": negative_stock,
    "c04_orders_without_items": orders_without_items,
    "c05_validation_run": validation_run,
    "c05_validation_summary": validation_summary,
    "c06_orphans": orphans,
    "c07_completeness": completeness,
    "c08_duplicate_numbers": duplicate_numbers,
    "c09_price_checks": price_checks,
    "c10_email_checks": email_checks,
    "c11_date_checks": date_checks,
    "c12_freshness": freshness,
    "c13_volumes": volumes,
    "c14_load_status": load_status,
    "c15_conformance": conformance,
    "c16_calendar_coverage": calendar_coverage,
    "c17_rule_checks": rule_checks,
    "c18_expectations": expectations,
}
