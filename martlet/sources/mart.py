"""Canonical retail tables as lazy frames over the input files.

``Mart`` maps the order/customer/product/supplier files onto the warehouse model.
Every property is a plan, nothing is computed or collected here. Only nation,
region and the calendar have a size that does not grow with the data; no join in
this file carries a broadcast hint, so Spark broadcasts a side only when its
measured size is below the threshold, and otherwise sort-merges with skew splits.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet import schemas
from martlet.functions.dates import date_key, day
from martlet.functions.money import as_decimal, cents
from martlet.plans.calendar import covering
from martlet.sources.inline import inline_rows

AS_OF = date(2001, 8, 1)


@dataclass(frozen=True)
class Span:
    """A closed range of order dates."""

    start: date
    end: date

    def __post_init__(self):
        if self.start > self.end:
            raise ValueError("start date is after end date")

    def holds(self, column: str = "order_date") -> Column:
        return F.col(column).between(day(self.start), day(self.end))


def line_totals() -> list[Column]:
    """Aggregates of priced lines into the measures every report starts from."""
    return [
        F.sum("quantity").alias("units"),
        F.sum("line_c").alias("revenue_c"),
        F.sum("cost_c").alias("cost_c"),
        F.sum("profit_c").alias("profit_c"),
        F.count(F.lit(1)).alias("n_lines"),
    ]


def header() -> list[Column]:
    """Customer and date of an order's rows. They are the same on all of them, so a
    minimum picks them; unlike grouping keys it costs nothing when not used."""
    return [F.min("customer_id").alias("customer_id"), F.min("order_date").alias("order_date")]


class Mart:
    def __init__(self, spark: SparkSession, path: str, as_of: date = AS_OF):
        self.spark, self.path, self.as_of = spark, path.rstrip("/"), as_of
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self.spark.read.schema(schemas.INPUT[name])
            self._tables[name] = reader.parquet(f"{self.path}/{name}.parquet")
        return self._tables[name]

    # ---- calendar -----------------------------------------------------------

    @cached_property
    def date_dim(self) -> DataFrame:
        """Every day of the years the orders touch, and at least of 1995 to 2029."""
        return covering(
            self.spark, self.orders, "order_date", date(1995, 1, 1), date(2029, 12, 31)
        )

    def row_count(self, name: str) -> Column:
        """Number of rows of an input table, as a scalar subquery."""
        return self.table(name).agg(F.count(F.lit(1))).scalar()

    @cached_property
    def places(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey", F.col("n_name").alias("nation_name"), F.col("r_name").alias("region_name")
        )

    # ---- order headers and lines ---------------------------------------------

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "cast(o_orderdate AS date) AS order_date",
            "CASE o_orderstatus WHEN 'F' THEN 'SHIPPED' WHEN 'P' THEN 'PROCESSING' "
            "ELSE 'PENDING' END AS status",
            "10 + o_orderkey % 91 AS freight",
        )

    @cached_property
    def items(self) -> DataFrame:
        """Order lines without prices, in whole units and hundredths."""
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_partkey AS product_key",
            "l_suppkey AS sales_rep_key",
            "cast(l_linenumber AS bigint) AS line_number",
            "cast(l_quantity AS bigint) AS quantity",
            "cast(round(l_discount * 100) AS bigint) AS discount_pct",
            "cast(round(l_tax * 100) AS bigint) AS tax_pct",
            "cast(l_shipdate AS date) AS shipped_date",
        )

    @cached_property
    def prices(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_key"), cents("p_retailprice").alias("price_c")
        )

    def priced(self, items: DataFrame, products: DataFrame | None = None) -> DataFrame:
        """Join unit prices and derive line total, unit cost and profit in cents.

        ``products`` may bring attributes along with ``price_c``, so that a report
        by product needs no second join.
        """
        line = "(quantity * price_c * (100 - discount_pct) + 50) div 100"
        unit_cost = "(price_c * 70 + 50) div 100"
        return items.join(self.prices if products is None else products, "product_key").selectExpr(
            "*",
            f"{line} AS line_c",
            f"{unit_cost} AS unit_cost_c",
            f"quantity * ({unit_cost}) AS cost_c",
            f"{line} - quantity * ({unit_cost}) AS profit_c",
        )

    def orders_in(self, span: Span | None) -> DataFrame:
        return self.orders if span is None else self.orders.filter(span.holds())

    def items_in(self, span: Span | None) -> DataFrame:
        """Lines of the span's orders; the others are gone before prices are joined."""
        if span is None:
            return self.items
        return self.items.join(self.orders_in(span).select("order_id"), "order_id", "left_semi")

    @cached_property
    def lines(self) -> DataFrame:
        return self.priced(self.items)

    def lines_with(self, attributes: list[str], span: Span | None = None) -> DataFrame:
        """Priced lines with product attributes, by the one join that brings prices."""
        products = self.products.select("product_key", "price_c", *attributes)
        return self.priced(self.items_in(span), products)

    def placed(self, span: Span | None = None) -> DataFrame:
        """Unpriced lines with their order's header."""
        return self.items.join(self.orders_in(span), "order_id")

    def sales(
        self, span: Span | None = None, dim: DataFrame | None = None, on: str | None = None
    ) -> DataFrame:
        """Priced lines with their order's header, and with ``dim`` joined on ``on``.

        The order join comes last over all orders: its result lies partitioned by
        order, and what is added up per order next needs no further shuffle. With a
        span it comes first, so that the lines outside are gone before prices.
        """
        if span is not None:
            rows = self.priced(self.placed(span))
            return rows if dim is None else rows.join(dim, on)
        rows = self.lines if dim is None else self.lines.join(dim, on)
        return rows.join(self.orders, "order_id")

    def order_sales(self, span: Span | None = None) -> DataFrame:
        """One row per order that has lines: measures added up, header attached.

        Summing per order first makes every later ``count(distinct order)`` a plain
        count, and turns a hot customer or day into map-side sums. Lines of an order
        mostly lie together, so the sums shrink the data before it is shuffled.
        """
        if span is not None:
            return self.sales(span).groupBy("order_id").agg(*header(), *line_totals())
        per_order = self.lines.groupBy("order_id").agg(*line_totals())
        return per_order.join(self.orders.select("order_id", "customer_id", "order_date"), "order_id")

    def rep_sales(self, span: Span | None = None) -> DataFrame:
        """One row per order and sales rep: measures added up, header attached."""
        return self.sales(span).groupBy("order_id", "sales_rep_key").agg(*header(), *line_totals())

    @cached_property
    def sales_fact(self) -> DataFrame:
        """The stored fact: one row per order line, decimals as declared."""
        return self.sales().select(
            "order_id",
            "line_number",
            date_key("order_date").alias("order_date_key"),
            F.col("customer_id").alias("customer_key"),
            "product_key",
            "sales_rep_key",
            "quantity",
            as_decimal("price_c", 10).alias("unit_price"),
            as_decimal("discount_pct", 5).alias("discount"),
            as_decimal("line_c").alias("line_total"),
            as_decimal("unit_cost_c", 10).alias("cost"),
            as_decimal("profit_c").alias("profit"),
            "order_date",
            "shipped_date",
            "status",
        )

    # ---- dimensions ------------------------------------------------------------

    @cached_property
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        business = key % 10 < 3
        return self.table("customer").join(
            self.places, F.col("c_nationkey") == F.col("n_nationkey")
        ).select(
            key.alias("customer_id"),
            F.concat(F.lit("C"), F.lpad(key.cast("string"), 8, "0")).alias("customer_number"),
            F.col("c_name").alias("customer_name"),
            F.when(business, "BUSINESS").otherwise("INDIVIDUAL").alias("customer_type"),
            F.col("c_mktsegment").alias("segment_name"),
            F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")).alias("email"),
            cents("c_acctbal").alias("annual_income"),
            F.date_add(F.lit("1950-01-01").cast("date"), (key * 37 % 18000).cast("int")).alias(
                "birth_date"
            ),
            F.date_add(F.lit("1994-01-01").cast("date"), (key % 365).cast("int")).alias(
                "registration_date"
            ),
            F.when(key % 13 == 0, "INACTIVE").otherwise("ACTIVE").alias("status"),
            F.col("nation_name").alias("billing_city"),
            F.col("region_name").alias("billing_country"),
            "n_nationkey",
        )

    @cached_property
    def customer_dim(self) -> DataFrame:
        return self.customers.withColumn("customer_key", F.col("customer_id"))

    @cached_property
    def products(self) -> DataFrame:
        size = F.col("p_size")
        price = cents("p_retailprice")
        return self.table("part").select(
            F.col("p_partkey").alias("product_key"),
            F.col("p_partkey").alias("product_id"),
            F.concat(F.lit("P"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias(
                "product_number"
            ),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category_name"),
            F.col("p_brand").alias("supplier_name"),
            F.when(size <= 10, "COMPACT").when(size <= 30, "STANDARD").otherwise("LARGE").alias(
                "product_line"
            ),
            price.alias("price_c"),
            F.expr("(cast(round(p_retailprice * 100) as bigint) * 70 + 50) div 100").alias(
                "unit_cost_c"
            ),
            (F.col("p_partkey") % 10 == 0).alias("discontinued"),
        )

    @cached_property
    def reps(self) -> DataFrame:
        return self.table("supplier").join(
            self.places, F.col("s_nationkey") == F.col("n_nationkey")
        ).select(
            F.col("s_suppkey").alias("sales_rep_key"),
            F.col("s_name").alias("sales_rep_name"),
            F.col("nation_name").alias("territory_name"),
            F.col("region_name").alias("region"),
            F.col("nation_name").alias("country"),
            F.when(F.col("s_suppkey") % 10 == 0, 8).otherwise(5).alias("commission_pct"),
        )

    # ---- master data behind the dimensions --------------------------------------

    @cached_property
    def segments(self) -> DataFrame:
        return inline_rows(
            self.spark,
            list(schemas.MARKETS),
            "segment_id bigint, segment_name string, discount_rate decimal(5,4)",
        )

    @cached_property
    def categories(self) -> DataFrame:
        rows = list(enumerate(schemas.CATEGORIES, start=1))
        return inline_rows(self.spark, rows, "category_id bigint, category_name string")

    @cached_property
    def suppliers(self) -> DataFrame:
        """Product suppliers: one per brand."""
        return (
            self.table("part")
            .select(F.col("p_brand").alias("supplier_name"))
            .distinct()
            .select(
                F.split_part("supplier_name", F.lit("#"), F.lit(2)).cast("bigint").alias(
                    "supplier_id"
                ),
                "supplier_name",
                F.concat(F.lit("Land of "), "supplier_name").alias("supplier_country"),
            )
        )

    @cached_property
    def addresses(self) -> DataFrame:
        return self.places.select(
            F.col("n_nationkey").cast("bigint").alias("address_id"),
            F.col("nation_name").alias("city"),
            F.concat(F.col("region_name"), F.lit("-"), F.col("nation_name")).alias(
                "state_province"
            ),
            F.col("region_name").alias("country"),
        )

    @cached_property
    def customer_master(self) -> DataFrame:
        """Customers as the ETL sees them: nullable parts, foreign keys, no names joined."""
        key = F.col("c_custkey")
        text = key.cast("string")
        business = key % 10 < 3
        market = F.create_map(
            *[F.lit(x) for i, name, _ in schemas.MARKETS for x in (name, i)]
        )
        return self.table("customer").select(
            key.alias("customer_id"),
            F.concat(F.lit("C"), F.lpad(text, 8, "0")).alias("customer_number"),
            F.when(business, "BUSINESS").otherwise("INDIVIDUAL").alias("customer_type"),
            F.when(business, F.concat(F.lit("Company "), text)).alias("company_name"),
            F.when(~business, F.concat(F.lit("First"), text)).alias("first_name"),
            F.when(~business & (key % 50 != 7), F.concat(F.lit("Last"), text)).alias("last_name"),
            F.concat(F.lit("user"), text, F.lit("@example.com")).alias("email"),
            F.concat(F.lit("555"), F.lpad((key % 10000000).cast("string"), 7, "0")).alias("phone"),
            F.when(
                key % 25 != 8,
                F.date_add(F.lit("1930-01-01").cast("date"), (key * 37 % 20000).cast("int")),
            ).alias("birth_date"),
            F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
            F.when(key % 20 != 9, cents("c_acctbal")).alias("annual_income"),
            F.when(key % 40 != 11, market[F.col("c_mktsegment")].cast("bigint")).alias(
                "segment_id"
            ),
            F.col("c_nationkey").cast("bigint").alias("billing_address_id"),
            ((F.col("c_nationkey") + key % 3) % 25).cast("bigint").alias("shipping_address_id"),
            F.date_add(F.lit("1994-01-01").cast("date"), (key % 365).cast("int")).alias(
                "registration_date"
            ),
            F.when(key % 13 == 0, "INACTIVE").otherwise("ACTIVE").alias("status"),
        )

    @cached_property
    def product_master(self) -> DataFrame:
        """Products with foreign keys; every thirtieth has no valid category."""
        key = F.col("product_id")
        category = F.create_map(
            *[F.lit(x) for i, name in enumerate(schemas.CATEGORIES, 1) for x in (name, i)]
        )
        return self.products.select(
            "product_id",
            "product_number",
            "product_name",
            F.when(key % 30 == 0, schemas.NO_CATEGORY)
            .otherwise(category[F.col("category_name")])
            .cast("bigint")
            .alias("category_id"),
            F.split_part("supplier_name", F.lit("#"), F.lit(2)).cast("bigint").alias("supplier_id"),
            as_decimal("price_c", 10).alias("unit_price"),
            as_decimal("unit_cost_c", 10).alias("cost"),
            "discontinued",
            (F.lit(100) + key % 400).alias("units_in_stock"),
            (F.lit(10) + key % 40).alias("reorder_level"),
        )

    # ---- stock and staff -------------------------------------------------------

    @cached_property
    def inventory(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("product_id"),
            F.lit("MAIN").alias("location_code"),
            (F.lit(100) + key % 400).alias("quantity_on_hand"),
            (F.lit(100) + key % 400).alias("quantity_available"),
            F.lit(0).cast("bigint").alias("quantity_allocated"),
            (F.lit(10) + key % 40).alias("reorder_point"),
            F.lit(None).cast("date").alias("last_received_date"),
        )

    @cached_property
    def positions(self) -> DataFrame:
        return inline_rows(
            self.spark,
            list(schemas.POSITIONS),
            "position_id bigint, position_code string, department_code string, "
            "min_salary bigint, max_salary bigint",
        )

    @cached_property
    def employees(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            key.alias("employee_id"),
            F.concat(F.lit("EMP"), F.lpad(key.cast("string"), 6, "0")).alias("employee_number"),
            F.col("s_name").alias("full_name"),
            (key % 4 + 1).alias("position_id"),
            F.date_add(F.lit("1990-01-01").cast("date"), (key * 53 % 4000).cast("int")).alias(
                "hire_date"
            ),
            F.when(key % 11 == 5, "TERMINATED").otherwise("ACTIVE").alias("status"),
            F.when(key > 0, F.expr("s_suppkey div 10")).alias("manager_id"),
            F.col("s_nationkey").alias("territory_id"),
        )
