"""Business processes as set-based jobs over a frame of requests.

Each takes all requests of a batch at once. A request that cannot be carried out
comes back with a message instead of stopping the batch.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import day
from martlet.functions.draws import draw_int
from martlet.functions.money import amount, cents, half_up
from martlet.operators import ledger
from martlet.operators.keys import number_rows, padded
from martlet.operators.mutate import update_from
from martlet.plans.builds import sales_reps
from martlet.plans.views import money
from martlet.sources.mart import Mart, Span

# ---- orders ---------------------------------------------------------------------

TAX_PERCENT = 8
FIRST_ORDER_NUMBER = 1000
FIRST_CUSTOMER_NUMBER = 100000


def order_requests(m: Mart) -> DataFrame:
    """A request per stored order: customer, rep, address and an array of items.

    Some requests lack a customer, some have no items, some items no discount.
    """
    key, products = F.col("o_orderkey"), F.col("n_products")

    def item(i: Column) -> Column:
        return F.struct(
            ((key * 7 + i * 13) % products).cast("bigint").alias("product_id"),
            (F.lit(1) + (key + i) % 9).cast("bigint").alias("quantity"),
            ((F.lit(500) + (key * 11 + i * 101) % 9000) / 100).cast("decimal(10,2)").alias(
                "unit_price"
            ),
            F.when(i % 3 != 0, ((key + i) % 20 / 100).cast("decimal(5,4)")).alias("discount"),
        )

    count = F.when(key % 50 == 0, 0).otherwise(1 + key % 4)
    items = F.filter(
        F.transform(F.sequence(F.lit(1).cast("bigint"), F.lit(4).cast("bigint")),
                    lambda i: F.when(i <= count, item(i))),
        lambda x: x.isNotNull(),
    )
    return m.table("orders").withColumn("n_products", m.row_count("part")).select(
        key.alias("request_id"),
        F.when(key % 97 != 0, F.col("o_custkey")).alias("customer_id"),
        (key % 10).alias("sales_rep_id"),
        F.concat(F.lit("Street "), key.cast("string")).alias("ship_address"),
        items.alias("items"),
    )


def _problem() -> Column:
    bad_item = F.exists(
        "items", lambda i: i.product_id.isNull() | i.quantity.isNull() | i.unit_price.isNull()
    )
    return (
        F.when(F.col("customer_id").isNull(), "Error processing order: customer is missing")
        .when(F.col("items").isNull(), "Error processing order: items are missing")
        .when(bad_item, "Error processing order: item is incomplete")
    )


def order_lines(requests: DataFrame) -> DataFrame:
    """One row per item of every acceptable request, priced in 1/100 cents.

    Discounts have four places, so a line needs six: cents times 10^4.
    """
    rate = F.coalesce(F.col("item.discount"), F.lit(0).cast("decimal(5,4)"))
    return (
        requests.filter(_problem().isNull())
        .select("request_id", F.posexplode("items").alias("pos", "item"))
        .select(
            "request_id",
            (F.col("pos") + 1).cast("bigint").alias("line_number"),
            "item.product_id",
            "item.quantity",
            cents("item.unit_price").alias("price_c"),
            rate.alias("discount"),
        )
        .withColumn(
            "line_c",
            half_up(
                F.col("quantity")
                * F.col("price_c")
                * (F.lit(10000) - F.round(F.col("discount") * 10000).cast("bigint")),
                F.lit(10000),
            ),
        )
    )


def process_orders(requests: DataFrame, now: datetime) -> DataFrame:
    """Order headers with number, totals, status and result message."""
    sums = order_lines(requests).groupBy("request_id").agg(
        F.sum("line_c").alias("sum_c"), F.count(F.lit(1)).alias("n")
    )
    numbered = number_rows(
        requests.withColumn("problem", _problem()).drop("items"),
        ["request_id"],
        FIRST_ORDER_NUMBER,
        "seq",
    )
    subtotal = F.coalesce("sum_c", F.lit(0))
    done = F.col("problem").isNull()
    number = padded("ORD" + now.strftime("%Y%m%d%H%M%S"), "seq", 4)
    out = update_from(
        numbered,
        sums,
        "request_id",
        subtotal_c=F.when(done, subtotal),
        tax_c=F.when(done, half_up(subtotal * TAX_PERCENT, F.lit(100))),
        item_count=F.when(done, F.coalesce("n", F.lit(0))),
        order_number=F.when(done, number),
    )
    return out.select(
        "request_id",
        "order_number",
        "customer_id",
        "sales_rep_id",
        F.when(done, day(now.date())).alias("order_date"),
        "item_count",
        money("subtotal_c", "subtotal"),
        money("tax_c", "tax_amount"),
        amount(F.col("subtotal_c") + F.col("tax_c")).alias("total_amount"),
        F.when(done, "PENDING").alias("status"),
        F.coalesce(
            "problem", F.concat(F.lit("Order processed successfully. Order Number: "), "order_number")
        ).alias("message"),
    )


def allocate_stock(inventory: DataFrame, lines: DataFrame, location: str = "MAIN") -> DataFrame:
    """Move ordered quantities from available to allocated at one location."""
    taken = lines.groupBy("product_id").agg(F.sum("quantity").alias("taken"))
    here = F.col("location_code") == location
    gone = F.when(here, F.coalesce("taken", F.lit(0))).otherwise(0)
    return update_from(
        inventory,
        taken,
        "product_id",
        quantity_available=F.col("quantity_available") - gone,
        quantity_allocated=F.col("quantity_allocated") + gone,
    )


NOW = datetime(2001, 8, 1, 12, 0, 0)


def processed_orders(m: Mart) -> DataFrame:
    return process_orders(order_requests(m), NOW)


def processed_items(m: Mart) -> DataFrame:
    return order_lines(order_requests(m)).select(
        "request_id", "line_number", "product_id", "quantity",
        money("price_c", "unit_price"), F.col("discount").cast("double").alias("discount"),
        money("line_c", "line_total"),
    )


def stock_after_orders(m: Mart) -> DataFrame:
    return allocate_stock(m.inventory, order_lines(order_requests(m))).select(
        "product_id", "location_code", "quantity_on_hand", "quantity_available",
        "quantity_allocated",
    )


# ---- onboarding --------------------------------------------------------------------

def onboarding_requests(m: Mart) -> DataFrame:
    c = m.customer_master
    return c.select(
        F.col("customer_id").alias("request_id"), "customer_type", "company_name", "first_name",
        "last_name", "email", "phone",
        F.concat(F.col("customer_id").cast("string"), F.lit(" Main St")).alias("address_line_1"),
        "annual_income",
        F.col("billing_address_id").alias("place_id"),
    ).join(
        m.addresses.select(F.col("address_id").alias("place_id"), "city", "country"), "place_id"
    ).drop("place_id")


def segment_for(income) -> Column:
    income = F.col(income) if isinstance(income, str) else income
    return (
        F.when(income >= 1000000, 1).when(income >= 100000, 2).when(income >= 10000, 3).otherwise(4)
    )


def onboard_customers(
    requests: DataFrame, as_of: date, first_customer: int, first_address: int
) -> tuple[DataFrame, DataFrame]:
    """New customers and their address rows; one address serves both roles."""
    numbered = number_rows(requests, ["request_id"], 0, "n").withColumns(
        {
            "customer_id": F.col("n") + first_customer,
            "address_id": F.col("n") + first_address,
            "customer_number": padded("C", F.col("n") + FIRST_CUSTOMER_NUMBER, 8),
        }
    )
    customers = numbered.select(
        "customer_id", "customer_number", "customer_type", "company_name", "first_name",
        "last_name", "email", "phone", "annual_income",
        segment_for("annual_income").alias("segment_id"),
        F.col("address_id").alias("billing_address_id"),
        F.col("address_id").alias("shipping_address_id"),
        day(as_of).alias("registration_date"),
        F.lit("ACTIVE").alias("status"),
        F.concat(
            F.lit("Customer onboarded successfully. Customer Number: "), "customer_number"
        ).alias("message"),
    )
    addresses = numbered.select(
        "address_id", "address_line_1", "city", "country", F.lit("BILLING").alias("address_type")
    )
    return customers, addresses


def onboarded_customers(m: Mart) -> DataFrame:
    return onboard_customers(onboarding_requests(m), m.as_of, 1, 1)[0]


def onboarded_addresses(m: Mart) -> DataFrame:
    return onboard_customers(onboarding_requests(m), m.as_of, 1, 1)[1]


# ---- stock movements ----------------------------------------------------------------

def item_ids(m: Mart) -> DataFrame:
    """Order lines with a gap-free item id in line order. Every column takes part in
    the order, so only identical lines are interchangeable."""
    order = [
        "order_id", "line_number", "product_key", "sales_rep_key", "quantity", "discount_pct",
        "tax_pct", "shipped_date",
    ]
    return number_rows(m.items.select(*order), order, 1, "order_item_id").select(
        *order[:5], "order_item_id"
    )


def stock_moves(m: Mart) -> DataFrame:
    """Every order line as a stock movement; the item id orders them."""
    n = F.col("order_item_id")
    kind = (
        F.when(n % 101 == 0, "SCRAP")
        .when(n % 5 == 0, "ADJUSTMENT")
        .when(n % 5 == 1, "RETURN")
        .otherwise("RECEIPT")
    )
    return item_ids(m).select(
        F.col("product_key").alias("product_id"),
        F.when(n % 103 == 0, "NORTH").otherwise("MAIN").alias("location_code"),
        n.alias("seq"),
        "quantity",
        kind.alias("transaction_type"),
    )


PLACE = ["product_id", "location_code"]


def apply_moves(inventory: DataFrame, moves: DataFrame, as_of: date) -> DataFrame:
    """Stock after all movements of the batch; unknown places stay unknown."""
    end = F.when(
        F.col("received").isNull(), F.col("quantity_on_hand")
    ).otherwise(F.coalesce("set_quantity", "quantity_on_hand") + F.col("added"))
    return update_from(
        inventory,
        ledger.closing(moves, PLACE),
        PLACE,
        quantity_on_hand=end,
        quantity_available=F.when(
            F.col("received").isNull(), F.col("quantity_available")
        ).otherwise(end - F.col("quantity_allocated")),
        last_received_date=F.when(F.col("received"), day(as_of)).otherwise(
            F.col("last_received_date")
        ),
    )


def move_messages(inventory: DataFrame, moves: DataFrame) -> DataFrame:
    """Result of each movement: the new quantity, a warning, or why it was refused."""
    stock = inventory.select(
        *PLACE, F.col("quantity_on_hand").alias("opening"), "reorder_point"
    )
    placed = moves.join(stock, PLACE, "left")
    refused = placed.filter(
        ~F.col("transaction_type").isin(*ledger.ADDING, ledger.SETTING) | F.col("opening").isNull()
    ).select(
        "seq",
        F.lit(None).cast("bigint").alias("balance"),
        F.when(
            F.col("opening").isNull(),
            F.concat(F.lit("Unknown stock location: "), "location_code"),
        )
        .otherwise(F.concat(F.lit("Invalid transaction type: "), "transaction_type"))
        .alias("message"),
    )
    done = ledger.running(placed.filter("opening IS NOT NULL"), PLACE, F.col("opening"))
    product = F.col("product_id").cast("string")
    message = F.when(
        F.col("balance") <= F.col("reorder_point"),
        F.concat(
            F.lit("Inventory updated. WARNING: Stock level below reorder point for Product ID: "),
            product,
        ),
    ).otherwise(
        F.concat(
            F.lit("Inventory updated successfully for Product ID: "), product,
            F.lit(", New quantity: "), F.col("balance").cast("string"),
        )
    )
    return done.select("seq", "balance", message.alias("message")).unionByName(refused)


def stock_after_moves(m: Mart) -> DataFrame:
    return apply_moves(m.inventory, stock_moves(m), m.as_of).select(
        *PLACE, "quantity_on_hand", "quantity_available", "last_received_date"
    )


def stock_messages(m: Mart) -> DataFrame:
    return move_messages(m.inventory, stock_moves(m))


# ---- payroll -------------------------------------------------------------------------

PERIODS, PERIOD_DAYS = 26, 14


def payroll_c(m: Mart) -> DataFrame:
    """Bi-weekly payroll since the start of the year, in cents, without commission."""
    year_start = F.trunc(day(m.as_of), "year")
    periods = F.transform(
        F.sequence(F.lit(0), F.lit(PERIODS - 1)), lambda i: F.date_add(year_start, i * PERIOD_DAYS)
    )
    start = F.col("pay_period_start")
    annual = F.col("min_salary") * 100 + F.expr("(max_salary - min_salary)") * draw_int(
        "salary", 3000, 8000, "employee_id", "period_key"
    ).cast("bigint") / F.lit(100)
    gross = F.col("base_c") + F.col("overtime_c") + F.col("bonus_c")

    def part(basis_points: int) -> Column:
        return half_up(F.col("gross_c") * basis_points, F.lit(10000))

    parts = ["federal_c", "state_c", "social_c", "medicare_c", "health_c", "retirement_c", "other_c"]
    return (
        m.employees.filter(F.col("status") == "ACTIVE")
        .join(m.positions.select("position_id", "min_salary", "max_salary"), "position_id")
        .withColumn("pay_period_start", F.explode(periods))
        .filter(start <= day(m.as_of))
        .withColumn("period_key", F.date_format(start, "yyyyMMdd"))
        .withColumn("annual_c", annual.cast("bigint"))
        .withColumn("base_c", half_up("annual_c", F.lit(26)))
        .withColumn("overtime_hours", draw_int("overtime", 0, 8, "employee_id", "period_key"))
        .withColumn("rate_c", half_up(F.col("annual_c") * 3, F.lit(26 * 80 * 2)))
        .withColumn("overtime_c", F.col("overtime_hours") * F.col("rate_c"))
        .withColumn(
            "bonus_c",
            F.when(
                F.month(start).isin(3, 6, 9, 12),
                draw_int("bonus", 500, 2000, "employee_id", "period_key") * 100,
            ).otherwise(0),
        )
        .withColumn("gross_c", gross)
        .withColumn("federal_c", part(2200))
        .withColumn("state_c", part(500))
        .withColumn("social_c", part(620))
        .withColumn("medicare_c", part(145))
        .withColumn("health_c", F.lit(35000))
        .withColumn("retirement_c", part(600))
        .withColumn("other_c", F.lit(5000))
        .withColumn("deductions_c", sum((F.col(p) for p in parts[1:]), F.col(parts[0])))
    )


def payroll(m: Mart) -> DataFrame:
    start = F.col("pay_period_start")
    return payroll_c(m).select(
        "employee_id",
        start,
        F.date_add(start, PERIOD_DAYS - 1).alias("pay_period_end"),
        F.date_add(start, PERIOD_DAYS + 2).alias("pay_date"),
        money("base_c", "base_salary"),
        "overtime_hours",
        money("rate_c", "overtime_rate"),
        money("overtime_c", "overtime_pay"),
        money("bonus_c", "bonus"),
        money("gross_c", "gross_pay"),
        money("federal_c", "federal_tax"),
        money("state_c", "state_tax"),
        money("social_c", "social_security"),
        money("medicare_c", "medicare"),
        money("health_c", "health_insurance"),
        money("retirement_c", "retirement_401k"),
        money("other_c", "other_deductions"),
        money("deductions_c", "total_deductions"),
        amount(F.col("gross_c") - F.col("deductions_c")).alias("net_pay"),
    )


def rep_order_totals(m: Mart, status: str, span: Span | None = None) -> DataFrame:
    """What each rep sold in each order of a status, taxed, with the order's date."""
    per_rep = (
        m.sales(span)
        .filter(F.col("status") == status)
        .groupBy("order_id", "sales_rep_key")
        .agg(F.min("order_date").alias("order_date"), F.sum("line_c").alias("sum_c"))
    )
    return per_rep.select(
        F.col("sales_rep_key").alias("sales_rep_id"),
        "order_date",
        half_up(F.col("sum_c") * 108, F.lit(100)).alias("total_c"),
    )


def sales_commission(
    m: Mart, start: date = date(2000, 1, 1), end: date = date(2000, 12, 31),
    status: str = "SHIPPED",
) -> DataFrame:
    """Commission of every rep for one period; reps without sales earn zero."""
    sold = (
        rep_order_totals(m, status, Span(start, end))
        .groupBy("sales_rep_id")
        .agg(F.sum("total_c").alias("sales_c"))
    )
    rate_pct = F.round(F.col("commission_rate") * 100).cast("bigint")
    return (
        sales_reps(m)
        .join(sold, "sales_rep_id", "left")
        .withColumn("sales_c", F.coalesce("sales_c", F.lit(0)))
        .select(
            "employee_id",
            "sales_rep_id",
            "commission_rate",
            money("sales_c", "total_sales"),
            amount(half_up(F.col("sales_c") * rate_pct, F.lit(100))).alias("commission"),
        )
    )


def payroll_with_commission(m: Mart, status: str = "SHIPPED") -> DataFrame:
    """Payroll rows with the commission earned in their period.

    Sales are added up per rep and day first. Pay periods do not overlap, so a day's
    sales match one row per employee: an equi-join on the employee with a date-range
    residual over rows that no longer depend on the number of orders.
    """
    daily = (
        rep_order_totals(m, status, Span(date(m.as_of.year, 1, 1), date.max))
        .groupBy("sales_rep_id", "order_date")
        .agg(F.sum("total_c").alias("total_c"))
        .join(sales_reps(m).select("sales_rep_id", "employee_id", "commission_rate"), "sales_rep_id")
        .withColumn(
            "earned_c",
            F.col("total_c") * F.round(F.col("commission_rate") * 100).cast("bigint"),
        )
        .select("employee_id", F.col("order_date").alias("sale_date"), "earned_c")
    )
    pay = payroll_c(m).select(
        "employee_id", "pay_period_start", "base_c", "gross_c", "deductions_c"
    )
    in_period = (pay.employee_id == daily.employee_id) & daily.sale_date.between(
        pay.pay_period_start, F.date_add(pay.pay_period_start, PERIOD_DAYS - 1)
    )
    earned = (
        pay.join(daily, in_period)
        .groupBy(pay.employee_id, "pay_period_start")
        .agg(half_up(F.sum("earned_c"), F.lit(100)).alias("earned_c"))
    )
    commission = F.coalesce("earned_c", F.lit(0))
    return (
        pay.join(sales_reps(m).select("employee_id"), "employee_id", "left_semi")
        .join(earned, ["employee_id", "pay_period_start"], "left")
        .select(
            "employee_id",
            "pay_period_start",
            amount(commission).alias("commission"),
            amount(F.col("gross_c") + commission).alias("gross_pay"),
            amount(F.col("gross_c") + commission - F.col("deductions_c")).alias("net_pay"),
        )
    )


# Phrases of the performance review, in draw order.
STRENGTHS = (
    "Strong technical skills, excellent communication",
    "Leadership abilities, team collaboration",
    "Problem-solving skills, initiative",
    "Customer focus, reliability",
    "Innovation, adaptability",
)
IMPROVEMENTS = (
    "Time management, project planning",
    "Documentation, process improvement",
    "Cross-functional collaboration",
    "Strategic thinking, delegation",
)
DEVELOPMENT_PLAN = "Focus on professional development courses and mentoring opportunities"


def performance_reviews(m: Mart) -> DataFrame:
    """Last year's review of active employees with a manager and a year of service."""
    year = F.trunc(day(m.as_of), "year")
    pick = lambda texts, salt: F.element_at(
        F.array(*[F.lit(t) for t in texts]),
        draw_int(salt, 1, len(texts), "employee_id").cast("int"),
    )
    key = "employee_id"
    raise_pct = F.when(
        draw_int("raise_score", 250, 450, key) >= 350, draw_int("raise_high", 3, 8, key)
    ).otherwise(draw_int("raise_low", 0, 3, key))
    eligible = (
        (F.col("status") == "ACTIVE")
        & (F.col("hire_date") <= F.add_months(day(m.as_of), -12))
        & F.col("manager_id").isNotNull()
    )
    return m.employees.filter(eligible).select(
        "employee_id",
        F.add_months(year, -12).alias("review_period_start"),
        F.date_sub(year, 1).alias("review_period_end"),
        F.col("manager_id").alias("reviewer_id"),
        (draw_int("score", 250, 450, key) / F.lit(100.0)).alias("performance_score"),
        draw_int("goals", 3, 8, key).alias("goals_met"),
        F.lit(8).alias("total_goals"),
        pick(STRENGTHS, "strength").alias("strengths"),
        pick(IMPROVEMENTS, "improve").alias("areas_for_improvement"),
        F.lit(DEVELOPMENT_PLAN).alias("development_plan"),
        raise_pct.alias("salary_increase_percent"),
        (draw_int("promotion", 250, 450, key) >= 400).alias("promotion_eligible"),
    )


ALL = {
    "e07_processed_orders": processed_orders,
    "e07_processed_items": processed_items,
    "e07_stock_after_orders": stock_after_orders,
    "e08_onboarded_customers": onboarded_customers,
    "e08_onboarded_addresses": onboarded_addresses,
    "e09_stock_after_moves": stock_after_moves,
    "e09_stock_messages": stock_messages,
    "e10_sales_commission": sales_commission,
    "e10_payroll_with_commission": payroll_with_commission,
    "e11_payroll": payroll,
    "e12_performance_reviews": performance_reviews,
    "w06_item_ids": item_ids,
}
