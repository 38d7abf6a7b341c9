"""The warehouse model: databases and typed tables, with keys and references.

Column lists are Spark DDL, so the catalog enforces types, lengths and NOT NULL and
fills defaults on insert. Keys and references are declared here and checked by
queries, since parquet tables do not enforce them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NOW = "timestamp_ntz DEFAULT cast(current_timestamp() AS timestamp_ntz)"
_MADE = f"created_date {_NOW}"
_BOTH = f"{_MADE}, modified_date {_NOW}"
_SCD = (
    "effective_date date NOT NULL, expiry_date date, is_current boolean DEFAULT true, "
    f"version bigint DEFAULT 1, {_MADE}"
)
_RAW_TAIL = "load_timestamp timestamp_ntz, file_name varchar(200), row_number bigint"
_CLEAN_TAIL = (
    "processed_date timestamp_ntz, source_file varchar(200), "
    "validation_status varchar(20) DEFAULT 'VALID'"
)


def _texts(names: str) -> str:
    return ", ".join(f"{n} string" for n in names.split())


# Columns, types, lengths and defaults of the warehouse tables.
TABLES: dict[str, dict[str, str]] = {
    "sales": {
        "sales_territories": "territory_id bigint NOT NULL, territory_name varchar(50) NOT NULL, "
        "territory_code varchar(10) NOT NULL, region varchar(30) NOT NULL, "
        f"country varchar(30) NOT NULL, manager_id bigint, {_BOTH}",
        "sales_reps": "sales_rep_id bigint NOT NULL, employee_id bigint NOT NULL, "
        "first_name varchar(50) NOT NULL, last_name varchar(50) NOT NULL, "
        "email varchar(100) NOT NULL, phone varchar(20), territory_id bigint, "
        "hire_date date NOT NULL, commission_rate decimal(5,4) DEFAULT 0.05, "
        f"status varchar(20) DEFAULT 'ACTIVE', {_BOTH}",
        "orders": "order_id bigint NOT NULL, order_number varchar(20) NOT NULL, "
        "customer_id bigint NOT NULL, sales_rep_id bigint, order_date date NOT NULL, "
        "required_date date, shipped_date date, ship_via varchar(50), "
        "freight decimal(10,2) DEFAULT 0.00, ship_name varchar(100), ship_address varchar(200), "
        "ship_city varchar(50), ship_region varchar(50), ship_postal_code varchar(20), "
        "ship_country varchar(30), subtotal decimal(12,2) DEFAULT 0.00, "
        "tax_amount decimal(12,2) DEFAULT 0.00, total_amount decimal(12,2) DEFAULT 0.00, "
        f"status varchar(20) DEFAULT 'PENDING', {_BOTH}",
        "order_items": "order_item_id bigint NOT NULL, order_id bigint NOT NULL, "
        "product_id bigint NOT NULL, quantity bigint NOT NULL, unit_price decimal(10,2) NOT NULL, "
        f"discount decimal(5,4) DEFAULT 0.00, line_total decimal(12,2), {_MADE}",
    },
    "customers": {
        "customer_segments": "segment_id bigint NOT NULL, segment_name varchar(50) NOT NULL, "
        "description string, min_annual_revenue decimal(15,2), max_annual_revenue decimal(15,2), "
        f"discount_rate decimal(5,4) DEFAULT 0.00, {_BOTH}",
        "addresses": "address_id bigint NOT NULL, address_line_1 varchar(200) NOT NULL, "
        "address_line_2 varchar(200), city varchar(50) NOT NULL, state_province varchar(50), "
        "postal_code varchar(20), country varchar(30) NOT NULL, "
        "address_type varchar(20) DEFAULT 'BILLING', latitude decimal(10,8), "
        f"longitude decimal(11,8), {_BOTH}",
        "customers": "customer_id bigint NOT NULL, customer_number varchar(20) NOT NULL, "
        "customer_type varchar(20) DEFAULT 'INDIVIDUAL', company_name varchar(100), "
        "first_name varchar(50), last_name varchar(50), title varchar(50), "
        "email varchar(100) NOT NULL, phone varchar(20), mobile varchar(20), birth_date date, "
        "gender varchar(10), marital_status varchar(20), education varchar(50), "
        "occupation varchar(100), annual_income decimal(15,2), segment_id bigint, "
        "billing_address_id bigint, shipping_address_id bigint, registration_date date NOT NULL, "
        "last_order_date date, total_orders bigint DEFAULT 0, "
        "total_spent decimal(15,2) DEFAULT 0.00, credit_limit decimal(15,2), "
        "status varchar(20) DEFAULT 'ACTIVE', preferred_language varchar(10) DEFAULT 'EN', "
        f"marketing_opt_in boolean DEFAULT true, {_BOTH}",
        "customer_addresses": "customer_address_id bigint NOT NULL, customer_id bigint NOT NULL, "
        "address_id bigint NOT NULL, address_type varchar(20) NOT NULL, "
        f"is_default boolean DEFAULT false, {_MADE}",
    },
    "products": {
        "categories": "category_id bigint NOT NULL, category_name varchar(50) NOT NULL, "
        f"description string, parent_category_id bigint, image_url varchar(200), {_BOTH}",
        "suppliers": "supplier_id bigint NOT NULL, supplier_name varchar(100) NOT NULL, "
        "contact_name varchar(100), contact_title varchar(50), address varchar(200), "
        "city varchar(50), region varchar(50), postal_code varchar(20), country varchar(30), "
        "phone varchar(20), fax varchar(20), email varchar(100), website varchar(200), "
        f"status varchar(20) DEFAULT 'ACTIVE', rating decimal(2,1) DEFAULT 5.0, {_BOTH}",
        "products": "product_id bigint NOT NULL, product_name varchar(100) NOT NULL, "
        "product_number varchar(25) NOT NULL, category_id bigint NOT NULL, supplier_id bigint, "
        "description string, color varchar(15), size varchar(10), weight decimal(8,2), "
        "unit_price decimal(10,2) NOT NULL, cost decimal(10,2), list_price decimal(10,2), "
        "discontinued boolean DEFAULT false, reorder_level bigint DEFAULT 10, "
        "units_in_stock bigint DEFAULT 0, units_on_order bigint DEFAULT 0, "
        "image_url varchar(200), product_line varchar(20), class varchar(10), "
        f"style varchar(10), {_BOTH}",
        "inventory": "inventory_id bigint NOT NULL, product_id bigint NOT NULL, "
        "location_code varchar(10) NOT NULL, quantity_on_hand bigint DEFAULT 0, "
        "quantity_available bigint DEFAULT 0, quantity_allocated bigint DEFAULT 0, "
        "reorder_point bigint DEFAULT 10, max_stock_level bigint DEFAULT 100, "
        "last_count_date date, last_received_date date, average_cost decimal(10,2), "
        f"last_cost decimal(10,2), {_BOTH}",
    },
    "hr": {
        "departments": "department_id bigint NOT NULL, department_name varchar(50) NOT NULL, "
        "department_code varchar(10) NOT NULL, description string, manager_id bigint, "
        "budget decimal(15,2), location varchar(100), phone varchar(20), email varchar(100), "
        f"{_BOTH}",
        "positions": "position_id bigint NOT NULL, position_title varchar(100) NOT NULL, "
        "position_code varchar(20) NOT NULL, department_id bigint NOT NULL, job_level int, "
        "min_salary decimal(12,2), max_salary decimal(12,2), description string, "
        f"requirements string, status varchar(20) DEFAULT 'ACTIVE', {_BOTH}",
        "employees": "employee_id bigint NOT NULL, employee_number varchar(20) NOT NULL, "
        "first_name varchar(50) NOT NULL, last_name varchar(50) NOT NULL, middle_name varchar(50), "
        "email varchar(100) NOT NULL, phone varchar(20), mobile varchar(20), birth_date date, "
        "gender varchar(10), marital_status varchar(20), address varchar(200), city varchar(50), "
        "state_province varchar(50), postal_code varchar(20), country varchar(30), "
        "hire_date date NOT NULL, termination_date date, position_id bigint NOT NULL, "
        "department_id bigint NOT NULL, manager_id bigint, "
        "employment_type varchar(20) DEFAULT 'FULL_TIME', status varchar(20) DEFAULT 'ACTIVE', "
        "emergency_contact_name varchar(100), emergency_contact_phone varchar(20), "
        f"emergency_contact_relationship varchar(50), {_BOTH}",
        "payroll": "payroll_id bigint NOT NULL, employee_id bigint NOT NULL, "
        "pay_period_start date NOT NULL, pay_period_end date NOT NULL, pay_date date NOT NULL, "
        "base_salary decimal(12,2) NOT NULL, overtime_hours decimal(5,2) DEFAULT 0.00, "
        "overtime_rate decimal(8,2) DEFAULT 0.00, overtime_pay decimal(12,2) DEFAULT 0.00, "
        "bonus decimal(12,2) DEFAULT 0.00, commission decimal(12,2) DEFAULT 0.00, "
        "gross_pay decimal(12,2) NOT NULL, federal_tax decimal(12,2) DEFAULT 0.00, "
        "state_tax decimal(12,2) DEFAULT 0.00, social_security decimal(12,2) DEFAULT 0.00, "
        "medicare decimal(12,2) DEFAULT 0.00, health_insurance decimal(12,2) DEFAULT 0.00, "
        "retirement_401k decimal(12,2) DEFAULT 0.00, other_deductions decimal(12,2) DEFAULT 0.00, "
        f"total_deductions decimal(12,2) DEFAULT 0.00, net_pay decimal(12,2) NOT NULL, {_MADE}",
        "employee_performance": "performance_id bigint NOT NULL, employee_id bigint NOT NULL, "
        "review_period_start date NOT NULL, review_period_end date NOT NULL, "
        "reviewer_id bigint NOT NULL, performance_score decimal(3,2), goals_met int, "
        "total_goals int, strengths string, areas_for_improvement string, "
        "development_plan string, salary_increase_percent decimal(5,2), "
        f"promotion_eligible boolean DEFAULT false, {_MADE}",
    },
    "analytics": {
        "date_dim": "date_key int NOT NULL, date_actual date NOT NULL, day_of_week int NOT NULL, "
        "day_of_week_name varchar(10) NOT NULL, day_of_month int NOT NULL, "
        "day_of_year int NOT NULL, week_of_year int NOT NULL, month_number int NOT NULL, "
        "month_name varchar(10) NOT NULL, month_abbr varchar(3) NOT NULL, "
        "quarter_number int NOT NULL, quarter_name varchar(2) NOT NULL, year_number int NOT NULL, "
        "is_weekend boolean NOT NULL, is_holiday boolean DEFAULT false, holiday_name varchar(50), "
        f"fiscal_year int, fiscal_quarter int, fiscal_month int, season varchar(10), {_MADE}",
        "customer_dim": "customer_key bigint NOT NULL, customer_id bigint NOT NULL, "
        "customer_number varchar(20) NOT NULL, customer_name varchar(200), "
        "customer_type varchar(20), company_name varchar(100), email varchar(100), "
        "phone varchar(20), birth_date date, gender varchar(10), age_group varchar(20), "
        "marital_status varchar(20), education varchar(50), occupation varchar(100), "
        "annual_income decimal(15,2), income_category varchar(20), segment_name varchar(50), "
        "billing_city varchar(50), billing_state varchar(50), billing_country varchar(30), "
        "shipping_city varchar(50), shipping_state varchar(50), shipping_country varchar(30), "
        f"registration_date date, status varchar(20), {_SCD}",
        "product_dim": "product_key bigint NOT NULL, product_id bigint NOT NULL, "
        "product_number varchar(25) NOT NULL, product_name varchar(100) NOT NULL, "
        "category_name varchar(50), category_hierarchy varchar(200), supplier_name varchar(100), "
        "supplier_country varchar(30), color varchar(15), size varchar(10), weight decimal(8,2), "
        "unit_price decimal(10,2), cost decimal(10,2), list_price decimal(10,2), "
        "product_line varchar(20), class varchar(10), style varchar(10), discontinued boolean, "
        f"{_SCD}",
        "sales_rep_dim": "sales_rep_key bigint NOT NULL, sales_rep_id bigint NOT NULL, "
        "employee_id bigint, sales_rep_name varchar(100) NOT NULL, email varchar(100), "
        "phone varchar(20), territory_name varchar(50), territory_code varchar(10), "
        "region varchar(30), country varchar(30), hire_date date, commission_rate decimal(5,4), "
        f"status varchar(20), {_SCD}",
        "sales_fact": "order_id bigint NOT NULL, order_item_id bigint, "
        "order_date_key int NOT NULL, shipped_date_key int, customer_key bigint NOT NULL, "
        "product_key bigint NOT NULL, sales_rep_key bigint, quantity bigint NOT NULL, "
        "unit_price decimal(10,2) NOT NULL, discount decimal(5,4) DEFAULT 0.00, "
        "discount_amount decimal(12,2), line_total decimal(12,2) NOT NULL, cost decimal(10,2), "
        "profit decimal(12,2), freight_amount decimal(10,2), tax_amount decimal(10,2), "
        f"net_amount decimal(12,2), order_status varchar(20), {_MADE}",
        "customer_ltv_fact": "customer_key bigint NOT NULL, calculation_date_key int NOT NULL, "
        "total_orders bigint DEFAULT 0, total_revenue decimal(15,2) DEFAULT 0.00, "
        "average_order_value decimal(12,2) DEFAULT 0.00, months_active int, "
        "days_since_first_order bigint, days_since_last_order bigint, "
        "order_frequency decimal(8,4), predicted_ltv decimal(15,2), customer_score varchar(1), "
        f"risk_segment varchar(20), churn_probability decimal(5,4), {_MADE}",
        "product_performance_fact": "product_key bigint NOT NULL, date_key int NOT NULL, "
        "units_sold bigint DEFAULT 0, revenue decimal(15,2) DEFAULT 0.00, "
        "profit_margin decimal(5,4), inventory_turns decimal(8,4), "
        "return_rate decimal(5,4) DEFAULT 0.00, customer_satisfaction decimal(3,2), "
        f"performance_score varchar(1), {_MADE}",
    },
    "staging": {
        "stg_customers_raw": _texts(
            "customer_number customer_type company_name first_name last_name email phone "
            "birth_date gender annual_income address_line_1 address_line_2 city state_province "
            "postal_code country registration_date") + ", " + _RAW_TAIL,
        "stg_products_raw": _texts(
            "product_number product_name category_name supplier_name description color size "
            "weight unit_price cost list_price discontinued") + ", " + _RAW_TAIL,
        "stg_orders_raw": _texts(
            "order_number customer_number sales_rep_email order_date required_date shipped_date "
            "ship_via freight ship_name ship_address ship_city ship_country status")
        + ", " + _RAW_TAIL,
        "stg_order_items_raw": _texts("order_number product_number quantity unit_price discount")
        + ", " + _RAW_TAIL,
        "stg_customers_clean": _texts("customer_number customer_type company_name first_name "
                                      "last_name email phone")
        + ", birth_date date, gender varchar(10), annual_income decimal(15,2), "
        + _texts("address_line_1 address_line_2 city state_province postal_code country")
        + f", registration_date date, {_CLEAN_TAIL}",
        "stg_products_clean": _texts("product_number product_name category_name supplier_name "
                                     "description color size")
        + ", weight decimal(8,2), unit_price decimal(10,2), cost decimal(10,2), "
        f"list_price decimal(10,2), discontinued boolean, {_CLEAN_TAIL}",
        "data_quality_issues": "table_name varchar(100) NOT NULL, column_name varchar(100), "
        "issue_type varchar(50) NOT NULL, issue_description string NOT NULL, "
        "record_identifier varchar(200), raw_value string, suggested_value string, "
        f"severity varchar(20) DEFAULT 'MEDIUM', status varchar(20) DEFAULT 'OPEN', {_MADE}, "
        "resolved_date timestamp_ntz, resolved_by varchar(100)",
    },
}

# Columns that together are unique in a table.
KEYS: dict[str, tuple[tuple[str, ...], ...]] = {
    "orders": (("order_id",), ("order_number",)),
    "order_items": (("order_item_id",),),
    "customers": (("customer_id",), ("customer_number",)),
    "customer_addresses": (("customer_id", "address_id", "address_type"),),
    "products": (("product_id",), ("product_number",)),
    "inventory": (("product_id", "location_code"),),
    "date_dim": (("date_key",), ("date_actual",)),
    "customer_dim": (("customer_key",), ("customer_id", "version")),
    "product_dim": (("product_key",), ("product_id", "version")),
    "sales_rep_dim": (("sales_rep_key",), ("sales_rep_id", "version")),
}


@dataclass(frozen=True)
class Namespace:
    """Database names of one environment: ``<prefix><schema><suffix>``."""

    prefix: str = ""
    suffix: str = ""

    def database(self, schema: str) -> str:
        return f"{self.prefix}{schema}{self.suffix}"

    def table(self, schema: str, table: str) -> str:
        return f"{self.database(schema)}.{table}"


def create(spark: SparkSession, names: Namespace, location: str) -> list[str]:
    """Create every database and table that does not exist; returns their names."""
    made = []
    for schema, tables in TABLES.items():
        database = names.database(schema)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}/{database}'")
        for table, columns in tables.items():
            made.append(names.table(schema, table))
            spark.sql(f"CREATE TABLE IF NOT EXISTS {made[-1]} ({columns}) USING parquet")
    return made


def insert(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Append by column name; columns the frame lacks take the table's defaults."""
    df.createOrReplaceTempView("martlet_insert")
    columns = ", ".join(df.columns)
    spark.sql(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM martlet_insert")


def duplicate_keys(df: DataFrame, table: str) -> DataFrame:
    """Number of key values used more than once, per declared key of a table."""
    counts = [
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .agg(F.count(F.lit(1)).alias("duplicates"))
        .select(F.lit(", ".join(key)).alias("key_columns"), "duplicates")
        for key in KEYS[table]
    ]
    return reduce(DataFrame.unionByName, counts)
