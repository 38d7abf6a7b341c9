"""Input schemas and the columns, keys and domains of the canonical tables."""

from __future__ import annotations

# Input files, read with these schemas so that opening a table costs no job.
INPUT = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}

# Raw staging: every business column is text, plus where the row came from.
RAW_CUSTOMERS = (
    "customer_number", "customer_type", "company_name", "first_name", "last_name", "email",
    "phone", "birth_date", "gender", "annual_income", "address_line_1", "address_line_2",
    "city", "state_province", "postal_code", "country", "registration_date",
)
RAW_PRODUCTS = (
    "product_number", "product_name", "category_name", "supplier_name", "description", "color",
    "size", "weight", "unit_price", "cost", "list_price", "discontinued",
)

# Clean staging: (column, type or None for text, how to fill it). One spec per
# table drives cleaning; the first column is the key that must be present.
CLEAN = {
    "segments": (
        ("segment_id", "bigint"), ("segment_name", None), ("description", None),
        ("min_annual_revenue", "decimal(15,2)"), ("max_annual_revenue", "decimal(15,2)"),
        ("discount_rate", "decimal(5,4)"),
    ),
    "categories": (
        ("category_id", "bigint"), ("category_name", None), ("description", None),
        ("parent_category_id", "bigint"),
    ),
    "suppliers": (
        ("supplier_id", "bigint"), ("supplier_name", None), ("contact_name", None),
        ("contact_title", None), ("address", None), ("city", None), ("region", None),
        ("postal_code", None), ("country", None), ("phone", None), ("email", None),
        ("website", None), ("status", None), ("rating", "decimal(3,1)"),
    ),
    "addresses": (
        ("address_id", "bigint"), ("customer_id", "bigint"), ("address_type", None),
        ("address_line_1", None), ("address_line_2", None), ("city", None),
        ("state_province", None), ("postal_code", None), ("country", None),
        ("is_default", "boolean"),
    ),
    "departments": (
        ("department_id", "bigint"), ("department_name", None), ("department_code", None),
        ("description", None), ("budget", "decimal(15,2)"), ("location", None),
        ("phone", None), ("email", None),
    ),
    "positions": (
        ("position_id", "bigint"), ("position_title", None), ("position_code", None),
        ("department_id", "bigint"), ("job_level", "bigint"), ("min_salary", "decimal(10,2)"),
        ("max_salary", "decimal(10,2)"), ("description", None), ("status", None),
    ),
}

# Columns a conforming table must have, by canonical table.
REQUIRED = {
    "sales_fact": ("order_id", "order_date_key", "customer_key", "product_key", "sales_rep_key",
                   "quantity", "unit_price", "line_total", "cost", "profit"),
    "customer_dim": ("customer_key", "customer_id", "customer_name", "segment_name",
                     "is_current", "version"),
    "product_dim": ("product_key", "product_id", "product_name", "category_name",
                    "is_current", "version"),
    "date_dim": ("date_key", "date_actual", "year_number", "month_number", "is_weekend",
                 "is_holiday"),
    "orders": ("order_id", "customer_id", "order_date", "status"),
    "order_items": ("order_id", "product_id", "quantity", "unit_price", "line_total"),
}

# Customer segments (id, name, lowest income, highest income, rate).
SEGMENTS = (
    (1, "Enterprise", "1000000", None, "0.15"),
    (2, "Corporate", "100000", "999999.0", "0.1"),
    (3, "Small Business", "10000", "99999.0", "0.05"),
    (4, "Individual", "0", "9999.0", "0.0"),
)

# Product categories and their ids; products of no known category get 9999.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
NO_CATEGORY = 9999

# Market segments of the customer file, with ids and discount rates.
MARKETS = (
    (1, "AUTOMOBILE", "0.15"), (2, "BUILDING", "0.1"), (3, "FURNITURE", "0.05"),
    (4, "HOUSEHOLD", "0.0"), (5, "MACHINERY", "0.2"),
)

# Positions used for the payroll and rep jobs: (id, code, department, low, high).
POSITIONS = (
    (1, "SALES_REP", "SALES", 45000, 75000),
    (2, "SR_SALES_REP", "SALES", 60000, 90000),
    (3, "SALES_MGR", "SALES", 80000, 120000),
    (4, "MKT_SPEC", "MKT", 50000, 70000),
)

PROCESS_LOG = (
    "process_name string, start_time timestamp, end_time timestamp, status string, "
    "records_processed bigint, records_inserted bigint, records_updated bigint, "
    "records_rejected bigint, error_message string"
)
LINEAGE = (
    "source_table string, source_column string, target_table string, target_column string, "
    "transformation_rule string, process_name string"
)
