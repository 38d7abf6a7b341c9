from oracles.base import AS_OF, CTES, big, r2
from oracles.files import EMAIL, SQL as _  # noqa: F401  (defines the raw CTEs)

SQL: dict[str, str] = {}


def _issue(table, column, kind, text, severity, record, source):
    col = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return f"""SELECT '{table}' AS table_name, {col} AS column_name, '{kind}' AS issue_type, '{text}' AS issue_description,
  CAST({record} AS VARCHAR) AS record_identifier, '{severity}' AS severity, 'OPEN' AS status FROM {source}"""


C1 = _issue("CUSTOMERS", None, "DUPLICATE", "Duplicate email addresses found", "HIGH", "email",
            "(SELECT email FROM rawc GROUP BY 1 HAVING COUNT(*) > 1) AS d")
C2 = _issue("PRODUCTS", "CATEGORY_ID", "MISSING_VALUE", "Products without valid category", "MEDIUM", "product_id",
            "pmaster WHERE category_id NOT IN (SELECT category_id FROM category)")
C3 = _issue("INVENTORY", "QUANTITY_ON_HAND", "INVALID_VALUE", "Negative inventory quantities", "HIGH", "product_id",
            "pmaster WHERE product_id % 60 = 0")
C4 = _issue("ORDERS", None, "MISSING_ITEMS", "Orders without order items", "HIGH", "order_id",
            "heads WHERE order_id NOT IN (SELECT order_id FROM item)")
SQL["c01_duplicate_emails"] = C1
SQL["c02_products_without_category"] = C2
SQL["c03_negative_stock"] = C3
SQL["c04_orders_without_items"] = C4
# Resolved issues are purged and found again, open ones stay: the union of all checks.
SQL["c05_validation_run"] = f"{C1} UNION ALL {C2} UNION ALL {C3} UNION ALL {C4}"
SQL["c05_validation_summary"] = f"""
SELECT table_name, issue_type, {big('COUNT(*)')} AS issues_found FROM ({SQL['c05_validation_run']}) AS v GROUP BY 1, 2"""
SQL["c06_orphans"] = f"""
SELECT 'products_without_supplier' AS check_name, {big('COUNT(*)')} AS n_rows FROM pmaster WHERE supplier_id NOT IN (SELECT supplier_id FROM brand)
UNION ALL SELECT 'products_without_category', {big('COUNT(*)')} FROM pmaster WHERE category_id NOT IN (SELECT category_id FROM category)
UNION ALL SELECT 'items_without_order', {big('COUNT(*)')} FROM item WHERE order_id NOT IN (SELECT order_id FROM heads)"""
CTES["qp"] = """
SELECT product_number, product_name, TRY_CAST(unit_price AS DECIMAL(10,2)) AS unit_price, TRY_CAST(cost AS DECIMAL(10,2)) AS cost FROM rawp"""


def _fill(table, source, column, floor):
    share = r2(f"COUNT({column}) * 10000", "COUNT(*)")
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, {share} AS filled_percent, {share} >= {floor} AS passed FROM {source}"


SQL["c07_completeness"] = " UNION ALL ".join(
    [_fill("CUSTOMERS", "rawc", c, f) for c, f in (("customer_number", 100), ("email", 95), ("first_name", 90), ("last_name", 90))]
    + [_fill("PRODUCTS", "qp", c, f) for c, f in (("product_number", 100), ("product_name", 100), ("unit_price", 95))]
)
SQL["c08_duplicate_numbers"] = f"""
SELECT 'CUSTOMERS' AS table_name, customer_number AS number, {big('COUNT(*)')} AS n FROM rawc GROUP BY 2 HAVING COUNT(*) > 1
UNION ALL SELECT 'PRODUCTS', product_number, {big('COUNT(*)')} FROM rawp GROUP BY 2 HAVING COUNT(*) > 1"""
SQL["c09_price_checks"] = f"""
SELECT {big('COUNT(*) FILTER (unit_price <= 0 OR cost <= 0)')} AS invalid_prices, {big('COUNT(*) FILTER (unit_price < 0)')} AS negative_prices FROM qp"""
SQL["c10_email_checks"] = f"""
SELECT {big(f"COUNT(*) FILTER (NOT regexp_matches(email, '{EMAIL}'))")} AS invalid_emails,
  {big("COUNT(*) FILTER (email NOT LIKE '%@%')")} AS emails_without_at FROM rawc"""
SQL["c11_date_checks"] = f"""
SELECT {big(f"COUNT(*) FILTER (b > {AS_OF} OR b < DATE '1900-01-01' OR g > {AS_OF})")} AS invalid_dates,
  {big('COUNT(*) FILTER (b IS NULL)')} AS unreadable_birth_dates
FROM (SELECT TRY_CAST(birth_date AS DATE) AS b, TRY_CAST(registration_date AS DATE) AS g FROM rawc) AS x"""
SQL["c12_freshness"] = f"""
WITH f AS (SELECT TRY_CAST(registration_date AS DATE) AS d FROM rawc)
SELECT {big('COUNT(*)')} AS total_customers, {big(f'COUNT(*) FILTER (d >= {AS_OF} - 30)')} AS recent_customers,
  {r2(f'COUNT(*) FILTER (d >= {AS_OF} - 30) * 10000', 'COUNT(*)')} AS recent_percent FROM f"""
_V = {"customer": (1000, 100000), "part": (100, 10000), "supplier": (10, 1000), "nation": (5, 100), "orders": (100, 2**62), "lineitem": (100, 2**62)}
SQL["c13_volumes"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {big('COUNT(*)')} AS n_rows, COUNT(*) BETWEEN {lo} AND {hi} AS in_range FROM {t}" for t, (lo, hi) in _V.items())
SQL["c14_load_status"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {big('COUNT(*)')} AS n_rows, CASE WHEN COUNT(*) > 0 THEN 'LOADED' ELSE 'EMPTY' END AS load_status FROM {t}"
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"))
SQL["c15_conformance"] = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, 0 AS n_missing, {big('COUNT(*)')} AS n_rows FROM {t}"
    for n, t in (("sales_fact", "fact"), ("customer_dim", "cdim"), ("product_dim", "pdim"), ("date_dim", "cal"), ("orders", "heads"), ("order_items", "fact")))
SQL["c16_calendar_coverage"] = f"""
SELECT {big('COUNT(*)')} AS calendar_days, (SELECT {big('COUNT(DISTINCT order_date)')} FROM heads WHERE order_date NOT IN (SELECT date_actual FROM cal)) AS uncovered_days
FROM cal WHERE date_actual BETWEEN (SELECT MIN(order_date) FROM heads) AND (SELECT MAX(order_date) FROM heads)"""


def _x(table, column, rule, failed, source):
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, {big(failed)} AS failed_rows, {failed} = 0 AS passed FROM {source}"


def _unique(table, column, source):
    return _x(table, column, "unique", "COALESCE(SUM(n), 0)", f"(SELECT COUNT(*) AS n FROM {source} GROUP BY {column} HAVING COUNT(*) > 1) AS d")


SQL["c18_expectations"] = " UNION ALL ".join([
    "SELECT 'CUSTOMERS' AS table_name, 'customer_number' AS column_name, 'exists' AS rule, CAST(0 AS BIGINT) AS failed_rows, TRUE AS passed",
    "SELECT 'CUSTOMERS', 'loyalty_level', 'exists', 1, FALSE",
    _x("CUSTOMERS", "customer_number", "not_null", "COUNT(*) FILTER (customer_number IS NULL)", "rawc"),
    _unique("CUSTOMERS", "customer_number", "rawc"),
    _x("CUSTOMERS", "email", "matches", f"COUNT(*) FILTER (NOT regexp_matches(email, '{EMAIL}'))", "rawc"),
    _x("CUSTOMERS", "customer_type", "one_of", "COUNT(*) FILTER (customer_type NOT IN ('INDIVIDUAL', 'BUSINESS'))", "rawc"),
    _unique("PRODUCTS", "product_number", "qp"),
    _x("PRODUCTS", "product_name", "not_null", "COUNT(*) FILTER (product_name IS NULL)", "qp"),
    _x("PRODUCTS", "unit_price", "at_least", "COUNT(*) FILTER (unit_price < 0)", "qp"),
    _x("PRODUCTS", "cost", "at_most", "COUNT(*) FILTER (cost > 700)", "qp"),
])

SQL["c17_rule_checks"] = f"""
SELECT 'email format' AS rule_name, regexp_matches(email, '{EMAIL}') AS ok, {big('COUNT(*)')} AS n FROM rawc GROUP BY 2
UNION ALL SELECT 'customer type', customer_type IN ('INDIVIDUAL', 'BUSINESS'), {big('COUNT(*)')} FROM rawc GROUP BY 2
UNION ALL SELECT 'price', COALESCE(unit_price >= 0, FALSE), {big('COUNT(*)')} FROM qp GROUP BY 2"""
