"""Shared CTEs and small SQL fragments."""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"


def r2(n: str, d: str, places: int = 2) -> str:
    """Integer n / d rounded half away from zero, scaled down by 10^places."""
    n, d = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE "
        f"CAST(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})) AS DOUBLE) / {10.0**places} END)"
    )


def s(x: str) -> str:
    """Sum of a two-place amount in whole cents."""
    return f"SUM(CAST(({x}) * 100 AS HUGEINT))"


def dbl(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE)"


def avg2(x: str, n: str = "COUNT(*)") -> str:
    return r2(s(x), n)


def pct(a: str, b: str) -> str:
    return r2(f"{s(a)} * 10000", s(b))


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def draw(salt: str, *keys: str) -> str:
    text = "||'-'||".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(('0x'||substr(md5({text}||':{salt}'),1,8))::BIGINT/4294967296.0::DOUBLE)"


def draw_int(salt: str, low: int, high: int, *keys: str) -> str:
    return f"CAST({low} + floor({draw(salt, *keys)} * {high - low + 1}) AS BIGINT)"


CTES: dict[str, str] = {}

CTES["heads"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_key, CAST(o_orderdate AS DATE) AS order_date,
  CASE o_orderstatus WHEN 'F' THEN 'SHIPPED' WHEN 'P' THEN 'PROCESSING' ELSE 'PENDING' END AS status,
  10 + o_orderkey % 91 AS freight
FROM orders"""

CTES["item"] = """
SELECT l_orderkey AS order_id, l_partkey AS product_key, l_suppkey AS sales_rep_key,
  CAST(l_linenumber AS BIGINT) AS line_number, CAST(l_quantity AS DECIMAL(10,0)) AS quantity,
  CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, CAST(l_discount AS DECIMAL(4,2)) AS discount,
  CAST(l_tax AS DECIMAL(4,2)) AS tax_rate, CAST(l_shipdate AS DATE) AS shipped_date,
  CAST(ROUND(CAST(p_retailprice AS DECIMAL(10,2)) * 0.70, 2) AS DECIMAL(10,2)) AS cost,
  CAST(ROUND(CAST(l_quantity AS DECIMAL(10,0)) * CAST(p_retailprice AS DECIMAL(10,2))
       * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2)) AS line_total
FROM lineitem JOIN part ON l_partkey = p_partkey"""

CTES["fact"] = """
SELECT item.*, CAST(line_total - quantity * cost AS DECIMAL(18,2)) AS profit,
  heads.customer_key, heads.order_date, heads.status, heads.freight
FROM item JOIN heads USING (order_id)"""

CTES["place"] = """
SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"""

CTES["cdim"] = """
SELECT c_custkey AS customer_key, 'C' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS customer_number,
  c_name AS customer_name, CASE WHEN c_custkey % 10 < 3 THEN 'BUSINESS' ELSE 'INDIVIDUAL' END AS customer_type,
  c_mktsegment AS segment_name, 'user' || c_custkey || '@example.com' AS email,
  CAST(round(c_acctbal * 100) AS BIGINT) AS annual_income,
  DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS birth_date,
  DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS registration_date,
  CASE WHEN c_custkey % 13 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
  n_name AS billing_city, r_name AS billing_country
FROM customer JOIN place ON c_nationkey = n_nationkey"""

CTES["pdim"] = """
SELECT p_partkey AS product_key, 'P' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS product_number,
  p_name AS product_name, p_type AS category_name, p_brand AS supplier_name,
  CASE WHEN p_size <= 10 THEN 'COMPACT' WHEN p_size <= 30 THEN 'STANDARD' ELSE 'LARGE' END AS product_line,
  CAST(p_retailprice AS DECIMAL(10,2)) AS list_price,
  CAST(ROUND(CAST(p_retailprice AS DECIMAL(10,2)) * 0.70, 2) AS DECIMAL(10,2)) AS unit_cost,
  p_partkey % 10 = 0 AS discontinued
FROM part"""

CTES["rdim"] = """
SELECT s_suppkey AS sales_rep_key, s_name AS sales_rep_name, n_name AS territory_name,
  r_name AS region, n_name AS country, CASE WHEN s_suppkey % 10 = 0 THEN 0.08 ELSE 0.05 END AS commission_rate
FROM supplier JOIN place ON s_nationkey = n_nationkey"""

_CALENDAR = """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS date_actual,
  CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, left(dayname(d), 3) AS day_of_week_name,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  CAST(week(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month_number,
  left(monthname(d), 3) AS month_name, left(monthname(d), 3) AS month_abbr,
  CAST(quarter(d) AS INTEGER) AS quarter_number, 'Q' || quarter(d) AS quarter_name,
  CAST(year(d) AS INTEGER) AS year_number, dayofweek(d) IN (0, 6) AS is_weekend,
  CAST(CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS INTEGER) AS fiscal_year,
  CAST(CASE WHEN month(d) BETWEEN 7 AND 9 THEN 1 WHEN month(d) >= 10 THEN 2 WHEN month(d) <= 3 THEN 3 ELSE 4 END AS INTEGER) AS fiscal_quarter,
  CAST(CASE WHEN month(d) >= 7 THEN month(d) - 6 ELSE month(d) + 6 END AS INTEGER) AS fiscal_month,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) <= 5 THEN 'Spring' WHEN month(d) <= 8 THEN 'Summer' ELSE 'Fall' END AS season,
  CASE WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year''s Day'
    WHEN month(d) = 7 AND day(d) = 4 THEN 'Independence Day'
    WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas Day'
    WHEN month(d) = 11 AND dayofweek(d) = 4 AND day(d) BETWEEN 22 AND 28 THEN 'Thanksgiving'
    WHEN month(d) = 5 AND dayofweek(d) = 1 AND day(d) > 24 THEN 'Memorial Day'
    WHEN month(d) = 9 AND dayofweek(d) = 1 AND day(d) <= 7 THEN 'Labor Day' END AS holiday_name"""

CTES["day_list"] = """
SELECT CAST(x AS DATE) AS d FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM heads) AS b,
  generate_series(CAST(least(date_trunc('year', lo), DATE '1995-01-01') AS DATE),
    CAST(greatest(date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY, DATE '2029-12-31') AS DATE), INTERVAL 1 DAY) AS t(x)"""
CTES["cal_raw"] = _CALENDAR + " FROM day_list"
CTES["cal"] = "SELECT *, holiday_name IS NOT NULL AS is_holiday FROM cal_raw"
CTES["span_list"] = """
SELECT CAST(x AS DATE) AS d FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM heads) AS b,
  generate_series(CAST(date_trunc('year', lo) AS DATE), CAST(date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE), INTERVAL 1 DAY) AS t(x)"""
CTES["span_raw"] = _CALENDAR + " FROM span_list"
CTES["span_cal"] = "SELECT *, holiday_name IS NOT NULL AS is_holiday FROM span_raw"

CTES["market"] = """
SELECT * FROM (VALUES (1, 'AUTOMOBILE', 0.15), (2, 'BUILDING', 0.1), (3, 'FURNITURE', 0.05),
  (4, 'HOUSEHOLD', 0.0), (5, 'MACHINERY', 0.2)) AS t(segment_id, segment_name, discount_rate)"""
CTES["category"] = """
SELECT * FROM (VALUES (1, 'ECONOMY'), (2, 'LARGE'), (3, 'MEDIUM'), (4, 'PROMO'), (5, 'SMALL'), (6, 'STANDARD'))
  AS t(category_id, category_name)"""
CTES["brand"] = """
SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS supplier_id, p_brand AS supplier_name,
  'Land of ' || p_brand AS supplier_country FROM part"""
CTES["address"] = """
SELECT CAST(n_nationkey AS BIGINT) AS address_id, n_name AS city, r_name || '-' || n_name AS state_province,
  r_name AS country FROM place"""
CTES["cmaster"] = """
SELECT c_custkey AS customer_id, 'C' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS customer_number,
  CASE WHEN c_custkey % 10 < 3 THEN 'BUSINESS' ELSE 'INDIVIDUAL' END AS customer_type,
  CASE WHEN c_custkey % 10 < 3 THEN 'Company ' || c_custkey END AS company_name,
  CASE WHEN c_custkey % 10 >= 3 THEN 'First' || c_custkey END AS first_name,
  CASE WHEN c_custkey % 10 >= 3 AND c_custkey % 50 <> 7 THEN 'Last' || c_custkey END AS last_name,
  'user' || c_custkey || '@example.com' AS email,
  '555' || lpad(CAST(c_custkey % 10000000 AS VARCHAR), 7, '0') AS phone,
  CASE WHEN c_custkey % 25 <> 8 THEN DATE '1930-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) END AS birth_date,
  CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  CASE WHEN c_custkey % 20 <> 9 THEN CAST(round(c_acctbal * 100) AS BIGINT) END AS annual_income,
  CASE WHEN c_custkey % 40 <> 11 THEN CAST(market.segment_id AS BIGINT) END AS segment_id,
  CAST(c_nationkey AS BIGINT) AS billing_address_id, CAST((c_nationkey + c_custkey % 3) % 25 AS BIGINT) AS shipping_address_id,
  DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS registration_date,
  CASE WHEN c_custkey % 13 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
FROM customer JOIN market ON segment_name = c_mktsegment"""
CTES["pmaster"] = """
SELECT product_key AS product_id, product_number, product_name,
  CASE WHEN product_key % 30 = 0 THEN 9999 ELSE CAST(category.category_id AS BIGINT) END AS category_id,
  CAST(split_part(supplier_name, '#', 2) AS BIGINT) AS supplier_id,
  list_price AS unit_price, unit_cost AS cost, discontinued,
  100 + product_key % 400 AS units_in_stock, 10 + product_key % 40 AS reorder_level
FROM pdim JOIN category USING (category_name)"""
CTES["posn"] = """
SELECT * FROM (VALUES (1, 'SALES_REP', 'SALES', 45000, 75000), (2, 'SR_SALES_REP', 'SALES', 60000, 90000),
  (3, 'SALES_MGR', 'SALES', 80000, 120000), (4, 'MKT_SPEC', 'MKT', 50000, 70000))
  AS t(position_id, position_code, department_code, min_salary, max_salary)"""
CTES["emp"] = """
SELECT s_suppkey AS employee_id, 'EMP' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS employee_number,
  s_name AS full_name, s_suppkey % 4 + 1 AS position_id,
  DATE '1990-01-01' + CAST(s_suppkey * 53 % 4000 AS INTEGER) AS hire_date,
  CASE WHEN s_suppkey % 11 = 5 THEN 'TERMINATED' ELSE 'ACTIVE' END AS status,
  CASE WHEN s_suppkey > 0 THEN s_suppkey // 10 END AS manager_id, s_nationkey AS territory_id
FROM supplier"""
CTES["rep"] = """
SELECT employee_id AS sales_rep_id, employee_id, full_name, territory_id, hire_date,
  CASE position_code WHEN 'SR_SALES_REP' THEN 0.08::DOUBLE WHEN 'SALES_REP' THEN 0.05::DOUBLE ELSE 0.10::DOUBLE END AS commission_rate,
  status FROM emp JOIN posn USING (position_id) WHERE department_code = 'SALES'"""
CTES["ordertotal"] = f"""
SELECT heads.*, COALESCE(t.c, 0) AS subtotal_c, {{tax}} AS tax_c, {{total}} AS total_c
FROM heads LEFT JOIN (SELECT order_id, {s('line_total')} AS c FROM item GROUP BY 1) AS t USING (order_id)""".format(
    tax="CAST((COALESCE(t.c, 0) * 8 * 2 + 100) // 200 AS BIGINT)",
    total="CAST((COALESCE(t.c, 0) * 108 * 2 + 100) // 200 AS BIGINT)",
)
CTES["alloc"] = """
SELECT x.*, x.line_c + tax_part + freight_part AS net_c FROM (
  SELECT f.*, CAST(f.line_total * 100 AS HUGEINT) AS line_c,
    CAST((2 * CAST(f.line_total * 100 AS HUGEINT) * o.tax_c + o.subtotal_c) // (2 * o.subtotal_c) AS HUGEINT) AS tax_part,
    CAST((2 * CAST(f.line_total * 100 AS HUGEINT) * f.freight * 100 + o.subtotal_c) // (2 * o.subtotal_c) AS HUGEINT) AS freight_part
  FROM fact AS f JOIN ordertotal AS o USING (order_id) WHERE f.status = 'SHIPPED') AS x"""
