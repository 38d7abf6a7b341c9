from oracles.base import AS_OF, avg2, big, dbl, draw_int, pct, r2, s

SQL: dict[str, str] = {}

SQL["b01_date_dimension"] = "SELECT * EXCLUDE (holiday_name, is_holiday) FROM span_cal"
SQL["b02_holidays"] = "SELECT date_key, date_actual, day_of_week, holiday_name FROM span_cal WHERE is_holiday"
SQL["b03_extended_dates"] = """
SELECT date_actual, CAST(epoch(date_actual) AS BIGINT) AS epoch,
  CASE WHEN day_of_month IN (1, 21, 31) THEN 'st' WHEN day_of_month IN (2, 22) THEN 'nd'
       WHEN day_of_month IN (3, 23) THEN 'rd' ELSE 'th' END AS day_suffix,
  CAST(day_of_year - dayofyear(date_trunc('quarter', date_actual)) + 1 AS INTEGER) AS day_of_quarter,
  CAST(ceil(day_of_month / 7.0) AS INTEGER) AS week_of_month,
  CAST(date_trunc('week', date_actual) AS DATE) AS first_day_of_week,
  CAST(date_trunc('week', date_actual) AS DATE) + 6 AS last_day_of_week,
  CAST(date_trunc('month', date_actual) AS DATE) AS first_day_of_month, last_day(date_actual) AS last_day_of_month,
  CAST(date_trunc('quarter', date_actual) AS DATE) AS first_day_of_quarter,
  CAST(date_trunc('quarter', date_actual) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS last_day_of_quarter,
  make_date(year_number, 1, 1) AS first_day_of_year, make_date(year_number, 12, 31) AS last_day_of_year,
  NOT is_weekend AS is_weekday
FROM span_cal"""
SQL["b04_calendar_check"] = f"""
SELECT {big('COUNT(*)')} AS total_records, MIN(date_actual) AS start_date, MAX(date_actual) AS end_date,
  {big('COUNT(CASE WHEN is_holiday THEN 1 END)')} AS holiday_count FROM span_cal"""

AGE = f"(year({AS_OF}) - year(birth_date))"
SQL["b05_customer_source"] = f"""
SELECT customer_id, customer_number, COALESCE(company_name, first_name || ' ' || last_name) AS customer_name,
  customer_type, company_name, email, phone, birth_date, gender,
  CASE WHEN birth_date IS NULL THEN 'Unknown' WHEN {AGE} < 25 THEN '18-24' WHEN {AGE} < 35 THEN '25-34'
    WHEN {AGE} < 45 THEN '35-44' WHEN {AGE} < 55 THEN '45-54' WHEN {AGE} < 65 THEN '55-64' ELSE '65+' END AS age_group,
  annual_income,
  CASE WHEN annual_income < 30000 THEN 'Low' WHEN annual_income < 75000 THEN 'Medium'
    WHEN annual_income < 150000 THEN 'High' ELSE 'Very High' END AS income_category,
  segment_name, b.city AS billing_city, b.state_province AS billing_state, b.country AS billing_country,
  t.city AS shipping_city, t.state_province AS shipping_state, t.country AS shipping_country,
  registration_date, status
FROM cmaster LEFT JOIN market USING (segment_id)
LEFT JOIN address AS b ON billing_address_id = b.address_id
LEFT JOIN address AS t ON shipping_address_id = t.address_id"""
SQL["b06_product_source"] = """
SELECT product_id, product_number, product_name, category_name, category_name AS category_hierarchy,
  supplier_name, supplier_country, CAST(unit_price AS DOUBLE) AS unit_price, CAST(cost AS DOUBLE) AS cost, discontinued
FROM pmaster LEFT JOIN category USING (category_id) LEFT JOIN brand USING (supplier_id)"""
OPEN = "DATE '9999-12-31' AS expiry_date, TRUE AS is_current, 1 AS version"
SQL["b07_initial_customer_dim"] = f"""
SELECT customer_id AS customer_key, customer_id, customer_number, customer_type, company_name, first_name, last_name,
  email, segment_name, city, state_province, country, registration_date, status, annual_income,
  registration_date AS effective_date, {OPEN}
FROM cmaster JOIN market USING (segment_id) JOIN address ON billing_address_id = address_id"""
SQL["b07_initial_product_dim"] = f"""
SELECT product_id AS product_key, product_id, product_number, product_name, category_name, supplier_name,
  CAST(unit_price AS DOUBLE) AS unit_price, CAST(cost AS DOUBLE) AS cost, discontinued,
  {AS_OF} AS effective_date, {OPEN}
FROM pmaster JOIN category USING (category_id) JOIN brand USING (supplier_id)"""
SQL["b07_initial_rep_dim"] = f"""
SELECT sales_rep_id AS sales_rep_key, sales_rep_id, employee_id, full_name, n_name AS territory_name, hire_date,
  commission_rate, hire_date AS effective_date, {OPEN}
FROM rep JOIN place ON territory_id = n_nationkey"""
SQL["b08_sales_reps"] = "SELECT * FROM rep"
SQL["b09_sales_fact"] = f"""
SELECT CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS order_date_key, customer_key, product_key, sales_rep_key,
  order_id, line_number, {big('quantity')} AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(ROUND(quantity * unit_price * discount, 2) AS DOUBLE) AS discount_amount,
  CAST(line_total AS DOUBLE) AS line_total, CAST(tax_part AS DOUBLE) / 100 AS tax_amount,
  CAST(freight_part AS DOUBLE) / 100 AS freight_amount, CAST(net_c AS DOUBLE) / 100 AS net_amount,
  CAST(cost AS DOUBLE) AS cost, CAST(profit AS DOUBLE) AS profit
FROM alloc"""
SQL["b10_order_totals"] = """
SELECT order_id, CAST(subtotal_c AS DOUBLE) / 100 AS subtotal, CAST(tax_c AS DOUBLE) / 100 AS tax_amount,
  CAST(total_c AS DOUBLE) / 100 AS total_amount FROM ordertotal"""
SQL["b11_customer_totals"] = f"""
SELECT cdim.customer_key AS customer_id, customer_number, {big('COALESCE(n, 0)')} AS total_orders,
  CAST(COALESCE(spent, 0) AS DOUBLE) / 100 AS total_spent, last_order_date
FROM cdim LEFT JOIN (SELECT customer_key, COUNT(*) AS n, SUM(total_c) AS spent, MAX(order_date) AS last_order_date
  FROM ordertotal GROUP BY 1) AS t USING (customer_key)"""
SQL["b12_customer_ltv"] = f"""
WITH t AS (SELECT cdim.customer_key, registration_date, COUNT(DISTINCT order_id) AS n, COUNT(order_id) AS lines,
    COALESCE(SUM(net_c), 0) AS net,
    CAST(date_diff('month', registration_date, {AS_OF}) AS INTEGER) AS months
  FROM cdim LEFT JOIN alloc USING (customer_key) GROUP BY 1, 2)
SELECT 20010801 AS calculation_date_key, customer_key, {big('n')} AS total_orders, CAST(net AS DOUBLE) / 100 AS total_revenue,
  COALESCE({r2('net', 'lines')}, 0.0) AS average_order_value, months AS months_active,
  {r2('net * greatest(months, 1) * 12', '10')} AS predicted_ltv,
  CASE WHEN net > 5000000 THEN 'A' WHEN net > 2000000 THEN 'B' WHEN net > 500000 THEN 'C' ELSE 'D' END AS customer_score,
  CASE WHEN months > 12 AND n = 0 THEN 'High Risk' WHEN months > 6 AND n <= 1 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_segment
FROM t"""
SQL["b13_product_performance"] = f"""
WITH ends AS (SELECT date_key, date_actual AS d FROM cal WHERE date_actual = last_day(date_actual)
    AND date_actual <= {AS_OF} AND date_actual >= {AS_OF} - INTERVAL 12 MONTH),
sold AS (SELECT product_key, last_day(order_date) AS d, SUM(quantity) AS units, SUM(line_total) AS revenue
  FROM fact WHERE order_date <= {AS_OF} GROUP BY 1, 2),
g AS (SELECT date_key, pdim.product_key, COALESCE(units, 0) AS units, COALESCE(revenue, 0) AS revenue, list_price,
    CASE WHEN units IS NULL THEN 0 ELSE list_price - unit_cost END AS gain
  FROM ends CROSS JOIN pdim LEFT JOIN sold ON sold.product_key = pdim.product_key AND sold.d = ends.d)
SELECT date_key, product_key, {big('units')} AS units_sold, CAST(revenue AS DOUBLE) AS revenue,
  {r2('gain * 100 * 10000', 'list_price * 100', 4)} AS profit_margin,
  {draw_int('turns', 1, 12, 'date_key', 'product_key')} AS inventory_turns,
  {draw_int('returns', 100, 500, 'date_key', 'product_key')} / 10000.0::DOUBLE AS return_rate,
  {draw_int('liking', 350, 500, 'date_key', 'product_key')} / 100.0::DOUBLE AS customer_satisfaction,
  CASE WHEN revenue > 10000 AND gain * 10 > list_price * 3 THEN 'A' WHEN revenue > 5000 AND gain * 10 > list_price * 2 THEN 'B'
    WHEN revenue > 1000 AND gain * 10 > list_price THEN 'C' ELSE 'D' END AS performance_score
FROM g"""
SQL["b14_customer_analytics"] = f"""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_date,
  CAST(strftime(date_trunc('month', order_date), '%Y%m%d') AS INTEGER) AS date_key, customer_id, segment_id,
  {big('COUNT(DISTINCT order_id)')} AS total_orders, {dbl('line_total')} AS total_amount, {dbl('profit')} AS total_profit,
  {avg2('line_total')} AS average_order_value, MAX(order_date) AS last_order_date
FROM fact JOIN cmaster ON customer_id = customer_key GROUP BY ALL"""
SQL["b15_initial_inventory"] = f"""
SELECT product_id, 'MAIN' AS location_code, units_in_stock AS quantity_on_hand, units_in_stock AS quantity_available,
  {big('0')} AS quantity_allocated, reorder_level AS reorder_point, reorder_level * 5 AS max_stock_level,
  {AS_OF} AS last_count_date, CAST(cost AS DOUBLE) AS average_cost, CAST(cost AS DOUBLE) AS last_cost FROM pmaster"""
SQL["b16_inventory_after_shipping"] = f"""
WITH sold AS (SELECT product_key AS product_id, SUM(quantity) AS n FROM fact WHERE status = 'SHIPPED' GROUP BY 1)
SELECT product_id, 'MAIN' AS location_code, {big('greatest(units_in_stock - COALESCE(n, 0), 0)')} AS quantity_on_hand,
  {big('greatest(units_in_stock - COALESCE(n, 0), 0)')} AS quantity_available, {big('0')} AS quantity_allocated,
  reorder_level AS reorder_point, {AS_OF} AS last_count_date
FROM pmaster LEFT JOIN sold USING (product_id)"""
SQL["b17_customer_addresses"] = """
SELECT customer_id, billing_address_id AS address_id, 'BILLING' AS address_type, TRUE AS is_default FROM cmaster
UNION ALL SELECT customer_id, shipping_address_id, 'SHIPPING', TRUE FROM cmaster WHERE shipping_address_id <> billing_address_id"""
SQL["b18_managers"] = """
SELECT e.employee_id, e.employee_number, e.manager_id, b.employee_number AS manager_number, b.full_name AS manager_name
FROM emp AS e LEFT JOIN emp AS b ON e.manager_id = b.employee_id"""
# Employee numbers are their ids, so the chain of command is the id's leading digits.
SQL["j13_reporting_lines"] = """
WITH up AS (SELECT employee_id, employee_number, manager_id, len(CAST(employee_id AS VARCHAR)) AS n FROM emp),
steps AS (SELECT employee_id, unnest(range(0, n)) AS i, n FROM up),
chain AS (SELECT s.employee_id, n - i AS pos, e.employee_number FROM steps AS s
  JOIN emp AS e ON e.employee_id = s.employee_id // CAST(10 ** s.i AS BIGINT)
  UNION ALL SELECT employee_id, 0, (SELECT employee_number FROM emp WHERE employee_id = 0) FROM up WHERE employee_id > 0)
SELECT employee_id, string_agg(employee_number, ' > ' ORDER BY pos) AS path, COUNT(*) - 1 AS depth FROM chain GROUP BY 1"""
SOURCE = SQL["b05_customer_source"]
_OLD = f"""
src AS ({SOURCE}),
old AS (SELECT * REPLACE (
    CASE WHEN customer_id % 5 = 0 THEN annual_income - 100 WHEN customer_id % 6 = 1 THEN NULL ELSE annual_income END AS annual_income,
    CASE WHEN customer_id % 11 = 3 THEN 'PENDING' ELSE status END AS status,
    CASE WHEN customer_id % 4 = 1 THEN '000' ELSE phone END AS phone)
  FROM src WHERE registration_date < DATE '1994-11-01')"""
_COLS = "{a}.customer_id, {a}.customer_name, {a}.email, {a}.phone, {a}.annual_income, {a}.status"
_DIFF = """(old.customer_name IS DISTINCT FROM src.customer_name OR old.email IS DISTINCT FROM src.email
  OR old.annual_income IS DISTINCT FROM src.annual_income OR old.status IS DISTINCT FROM src.status)"""
SQL["m07_merged_customers"] = f"""
WITH {_OLD}
SELECT {_COLS.format(a='old')}, DATE '2000-01-01' AS effective_date,
  CASE WHEN {_DIFF} THEN {AS_OF} ELSE DATE '9999-12-31' END AS expiry_date, NOT {_DIFF} AS is_current, 1 AS version
FROM old JOIN src USING (customer_id)
UNION ALL
SELECT {_COLS.format(a='src')}, {AS_OF}, DATE '9999-12-31', TRUE, CASE WHEN old.customer_id IS NULL THEN 1 ELSE 2 END
FROM src LEFT JOIN old USING (customer_id) WHERE old.customer_id IS NULL OR {_DIFF}"""
_PLAIN = """COALESCE(old.customer_name <> src.customer_name, FALSE) OR COALESCE(old.email <> src.email, FALSE)
  OR COALESCE(old.annual_income <> src.annual_income, FALSE) OR COALESCE(old.status <> src.status, FALSE)"""
SQL["m07_merged_customers_single_pass"] = f"""
WITH {_OLD}
SELECT old.customer_id, old.annual_income, old.status,
  CASE WHEN {_PLAIN} THEN {AS_OF} ELSE DATE '9999-12-31' END AS expiry_date, NOT ({_PLAIN}) AS is_current, 1 AS version
FROM old JOIN src USING (customer_id)
UNION ALL SELECT customer_id, annual_income, status, DATE '9999-12-31', TRUE, 1 FROM src
WHERE customer_id NOT IN (SELECT customer_id FROM old)"""
SQL["m08_merged_products"] = f"""
WITH src AS ({SQL['b06_product_source']}),
old AS (SELECT * REPLACE (CASE WHEN product_id % 8 = 3 THEN CAST(CAST(unit_price AS DECIMAL(10,2)) - 1 AS DOUBLE) ELSE unit_price END AS unit_price,
    product_id % 12 = 5 OR discontinued AS discontinued) FROM src WHERE supplier_name <> 'Brand#7'),
d AS (SELECT src.product_id, old.product_id AS old_id,
    old.unit_price <> src.unit_price OR old.discontinued <> src.discontinued AS changed
  FROM src LEFT JOIN old USING (product_id))
SELECT old.product_id, product_name, category_name, unit_price, discontinued, DATE '2000-01-01' AS effective_date,
  CASE WHEN changed THEN {AS_OF} ELSE DATE '9999-12-31' END AS expiry_date, NOT changed AS is_current, 1 AS version
FROM old JOIN d USING (product_id)
UNION ALL SELECT src.product_id, product_name, category_name, unit_price, discontinued, {AS_OF}, DATE '9999-12-31', TRUE,
  CASE WHEN old_id IS NULL THEN 1 ELSE 2 END
FROM src JOIN d USING (product_id) WHERE old_id IS NULL OR changed"""

for _name, _on in (("b09_orders_by_version", "effective_date <= order_date AND order_date < expiry_date"), ("b09_orders_by_current_version", "is_current")):
    SQL[_name] = f"""
SELECT version, CAST(year(order_date) AS INTEGER) AS year, {big('COUNT(*)')} AS n_orders
FROM heads LEFT JOIN ({SQL['m07_merged_customers']}) AS d ON d.customer_id = customer_key AND {_on} GROUP BY 1, 2"""
