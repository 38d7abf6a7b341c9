from oracles.base import AS_OF, big, draw, draw_int, s

SQL: dict[str, str] = {}


def idx(salt: str, table: str, *keys: str) -> str:
    return f"CAST(floor({draw(salt, *keys)} * (SELECT COUNT(*) FROM {table})) AS BIGINT)"


SQL["g00_draws"] = f"""
SELECT customer_key AS customer_id, round({draw('demo', 'customer_key')}, 9) AS draw,
  {draw_int('demo_int', 1, 6, 'customer_key')} AS die FROM cdim"""

K = ("customer_key", "copy")
SQL["g01_synth_orders"] = f"""
WITH r AS (SELECT sales_rep_key, row_number() OVER (ORDER BY sales_rep_key) - 1 AS rep_no FROM rdim),
b AS (SELECT cdim.*, copy, CAST({AS_OF} - CAST({draw_int('age', 1, 365, *K)} AS INTEGER) AS DATE) AS order_date,
    {idx('rep', 'supplier', *K)} AS rep_no FROM cdim, range(1, 6) AS t(copy)),
o AS (SELECT row_number() OVER (ORDER BY customer_key, copy) AS order_id, customer_key AS customer_id, sales_rep_key AS sales_rep_id, order_date,
    order_date + CAST({draw_int('promise', 7, 21, *K)} AS INTEGER) AS required_date,
    CASE WHEN {draw_int('ships', 1, 10, *K)} <= 8 THEN order_date + CAST({draw_int('transit', 1, 14, *K)} AS INTEGER) END AS shipped_date,
    list_extract(['FedEx', 'UPS', 'DHL'], {draw_int('carrier', 1, 3, *K)}) AS ship_via,
    {draw_int('freight', 10, 100, *K)} AS freight, customer_name AS ship_name, billing_city AS ship_city
  FROM b JOIN r USING (rep_no))
SELECT *, 'ORD' || CASE WHEN order_id < 1000000 THEN lpad(CAST(order_id AS VARCHAR), 6, '0') ELSE CAST(order_id AS VARCHAR) END AS order_number,
  CASE WHEN shipped_date IS NOT NULL THEN 'SHIPPED' WHEN order_date <= {AS_OF} - 7 THEN 'PROCESSING' ELSE 'PENDING' END AS status FROM o"""

K = ("order_id", "slot")
SQL["g02_synth_order_items"] = f"""
WITH b AS (SELECT order_id, slot, segment_id, CAST(round(discount_rate * 100) AS BIGINT) AS rate
  FROM heads JOIN cmaster ON customer_id = customer_key JOIN market USING (segment_id), range(1, 16) AS t(slot)),
h AS (SELECT *, {idx('product', 'part', *K)} AS product_no FROM b
  WHERE {draw_int('buys', 1, 100, *K)} <= CASE segment_id WHEN 1 THEN 40 WHEN 2 THEN 25 WHEN 3 THEN 15 ELSE 8 END),
p AS (SELECT product_key, list_price, row_number() OVER (ORDER BY product_key) - 1 AS product_no FROM pdim),
x AS (SELECT order_id, slot, product_key AS product_id,
    CASE segment_id WHEN 1 THEN {draw_int('qty', 20, 100, *K)} WHEN 2 THEN {draw_int('qty', 5, 50, *K)}
      WHEN 3 THEN {draw_int('qty', 2, 20, *K)} ELSE {draw_int('qty', 1, 5, *K)} END AS quantity, list_price,
    CASE segment_id WHEN 1 THEN rate + {draw_int('disc', 0, 5, *K)} WHEN 2 THEN rate + {draw_int('disc', 0, 3, *K)} ELSE rate END AS pct
  FROM h JOIN p USING (product_no))
SELECT order_id, slot, product_id, quantity, CAST(list_price AS DOUBLE) AS unit_price, pct / 100.0::DOUBLE AS discount,
  CAST((2 * quantity * CAST(list_price * 100 AS BIGINT) * (100 - pct) + 100) // 200 AS DOUBLE) / 100 AS line_total FROM x"""

K = ("customer_key", "pick")
SQL["g03_synth_facts"] = f"""
WITH b AS (SELECT customer_key, pick, {idx('fact_product', 'part', *K)} AS product_no,
    DATE '2024-01-01' + CAST({draw_int('fact_day', 0, 365, *K)} AS INTEGER) AS d,
    {draw_int('fact_qty', 1, 10, *K)} AS q, {draw_int('fact_disc', 0, 2000, *K)} AS bp FROM cdim, range(1, 4) AS t(pick)),
p AS (SELECT product_key, unit_cost, CAST(list_price * 100 AS BIGINT) AS pc, row_number() OVER (ORDER BY product_key) - 1 AS product_no FROM pdim),
x AS (SELECT *, (2 * pc * bp + 10000) // 20000 AS dc, row_number() OVER (ORDER BY customer_key, product_key, pick) AS n FROM b JOIN p USING (product_no))
SELECT 'ORD-' || lpad(CAST(n AS VARCHAR), 8, '0') AS order_number, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
  customer_key AS customer_id, product_key AS product_id, 1 AS sales_rep_id, 1 AS territory_id, q AS quantity_ordered,
  CAST(pc AS DOUBLE) / 100 AS unit_price, CAST(dc AS DOUBLE) / 100 AS discount_amount, CAST(q * pc - dc AS DOUBLE) / 100 AS line_total,
  CAST(q * unit_cost AS DOUBLE) AS cost_amount, CAST(q * pc - dc - CAST(q * unit_cost * 100 AS BIGINT) AS DOUBLE) / 100 AS profit_amount
FROM x"""
SQL["g04_address_assignment"] = f"""
WITH w AS (SELECT customer_key, unnest(range(1, 2 + customer_key % 3)) AS slot FROM cdim),
sl AS (SELECT *, row_number() OVER (ORDER BY customer_key, slot) AS n FROM w),
st AS (SELECT order_id AS address_id, CASE WHEN order_id % 2 = 0 THEN 'BILLING' ELSE 'SHIPPING' END AS address_type, billing_city, billing_country,
  row_number() OVER (ORDER BY order_id) AS n FROM heads JOIN cdim USING (customer_key))
SELECT customer_key AS customer_id, address_id, address_type, billing_city AS state_province, billing_country AS country,
  n = 1 OR {draw('default', 'address_id')} < 0.3 AS is_default FROM sl JOIN st USING (n)"""

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
SQL["o01_execution_stats"] = f"""
SELECT {big('COUNT(*)')} AS execution_count,
  CAST((2 * {s('CAST(value AS DECIMAL(12,2))')} + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100 AS avg_execution_time,
  MAX(value) AS max_execution_time
FROM events WHERE event_type LIKE '%e%' AND ts >= {NOW} - INTERVAL 24 HOUR"""
SQL["o02_slow_entries"] = f"""
SELECT event_id, user_id, event_type, value FROM events WHERE value > 300 AND ts >= {NOW} - INTERVAL 24 HOUR
ORDER BY value DESC, event_id"""
SQL["o03_cost_per_day"] = f"""
SELECT event_type, CAST(ts AS DATE) AS usage_date, CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_credits,
  CAST(SUM(CAST(value AS DECIMAL(12,2))) * 2 AS DOUBLE) AS estimated_cost_usd
FROM events WHERE ts >= {NOW} - INTERVAL 720 HOUR GROUP BY 1, 2"""
SQL["o04_access_patterns"] = f"""
SELECT user_id, event_type, {big('COUNT(*)')} AS access_count, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_access
FROM events WHERE ts >= {NOW} - INTERVAL 168 HOUR GROUP BY 1, 2"""
SQL["o05_slowest"] = f"""
SELECT event_id, event_type, value FROM events WHERE ts >= {NOW} - INTERVAL 1 HOUR ORDER BY value DESC, event_id LIMIT 10"""
