from oracles.base import AS_OF, big, draw_int, r2, s

SQL: dict[str, str] = {}

REQUESTS = """
req AS (SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS customer_id,
    o_orderkey % 10 AS sales_rep_id, CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE 1 + o_orderkey % 4 END AS n_items
  FROM orders),
ln AS (SELECT request_id, i AS line_number, (request_id * 7 + i * 13) % (SELECT COUNT(*) FROM part) AS product_id,
    1 + (request_id + i) % 9 AS quantity, 500 + (request_id * 11 + i * 101) % 9000 AS price_c,
    CASE WHEN i % 3 <> 0 THEN (request_id + i) % 20 ELSE 0 END AS pct
  FROM req, range(1, 5) AS t(i) WHERE i <= n_items AND customer_id IS NOT NULL),
lined AS (SELECT *, (quantity * price_c * (100 - pct) * 2 + 100) // 200 AS line_c FROM ln)"""
SQL["e07_processed_orders"] = f"""
WITH {REQUESTS},
t AS (SELECT request_id, SUM(line_c) AS c, COUNT(*) AS n FROM lined GROUP BY 1),
o AS (SELECT req.*, customer_id IS NOT NULL AS ok, {big('COALESCE(c, 0)')} AS c, COALESCE(n, 0) AS n,
    {big('(COALESCE(c, 0) * 16 + 100) // 200')} AS tax,
    'ORD20010801120000' || CASE WHEN rn < 10000 THEN lpad(CAST(rn AS VARCHAR), 4, '0') ELSE CAST(rn AS VARCHAR) END AS num
  FROM (SELECT *, 999 + row_number() OVER (ORDER BY request_id) AS rn FROM req) AS req LEFT JOIN t USING (request_id))
SELECT request_id, CASE WHEN ok THEN num END AS order_number, customer_id, sales_rep_id,
  CASE WHEN ok THEN {AS_OF} END AS order_date, CASE WHEN ok THEN {big('n')} END AS item_count,
  CASE WHEN ok THEN CAST(c AS DOUBLE) / 100 END AS subtotal, CASE WHEN ok THEN CAST(tax AS DOUBLE) / 100 END AS tax_amount,
  CASE WHEN ok THEN CAST(c + tax AS DOUBLE) / 100 END AS total_amount, CASE WHEN ok THEN 'PENDING' END AS status,
  CASE WHEN ok THEN 'Order processed successfully. Order Number: ' || num
    ELSE 'Error processing order: customer is missing' END AS message
FROM o"""
SQL["e07_processed_items"] = f"""
WITH {REQUESTS}
SELECT request_id, line_number, {big('product_id')} AS product_id, quantity, price_c / 100.0::DOUBLE AS unit_price,
  pct / 100.0::DOUBLE AS discount, CAST(line_c AS DOUBLE) / 100 AS line_total FROM lined"""
SQL["e07_stock_after_orders"] = f"""
WITH {REQUESTS}, g AS (SELECT product_id, SUM(quantity) AS n FROM lined GROUP BY 1)
SELECT pmaster.product_id, 'MAIN' AS location_code, units_in_stock AS quantity_on_hand,
  {big('units_in_stock - COALESCE(n, 0)')} AS quantity_available, {big('COALESCE(n, 0)')} AS quantity_allocated
FROM pmaster LEFT JOIN g ON g.product_id = pmaster.product_id"""
SQL["e08_onboarded_customers"] = f"""
WITH n AS (SELECT *, row_number() OVER (ORDER BY customer_id) AS rn FROM cmaster)
SELECT rn AS customer_id, 'C' || lpad(CAST(rn + 99999 AS VARCHAR), 8, '0') AS customer_number, customer_type, company_name,
  first_name, last_name, email, phone, annual_income,
  CASE WHEN annual_income >= 1000000 THEN 1 WHEN annual_income >= 100000 THEN 2 WHEN annual_income >= 10000 THEN 3 ELSE 4 END AS segment_id,
  rn AS billing_address_id, rn AS shipping_address_id, {AS_OF} AS registration_date, 'ACTIVE' AS status,
  'Customer onboarded successfully. Customer Number: C' || lpad(CAST(rn + 99999 AS VARCHAR), 8, '0') AS message
FROM n"""
SQL["e08_onboarded_addresses"] = """
SELECT row_number() OVER (ORDER BY customer_id) AS address_id, customer_id || ' Main St' AS address_line_1, city, country,
  'BILLING' AS address_type FROM cmaster JOIN address ON billing_address_id = address_id"""

MOVES = f"""
ids AS (SELECT row_number() OVER (ORDER BY order_id, line_number, product_key, sales_rep_key, quantity, discount, tax_rate, shipped_date) AS seq, * FROM item),
mv AS (SELECT seq, product_key AS product_id, CASE WHEN seq % 103 = 0 THEN 'NORTH' ELSE 'MAIN' END AS location_code,
    {big('quantity')} AS quantity, CASE WHEN seq % 101 = 0 THEN 'SCRAP' WHEN seq % 5 = 0 THEN 'ADJUSTMENT'
      WHEN seq % 5 = 1 THEN 'RETURN' ELSE 'RECEIPT' END AS kind FROM ids),
ok AS (SELECT mv.*, units_in_stock AS opening, reorder_level FROM mv JOIN pmaster USING (product_id)
  WHERE location_code = 'MAIN' AND kind <> 'SCRAP'),
seg AS (SELECT *, SUM(CASE WHEN kind = 'ADJUSTMENT' THEN 1 ELSE 0 END) OVER (PARTITION BY product_id ORDER BY seq) AS sg FROM ok),
bal AS (SELECT *, {big('SUM(quantity) OVER (PARTITION BY product_id, sg ORDER BY seq) + CASE WHEN sg = 0 THEN opening ELSE 0 END')} AS balance FROM seg)"""
SQL["w06_item_ids"] = f"""
SELECT order_id, line_number, product_key, sales_rep_key, {big('quantity')} AS quantity,
  row_number() OVER (ORDER BY order_id, line_number, product_key, sales_rep_key, quantity, discount, tax_rate, shipped_date) AS order_item_id FROM item"""
SQL["e09_stock_after_moves"] = f"""
WITH {MOVES}, e AS (SELECT product_id, max_by(balance, seq) AS q, bool_or(kind IN ('RECEIPT', 'RETURN')) AS got FROM bal GROUP BY 1)
SELECT pmaster.product_id, 'MAIN' AS location_code, COALESCE(q, units_in_stock) AS quantity_on_hand,
  COALESCE(q, units_in_stock) AS quantity_available, CASE WHEN got THEN {AS_OF} END AS last_received_date
FROM pmaster LEFT JOIN e USING (product_id)"""
SQL["e09_stock_messages"] = f"""
WITH {MOVES}
SELECT seq, balance, CASE WHEN balance <= reorder_level THEN 'Inventory updated. WARNING: Stock level below reorder point for Product ID: ' || product_id
  ELSE 'Inventory updated successfully for Product ID: ' || product_id || ', New quantity: ' || balance END AS message FROM bal
UNION ALL SELECT seq, NULL, CASE WHEN location_code <> 'MAIN' THEN 'Unknown stock location: ' || location_code
  ELSE 'Invalid transaction type: ' || kind END FROM mv WHERE location_code <> 'MAIN' OR kind = 'SCRAP'"""

REPTOTAL = f"""
rt AS (SELECT sales_rep_key AS sales_rep_id, order_id, order_date, status, ({s('line_total')} * 216 + 100) // 200 AS total_c
  FROM fact GROUP BY ALL)"""
SQL["e10_sales_commission"] = f"""
WITH {REPTOTAL}, g AS (SELECT sales_rep_id, SUM(total_c) AS c FROM rt
  WHERE status = 'SHIPPED' AND order_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31' GROUP BY 1)
SELECT employee_id, sales_rep_id, commission_rate, CAST(COALESCE(c, 0) AS DOUBLE) / 100 AS total_sales,
  {r2('COALESCE(c, 0) * CAST(round(commission_rate * 100) AS BIGINT)', '100')} AS commission
FROM rep LEFT JOIN g USING (sales_rep_id)"""

_PAY = f"""
per AS (SELECT employee_id, min_salary, max_salary, CAST(DATE '2001-01-01' + CAST(i * 14 AS INTEGER) AS DATE) AS start
  FROM emp JOIN posn USING (position_id), range(0, 26) AS t(i) WHERE status = 'ACTIVE' AND DATE '2001-01-01' + CAST(i * 14 AS INTEGER) <= {AS_OF}),
pk AS (SELECT *, strftime(start, '%Y%m%d') AS k FROM per),
ann AS (SELECT *, CAST(min_salary * 100 + (max_salary - min_salary) * {draw_int('salary', 3000, 8000, 'employee_id', 'k')} // 100 AS BIGINT) AS a,
  {draw_int('overtime', 0, 8, 'employee_id', 'k')} AS hours,
  CASE WHEN month(start) IN (3, 6, 9, 12) THEN {draw_int('bonus', 500, 2000, 'employee_id', 'k')} * 100 ELSE 0 END AS bonus FROM pk),
b AS (SELECT *, (2 * a + 26) // 52 AS base, (6 * a + 4160) // 8320 AS rate FROM ann),
g AS (SELECT *, hours * rate AS ot, base + hours * rate + bonus AS gross FROM b),
t AS (SELECT *, (gross * 2200 * 2 + 10000) // 20000 AS fed, (gross * 500 * 2 + 10000) // 20000 AS st,
  (gross * 620 * 2 + 10000) // 20000 AS soc, (gross * 145 * 2 + 10000) // 20000 AS med,
  (gross * 600 * 2 + 10000) // 20000 AS ret FROM g),
pay AS (SELECT *, fed + st + soc + med + 35000 + ret + 5000 AS ded FROM t)"""


def _m(x: str, name: str) -> str:
    return f"CAST({x} AS DOUBLE) / 100 AS {name}"


SQL["e11_payroll"] = f"""
WITH {_PAY}
SELECT employee_id, start AS pay_period_start, start + 13 AS pay_period_end, start + 16 AS pay_date, {_m('base', 'base_salary')},
  hours AS overtime_hours, {_m('rate', 'overtime_rate')}, {_m('ot', 'overtime_pay')}, {_m('bonus', 'bonus')}, {_m('gross', 'gross_pay')},
  {_m('fed', 'federal_tax')}, {_m('st', 'state_tax')}, {_m('soc', 'social_security')}, {_m('med', 'medicare')},
  {_m('35000', 'health_insurance')}, {_m('ret', 'retirement_401k')}, {_m('5000', 'other_deductions')},
  {_m('ded', 'total_deductions')}, {_m('gross - ded', 'net_pay')} FROM pay"""
SQL["e10_payroll_with_commission"] = f"""
WITH {REPTOTAL}, {_PAY},
e AS (SELECT p.employee_id, p.start, SUM(total_c * CAST(round(commission_rate * 100) AS BIGINT)) AS c
  FROM pay AS p JOIN rep USING (employee_id) JOIN rt ON rt.sales_rep_id = rep.sales_rep_id AND rt.status = 'SHIPPED'
    AND rt.order_date BETWEEN p.start AND p.start + 13 GROUP BY 1, 2),
x AS (SELECT pay.*, COALESCE((2 * c + 100) // 200, 0) AS com FROM pay JOIN rep USING (employee_id) LEFT JOIN e USING (employee_id, start))
SELECT employee_id, start AS pay_period_start, {_m('com', 'commission')}, {_m('gross + com', 'gross_pay')},
  {_m('gross + com - ded', 'net_pay')} FROM x"""

_STRENGTH = ("Strong technical skills, excellent communication", "Leadership abilities, team collaboration",
             "Problem-solving skills, initiative", "Customer focus, reliability", "Innovation, adaptability")
_IMPROVE = ("Time management, project planning", "Documentation, process improvement",
            "Cross-functional collaboration", "Strategic thinking, delegation")


def _pick(texts, salt: str) -> str:
    options = ", ".join(f"'{t}'" for t in texts)
    return f"list_extract([{options}], {draw_int(salt, 1, len(texts), 'employee_id')})"


SQL["e12_performance_reviews"] = f"""
SELECT employee_id, DATE '2000-01-01' AS review_period_start, DATE '2000-12-31' AS review_period_end, manager_id AS reviewer_id,
  {draw_int('score', 250, 450, 'employee_id')} / 100.0::DOUBLE AS performance_score, {draw_int('goals', 3, 8, 'employee_id')} AS goals_met,
  8 AS total_goals, {_pick(_STRENGTH, 'strength')} AS strengths, {_pick(_IMPROVE, 'improve')} AS areas_for_improvement,
  'Focus on professional development courses and mentoring opportunities' AS development_plan,
  CASE WHEN {draw_int('raise_score', 250, 450, 'employee_id')} >= 350 THEN {draw_int('raise_high', 3, 8, 'employee_id')}
    ELSE {draw_int('raise_low', 0, 3, 'employee_id')} END AS salary_increase_percent,
  {draw_int('promotion', 250, 450, 'employee_id')} >= 400 AS promotion_eligible
FROM emp WHERE status = 'ACTIVE' AND hire_date <= {AS_OF} - INTERVAL 12 MONTH AND manager_id IS NOT NULL"""
