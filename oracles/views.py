from oracles.base import avg2, big, dbl, pct, r2, s

SQL: dict[str, str] = {}
ORDERS = f"{big('COUNT(DISTINCT order_id)')} AS total_orders"
CUSTOMERS = f"{big('COUNT(DISTINCT customer_key)')} AS unique_customers"
REVENUE = f"{dbl('line_total')} AS total_revenue"
PROFIT = f"{dbl('profit')} AS total_profit"
AVG = f"{avg2('line_total')} AS avg_order_value"
MARGIN = f"{pct('profit', 'line_total')} AS profit_margin_percent"

SQL["v01_monthly_sales_summary"] = f"""
SELECT year_number, month_number, month_name, {ORDERS}, {big('SUM(quantity)')} AS total_units_sold,
  {REVENUE}, {dbl('quantity * cost')} AS total_cost, {PROFIT}, {AVG}, {MARGIN}
FROM fact JOIN cal ON order_date = date_actual GROUP BY ALL"""

SQL["v02_quarterly_sales_performance"] = f"""
SELECT year_number, quarter_number, quarter_name, {ORDERS}, {CUSTOMERS}, {REVENUE}, {PROFIT}, {AVG},
  {r2(s('line_total'), 'COUNT(DISTINCT customer_key)')} AS revenue_per_customer
FROM fact JOIN cal ON order_date = date_actual GROUP BY ALL"""

SQL["v03_sales_rep_performance"] = f"""
SELECT sales_rep_name, territory_name, region, {ORDERS}, {CUSTOMERS}, {REVENUE}, {PROFIT}, {AVG},
  {r2(s('line_total'), 'COUNT(DISTINCT order_id)')} AS avg_order_size, {MARGIN}
FROM fact JOIN rdim USING (sales_rep_key) GROUP BY ALL"""

SQL["v04_territory_sales_analysis"] = f"""
SELECT territory_name, region, country, {big('COUNT(DISTINCT sales_rep_key)')} AS active_sales_reps,
  {ORDERS}, {CUSTOMERS}, {REVENUE}, {PROFIT},
  {r2(s('line_total'), 'COUNT(DISTINCT sales_rep_key)')} AS revenue_per_rep,
  {r2(s('line_total'), 'COUNT(DISTINCT customer_key)')} AS revenue_per_customer
FROM fact JOIN rdim USING (sales_rep_key) GROUP BY ALL"""

SQL["v05_top_products_by_revenue"] = f"""
SELECT product_name, category_name, supplier_name, product_line, {big('SUM(quantity)')} AS total_units_sold,
  {REVENUE}, {PROFIT}, {avg2('unit_price')} AS avg_selling_price,
  {big('COUNT(DISTINCT order_id)')} AS orders_count, {MARGIN}
FROM fact JOIN pdim USING (product_key) GROUP BY ALL"""

SQL["v06_customer_sales_summary"] = f"""
SELECT customer_name, customer_type, segment_name, billing_city, billing_country, {ORDERS},
  {big('SUM(quantity)')} AS total_units_purchased, {dbl('line_total')} AS total_spent, {AVG},
  MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
  CAST(date_diff('day', MIN(order_date), MAX(order_date)) AS INTEGER) AS customer_lifespan_days
FROM fact JOIN cdim USING (customer_key) GROUP BY ALL"""

SQL["v07_sales_trend_analysis"] = f"""
SELECT date_actual, day_of_week_name, month_name, quarter_name, year_number, is_weekend, is_holiday,
  {big('COUNT(DISTINCT order_id)')} AS daily_orders, {dbl('line_total')} AS daily_revenue,
  {dbl('profit')} AS daily_profit, {AVG}
FROM fact JOIN cal ON order_date = date_actual GROUP BY ALL"""

SQL["v08_category_performance"] = f"""
SELECT category_name, {big('COUNT(DISTINCT product_key)')} AS products_in_category, {ORDERS},
  {big('SUM(quantity)')} AS total_units_sold, {REVENUE}, {PROFIT},
  {avg2('unit_price')} AS avg_unit_price, {MARGIN},
  {r2(s('line_total'), 'COUNT(DISTINCT product_key)')} AS revenue_per_product
FROM fact JOIN pdim USING (product_key) GROUP BY ALL"""


def _kpi(kind: str, name: str, where: str) -> str:
    return f"""
SELECT '{kind}' AS period_type, '{name}' AS period_name, {ORDERS}, {CUSTOMERS}, {REVENUE}, {PROFIT},
  {AVG}, {MARGIN}, {big('COUNT(DISTINCT product_key)')} AS products_sold
FROM fact WHERE {where} HAVING COUNT(*) > 0"""


KPI = " UNION ALL ".join(
    [
        _kpi("Current Month", "2001-08", "year(order_date) = 2001 AND month(order_date) = 8"),
        _kpi("Current Quarter", "2001-Q3", "year(order_date) = 2001 AND quarter(order_date) = 3"),
        _kpi("Year to Date", "2001", "year(order_date) = 2001"),
    ]
)
SQL["v09_executive_kpi_dashboard"] = KPI

SQL["v10_yearly_sales_summary"] = f"""
SELECT CAST(year(order_date) AS INTEGER) AS year_number, {ORDERS}, {big('SUM(quantity)')} AS total_units_sold,
  {REVENUE}, {dbl('quantity * cost')} AS total_cost, {PROFIT}, {AVG}, {MARGIN}
FROM fact GROUP BY 1"""

# Closing stock of a day: the opening stock and all flows up to it, or, for a counted
# product, the flows since its last count.
SQL["v11_inventory_turnover"] = f"""
WITH sold AS (SELECT l_partkey AS p, CAST(l_shipdate AS DATE) AS d, SUM(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY ALL),
flow AS (SELECT p, d, -q AS x FROM sold UNION ALL SELECT p, CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE), q FROM sold),
days AS (SELECT CAST(t.x AS DATE) AS d FROM generate_series(DATE '2000-01-01', DATE '2000-12-31', INTERVAL 1 DAY) AS t(x)),
before AS (SELECT p, SUM(x) FILTER (WHERE d < DATE '1999-07-01') AS b1, SUM(x) FILTER (WHERE d < DATE '2000-07-01') AS b2 FROM flow GROUP BY 1),
marks AS (SELECT p, d, x, false AS is_day FROM flow UNION ALL SELECT product_id, d, 0, true FROM pmaster, days),
upto AS (SELECT DISTINCT p, d, SUM(x) OVER (PARTITION BY p ORDER BY d) AS c FROM marks QUALIFY bool_or(is_day) OVER (PARTITION BY p, d)),
held AS (SELECT product_id AS p, SUM(units_in_stock + COALESCE(c, 0) - CASE WHEN product_id % 7 <> 0 THEN 0
    WHEN d < DATE '2000-07-01' THEN COALESCE(b1, 0) ELSE COALESCE(b2, 0) END) AS sd
  FROM pmaster JOIN upto ON product_id = upto.p LEFT JOIN before ON product_id = before.p GROUP BY 1),
shipped AS (SELECT p, SUM(q) AS u FROM sold WHERE year(d) = 2000 GROUP BY 1),
every AS (SELECT pdim.*, sd, COALESCE(u, 0) AS u, CAST(unit_cost * 100 AS HUGEINT) AS cc
  FROM pdim JOIN held ON product_key = held.p LEFT JOIN shipped ON product_key = shipped.p)
SELECT product_number, product_name, category_name, {big('u')} AS units_shipped, CAST(u * cc AS DOUBLE) / 100 AS cost_of_goods,
  {r2('sd * 100', '366')} AS average_stock, {r2('sd * cc', '366')} AS average_stock_value,
  CASE WHEN sd > 0 THEN {r2('u * 3660000', 'sd', 4)} END AS turnover_ratio, {r2('sd * 100', 'u')} AS days_of_supply FROM every"""

SQL["v12_event_days"] = f"""
SELECT CAST(ts AS DATE) AS date_actual, event_type, {big('COUNT(*)')} AS daily_events,
  CAST(COALESCE(SUM(CAST(round(value * 100) AS BIGINT)), 0) AS DOUBLE) / 100 AS daily_value FROM events WHERE ts IS NOT NULL GROUP BY 1, 2"""
