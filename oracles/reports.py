from oracles.base import avg2, big, dbl, pct, r2, s
from oracles.views import AVG, CUSTOMERS, KPI, MARGIN, ORDERS, PROFIT, REVENUE
from oracles.views import SQL as VIEWS

SQL: dict[str, str] = {}
RANGE = "order_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'"

SQL["q01_kpi"] = f"SELECT * FROM ({KPI}) AS k WHERE period_type = 'Current Month'"
SQL["q02_sales_trend"] = f"""
SELECT date_actual, daily_revenue, daily_orders, avg_order_value, is_weekend, is_holiday
FROM ({VIEWS['v07_sales_trend_analysis']}) AS v WHERE date_actual >= DATE '2001-08-01' - 30"""
SQL["q03_top_categories"] = f"""
SELECT category_name, total_revenue, total_profit, profit_margin_percent, total_units_sold
FROM ({VIEWS['v08_category_performance']}) AS v ORDER BY total_revenue DESC, category_name LIMIT 10"""
SQL["q04_territory_performance"] = f"""
SELECT territory_name, region, country, total_revenue, total_orders, unique_customers, revenue_per_customer
FROM ({VIEWS['v04_territory_sales_analysis']}) AS v"""
SQL["q05_territory_rollup"] = f"""
SELECT region, territory_name, {big('GROUPING(region, territory_name)')} AS level, {REVENUE}
FROM item JOIN rdim USING (sales_rep_key) GROUP BY ROLLUP (region, territory_name)"""
SQL["q06_sales_overview"] = f"""
SELECT {ORDERS}, {CUSTOMERS}, {REVENUE}, {PROFIT}, {AVG}, {big('SUM(quantity)')} AS total_units_sold,
  {big('COUNT(DISTINCT product_key)')} AS products_sold, {MARGIN}
FROM fact WHERE {RANGE}"""
SQL["q07_daily_sales"] = f"""
SELECT date_actual, day_of_week_name, is_weekend, is_holiday, {big('COUNT(DISTINCT order_id)')} AS daily_orders,
  {dbl('line_total')} AS daily_revenue, {dbl('profit')} AS daily_profit, {AVG}, {big('SUM(quantity)')} AS units_sold
FROM fact JOIN cal ON order_date = date_actual WHERE {RANGE} GROUP BY ALL"""
SQL["q08_rep_performance"] = f"""
SELECT sales_rep_name, territory_name, region, {ORDERS}, {CUSTOMERS}, {REVENUE}, {PROFIT}, {AVG}, {MARGIN}
FROM fact JOIN rdim USING (sales_rep_key) WHERE {RANGE} GROUP BY ALL"""
SQL["q09_product_performance"] = f"""
SELECT product_name, category_name, supplier_name, {big('SUM(quantity)')} AS total_units_sold, {REVENUE}, {PROFIT},
  {avg2('unit_price')} AS avg_selling_price, {big('COUNT(DISTINCT order_id)')} AS orders_count, {MARGIN}
FROM fact JOIN pdim USING (product_key) WHERE {RANGE} GROUP BY product_name, category_name, supplier_name
ORDER BY total_revenue DESC, product_name, category_name, supplier_name LIMIT 20"""
SQL["q10_customer_analysis"] = f"""
SELECT segment_name, customer_type, {big('COUNT(DISTINCT customer_key)')} AS customer_count, {ORDERS}, {REVENUE}, {AVG},
  {r2(s('line_total'), 'COUNT(DISTINCT customer_key)')} AS revenue_per_customer
FROM fact JOIN cdim USING (customer_key) WHERE {RANGE} GROUP BY ALL"""
SQL["q11_monthly_comparison"] = f"""
SELECT month_number, month_name, {dbl('line_total')} AS monthly_revenue, {dbl('profit')} AS monthly_profit,
  {big('COUNT(DISTINCT order_id)')} AS monthly_orders, {AVG}
FROM fact JOIN cal ON order_date = date_actual WHERE year_number = 2000 GROUP BY ALL"""


def _means(label: str, having: str = "TRUE") -> str:
    return f"""
WITH per_day AS (SELECT date_actual, day_of_week_name, is_weekend, is_holiday, COUNT(DISTINCT order_id) AS n,
  SUM(line_total) AS revenue FROM fact JOIN cal ON order_date = date_actual WHERE {RANGE} GROUP BY ALL)
SELECT {label} AS day_group, {r2('SUM(n) * 100', 'COUNT(*)')} AS avg_daily_orders,
  {avg2('revenue')} AS avg_daily_revenue
FROM per_day WHERE {having} GROUP BY 1"""


SQL["q12_by_day_of_week"] = _means("day_of_week_name")
SQL["q13_weekend_vs_weekday"] = _means("CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END")
SQL["q14_holiday_vs_regular"] = _means(
    "CASE WHEN is_holiday THEN 'Holiday' ELSE 'Regular Day' END",
    "(SELECT COUNT(*) FROM per_day WHERE is_holiday) > 0",
)
SQL["q15_top_reps"] = f"""
SELECT * FROM ({SQL['q08_rep_performance']}) AS q ORDER BY total_revenue DESC, sales_rep_name LIMIT 10"""
SQL["q15_top_products_revenue"] = f"""
SELECT * FROM ({SQL['q09_product_performance']}) AS q
ORDER BY total_revenue DESC, product_name, category_name, supplier_name LIMIT 10"""
_ALL_PRODUCTS = SQL["q09_product_performance"].rpartition("ORDER BY")[0]
SQL["q15_top_products_units"] = f"""
SELECT * FROM ({_ALL_PRODUCTS}) AS q
ORDER BY total_units_sold DESC, product_name, category_name, supplier_name LIMIT 10"""
SQL["q16_category_totals"] = f"""
SELECT category_name, CAST(SUM(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
  CAST(SUM(CAST(total_profit AS DECIMAL(18,2))) AS DOUBLE) AS total_profit,
  {big('SUM(total_units_sold)')} AS total_units_sold
FROM ({_ALL_PRODUCTS}) AS q GROUP BY 1"""


def _share(key: str, dim: str, join: str) -> str:
    return f"""
WITH g AS (SELECT {key}, SUM(line_total) AS revenue FROM fact JOIN {dim} USING ({join}) WHERE {RANGE} GROUP BY 1)
SELECT {key}, CAST(revenue AS DOUBLE) AS total_revenue,
  {r2('revenue * 100 * 10000', '(SELECT SUM(revenue) * 100 FROM g)')} AS share_percent FROM g"""


SQL["q17_category_share"] = _share("category_name", "pdim", "product_key")
SQL["q17_segment_share"] = _share("segment_name", "cdim", "customer_key")
SQL["q18_segments_by_value"] = SQL["q10_customer_analysis"]
SQL["q18_categories_by_revenue"] = SQL["q16_category_totals"]
_DAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
SQL["q19_sales_heatmap"] = f"""
SELECT month_number, {', '.join(f"CAST(SUM(line_total) FILTER (day_of_week_name = '{d}') AS DOUBLE) AS {d.lower()}" for d in _DAYS)}
FROM fact JOIN cal ON order_date = date_actual WHERE {RANGE} GROUP BY 1"""
SQL["q19_revenue_quartiles"] = f"""
WITH per_day AS (SELECT day_of_week_name, date_actual, CAST(SUM(line_total) * 100 AS BIGINT) AS c
  FROM fact JOIN cal ON order_date = date_actual WHERE {RANGE} GROUP BY 1, 2)
SELECT day_of_week_name, MIN(c) / 100.0::DOUBLE AS lowest,
  ROUND(quantile_cont(c, 0.25)) / 100.0::DOUBLE AS q1, ROUND(quantile_cont(c, 0.5)) / 100.0::DOUBLE AS median,
  ROUND(quantile_cont(c, 0.75)) / 100.0::DOUBLE AS q3, MAX(c) / 100.0::DOUBLE AS highest FROM per_day GROUP BY 1"""
SQL["q19_profit_waterfall"] = f"""
WITH g AS (SELECT month_number AS step, SUM(profit) AS v FROM fact JOIN cal ON order_date = date_actual
  WHERE {RANGE} GROUP BY 1)
SELECT step, 'relative' AS measure, CAST(v AS DOUBLE) AS value, CAST(SUM(v) OVER (ORDER BY step) AS DOUBLE) AS running_total FROM g
UNION ALL SELECT 13, 'total', CAST(SUM(v) AS DOUBLE), CAST(SUM(v) AS DOUBLE) FROM g"""
SQL["q19_order_funnel"] = f"""
WITH g AS (SELECT 1 AS step, 'Placed' AS stage, COUNT(*) AS n FROM heads
  UNION ALL SELECT 2, 'Processed', COUNT(*) FROM heads WHERE status <> 'PENDING'
  UNION ALL SELECT 3, 'Shipped', COUNT(*) FROM heads WHERE status = 'SHIPPED')
SELECT step, stage, {big('n')} AS n_orders, {r2('n * 10000', '(SELECT n FROM g WHERE step = 1)')} AS percent_of_first FROM g"""


def text(x: str, prefix: str = "") -> str:
    return f"""CASE WHEN {x} IS NULL THEN '{prefix}0'
  WHEN abs({x}) >= 1e9 THEN format('{prefix}{{:.1f}}B', CAST({x} / 1e9 AS DOUBLE))
  WHEN abs({x}) >= 1e6 THEN format('{prefix}{{:.1f}}M', CAST({x} / 1e6 AS DOUBLE))
  WHEN abs({x}) >= 1e3 THEN format('{prefix}{{:.1f}}K', CAST({x} / 1e3 AS DOUBLE))
  ELSE format('{prefix}{{:.0f}}', CAST({x} AS DOUBLE)) END"""


SQL["r01_kpi_report"] = f"""
SELECT period_type, period_name, {text('total_revenue', '$')} AS revenue_text, {text('total_profit', '$')} AS profit_text,
  {text('total_orders')} AS orders_text, {text('unique_customers')} AS customers_text,
  {text('avg_order_value', '$')} AS avg_order_text, format('{{:.1f}}%', profit_margin_percent) AS margin_text
FROM ({KPI}) AS k"""
SQL["r01_territory_report"] = f"""
SELECT territory_name, {text('total_revenue', '$')} AS total_revenue, total_orders,
  {text('revenue_per_customer', '$')} AS revenue_per_customer FROM ({VIEWS['v04_territory_sales_analysis']}) AS v"""
