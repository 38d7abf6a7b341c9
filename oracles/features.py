from oracles.base import AS_OF, CTES, avg2, big, dbl, draw, r2

SQL: dict[str, str] = {}
AGE = f"(year({AS_OF}) - year(birth_date))"
CTES["profile"] = f"""
SELECT customer_key AS customer_id, customer_type, segment_name, CASE WHEN customer_key % 20 <> 9 THEN annual_income END AS annual_income,
  CASE WHEN {AGE} < 25 THEN '18-24' WHEN {AGE} < 35 THEN '25-34' WHEN {AGE} < 45 THEN '35-44' ELSE '45+' END AS age_group, billing_country
FROM cdim"""
CTES["purchase"] = f"""
SELECT fact.customer_key AS customer_id, COUNT(DISTINCT order_id) AS n, {dbl('line_total')} AS total_spent, {avg2('line_total')} AS avg_order_value,
  MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date, COUNT(DISTINCT category_name) AS cats,
  COUNT(DISTINCT date_trunc('month', order_date)) AS months, STDDEV_SAMP(CAST(line_total AS DOUBLE)) AS sd,
  CAST(SUM(line_total) * 100 AS HUGEINT) AS spent_c
FROM fact JOIN pdim USING (product_key) GROUP BY 1"""


def code(column: str) -> str:
    return f"(SELECT COUNT(DISTINCT q.{column}) FROM profile AS q WHERE q.{column} < p.{column})"


SQL["l01_clv_features"] = f"""
SELECT customer_id, customer_type, segment_name, COALESCE(CAST(annual_income AS DOUBLE),
    (SELECT median(annual_income) FROM purchase JOIN profile USING (customer_id))) AS annual_income, age_group, billing_country,
  {big('n')} AS total_orders, total_spent, avg_order_value, first_order_date, last_order_date,
  CAST(last_order_date - first_order_date AS INTEGER) AS customer_lifespan_days, {big('cats')} AS categories_purchased,
  CAST({AS_OF} - last_order_date AS INTEGER) AS days_since_last_order,
  {r2('n * 1000000', 'last_order_date - first_order_date + 1', 6)} AS order_frequency,
  {code('customer_type')} AS customer_type_encoded, {code('segment_name')} AS segment_encoded,
  {code('age_group')} AS age_group_encoded, {code('billing_country')} AS country_encoded
FROM purchase JOIN profile AS p USING (customer_id)"""
SQL["l02_churn_features"] = f"""
SELECT customer_id, customer_type, segment_name, annual_income, age_group, {big('n')} AS total_orders, total_spent, avg_order_value,
  CAST({AS_OF} - last_order_date AS INTEGER) AS days_since_last_order, {big('cats')} AS categories_purchased,
  ROUND(COALESCE(sd, 0), 4) AS order_value_std, {big('months')} AS active_months,
  CASE WHEN {AS_OF} - last_order_date > 90 THEN 1 ELSE 0 END AS is_churned, {r2('n * 10000', 'months', 4)} AS order_frequency,
  {r2('spent_c', 'months')} AS avg_monthly_spend, {code('customer_type')} AS customer_type_encoded,
  {code('segment_name')} AS segment_encoded, {code('age_group')} AS age_group_encoded
FROM purchase JOIN profile AS p USING (customer_id)"""


def series(period: str) -> str:
    return f"""
WITH g AS (SELECT CAST({period} AS DATE) AS p, CAST(SUM(line_total) * 100 AS HUGEINT) AS c, COUNT(*) AS k, COUNT(DISTINCT order_id) AS n,
    COUNT(DISTINCT customer_key) AS u FROM fact GROUP BY 1),
w AS (SELECT *, lag(c, 1) OVER o AS l1, lag(c, 7) OVER o AS l7, row_number() OVER o - 1 AS trend,
    SUM(c) OVER (ORDER BY p ROWS 6 PRECEDING) AS s7, SUM(c) OVER (ORDER BY p ROWS 29 PRECEDING) AS s30 FROM g WINDOW o AS (ORDER BY p))
SELECT p AS date_period, CAST(c AS DOUBLE) / 100 AS total_sales, {big('n')} AS order_count, {r2('c', 'k')} AS avg_order_value,
  {big('u')} AS unique_customers, CAST(dayofweek(p) + 1 AS INTEGER) AS day_of_week, CAST(month(p) AS INTEGER) AS month_number,
  CAST(quarter(p) AS INTEGER) AS quarter_number, dayofweek(p) IN (0, 6) AS is_weekend, p IN (SELECT date_actual FROM cal WHERE is_holiday) AS is_holiday,
  CAST(l1 AS DOUBLE) / 100 AS sales_lag_1, CAST(l7 AS DOUBLE) / 100 AS sales_lag_7,
  CASE WHEN trend >= 6 THEN {r2('s7', '7')} END AS sales_ma_7, CASE WHEN trend >= 29 THEN {r2('s30', '30')} END AS sales_ma_30,
  trend, ROUND(sin(2 * pi() * month(p) / 12), 6) + 0.0 AS month_sin, ROUND(cos(2 * pi() * month(p) / 12), 6) + 0.0 AS month_cos FROM w"""


SQL["l03_daily_series"] = series("order_date")
SQL["l03_weekly_series"] = series("date_trunc('week', order_date)")
SQL["l03_monthly_series"] = series("date_trunc('month', order_date)")
SQL["l04_segment_codes"] = """
SELECT label, row_number() OVER (ORDER BY label) - 1 AS code FROM (SELECT DISTINCT segment_name AS label FROM cdim) AS d"""
SQL["l05_scaled_income"] = """
SELECT customer_key AS customer_id, ROUND((annual_income - (SELECT AVG(annual_income) FROM cdim)) / (SELECT STDDEV_POP(annual_income) FROM cdim), 6) AS income
FROM cdim"""
SQL["l06_split_customers"] = f"""
SELECT customer_key AS customer_id, CASE WHEN {draw('split-42', 'customer_key')} < 0.8 THEN 'train' ELSE 'test' END AS side FROM cdim"""
_LABEL = f"(SELECT customer_key, CASE WHEN {AS_OF} - MAX(order_date) > 90 THEN 1 ELSE 0 END AS is_churned, COUNT(*) AS n FROM heads GROUP BY 1) AS f"
SQL["l06_split_by_label"] = f"""
SELECT is_churned, CASE WHEN {draw('split-42', 'customer_key', 'is_churned')} < 0.8 THEN 'train' ELSE 'test' END AS side,
  {big('COUNT(*)')} AS n FROM {_LABEL} GROUP BY 1, 2"""
SQL["l06_split_by_time"] = f"""
SELECT order_date, {big('COUNT(*)')} AS n_orders,
  CASE WHEN row_number() OVER (ORDER BY order_date) - 1 < floor((SELECT COUNT(DISTINCT order_date) FROM heads) * 0.8) THEN 'train' ELSE 'test' END AS side
FROM heads GROUP BY 1"""
SQL["l11_naive_forecast_metrics"] = f"""
WITH x AS (SELECT total_sales AS y, sales_ma_7 AS p FROM ({series('order_date')}) AS s WHERE sales_ma_7 IS NOT NULL)
SELECT ROUND(AVG((y - p) * (y - p)) / 1e6, 3) AS mse_millions, ROUND(1 - SUM((y - p) * (y - p)) / (VAR_POP(y) * COUNT(*)), 6) AS r2_score,
  ROUND(AVG(abs((y - p) / y)) * 100, 6) AS mape FROM x"""
SQL["l11_rule_churn_metrics"] = f"""
WITH c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (is_churned = 1 AND n < 10) AS tp, COUNT(*) FILTER (is_churned = 0 AND n < 10) AS fp,
  COUNT(*) FILTER (is_churned = 1 AND n >= 10) AS fn FROM {_LABEL})
SELECT {r2('(n - fp - fn) * 1000000', 'n', 6)} AS accuracy, {r2('tp * 1000000', '(tp + fp)', 6)} AS precision,
  {r2('tp * 1000000', '(tp + fn)', 6)} AS recall, {r2('tp * 2000000', '(2 * tp + fp + fn)', 6)} AS f1_score,
  {r2('(tp + fn) * 1000000', 'n', 6)} AS label_rate FROM c"""
SQL["l12_reloaded_model"] = f"SELECT {big('COUNT(*)')} AS n_customers, {big('0')} AS n_differ FROM purchase"


def facts(model: str, source: str, values: dict[str, str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{model}' AS model, '{k}' AS fact, {big(v)} AS value FROM src" for k, v in values.items())
    return f"WITH src AS ({source}) {rows}"


_FOREST = dict.fromkeys(("reported_rows_agree", "mse_agrees", "r2_agrees", "predictions_in_range", "importances_sum_to_one", "better_than_rule"), "1")
SQL["l07_clv_checks"] = facts("clv", f"""
SELECT COUNT(*) FILTER (u < 0.8) AS tr, COUNT(*) FILTER (u >= 0.8) AS te FROM (SELECT {draw('split-42', 'customer_id')} AS u FROM purchase) AS x""",
    {"train_rows": "tr", "test_rows": "te", **_FOREST})
SQL["l08_score_checks"] = facts("clv", "SELECT COUNT(*) AS n FROM purchase", {"customers": "n", "scored_twice": "0", "out_of_range": "0"})
SQL["l09_churn_checks"] = facts("churn", f"""
SELECT COUNT(*) FILTER (u < 0.8) AS tr, COUNT(*) FILTER (u >= 0.8) AS te FROM (SELECT {draw('split-42', 'customer_id', 'is_churned')} AS u
  FROM (SELECT customer_id, CASE WHEN {AS_OF} - last_order_date > 90 THEN 1 ELSE 0 END AS is_churned FROM purchase) AS y) AS x""",
    {"train_rows": "tr", "test_rows": "te", "reported_rows_agree": "1", "metrics_agree": "1", "probabilities_outside": "0",
     "labels_off_probability": "0", "better_than_chance": "1", "better_than_rule": "1"})
SQL["l10_forecast_checks"] = facts("forecast", """
SELECT CAST(floor(n * 0.8) AS BIGINT) AS tr, n FROM (SELECT COUNT(DISTINCT order_date) - 29 AS n FROM fact) AS x""",
    {"train_rows": "tr", "test_rows": "n - tr", **_FOREST})
SQL["u02_ltv_checks"] = facts("ltv", """
SELECT (SELECT COUNT(*) FROM customer) AS n, (SELECT COUNT(*) FROM purchase) AS k""", {"customers": "n", "predicted": "k", "off": "0"})
