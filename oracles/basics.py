from oracles.base import AS_OF, avg2, big, dbl, draw, pct, r2, s
from oracles.files import EMAIL
from oracles.jobs import REQUESTS
from oracles.reports import text

SQL: dict[str, str] = {}
N = f"{big('COUNT(*)')} AS n"

SQL["p01_projected"] = """
SELECT order_id, line_number, product_key, sales_rep_key, CAST(quantity * unit_price AS DOUBLE) AS gross, CAST(line_total AS DOUBLE) AS net,
  CAST(quantity * unit_price - line_total AS DOUBLE) AS saved FROM item"""
SQL["p02_filter_after_select"] = """
SELECT trim(upper(customer_type)) AS customer_type, trim(upper(customer_number)) AS customer_number FROM rawc
WHERE trim(upper(customer_type)) = 'INDIVIDUAL' AND customer_number IS NOT NULL"""
SQL["p03_null_tests"] = """
SELECT customer_id, first_name FROM cmaster WHERE company_name IS NULL AND last_name IS NULL AND first_name IS NOT NULL"""
SQL["p04_comparisons"] = f"""
SELECT line_number, {N}, {big('SUM(quantity)')} AS units FROM item
WHERE quantity > 10 AND quantity <= 40 AND discount >= 0.02 AND discount < 0.09 AND line_number <> 3 GROUP BY 1"""
SQL["p05_in_lists"] = f"""
SELECT status, CAST(month(order_date) AS INTEGER) AS month, {N} FROM heads
WHERE status IN ('SHIPPED', 'PENDING') AND month(order_date) NOT IN (1, 7, 12) GROUP BY 1, 2"""
SQL["p06_between_dates"] = """
SELECT order_id, order_date FROM heads WHERE order_date BETWEEN DATE '1999-03-01' AND DATE '1999-04-30'"""
SQL["p07_email_pattern"] = f"SELECT regexp_matches(email, '{EMAIL}') AS is_valid, {N} FROM rawc GROUP BY 1"
SQL["p08_like_patterns"] = """
SELECT product_key, product_name FROM pdim WHERE product_name LIKE '%ring' AND product_name NOT LIKE 'red%'"""
SQL["p09_boolean_filter"] = f"""
SELECT holiday_name, {big('COUNT(*)')} AS n_orders FROM cal JOIN heads ON order_date = date_actual WHERE is_holiday GROUP BY 1"""
SQL["p10_case_labels"] = f"""
SELECT CASE WHEN quantity < 10 THEN 'small' WHEN quantity < 30 THEN 'medium' ELSE 'large' END AS size,
  CASE WHEN discount > 0.05 THEN 'deep' WHEN discount > 0 THEN 'light' ELSE 'none' END AS discount,
  CASE line_number WHEN 1 THEN 'first' ELSE 'other' END AS place, {N} FROM item GROUP BY ALL"""
SQL["p11_null_guards"] = f"""
SELECT customer_id, COALESCE(company_name, last_name, 'unnamed') AS name, NULLIF(status, 'ACTIVE') AS exception_status,
  {r2('customer_id * 10000', '(customer_id % 5)', 4)} AS guarded FROM cmaster"""
SQL["p12_in_subquery"] = f"""
SELECT status, {N} FROM heads WHERE order_id IN (SELECT order_id FROM item WHERE quantity >= 49) GROUP BY 1"""
SQL["p13_having_alias"] = f"""
SELECT customer_key AS customer_id, {big('COUNT(*)')} AS total_orders FROM heads GROUP BY 1 HAVING COUNT(*) > 15"""
SQL["p14_probabilistic_filter"] = f"""
SELECT customer_key AS customer_id, segment_name FROM cdim
WHERE {draw('keep', 'customer_key')} < CASE segment_name WHEN 'BUILDING' THEN 0.4 WHEN 'MACHINERY' THEN 0.25 ELSE 0.08 END"""
SQL["p15_relative_dates"] = f"""
SELECT {big(f'COUNT(*) FILTER (order_date >= {AS_OF} - 30)')} AS last_30_days,
  {big("COUNT(*) FILTER (strftime(order_date, '%Y-%m') = '2001-08')")} AS this_month,
  {big('COUNT(*) FILTER (year(order_date) = 2001 AND quarter(order_date) = 3)')} AS this_quarter,
  {big('COUNT(*) FILTER (year(order_date) = 2001)')} AS this_year,
  {big(f'COUNT(*) FILTER (order_date >= {AS_OF} - INTERVAL 12 MONTH)')} AS last_12_months FROM heads"""

SQL["j01_fact_by_dimension"] = f"SELECT region, {dbl('line_total')} AS total_revenue FROM item JOIN rdim USING (sales_rep_key) GROUP BY 1"
SQL["j02_left_join"] = """
SELECT cdim.customer_key AS customer_id, n_orders FROM cdim LEFT JOIN (SELECT customer_key, COUNT(*) AS n_orders FROM heads
  GROUP BY 1) AS t USING (customer_key)"""
SQL["j03_star_join"] = f"""
SELECT year_number, segment_name, product_line, region, {dbl('line_total')} AS total_revenue
FROM fact JOIN cal ON order_date = date_actual JOIN cdim USING (customer_key) JOIN pdim USING (product_key) JOIN rdim USING (sales_rep_key) GROUP BY ALL"""
SQL["j04_two_roles"] = f"""
SELECT b.country AS billed_to, t.country AS sent_to, {N} FROM cmaster JOIN address AS b ON billing_address_id = b.address_id
JOIN address AS t ON shipping_address_id = t.address_id GROUP BY 1, 2"""
SQL["j05_anti_join"] = "SELECT heads.order_id, status FROM heads LEFT JOIN item USING (order_id) WHERE item.order_id IS NULL"
SQL["j06_semi_join"] = """
SELECT customer_key AS customer_id, customer_name FROM cdim WHERE customer_key IN (SELECT customer_key FROM heads WHERE order_date >= DATE '2001-07-25')"""
_ENDS = f"(SELECT date_key, date_actual FROM cal WHERE date_actual = last_day(date_actual) AND date_actual <= {AS_OF} AND date_actual >= {AS_OF} - INTERVAL 12 MONTH) AS e"
SQL["j07_dense_grid"] = f"SELECT product_key, date_actual AS month_end FROM {_ENDS} CROSS JOIN pdim"
SQL["j08_month_range_join"] = f"""
SELECT pdim.product_key, date_key, {big('COALESCE(SUM(quantity), 0)')} AS units_sold FROM {_ENDS} CROSS JOIN pdim
LEFT JOIN fact ON fact.product_key = pdim.product_key AND order_date BETWEEN date_trunc('month', date_actual) AND date_actual GROUP BY 1, 2"""
SQL["j09_period_join"] = f"""
WITH p AS (SELECT employee_id, DATE '2001-01-01' + CAST(i * 14 AS INTEGER) AS period_start FROM emp, range(0, 16) AS t(i))
SELECT employee_id, period_start, {big('COUNT(DISTINCT order_date)')} AS days_with_sales FROM p JOIN fact ON sales_rep_key = employee_id
  AND order_date BETWEEN period_start AND period_start + 13 GROUP BY 1, 2"""
SQL["j10_correlated_aggregate"] = """
SELECT customer_key AS customer_id, (SELECT COUNT(*) FROM heads AS h WHERE h.customer_key = cdim.customer_key) AS total_orders,
  (SELECT MAX(order_date) FROM heads AS h WHERE h.customer_key = cdim.customer_key) AS last_order_date FROM cdim"""
SQL["j11_scalar_lookup"] = """
SELECT sales_rep_key, territory_name, n_nationkey AS territory_id, (SELECT MAX(n_nationkey) FROM place) AS newest_territory
FROM rdim JOIN place ON territory_name = n_name"""
SQL["j12_lookup_with_default"] = """
SELECT product_key, name AS category_name, CAST(COALESCE(category_id, 1) AS BIGINT) AS category_id
FROM (SELECT product_key, CASE WHEN product_key % 50 = 0 THEN 'Old ' || category_name ELSE category_name END AS name FROM pdim) AS p
LEFT JOIN category ON category.category_name = name"""
SQL["j14_merge_join"] = """
SELECT product_key, CASE WHEN supplier_name = 'Brand#7' THEN 'insert' WHEN category_name = 'PROMO' THEN 'keep' WHEN product_key % 3 <> 0 THEN 'update' ELSE 'same' END AS action
FROM pdim WHERE NOT (supplier_name = 'Brand#7' AND category_name = 'PROMO')"""

SQL["a01_grouped"] = f"""
SELECT year_number, quarter_name, month_name, day_of_week_name, is_weekend, is_holiday, status, {N}
FROM cal JOIN heads ON order_date = date_actual GROUP BY ALL"""
SQL["a02_global_totals"] = f"""
SELECT {big('COUNT(*)')} AS n_lines, {big('SUM(quantity)')} AS units, {dbl('line_total')} AS revenue, MIN(shipped_date) AS first_shipped FROM item"""
SQL["a03_counts"] = f"""
SELECT {big('COUNT(*)')} AS n_rows, {big('COUNT(company_name)')} AS n_companies, {big("COUNT(CASE WHEN status = 'ACTIVE' THEN 1 END)")} AS n_active FROM cmaster"""
SQL["a04_distinct_counts"] = f"""
SELECT status, {big('COUNT(DISTINCT order_id)')} AS orders, {big('COUNT(DISTINCT customer_key)')} AS customers,
  {big('COUNT(DISTINCT product_key)')} AS products FROM fact GROUP BY 1"""
SQL["a05_distinct_months"] = f"""
SELECT customer_key AS customer_id, {big("COUNT(DISTINCT date_trunc('month', order_date))")} AS active_months FROM heads GROUP BY 1"""
SQL["a06_basic_aggregates"] = f"""
SELECT sales_rep_key, {big('SUM(quantity)')} AS units, {big('MIN(quantity)')} AS fewest, {big('MAX(quantity)')} AS most, {avg2('line_total')} AS mean_line
FROM item GROUP BY 1"""
SQL["a07_deviations"] = "SELECT product_key, ROUND(STDDEV_SAMP(CAST(line_total AS DOUBLE)), 4) AS line_std FROM item GROUP BY 1"
SQL["a08_guarded_ratios"] = f"""
SELECT customer_key AS customer_id, {r2("SUM(CASE WHEN status = 'SHIPPED' THEN freight ELSE 0 END) * 10000", 'SUM(freight)')} AS shipped_percent FROM heads GROUP BY 1"""
SQL["a09_sum_of_products"] = f"SELECT line_number, {dbl('quantity * unit_price')} AS gross FROM item GROUP BY 1"
SQL["a10_distinct_rows"] = "SELECT DISTINCT category_name, supplier_name, product_line FROM pdim"
SQL["a11_exact_median"] = """
SELECT (SELECT median(annual_income) FROM cdim) AS median_income, (SELECT median(CAST(line_total * 100 AS BIGINT)) / 100 FROM item) AS median_line"""
SQL["a12_flag_rate"] = f"""
SELECT segment_name, {r2("COUNT(*) FILTER (status = 'INACTIVE') * 1000000", 'COUNT(*)', 6)} AS inactive_rate FROM cdim GROUP BY 1"""
SQL["a13_two_level"] = f"""
SELECT CAST(year(d) AS INTEGER) AS year, {avg2('v')} AS mean_daily_revenue FROM (SELECT order_date AS d, SUM(line_total) AS v FROM fact GROUP BY 1) AS t GROUP BY 1"""
SQL["a14_region_rollup"] = f"""
SELECT region, territory_name, {big('COUNT(*)')} AS n_reps, {big('GROUPING(territory_name)')} AS is_subtotal FROM rdim GROUP BY ROLLUP (region, territory_name)"""
SQL["a15_quartiles"] = """
SELECT CAST(dow AS INTEGER) AS day_of_week, ROUND(quantile_cont(n, 0.25), 4) AS q1, ROUND(quantile_cont(n, 0.5), 4) AS median, ROUND(quantile_cont(n, 0.75), 4) AS q3
FROM (SELECT dayofweek(order_date) + 1 AS dow, date_trunc('month', order_date) AS mo, CAST(COUNT(*) AS DOUBLE) AS n FROM heads GROUP BY 1, 2) AS t GROUP BY 1"""
SQL["a16_pivoted"] = f"""
SELECT CAST(year(order_date) AS INTEGER) AS year, {', '.join(f"{big(f'''COUNT(*) FILTER (status = '{x}')''')} AS {x}" for x in ('SHIPPED', 'PROCESSING', 'PENDING'))}
FROM heads GROUP BY 1"""
SQL["a17_shares"] = f"""
SELECT status, {r2('SUM(freight) * 10000', '(SELECT SUM(freight) FROM heads)')} AS share_percent FROM heads GROUP BY 1"""

_DAILY = "(SELECT order_date, COUNT(*) AS n FROM heads GROUP BY 1) AS d"
SQL["w01_date_spine"] = f"""
SELECT CAST(row_number() OVER (ORDER BY date_actual) AS INTEGER) AS day_number, date_actual AS day, COALESCE(n, 0) AS n_orders
FROM cal LEFT JOIN {_DAILY} ON order_date = date_actual
WHERE date_actual BETWEEN (SELECT MIN(order_date) FROM heads) AND (SELECT MAX(order_date) FROM heads)"""
SQL["w02_order_numbers"] = """
SELECT order_id, customer_key AS customer_id, 'ORD-' || lpad(CAST(row_number() OVER (ORDER BY customer_key, order_id) AS VARCHAR), 8, '0') AS order_number FROM heads"""
SQL["w03_lags"] = f"SELECT order_date, n, lag(n) OVER (ORDER BY order_date) AS lag_1, lag(n, 7) OVER (ORDER BY order_date) AS lag_7 FROM {_DAILY}"
SQL["w04_rolling_means"] = f"""
SELECT order_date, CASE WHEN i >= 7 THEN {r2('s7 * 10000', '7', 4)} END AS mean_7, CASE WHEN i >= 30 THEN {r2('s30 * 10000', '30', 4)} END AS mean_30
FROM (SELECT order_date, row_number() OVER (ORDER BY order_date) AS i, SUM(n) OVER (ORDER BY order_date ROWS 6 PRECEDING) AS s7,
  SUM(n) OVER (ORDER BY order_date ROWS 29 PRECEDING) AS s30 FROM {_DAILY}) AS w"""
SQL["w05_trend"] = f"SELECT order_date, row_number() OVER (ORDER BY order_date) - 1 AS trend FROM {_DAILY}"
SQL["w07_running_total"] = f"""
SELECT month, n, {big('SUM(n) OVER (ORDER BY month)')} AS running_total FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, COUNT(*) AS n FROM heads GROUP BY 1) AS t"""
SQL["w08_share_of_first"] = f"""
SELECT line_number, n, {r2('n * 10000', '(first_value(n) OVER (ORDER BY line_number))')} AS percent_of_first
FROM (SELECT line_number, COUNT(*) AS n FROM item GROUP BY 1) AS t"""
SQL["t01_sorted_rows"] = "SELECT region, territory_name, sales_rep_name FROM rdim"
SQL["t02_first_rows"] = "SELECT customer_key AS customer_id, customer_name FROM cdim ORDER BY 1 LIMIT 1000"
SQL["t03_top_k"] = f"SELECT product_key, {dbl('line_total')} AS revenue FROM item GROUP BY 1 ORDER BY revenue DESC, product_key LIMIT 25"
SQL["t04_largest"] = "SELECT customer_key AS customer_id, annual_income FROM cdim ORDER BY annual_income DESC, customer_key LIMIT 10"
SQL["t05_first_or_none"] = "SELECT order_id, order_date FROM heads WHERE status = 'PENDING' ORDER BY order_date DESC, order_id LIMIT 1"
SQL["x01_union_all"] = " UNION ALL ".join(
    f"SELECT {big('COUNT(*)')} AS n_orders, '{p}' AS period, {big('SUM(freight)')} AS freight FROM heads WHERE order_date >= DATE '{d}'"
    for p, d in (("month", "2001-07-01"), ("quarter", "2001-05-01"), ("year", "2000-08-01")))

SQL["f_string"] = """
SELECT upper(trim(customer_number)) AS number, lower(trim(email)) AS email, regexp_replace(phone, '[^0-9]', '', 'g') AS digits, city || ', ' || country AS place,
  first_name || ' ' || last_name AS full_name, lpad(postal_code, 8, '0') AS padded, left(state_province, 3) AS initials, left(address_line_1, 5) AS cut
FROM rawc WHERE customer_number IS NOT NULL"""
SQL["f_cast"] = """
SELECT product_number, CAST(TRY_CAST(unit_price AS DECIMAL(10,2)) AS DOUBLE) AS unit_price,
  CASE WHEN unit_price <> 'abc' THEN CAST(ROUND(CAST(unit_price AS DECIMAL(10,2)), 0) AS BIGINT) END AS whole, TRY_CAST(product_number AS DATE) AS no_date,
  TRY_CAST(CASE WHEN discontinued <> 'maybe' THEN discontinued END AS BOOLEAN) AS strict_flag, COALESCE(discontinued = 'true', FALSE) AS loose_flag FROM rawp"""
SQL["f_date_parts"] = """
SELECT order_id, CAST(year(order_date) AS INTEGER) AS y, CAST(month(order_date) AS INTEGER) AS mo, CAST(day(order_date) AS INTEGER) AS dom,
  CAST(quarter(order_date) AS INTEGER) AS q, CAST(dayofweek(order_date) + 1 AS INTEGER) AS dow, CAST(dayofyear(order_date) AS INTEGER) AS doy,
  CAST(week(order_date) AS INTEGER) AS week, left(dayname(order_date), 3) AS day_name, left(monthname(order_date), 3) AS month_name,
  CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, CAST(epoch(order_date) AS BIGINT) AS epoch FROM heads"""
SQL["f_date_arithmetic"] = f"""
SELECT order_id, order_date + 45 AS plus_days, CAST(order_date - INTERVAL 2 MONTH AS DATE) AS minus_months, CAST(order_date + INTERVAL 12 MONTH AS DATE) AS plus_year,
  CAST(date_diff('day', order_date, {AS_OF}) AS INTEGER) AS days, CAST(date_diff('month', order_date, {AS_OF}) AS INTEGER) AS months,
  CAST(date_diff('year', order_date, {AS_OF}) AS INTEGER) AS years, last_day(order_date) AS month_end,
  CAST(date_trunc('quarter', order_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end, make_date(year(order_date), 12, 31) AS year_end,
  CAST(date_trunc('week', order_date) AS DATE) AS week_start, CAST(date_trunc('quarter', order_date) AS DATE) AS quarter_start,
  strftime(TIMESTAMP '2001-08-01 10:00:00' - INTERVAL 36 HOUR, '%Y-%m-%d %H') AS earlier FROM heads"""
SQL["f_format"] = f"""
SELECT customer_id, {text('annual_income', '$')} AS income_text, {text('(annual_income * 1000)')} AS large_text,
  format('{{:.1f}}%', (customer_id % 800) / 8.0::DOUBLE) AS percent_text, strftime(registration_date, '%Y%m%d') || '000000' AS stamp FROM cmaster"""
SQL["f_math"] = """
SELECT product_key, (2 * c + 7) // 14 AS rounded, CAST(ceil(c / 700.0) AS BIGINT) AS up, CAST(floor(c / 700.0) AS BIGINT) AS down,
  greatest(COALESCE(CASE WHEN c % 3 = 0 THEN c END, 0), 91000) AS at_least, abs(c - 95000) AS distance, ROUND(sin(c / 100.0::DOUBLE), 6) + 0.0 AS wave
FROM (SELECT product_key, CAST(list_price * 100 AS BIGINT) AS c FROM pdim) AS t"""
SQL["f_array"] = f"""
WITH {REQUESTS}, al AS (SELECT req.request_id, i, (req.request_id * 7 + i * 13) % (SELECT COUNT(*) FROM part) AS p, 1 + (req.request_id + i) % 9 AS q
  FROM req, range(1, 5) AS t(i) WHERE i <= n_items)
SELECT req.request_id, COUNT(al.i) AS n_items, {big('MAX(CASE WHEN i = 1 THEN p END)')} AS first_product, {big('COALESCE(SUM(q), 0)')} AS units
FROM req LEFT JOIN al USING (request_id) GROUP BY 1"""
SQL["f_json"] = f"SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, {N} FROM events GROUP BY 1"
SQL["f_null"] = """
SELECT customer_id, COALESCE(annual_income, 0) AS annual_income, COALESCE(last_name, '?') AS last_name FROM cmaster WHERE birth_date IS NOT NULL"""
