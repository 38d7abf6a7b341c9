from oracles.base import CTES, big
from oracles.reports import SQL as REPORTS
from oracles.views import SQL as VIEWS

SQL: dict[str, str] = {}
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def _p(c: str) -> str:
    """Price text of a cents amount."""
    return f"(CAST({c} // 100 AS VARCHAR) || '.' || lpad(CAST({c} % 100 AS VARCHAR), 2, '0'))"


CTES["rawc"] = """
SELECT c_custkey AS key, CASE WHEN r = 0 THEN NULL WHEN r = 3 THEN '  c' || lpad(t, 8, '0') || ' ' ELSE 'C' || lpad(t, 8, '0') END AS customer_number,
  CASE WHEN r = 2 THEN 'PERSON' WHEN r = 3 THEN ' Individual ' WHEN c_custkey % 10 < 3 THEN 'BUSINESS' ELSE 'INDIVIDUAL' END AS customer_type,
  CASE WHEN c_custkey % 10 < 3 THEN ' Company ' || t END AS company_name,
  CASE WHEN c_custkey % 10 >= 3 THEN 'First' || t END AS first_name, CASE WHEN c_custkey % 10 >= 3 THEN 'Last' || t END AS last_name,
  CASE WHEN r = 1 THEN 'user' || t || '.example.com' WHEN r = 3 THEN ' User' || t || '@Example.COM '
    WHEN r = 6 THEN 'user' || (c_custkey - 1) || '@example.com' ELSE 'user' || t || '@example.com' END AS email,
  CASE WHEN r = 4 THEN '(555) 010-' ELSE '555-010-' END || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
  CASE WHEN r = 5 THEN 'not-a-date' ELSE CAST(DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS VARCHAR) END AS birth_date,
  CASE WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'f' END AS gender, CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS annual_income,
  t || ' Main St' AS address_line_1, CAST(NULL AS VARCHAR) AS address_line_2, n_name AS city, r_name AS state_province,
  lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code, lower(r_name) AS country,
  CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS VARCHAR) AS registration_date,
  'customers_batch' || (c_custkey % 4) || '.csv' AS file_name
FROM (SELECT *, c_custkey % 50 AS r, CAST(c_custkey AS VARCHAR) AS t FROM customer JOIN place ON c_nationkey = n_nationkey) AS x"""
CTES["rawp"] = f"""
SELECT p_partkey AS key, 'p' || lpad(t, 6, '0') AS product_number, CASE WHEN r <> 3 THEN p_name || ' ' END AS product_name,
  p_type AS category_name, p_brand AS supplier_name, p_name || ', ' || p_type AS description, split_part(p_name, ' ', 1) AS color,
  CAST(p_size AS VARCHAR) AS size, (p_size // 10) || '.' || (p_size % 10) AS weight,
  CASE r WHEN 0 THEN '-1' WHEN 1 THEN '0' WHEN 2 THEN 'abc' ELSE {_p('pc')} END AS unit_price,
  CASE WHEN r = 4 THEN '-5' ELSE {_p('((pc * 70 + 50) // 100)')} END AS cost, {_p('(pc * 120 // 100)')} AS list_price,
  CASE r WHEN 5 THEN 'true' WHEN 6 THEN 'maybe' WHEN 7 THEN NULL ELSE CASE WHEN p_partkey % 10 = 0 THEN 'TRUE' ELSE 'FALSE' END END AS discontinued,
  'products_batch' || (p_partkey % 3) || '.csv' AS file_name
FROM (SELECT *, p_partkey % 40 AS r, CAST(p_partkey AS VARCHAR) AS t, CAST(round(p_retailprice * 100) AS BIGINT) AS pc FROM part) AS x"""
CTES["raw_segments"] = """
SELECT CASE WHEN segment_id <> 4 THEN CAST(segment_id AS VARCHAR) END AS segment_id, segment_name,
  segment_name || ' customer segment' AS description,
  CASE WHEN segment_id = 2 THEN 'abc' ELSE CAST(segment_id * 1000 AS VARCHAR) END AS min_annual_revenue,
  CASE WHEN segment_id <> 1 THEN (segment_id * 1000 + 999) || '.5' END AS max_annual_revenue,
  '0.' || lpad(CAST(segment_id * 5 AS VARCHAR), 2, '0') AS discount_rate, 'customer_segments.csv' AS file_name
FROM (SELECT DISTINCT c_mktsegment AS segment_name FROM customer WHERE c_mktsegment IS NOT NULL) AS n LEFT JOIN market USING (segment_name)"""
CTES["raw_categories"] = """
SELECT CAST(category_id AS VARCHAR) AS category_id, category_name, category_name || ' products, and accessories' AS description,
  CASE category_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'none' ELSE CAST(category_id - 1 AS VARCHAR) END AS parent_category_id,
  'categories.csv' AS file_name
FROM (SELECT DISTINCT p_type AS category_name FROM part WHERE p_type IS NOT NULL) AS n LEFT JOIN category USING (category_name)"""
CTES["raw_suppliers"] = """
SELECT CASE WHEN s_suppkey % 40 <> 3 THEN t END AS supplier_id, s_name AS supplier_name, 'Contact ' || t AS contact_name,
  'Manager' AS contact_title, t || ' Dock Rd' AS address, n_name AS city, r_name || ' region' AS region, lpad(t, 5, '0') AS postal_code,
  'The united republic of the land of ' || n_name AS country, '+1 (555) 010-' || lpad(t, 4, '0') || ' ext. ' || t AS phone,
  'sales' || t || '@example.com' AS email, 'https://example.com/' || t AS website,
  CASE WHEN s_suppkey % 7 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
  CASE WHEN s_suppkey % 30 = 7 THEN 'n/a' ELSE (s_suppkey % 5) || '.' || (s_suppkey % 10) END AS rating, 'suppliers.csv' AS file_name
FROM (SELECT *, CAST(s_suppkey AS VARCHAR) AS t FROM supplier JOIN place ON s_nationkey = n_nationkey) AS x"""
CTES["raw_addresses"] = """
SELECT t AS address_id, CASE WHEN c_custkey % 45 = 5 THEN 'unknown' ELSE t END AS customer_id,
  CASE WHEN c_custkey % 45 = 7 THEN 'C?' ELSE 'C' || lpad(t, 8, '0') END AS customer_number,
  CASE WHEN c_custkey % 2 = 0 THEN 'BILLING' ELSE 'SHIPPING' END AS address_type, t || ' Main St' AS address_line_1,
  CASE c_custkey % 3 WHEN 0 THEN 'NULL' WHEN 1 THEN 'Apt ' || t END AS address_line_2, n_name AS city,
  'Province of ' || n_name || ', in the wide and fair lands of ' || r_name AS state_province,
  lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code, 'United kingdoms of the great ' || r_name AS country,
  CASE c_custkey % 6 WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN 'TRUE' WHEN 3 THEN '1' WHEN 4 THEN 'maybe' END AS is_default,
  'addresses.csv' AS file_name
FROM (SELECT *, CAST(c_custkey AS VARCHAR) AS t FROM customer JOIN place ON c_nationkey = n_nationkey) AS x"""
CTES["raw_departments"] = """
SELECT CASE WHEN r_regionkey <> 4 THEN t END AS department_id, r_name || ' sales' AS department_name, left(r_name, 3) AS department_code,
  'Department for ' || r_name AS description, CASE WHEN r_regionkey = 1 THEN '1,5' ELSE t || '00000.50' END AS budget, r_name AS location,
  '555-010' || t AS phone, 'dept' || t || '@example.com' AS email, 'departments.csv' AS file_name
FROM (SELECT *, CAST(r_regionkey AS VARCHAR) AS t FROM region) AS x"""
CTES["raw_positions"] = """
SELECT t AS position_id, 'Lead of ' || n_name AS position_title, 'LEAD_' || t AS position_code,
  CASE WHEN n_nationkey % 9 = 4 THEN 'x' ELSE CAST(n_regionkey AS VARCHAR) END AS department_id,
  CASE WHEN n_nationkey % 8 = 1 THEN 'high' ELSE CAST(n_nationkey % 10 AS VARCHAR) END AS job_level,
  (30000 + n_nationkey * 100) || '.25' AS min_salary, CAST(60000 + n_nationkey * 100 AS VARCHAR) AS max_salary,
  'Position in ' || n_name AS description, 'ACTIVE' AS status, 'positions.csv' AS file_name
FROM (SELECT *, CAST(n_nationkey AS VARCHAR) AS t FROM nation) AS x"""


def dec(c: str, kind: str) -> str:
    return f"CAST(TRY_CAST({c} AS DECIMAL{kind}) AS DOUBLE) AS {c}"


SQL["s01_csv_scan"] = "SELECT * EXCLUDE (key) FROM rawc"
SQL["s02_json_scan"] = """
SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""
SQL["s02_json_duplicate_keys"] = f"""
SELECT event_id % 5 = 0 AS has_duplicates, {big('COUNT(*)')} AS n FROM events GROUP BY 1"""
SQL["s03_parquet_scan"] = f"""
SELECT strftime(order_date, '%Y-%m') AS order_month, {big('COUNT(*)')} AS n_orders, MIN(order_date) AS first_date
FROM heads WHERE order_date >= DATE '2000-06-01' GROUP BY 1"""
SQL["s05_stage_scan"] = f"""
SELECT status, {big('COUNT(*)')} AS n, {big('SUM(order_id)')} AS id_sum FROM heads GROUP BY 1"""
SQL["s06_bulk_copy"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN o_orderkey % 30 <> 1 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS total,
  o_orderpriority || ', urgent' AS priority FROM orders WHERE o_orderkey % 40 <> 0 AND o_orderkey % 90 <> 7"""
SQL["s06_refused_rows"] = """
SELECT o_orderkey AS order_id, CAST(k AS INTEGER) AS n_fields,
  CASE WHEN k < 4 THEN 'too few' ELSE 'too many' END || ' fields: 4 expected, ' || k || ' found' AS reason, true AS has_row_number
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 90 = 7 THEN 2 ELSE 6 END AS k FROM orders
  WHERE o_orderkey % 40 = 0 OR o_orderkey % 90 = 7) AS x"""
SQL["s05_stage_accounts"] = f"""
SELECT event_type AS batch, 'LOADED' AS status, {big('COUNT(*)')} AS n_rows, {big('0')} AS n_refused FROM events GROUP BY 1
UNION ALL SELECT 'broken', 'NO ROWS', 0, 0"""
SQL["s06a_copy_segments"] = f"""
SELECT segment_name, description, {dec('min_annual_revenue', '(15,2)')}, {dec('max_annual_revenue', '(15,2)')},
  {dec('discount_rate', '(5,4)')} FROM raw_segments"""
SQL["s06b_copy_categories"] = """
SELECT category_name, description, TRY_CAST(NULLIF(parent_category_id, '') AS BIGINT) AS parent_category_id FROM raw_categories"""
SQL["s06c_copy_suppliers"] = f"SELECT * EXCLUDE (supplier_id, file_name, rating), {dec('rating', '(3,1)')} FROM raw_suppliers"
CTES["ided"] = """
SELECT rawp.*, CASE WHEN size = '9' THEN 1 ELSE CAST(category.category_id AS BIGINT) END AS category_id,
  CASE WHEN size = '7' THEN 1 ELSE CAST(split_part(supplier_name, '#', 2) AS BIGINT) END AS supplier_id
FROM rawp JOIN category USING (category_name)"""
SQL["s06d_copy_products"] = f"""
SELECT product_number, product_name, category_id, supplier_id, description, color, size,
  {dec('weight', '(8,2)')}, {dec('unit_price', '(10,2)')}, {dec('cost', '(10,2)')}, {dec('list_price', '(10,2)')},
  TRY_CAST(CASE WHEN discontinued <> 'maybe' THEN discontinued END AS BOOLEAN) AS discontinued FROM ided"""
SQL["s06e_copy_customers"] = """
SELECT customer_number, customer_type, company_name, first_name, last_name, email, phone, TRY_CAST(birth_date AS DATE) AS birth_date,
  gender, CAST(annual_income AS DOUBLE) AS annual_income, 'ACTIVE' AS status, 'EN' AS preferred_language,
  CASE WHEN gender = 'm' THEN TRUE END AS marketing_opt_in, CAST(registration_date AS DATE) AS registration_date FROM rawc"""
SQL["s06f_copy_addresses"] = """
SELECT cdim.customer_key AS customer_id, address_type, address_line_1, NULLIF(address_line_2, 'NULL') AS address_line_2, city, state_province,
  postal_code, country, CASE is_default WHEN 'True' THEN TRUE WHEN 'TRUE' THEN TRUE WHEN '1' THEN TRUE WHEN 'false' THEN FALSE END AS is_default
FROM raw_addresses JOIN cdim USING (customer_number)"""
SQL["s06g_copy_departments"] = f"""
SELECT department_name, department_code, description, {dec('budget', '(15,2)')}, location, phone, email FROM raw_departments"""
SQL["s06h_copy_positions"] = f"""
SELECT position_title, position_code, CAST(d.department_id AS BIGINT) AS department_id, TRY_CAST(job_level AS BIGINT) AS job_level,
  {dec('min_salary', '(10,2)')}, {dec('max_salary', '(10,2)')}, p.description, p.status
FROM raw_positions AS p JOIN raw_departments AS d ON p.department_id = d.department_id"""
SQL["s07_staged_rows"] = f"SELECT {big('COUNT(*)')} AS n_rows, {big('0')} AS broken_files FROM customer"
SQL["s08_mapped_suppliers"] = """
SELECT supplier_name, city, left(region, 50) AS region, left(country, 30) AS country, left(phone, 20) AS phone, rating FROM raw_suppliers"""
SQL["s09_loaded_customers"] = """
SELECT customer_number, customer_type, company_name, first_name, last_name, left(email, 100) AS email, left(phone, 20) AS phone,
  TRY_CAST(birth_date AS DATE) AS birth_date, gender, CAST(annual_income AS DOUBLE) AS annual_income, 'ACTIVE' AS status,
  'EN' AS preferred_language, length(city) % 5 NOT IN (1, 2) AS marketing_opt_in, CAST(registration_date AS DATE) AS registration_date
FROM rawc"""
SQL["s10_loaded_products"] = """
SELECT product_number, product_name, category_id, supplier_id, description, color, size, CAST(weight AS DOUBLE) AS weight,
  TRY_CAST(unit_price AS DOUBLE) AS unit_price, TRY_CAST(cost AS DOUBLE) AS cost, CAST(list_price AS DOUBLE) AS list_price,
  COALESCE(discontinued = 'true', FALSE) AS discontinued FROM ided"""
SQL["s11_loaded_addresses"] = """
SELECT cdim.customer_key AS customer_id, address_type, address_line_1, NULLIF(address_line_2, 'NULL') AS address_line_2, city,
  left(state_province, 50) AS state_province, postal_code, left(country, 30) AS country, COALESCE(is_default IN ('True', '1'), FALSE) AS is_default
FROM raw_addresses JOIN cdim USING (customer_number)"""
SQL["s12_table_scan"] = "SELECT order_id, customer_key AS customer_id, order_date, status FROM heads"
SQL["s13_row_generator"] = "SELECT sales_rep_key, copy FROM rdim, range(1, 6) AS t(copy)"
SQL["s14_inline_values"] = f"""
SELECT position_code, {big('COUNT(*)')} AS n_employees, {big('MAX(max_salary)')} AS max_salary
FROM posn JOIN emp USING (position_id) GROUP BY 1"""
SQL["e01_extract_counts"] = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, {big('COUNT(*)')} AS record_count FROM {t}"
    for n, t in (("customers", "rawc"), ("products", "rawp"), ("segments", "raw_segments"), ("categories", "raw_categories"),
                 ("suppliers", "raw_suppliers"), ("addresses", "raw_addresses"), ("departments", "raw_departments"), ("positions", "raw_positions"))
)
CTES["tc"] = f"""
SELECT trim(upper(customer_number)) AS customer_number, trim(upper(customer_type)) AS customer_type, trim(company_name) AS company_name,
  first_name, last_name, lower(trim(email)) AS email, regexp_replace(phone, '[^0-9]', '', 'g') AS phone,
  TRY_CAST(birth_date AS DATE) AS birth_date, upper(gender) AS gender, CAST(annual_income AS DOUBLE) AS annual_income,
  address_line_1, address_line_2, city, state_province, postal_code, upper(country) AS country,
  CAST(registration_date AS DATE) AS registration_date, file_name AS source_file,
  CASE WHEN customer_number IS NULL THEN 'customer number is missing'
    WHEN trim(upper(customer_type)) NOT IN ('INDIVIDUAL', 'BUSINESS') THEN 'customer type is unknown'
    WHEN NOT regexp_matches(lower(trim(email)), '{EMAIL}') THEN 'e-mail is not valid' END AS reject_reason
FROM rawc"""
SQL["e02_cleaned_customers"] = "SELECT * EXCLUDE (reject_reason), 'VALID' AS validation_status FROM tc WHERE reject_reason IS NULL"
SQL["e02_rejected_customers"] = """
SELECT customer_number, email, customer_type, reject_reason FROM tc WHERE reject_reason IS NOT NULL"""
CTES["tp"] = """
SELECT trim(upper(product_number)) AS product_number, trim(product_name) AS product_name, category_name, supplier_name, description,
  upper(color) AS color, upper(size) AS size, CAST(TRY_CAST(weight AS DECIMAL(8,2)) AS DOUBLE) AS weight,
  CAST(TRY_CAST(unit_price AS DECIMAL(10,2)) AS DOUBLE) AS unit_price, CAST(TRY_CAST(cost AS DECIMAL(10,2)) AS DOUBLE) AS cost,
  CAST(TRY_CAST(list_price AS DECIMAL(10,2)) AS DOUBLE) AS list_price, COALESCE(upper(discontinued) = 'TRUE', FALSE) AS discontinued,
  file_name AS source_file FROM rawp"""
SQL["e03_cleaned_products"] = """
SELECT *, 'VALID' AS validation_status FROM tp WHERE product_number IS NOT NULL AND product_name IS NOT NULL AND unit_price > 0 AND cost >= 0"""
SQL["e03_rejected_products"] = """
SELECT product_number, unit_price, CASE WHEN product_name IS NULL THEN 'product name is missing'
  WHEN unit_price IS NULL OR unit_price <= 0 THEN 'unit price is not positive' ELSE 'cost is negative or missing' END AS reject_reason
FROM tp WHERE product_name IS NULL OR unit_price IS NULL OR unit_price <= 0 OR cost < 0"""
TAIL = "file_name AS source_file, 'VALID' AS validation_status"
SQL["e04_clean_segments"] = f"""
SELECT TRY_CAST(segment_id AS BIGINT) AS segment_id, segment_name, description, {dec('min_annual_revenue', '(15,2)')},
  {dec('max_annual_revenue', '(15,2)')}, {dec('discount_rate', '(5,4)')}, {TAIL} FROM raw_segments WHERE segment_id IS NOT NULL"""
SQL["e04_clean_categories"] = f"""
SELECT TRY_CAST(category_id AS BIGINT) AS category_id, category_name, description,
  TRY_CAST(NULLIF(parent_category_id, '') AS BIGINT) AS parent_category_id, {TAIL} FROM raw_categories WHERE category_id IS NOT NULL"""
SQL["e04_clean_suppliers"] = f"""
SELECT * EXCLUDE (supplier_id, rating, file_name), TRY_CAST(supplier_id AS BIGINT) AS supplier_id, {dec('rating', '(3,1)')}, {TAIL}
FROM raw_suppliers WHERE supplier_id IS NOT NULL"""
SQL["e04_clean_addresses"] = f"""
SELECT TRY_CAST(address_id AS BIGINT) AS address_id, TRY_CAST(customer_id AS BIGINT) AS customer_id, address_type, address_line_1,
  address_line_2, city, state_province, postal_code, country,
  CASE is_default WHEN 'True' THEN TRUE WHEN 'TRUE' THEN TRUE WHEN '1' THEN TRUE WHEN 'false' THEN FALSE END AS is_default, {TAIL}
FROM raw_addresses"""
SQL["e04_clean_departments"] = f"""
SELECT TRY_CAST(department_id AS BIGINT) AS department_id, department_name, department_code, description, {dec('budget', '(15,2)')},
  location, phone, email, {TAIL} FROM raw_departments WHERE department_id IS NOT NULL"""
SQL["e04_clean_positions"] = f"""
SELECT TRY_CAST(position_id AS BIGINT) AS position_id, position_title, position_code, TRY_CAST(department_id AS BIGINT) AS department_id,
  TRY_CAST(job_level AS BIGINT) AS job_level, {dec('min_salary', '(10,2)')}, {dec('max_salary', '(10,2)')}, description, status, {TAIL}
FROM raw_positions"""
_DROP = "source_file, validation_status"
SQL["e05_load_segments"] = f"SELECT * EXCLUDE (segment_id, {_DROP}) FROM ({SQL['e04_clean_segments']}) AS c WHERE segment_id > 2"
SQL["e05_load_categories"] = f"SELECT * EXCLUDE (category_id, {_DROP}) FROM ({SQL['e04_clean_categories']}) AS c WHERE category_id > 3"
SQL["e05_load_suppliers"] = f"SELECT * EXCLUDE (supplier_id, {_DROP}) FROM ({SQL['e04_clean_suppliers']}) AS c"
SQL["e05_load_departments"] = f"SELECT * EXCLUDE (department_id, {_DROP}) FROM ({SQL['e04_clean_departments']}) AS c"
SQL["e05_load_positions"] = f"""
SELECT * EXCLUDE (position_id, {_DROP}) FROM ({SQL['e04_clean_positions']}) AS c
WHERE department_id IN (SELECT department_id FROM ({SQL['e04_clean_departments']}) AS d)"""
SQL["e06_full_run_log"] = f"""
WITH c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (reject_reason IS NULL) AS v FROM tc),
p AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (product_name IS NOT NULL AND unit_price > 0 AND cost >= 0) AS v FROM tp)
SELECT 'ETL_CUSTOMERS' AS process_name, 'SUCCESS' AS status, {big('n')} AS records_processed, {big('v')} AS records_inserted,
  {big('0')} AS records_updated, {big('n - v')} AS records_rejected FROM c
UNION ALL SELECT 'ETL_PRODUCTS', 'SUCCESS', {big('n')}, {big('v')}, 0, {big('n - v')} FROM p
UNION ALL SELECT 'FULL_ETL_PIPELINE', 'SUCCESS', {big('c.n + p.n')}, {big('c.v + p.v')}, 0, 0 FROM c, p"""
SQL["s05_incremental_copy"] = f"""
SELECT CASE WHEN reject_reason IS NULL THEN 'VALID' ELSE 'REJECTED' END AS validation_status, {big('COUNT(*)')} AS n FROM tc GROUP BY 1"""
SQL["m01_truncate_and_load"] = f"""
SELECT customer_type, {big('COUNT(*)')} AS loaded_count FROM tc WHERE reject_reason IS NULL GROUP BY 1"""
SQL["m02_overwrite_load"] = "SELECT order_id, status FROM heads WHERE status = 'SHIPPED'"
SQL["m03_inserted_rows"] = """
SELECT order_id, status, CASE WHEN status = 'SHIPPED' THEN freight END AS freight FROM heads"""
SQL["m04_deleted_rows"] = "SELECT order_id, order_date FROM heads WHERE year(order_date) <> 1998"
SQL["m05_updated_rows"] = """
SELECT order_id, CASE WHEN status = 'PENDING' AND order_date < DATE '1996-01-01' THEN 'CANCELLED' ELSE status END AS status,
  CASE WHEN status = 'PENDING' AND order_date < DATE '1996-01-01' THEN 0 ELSE freight END AS freight FROM heads"""
SQL["m06_updated_from_aggregate"] = f"""
SELECT order_id, status, (SELECT COUNT(*) FROM item WHERE item.order_id = heads.order_id) AS line_count,
  {big('COALESCE((SELECT SUM(quantity) FROM item WHERE item.order_id = heads.order_id), 0)')} AS units FROM heads"""
SQL["m09_process_log"] = """
SELECT 'ORDER_DATA_LOAD' AS process_name, 'SUCCESS' AS status, COUNT(*) AS records_processed, COUNT(*) AS records_inserted,
  CAST(0 AS BIGINT) AS records_updated, CAST(0 AS BIGINT) AS records_rejected, CAST(NULL AS VARCHAR) AS error_message FROM orders
UNION ALL SELECT 'INVENTORY_UPDATE', 'ERROR', COUNT(*), 0, 0, 0, 'no stock' FROM part"""
SQL["m10_lineage_rows"] = """
SELECT t.*, CASE source_table WHEN 'ORDERS' THEN (SELECT COUNT(*) FROM orders) WHEN 'ORDER_ITEMS' THEN (SELECT COUNT(*) FROM lineitem)
    ELSE (SELECT COUNT(*) FROM customer) END AS source_rows
FROM (VALUES ('STG_CUSTOMERS_RAW', 'CUSTOMER_NUMBER', 'CUSTOMERS', 'CUSTOMER_NUMBER', 'DIRECT_COPY', 'CUSTOMER_ETL'),
  ('STG_CUSTOMERS_RAW', 'ANNUAL_INCOME', 'CUSTOMERS', 'ANNUAL_INCOME', 'CAST_TO_DECIMAL', 'CUSTOMER_ETL'),
  ('CUSTOMERS', 'CUSTOMER_ID', 'CUSTOMER_DIM', 'CUSTOMER_ID', 'DIRECT_COPY', 'DIM_LOAD'),
  ('ORDERS', 'ORDER_DATE', 'SALES_FACT', 'ORDER_DATE_KEY', 'DATE_LOOKUP', 'FACT_LOAD'),
  ('ORDER_ITEMS', 'QUANTITY', 'SALES_FACT', 'QUANTITY', 'DIRECT_COPY', 'FACT_LOAD'))
  AS t(source_table, source_column, target_table, target_column, transformation_rule, process_name)"""
SQL["m11_restored_snapshot"] = f"SELECT status, {big('COUNT(*)')} AS n, {big('0')} AS n_while_truncated FROM heads GROUP BY 1"
SQL["m12_exported_csv"] = """
SELECT product_number, product_name, category_name, CAST(list_price * 100 AS BIGINT) AS price_c FROM pdim"""
SQL["b09_stored_fact_months"] = REPORTS["q11_monthly_comparison"]
SQL["b09_stored_fact_territories"] = VIEWS["v04_territory_sales_analysis"]
SQL["u03_named_runs"] = f"""
SELECT 'CUSTOMERS' AS table_name, 'SUCCESS' AS status, {big('COUNT(*)')} AS loaded FROM tc WHERE reject_reason IS NULL
UNION ALL SELECT 'ORDERS', 'SKIPPED', NULL UNION ALL SELECT 'PRODUCTS', 'ERROR', NULL"""
