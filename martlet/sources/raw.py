"""Raw staging frames: the input tables as text, dirty the way files are.

The dirt is a function of the key, so what cleaning must do with a row is known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.sources.mart import Mart


def customers(m: Mart) -> DataFrame:
    """key % 50: 0 no number, 1 e-mail without @, 2 unknown type, 3 padded and mixed
    case, 4 formatted phone, 5 unreadable birth date, 6 the previous key's e-mail."""
    joined = m.table("customer").join(m.places, F.col("c_nationkey") == F.col("n_nationkey"))
    k = joined.withColumns(
        {
            "r": F.col("c_custkey") % 50,
            "t": F.col("c_custkey").cast("string"),
            "business": F.col("c_custkey") % 10 < 3,
        }
    )
    return k.selectExpr(
        "CASE WHEN r = 0 THEN NULL WHEN r = 3 THEN concat('  c', lpad(t, 8, '0'), ' ') "
        "ELSE concat('C', lpad(t, 8, '0')) END AS customer_number",
        "CASE WHEN r = 2 THEN 'PERSON' WHEN r = 3 THEN ' Individual ' WHEN business THEN 'BUSINESS' "
        "ELSE 'INDIVIDUAL' END AS customer_type",
        "CASE WHEN business THEN concat(' Company ', t) END AS company_name",
        "CASE WHEN NOT business THEN concat('First', t) END AS first_name",
        "CASE WHEN NOT business THEN concat('Last', t) END AS last_name",
        "CASE WHEN r = 1 THEN concat('user', t, '.example.com') "
        "WHEN r = 3 THEN concat(' User', t, '@Example.COM ') "
        "WHEN r = 6 THEN concat('user', cast(c_custkey - 1 AS string), '@example.com') "
        "ELSE concat('user', t, '@example.com') END AS email",
        "CASE WHEN r = 4 THEN concat('(555) 010-', lpad(cast(c_custkey % 10000 AS string), 4, '0')) "
        "ELSE concat('555-010-', lpad(cast(c_custkey % 10000 AS string), 4, '0')) END AS phone",
        "CASE WHEN r = 5 THEN 'not-a-date' ELSE cast(date_add(DATE '1950-01-01', "
        "cast(c_custkey * 37 % 18000 AS int)) AS string) END AS birth_date",
        "CASE WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'f' END AS gender",
        "cast(cast(round(c_acctbal * 100) AS bigint) AS string) AS annual_income",
        "concat(t, ' Main St') AS address_line_1",
        "cast(NULL AS string) AS address_line_2",
        "nation_name AS city",
        "region_name AS state_province",
        "lpad(cast(c_custkey % 100000 AS string), 5, '0') AS postal_code",
        "lower(region_name) AS country",
        "cast(date_add(DATE '1994-01-01', cast(c_custkey % 365 AS int)) AS string) "
        "AS registration_date",
        "concat('customers_batch', cast(c_custkey % 4 AS string), '.csv') AS file_name",
    )


def products(m: Mart) -> DataFrame:
    """key % 40: 0 price -1, 1 price 0, 2 price 'abc', 3 no name, 4 cost -5, 5 flag
    'true', 6 flag 'maybe', 7 no flag."""
    k = m.table("part").withColumns(
        {
            "r": F.col("p_partkey") % 40,
            "t": F.col("p_partkey").cast("string"),
            "pc": F.round(F.col("p_retailprice") * 100).cast("bigint"),
        }
    )

    def text(c: str) -> str:
        return f"concat(cast({c} div 100 AS string), '.', lpad(cast({c} % 100 AS string), 2, '0'))"

    return k.selectExpr(
        "concat('p', lpad(t, 6, '0')) AS product_number",
        "CASE WHEN r <> 3 THEN concat(p_name, ' ') END AS product_name",
        "p_type AS category_name",
        "p_brand AS supplier_name",
        "concat(p_name, ', ', p_type) AS description",
        "split_part(p_name, ' ', 1) AS color",
        "cast(p_size AS string) AS size",
        "concat(cast(p_size div 10 AS string), '.', cast(p_size % 10 AS string)) AS weight",
        f"CASE r WHEN 0 THEN '-1' WHEN 1 THEN '0' WHEN 2 THEN 'abc' ELSE {text('pc')} END "
        "AS unit_price",
        f"CASE WHEN r = 4 THEN '-5' ELSE {text('((pc * 70 + 50) div 100)')} END AS cost",
        f"{text('(pc * 120 div 100)')} AS list_price",
        "CASE r WHEN 5 THEN 'true' WHEN 6 THEN 'maybe' WHEN 7 THEN NULL ELSE "
        "CASE WHEN p_partkey % 10 = 0 THEN 'TRUE' ELSE 'FALSE' END END AS discontinued",
        "concat('products_batch', cast(p_partkey % 3 AS string), '.csv') AS file_name",
    )


def segments(m: Mart) -> DataFrame:
    """One row per market segment in the customer file, with an open upper bound and
    one unreadable number. A segment without an id yet has none, and no amounts."""
    names = m.table("customer").select(F.col("c_mktsegment").alias("segment_name")).distinct()
    return names.filter("segment_name IS NOT NULL").join(
        m.segments.selectExpr("segment_name AS name", "segment_id"),
        F.col("segment_name") == F.col("name"),
        "left",
    ).selectExpr(
        "CASE WHEN segment_id <> 4 THEN cast(segment_id AS string) END AS segment_id",
        "segment_name",
        "concat(segment_name, ' customer segment') AS description",
        "CASE WHEN segment_id = 2 THEN 'abc' ELSE cast(segment_id * 1000 AS string) END "
        "AS min_annual_revenue",
        "CASE WHEN segment_id <> 1 THEN concat(cast(segment_id * 1000 + 999 AS string), '.5') END "
        "AS max_annual_revenue",
        "concat('0.', lpad(cast(segment_id * 5 AS string), 2, '0')) AS discount_rate",
        "'customer_segments.csv' AS file_name",
    )


def categories(m: Mart) -> DataFrame:
    """One row per category in the product file; a new one has no id yet."""
    names = m.table("part").select(F.col("p_type").alias("category_name")).distinct()
    return names.filter("category_name IS NOT NULL").join(
        m.categories.selectExpr("category_name AS name", "category_id"),
        F.col("category_name") == F.col("name"),
        "left",
    ).selectExpr(
        "cast(category_id AS string) AS category_id",
        "category_name",
        "concat(category_name, ' products, and accessories') AS description",
        "CASE WHEN category_id % 3 = 0 THEN '' WHEN category_id % 3 = 1 THEN 'none' "
        "ELSE cast(category_id - 1 AS string) END AS parent_category_id",
        "'categories.csv' AS file_name",
    )


def suppliers(m: Mart) -> DataFrame:
    k = m.table("supplier").join(m.places, F.col("s_nationkey") == F.col("n_nationkey"))
    return k.withColumn("t", F.col("s_suppkey").cast("string")).selectExpr(
        "CASE WHEN s_suppkey % 40 <> 3 THEN t END AS supplier_id",
        "s_name AS supplier_name",
        "concat('Contact ', t) AS contact_name",
        "'Manager' AS contact_title",
        "concat(t, ' Dock Rd') AS address",
        "nation_name AS city",
        "concat(region_name, ' region') AS region",
        "lpad(t, 5, '0') AS postal_code",
        "concat('The united republic of the land of ', nation_name) AS country",
        "concat('+1 (555) 010-', lpad(t, 4, '0'), ' ext. ', t) AS phone",
        "concat('sales', t, '@example.com') AS email",
        "concat('https://example.com/', t) AS website",
        "CASE WHEN s_suppkey % 7 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status",
        "CASE WHEN s_suppkey % 30 = 7 THEN 'n/a' ELSE concat(cast(s_suppkey % 5 AS string), '.', "
        "cast(s_suppkey % 10 AS string)) END AS rating",
        "'suppliers.csv' AS file_name",
    )


def addresses(m: Mart) -> DataFrame:
    k = m.table("customer").join(m.places, F.col("c_nationkey") == F.col("n_nationkey"))
    return k.withColumn("t", F.col("c_custkey").cast("string")).selectExpr(
        "t AS address_id",
        "CASE WHEN c_custkey % 45 = 5 THEN 'unknown' ELSE t END AS customer_id",
        "CASE WHEN c_custkey % 45 = 7 THEN 'C?' ELSE concat('C', lpad(t, 8, '0')) END "
        "AS customer_number",
        "CASE WHEN c_custkey % 2 = 0 THEN 'BILLING' ELSE 'SHIPPING' END AS address_type",
        "concat(t, ' Main St') AS address_line_1",
        "CASE WHEN c_custkey % 3 = 0 THEN 'NULL' WHEN c_custkey % 3 = 1 THEN concat('Apt ', t) END "
        "AS address_line_2",
        "nation_name AS city",
        "concat('Province of ', nation_name, ', in the wide and fair lands of ', region_name) "
        "AS state_province",
        "lpad(cast(c_custkey % 100000 AS string), 5, '0') AS postal_code",
        "concat('United kingdoms of the great ', region_name) AS country",
        "CASE c_custkey % 6 WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN 'TRUE' "
        "WHEN 3 THEN '1' WHEN 4 THEN 'maybe' END AS is_default",
        "'addresses.csv' AS file_name",
    )


def departments(m: Mart) -> DataFrame:
    return m.table("region").withColumn("t", F.col("r_regionkey").cast("string")).selectExpr(
        "CASE WHEN r_regionkey <> 4 THEN t END AS department_id",
        "concat(r_name, ' sales') AS department_name",
        "left(r_name, 3) AS department_code",
        "concat('Department for ', r_name) AS description",
        "CASE WHEN r_regionkey = 1 THEN '1,5' ELSE concat(t, '00000.50') END AS budget",
        "r_name AS location",
        "concat('555-010', t) AS phone",
        "concat('dept', t, '@example.com') AS email",
        "'departments.csv' AS file_name",
    )


def positions(m: Mart) -> DataFrame:
    return m.table("nation").withColumn("t", F.col("n_nationkey").cast("string")).selectExpr(
        "t AS position_id",
        "concat('Lead of ', n_name) AS position_title",
        "concat('LEAD_', t) AS position_code",
        "CASE WHEN n_nationkey % 9 = 4 THEN 'x' ELSE cast(n_regionkey AS string) END "
        "AS department_id",
        "CASE WHEN n_nationkey % 8 = 1 THEN 'high' ELSE cast(n_nationkey % 10 AS string) END "
        "AS job_level",
        "concat(cast(30000 + n_nationkey * 100 AS string), '.25') AS min_salary",
        "cast(60000 + n_nationkey * 100 AS string) AS max_salary",
        "concat('Position in ', n_name) AS description",
        "'ACTIVE' AS status",
        "'positions.csv' AS file_name",
    )


REFERENCE = {
    "segments": segments,
    "categories": categories,
    "suppliers": suppliers,
    "addresses": addresses,
    "departments": departments,
    "positions": positions,
}
