"""Scans, loads and stored-table jobs over files written from the input tables.

A query here first writes the raw form of whole input tables to the shared folder,
as a source system would deliver them, and then reads them the way under test.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet import schemas
from martlet.functions.dates import day
from martlet.functions.text import cut, flag, to_type
from martlet.operators import mutate
from martlet.operators.lookup import lookup
from martlet.plans import builds, etl, reports, views
from martlet.session import fresh_path
from martlet.sources import files, raw
from martlet.sources.mart import Mart
from martlet.sources.stored import StoredMart, store_fact
from martlet.sources.tables import Tables
from martlet.streaming.staging import copy_new_files, read_copied


def _stage(m: Mart, df: DataFrame, label: str) -> str:
    return files.write_csv(df, fresh_path(m.spark, label))


def _double(*columns: str) -> list[Column]:
    return [F.col(c).cast("double").alias(c) for c in columns]


# ---- scans -----------------------------------------------------------------------

def csv_scan(m: Mart) -> DataFrame:
    """Raw customers through a CSV round trip, null tokens resolved."""
    source = raw.customers(m).withColumn(
        "address_line_2",
        F.when(F.col("customer_number").endswith("1"), "NULL").otherwise("null"),
    )
    return files.read_csv(m.spark, _stage(m, source, "customers"), source.columns)


def json_scan(m: Mart) -> DataFrame:
    """Events as JSON, with their properties parsed by a declared schema."""
    path = fresh_path(m.spark, "events-json")
    m.table("events").select(
        "event_id", "event_type", "value", F.from_json("props", "k int").alias("props")
    ).write.json(path)
    rows = files.read_json(
        m.spark, path, "event_id bigint, event_type string, value double, props struct<k: int>"
    )
    return rows.select("event_id", "event_type", "value", F.col("props.k").alias("k"))


def json_duplicate_keys(m: Mart) -> DataFrame:
    """Property texts checked for keys named twice; every fifth text has one added."""
    text = F.when(
        F.col("event_id") % 5 == 0, F.regexp_replace("props", r"\}$", ', "k": 0}')
    ).otherwise(F.col("props"))
    rows = m.table("events").withColumn("text", text)
    return rows.groupBy(files.has_duplicate_keys("text").alias("has_duplicates")).agg(
        F.count(F.lit(1)).alias("n")
    )


def parquet_scan(m: Mart) -> DataFrame:
    """Orders stored by month; the date filter reads only the months it needs."""
    path = fresh_path(m.spark, "orders-by-month")
    orders = m.orders.withColumn("order_month", F.date_format("order_date", "yyyy-MM"))
    # Rows of a month meet in a few tasks before the write; AQE splits a large month.
    orders.hint("rebalance", "order_month").write.partitionBy("order_month").parquet(path)
    stored = files.read_parquet(m.spark, path, orders.schema)
    return (
        stored.filter(F.col("order_month") >= "2000-06")
        .groupBy("order_month")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.min("order_date").alias("first_date"))
    )


def stage_scan(m: Mart) -> DataFrame:
    """All CSV files below a folder of folders, other files left alone."""
    path = fresh_path(m.spark, "stage")
    for part in ("a", "b"):
        keep = F.col("order_id") % 2 == (0 if part == "a" else 1)
        files.write_csv(m.orders.filter(keep).select("order_id", "status"), f"{path}/{part}")
    m.orders.select("order_id").write.json(f"{path}/other")
    rows = files.read_stage(
        m.spark, path, "csv", "order_id bigint, status string", "*.csv", header="true"
    )
    return rows.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("order_id").alias("id_sum")
    )


def table_scan(m: Mart) -> DataFrame:
    m.orders.createOrReplaceTempView("martlet_orders")
    return m.spark.table("martlet_orders").select("order_id", "customer_id", "order_date", "status")


def row_generator(m: Mart) -> DataFrame:
    """Generated rows: five per rep, as the order generator makes them."""
    return m.reps.select("sales_rep_key").withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(5).cast("bigint")))
    )


def inline_values(m: Mart) -> DataFrame:
    """Inline seed rows (positions) joined with the staff that holds them."""
    return m.positions.join(m.employees, "position_id").groupBy("position_code").agg(
        F.count(F.lit(1)).alias("n_employees"), F.max("max_salary").alias("max_salary")
    )


def incremental_copy(m: Mart) -> DataFrame:
    """A stage folder copied twice: the second run takes only the files added since."""
    stage, target = fresh_path(m.spark, "stage"), fresh_path(m.spark, "copied")
    state = fresh_path(m.spark, "copied-state")
    rows = raw.customers(m).drop("file_name")
    early = F.col("registration_date") < "1994-07-01"
    for part in (rows.filter(early), rows.filter(~early)):
        files.write_csv(part, f"{stage}/{uuid.uuid4().hex}")
        copy_new_files(m.spark, f"{stage}/*", target, state, rows.columns, etl.transform_customers)
    return read_copied(m.spark, target).groupBy("validation_status").agg(
        F.count(F.lit(1)).alias("n")
    )


# ---- bulk copy --------------------------------------------------------------------

def _order_lines(m: Mart) -> str:
    """Orders as lines of text; every fortieth key has two fields too many, and every
    ninetieth breaks off after the second."""
    key = F.col("o_orderkey")
    whole = F.concat_ws(
        ",",
        key.cast("string"),
        F.col("o_custkey").cast("string"),
        F.when(key % 30 == 1, "n/a").otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string")),
        F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(', urgent"')),
        F.when(key % 40 == 0, "surplus,fields"),
    )
    short = F.concat_ws(",", key.cast("string"), F.col("o_custkey").cast("string"))
    path = fresh_path(m.spark, "copy")
    text = F.when(key % 90 == 7, short).otherwise(whole)
    m.table("orders").select(text.alias("line")).write.text(path)
    return path


def bulk_copy(m: Mart) -> DataFrame:
    """Positional copy of order lines of text; rows with too many or too few fields are
    skipped and numbers that do not parse become NULL."""
    rows, _ = files.copy_rows(m.spark, _order_lines(m), 4, header=False)
    return files.project(
        rows,
        order_id=to_type("c1", "bigint"),
        customer_id=to_type("c2", "bigint"),
        total=to_type("c3", "decimal(12,2)").cast("double"),
        priority=F.col("c4"),
    )


def refused_rows(m: Mart) -> DataFrame:
    """The order lines a bulk copy skips, each with its reason."""
    refused = files.refused_rows(m.spark, _order_lines(m), 4, header=False)
    return refused.select(
        F.split_part("record", F.lit(","), F.lit(1)).cast("bigint").alias("order_id"),
        "n_fields",
        "reason",
        (F.col("row_number") > 0).alias("has_row_number"),
    )


def stage_accounts(m: Mart) -> DataFrame:
    """Files and rows of a stage folder by batch: read, refused, or without rows. One
    batch of Parquet files is text under a Parquet name."""
    path = fresh_path(m.spark, "accounts")
    events = m.table("events")
    events.select("event_id", "value", F.col("event_type").alias("batch")).write.partitionBy(
        "batch"
    ).parquet(path)
    events.select("props").write.text(f"{path}/batch=broken")
    accounts = files.file_accounts(
        m.spark, path, "parquet", "event_id bigint, value double", "part-*"
    )
    return accounts.groupBy(
        F.regexp_extract("path", "/batch=([^/]*)/", 1).alias("batch"), "status"
    ).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_refused").alias("n_refused"))


def _positional(m: Mart, name: str) -> DataFrame:
    source = raw.REFERENCE[name](m).drop("file_name")
    rows, _ = files.copy_rows(m.spark, _stage(m, source, name), len(source.columns))
    return rows


def _number(c: str, kind: str = "double") -> Column:
    return to_type(c, kind)


def copy_segments(m: Mart) -> DataFrame:
    return files.project(
        _positional(m, "segments"),
        segment_name=F.col("c2"),
        description=F.col("c3"),
        min_annual_revenue=to_type("c4", "decimal(15,2)").cast("double"),
        max_annual_revenue=to_type("c5", "decimal(15,2)").cast("double"),
        discount_rate=to_type("c6", "decimal(5,4)").cast("double"),
    )


def copy_categories(m: Mart) -> DataFrame:
    return files.project(
        _positional(m, "categories"),
        category_name=F.col("c2"),
        description=F.col("c3"),
        parent_category_id=to_type(F.nullif(F.col("c4"), F.lit("")), "bigint"),
    )


def copy_suppliers(m: Mart) -> DataFrame:
    names = [c for c, _ in schemas.CLEAN["suppliers"]][1:-1]
    return files.project(
        _positional(m, "suppliers"),
        **{c: F.col(f"c{i}") for i, c in enumerate(names, start=2)},
        rating=to_type("c14", "decimal(3,1)").cast("double"),
    )


def _with_ids(m: Mart, rows: DataFrame, category: str, supplier: str) -> DataFrame:
    """Category and supplier ids by name; names without a match get id 1."""
    known = m.suppliers.select(
        F.col("supplier_id").alias("_sid"), F.col("supplier_name").alias("_sname")
    )
    groups = m.categories.select(
        F.col("category_id").alias("_cid"), F.col("category_name").alias("_cname")
    )
    with_category = lookup(
        rows, groups, F.col(category) == F.col("_cname"), "_cid", "category_id", 1
    )
    return lookup(
        with_category, known, F.col(supplier) == F.col("_sname"), "_sid", "supplier_id", 1
    )


def _named_products(m: Mart) -> DataFrame:
    """Raw products; those of two sizes name a category or a supplier nobody knows."""
    def old(column: str, size: str) -> Column:
        return F.when(F.col("size") == size, F.concat(F.lit("Old "), F.col(column))).otherwise(F.col(column))

    return raw.products(m).drop("file_name").withColumns(
        {"category_name": old("category_name", "9"), "supplier_name": old("supplier_name", "7")}
    )


def copy_products(m: Mart) -> DataFrame:
    source = _named_products(m).withColumn("number", F.lit("0"))
    source = source.select("number", *schemas.RAW_PRODUCTS)
    rows, _ = files.copy_rows(m.spark, _stage(m, source, "products"), len(source.columns))
    return _with_ids(m, rows, "c4", "c5").select(
        F.col("c2").alias("product_number"),
        F.col("c3").alias("product_name"),
        "category_id",
        "supplier_id",
        F.col("c6").alias("description"),
        F.col("c7").alias("color"),
        F.col("c8").alias("size"),
        *[
            to_type(c, kind).cast("double").alias(n)
            for c, n, kind in (
                ("c9", "weight", "decimal(8,2)"), ("c10", "unit_price", "decimal(10,2)"),
                ("c11", "cost", "decimal(10,2)"), ("c12", "list_price", "decimal(10,2)"),
            )
        ],
        to_type("c13", "boolean").alias("discontinued"),
    )


def copy_customers(m: Mart) -> DataFrame:
    source = raw.customers(m).select(
        F.lit("0").alias("id"), "customer_number", "customer_type", "company_name", "first_name",
        "last_name", "email", "phone", "birth_date", "gender", "annual_income",
        F.lit("ACTIVE").alias("status"), F.lit("EN").alias("language"),
        F.when(F.col("gender") == "m", "yes").otherwise("off").alias("opt_in"),
        "registration_date",
    )
    rows, _ = files.copy_rows(m.spark, _stage(m, source, "customers"), len(source.columns))
    texts = ("customer_number", "customer_type", "company_name", "first_name", "last_name",
             "email", "phone")
    return files.project(
        rows,
        **{c: F.col(f"c{i}") for i, c in enumerate(texts, start=2)},
        birth_date=to_type("c9", "date"),
        gender=F.col("c10"),
        annual_income=to_type("c11", "decimal(15,2)").cast("double"),
        status=F.col("c12"),
        preferred_language=F.col("c13"),
        marketing_opt_in=to_type("c14", "boolean"),
        registration_date=to_type("c15", "date"),
    )


def copy_addresses(m: Mart) -> DataFrame:
    """Customer resolved by number; rows of unknown customers drop out."""
    source = raw.addresses(m).select(
        "address_id", "customer_number", "address_type", "address_line_1", "address_line_2",
        "city", "state_province", "postal_code", "country", "is_default",
    )
    rows, _ = files.copy_rows(m.spark, _stage(m, source, "addresses"), 10)
    known = m.customers.select("customer_id", F.col("customer_number").alias("c2"))
    texts = ("address_type", "address_line_1", "address_line_2", "city", "state_province",
             "postal_code", "country")
    return files.project(
        rows.join(known, "c2"),
        customer_id=F.col("customer_id"),
        **{c: F.col(f"c{i}") for i, c in enumerate(texts, start=3)},
        is_default=to_type("c10", "boolean"),
    )


def copy_departments(m: Mart) -> DataFrame:
    names = ("department_name", "department_code", "description")
    return files.project(
        _positional(m, "departments"),
        **{c: F.col(f"c{i}") for i, c in enumerate(names, start=2)},
        budget=to_type("c5", "decimal(15,2)").cast("double"),
        location=F.col("c6"),
        phone=F.col("c7"),
        email=F.col("c8"),
    )


def copy_positions(m: Mart) -> DataFrame:
    known = etl.clean_reference(raw.departments(m), "departments").select("department_id")
    rows = _positional(m, "positions").withColumn("department_id", to_type("c4", "bigint"))
    return files.project(
        rows.join(known, "department_id"),
        position_title=F.col("c2"),
        position_code=F.col("c3"),
        department_id=F.col("department_id"),
        job_level=to_type("c5", "bigint"),
        min_salary=to_type("c6", "decimal(10,2)").cast("double"),
        max_salary=to_type("c7", "decimal(10,2)").cast("double"),
        description=F.col("c8"),
        status=F.col("c9"),
    )


# ---- loaders ------------------------------------------------------------------------

def staged_rows(m: Mart) -> DataFrame:
    """Raw staging with lineage columns: every file is numbered 1..n without gaps."""
    source = raw.customers(m).drop("file_name")
    staged = files.with_lineage(m.spark, _stage(m, source, "customers"), source.columns)
    per_file = staged.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("row_number").alias("last"),
        F.sum("row_number").alias("total"),
    )
    broken = (F.col("n") != F.col("last")) | (F.col("total") * 2 != F.col("n") * (F.col("n") + 1))
    return per_file.agg(F.sum("n").alias("n_rows"), F.count_if(broken).alias("broken_files"))


# Lengths the target columns allow.
LIMITS = {"country": 30, "phone": 20, "region": 50, "state_province": 50, "email": 100}


def mapped_load(rows: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep and rename the mapped columns that exist, cut to the target's lengths."""
    return rows.select(
        *[
            (cut(old, LIMITS[new]) if new in LIMITS else F.col(old)).alias(new)
            for old, new in mapping.items()
            if old in rows.columns
        ]
    )


def mapped_suppliers(m: Mart) -> DataFrame:
    source = raw.suppliers(m).drop("file_name")
    rows = files.read_csv(m.spark, _stage(m, source, "suppliers"), source.columns)
    wanted = {c: c for c in ("supplier_name", "city", "region", "country", "phone", "fax", "rating")}
    return mapped_load(rows, wanted)


def load_customers(rows: DataFrame) -> DataFrame:
    """Customer load: missing columns take defaults, dates and numbers that do not
    parse become NULL, texts are cut, flags go through the vocabulary."""
    defaults = {"status": "ACTIVE", "preferred_language": "EN", "marketing_opt_in": "true"}
    columns = ["customer_number", "customer_type", "company_name", "first_name", "last_name",
               "email", "phone", "birth_date", "gender", "annual_income", "status",
               "preferred_language", "marketing_opt_in", "registration_date"]
    full = rows.select(
        *[
            F.col(c) if c in rows.columns else F.lit(defaults.get(c)).cast("string").alias(c)
            for c in columns
        ]
    )
    return full.withColumns(
        {
            "email": cut("email", LIMITS["email"]),
            "phone": cut("phone", LIMITS["phone"]),
            "birth_date": to_type("birth_date", "date"),
            "registration_date": to_type("registration_date", "date"),
            "annual_income": to_type("annual_income", "double"),
            "marketing_opt_in": flag("marketing_opt_in", True),
        }
    )


def loaded_customers(m: Mart) -> DataFrame:
    """From a file without status and language, with free-text opt-in flags."""
    words = F.array(*[F.lit(w) for w in ("True", "false", "0", "no", "1")])
    source = raw.customers(m).select(
        "customer_number", "customer_type", "company_name", "first_name", "last_name", "email",
        "phone", "birth_date", "gender", "annual_income", "registration_date",
        F.element_at(words, F.length("city") % 5 + 1).alias("marketing_opt_in"),
    )
    path = _stage(m, source, "customers")
    return load_customers(files.read_csv(m.spark, path, source.columns))


def loaded_products(m: Mart) -> DataFrame:
    source = _named_products(m)
    rows = files.read_csv(m.spark, _stage(m, source, "products"), source.columns)
    return _with_ids(m, rows, "category_name", "supplier_name").select(
        "product_number", "product_name", "category_id", "supplier_id", "description", "color",
        "size",
        *[to_type(c, "double").alias(c) for c in ("weight", "unit_price", "cost", "list_price")],
        flag("discontinued", False).alias("discontinued"),
    )


def loaded_addresses(m: Mart) -> DataFrame:
    """Addresses keyed by customer number; unresolved customers are dropped."""
    source = raw.addresses(m).drop("file_name", "customer_id")
    rows = files.read_csv(m.spark, _stage(m, source, "addresses"), source.columns)
    known = m.customers.select("customer_id", "customer_number")
    return rows.join(known, "customer_number").select(
        "customer_id", "address_type", "address_line_1", "address_line_2", "city",
        cut("state_province", LIMITS["state_province"]).alias("state_province"),
        "postal_code",
        cut("country", LIMITS["country"]).alias("country"),
        flag("is_default", False).alias("is_default"),
    )


# ---- extract, clean, load ------------------------------------------------------------

def extract_counts(m: Mart) -> DataFrame:
    """Rows found in each raw staging table."""
    frames = {"customers": raw.customers(m), "products": raw.products(m)}
    frames |= {name: make(m) for name, make in raw.REFERENCE.items()}
    counts = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count"
        )
        for name, df in frames.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def cleaned_customers(m: Mart) -> DataFrame:
    valid = etl.transform_customers(raw.customers(m)).valid
    return valid.withColumn("annual_income", F.col("annual_income").cast("double"))


def rejected_customers(m: Mart) -> DataFrame:
    return etl.transform_customers(raw.customers(m)).rejected.select(
        "customer_number", "email", "customer_type", "reject_reason"
    )


def cleaned_products(m: Mart) -> DataFrame:
    valid = etl.transform_products(raw.products(m)).valid
    numbers = ("weight", "unit_price", "cost", "list_price")
    return valid.withColumns({c: F.col(c).cast("double") for c in numbers})


def rejected_products(m: Mart) -> DataFrame:
    return etl.transform_products(raw.products(m)).rejected.select(
        "product_number", F.col("unit_price").cast("double").alias("unit_price"), "reject_reason"
    )


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparing."""
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("double")
            for f in df.schema
            if f.dataType.typeName() == "decimal"
        }
    )


def _cleaned(name: str):
    return lambda m: _plain(etl.clean_reference(raw.REFERENCE[name](m), name))


def _loaded(name: str, above: int | None = None):
    def load(m: Mart) -> DataFrame:
        cleaned = etl.clean_reference(raw.REFERENCE[name](m), name)
        departments = None
        if name == "positions":
            departments = etl.clean_reference(raw.departments(m), "departments")
        return _plain(etl.load_reference(cleaned, name, above, departments))

    return load


def _run(m: Mart) -> Tables:
    tables = Tables(m.spark, fresh_path(m.spark, "warehouse"))
    tables.replace("stg_customers_raw", raw.customers(m))
    tables.replace("stg_products_raw", raw.products(m))
    dims = {
        "customer_dim": (
            builds.customer_source(m), "customer_id",
            ["customer_name", "email", "annual_income", "status"],
        ),
        "product_dim": (
            builds.product_source(m), "product_id",
            ["product_name", "unit_price", "cost", "discontinued"],
        ),
    }
    etl.run(tables, ["CUSTOMERS", "PRODUCTS", "ORDERS", "MISSING"], dims, m.as_of)
    return tables


def full_run_log(m: Mart) -> DataFrame:
    """Process log of a full run over the raw customer and product tables."""
    return _run(m).process_log().select(
        "process_name", "status", "records_processed", "records_inserted", "records_updated",
        "records_rejected",
    )


# ---- stored tables --------------------------------------------------------------------

def truncate_and_load(m: Mart) -> DataFrame:
    """Clean staging replaced by a second load; the count is taken from the files."""
    tables = Tables(m.spark, fresh_path(m.spark, "warehouse"))
    cleaned = etl.transform_customers(raw.customers(m)).valid
    tables.replace("stg_customers_clean", cleaned)
    stored = tables.replace("stg_customers_clean", cleaned)
    return stored.groupBy("customer_type").agg(F.count(F.lit(1)).alias("loaded_count"))


def overwrite_load(m: Mart) -> DataFrame:
    path = fresh_path(m.spark, "overwrite")
    m.orders.write.parquet(path)
    m.orders.filter(F.col("status") == "SHIPPED").write.mode("overwrite").parquet(path)
    return m.spark.read.schema(m.orders.schema).parquet(path).select("order_id", "status")


def inserted_rows(m: Mart) -> DataFrame:
    """Two inserts of all orders into a stored table, the second lacking a column."""
    tables = Tables(m.spark, fresh_path(m.spark, "warehouse"))
    tables.insert("orders", m.orders.filter(F.col("status") == "SHIPPED"))
    return tables.insert(
        "orders", m.orders.filter(~F.col("status").eqNullSafe("SHIPPED")).drop("freight")
    ).select("order_id", "status", "freight")


def deleted_rows(m: Mart) -> DataFrame:
    """Orders of a date range deleted; unknown dates would stay."""
    gone = F.col("order_date").between(day(date(1998, 1, 1)), day(date(1998, 12, 31)))
    return mutate.delete_where(m.orders, gone).select("order_id", "order_date")


def updated_rows(m: Mart) -> DataFrame:
    late = (F.col("status") == "PENDING") & (F.col("order_date") < day(date(1996, 1, 1)))
    return mutate.update_where(
        m.orders, late, status=F.lit("CANCELLED"), freight=F.lit(0).cast("bigint")
    ).select("order_id", "status", "freight")


def updated_from_aggregate(m: Mart) -> DataFrame:
    """Orders with line count and units, by one aggregate and one join."""
    per_order = m.items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("q")
    )
    return mutate.update_from(
        m.orders.select("order_id", "status"), per_order, "order_id",
        line_count=F.coalesce("n", F.lit(0)), units=F.coalesce("q", F.lit(0)),
    )


def process_log(m: Mart) -> DataFrame:
    """Log entries with their counters, one of them a failure."""
    tables = Tables(m.spark, fresh_path(m.spark, "warehouse"))
    began = datetime.now()
    n = m.orders.count()
    tables.log_process("ORDER_DATA_LOAD", "SUCCESS", began, n, n)
    tables.log_process("INVENTORY_UPDATE", "ERROR", began, m.inventory.count(), error="no stock")
    return tables.process_log().filter("end_time >= start_time").drop("start_time", "end_time")


def lineage_rows(m: Mart) -> DataFrame:
    """Lineage entries, with the number of rows of the source they describe."""
    tables = Tables(m.spark, fresh_path(m.spark, "warehouse"))
    tables.add_lineage(list(etl.LINEAGE))
    counts = m.spark.range(0, 1, 1, 1).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("source_table"), m.row_count(t).alias("source_rows"))
                    for n, t in (
                        ("STG_CUSTOMERS_RAW", "customer"), ("CUSTOMERS", "customer"),
                        ("ORDERS", "orders"), ("ORDER_ITEMS", "lineitem"),
                    )
                ]
            )
        )
    )
    return tables.lineage().join(counts, "source_table")


def restored_snapshot(m: Mart) -> DataFrame:
    """Snapshot, then truncate, then restore: the table is whole again."""
    tables = Tables(m.spark, fresh_path(m.spark, "warehouse"))
    tables.replace("orders", m.orders)
    tables.snapshot("before", ["orders"])
    tables.truncate("orders")
    empty = tables.read("orders").agg(F.count(F.lit(1)).alias("n_empty"))
    tables.restore("before", ["orders"])
    return tables.read("orders").groupBy("status").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "n_while_truncated", empty.scalar()
    )


def _stored(m: Mart) -> StoredMart:
    tables = Tables(m.spark, fresh_path(m.spark, "warehouse"))
    store_fact(m, tables)
    return StoredMart(m, tables)


def stored_fact_months(m: Mart) -> DataFrame:
    """One year's monthly comparison from the stored fact: twelve months are read."""
    return reports.monthly_comparison(_stored(m))


def stored_fact_territories(m: Mart) -> DataFrame:
    """The territory view from the stored fact."""
    return views.territory_sales_analysis(_stored(m))


def exported_csv(m: Mart) -> DataFrame:
    """Product export as CSV with header, read back typed."""
    out = m.products.select("product_number", "product_name", "category_name", "price_c")
    rows = files.read_csv(m.spark, _stage(m, out, "export"), out.columns)
    return rows.withColumn("price_c", to_type("price_c", "bigint"))


def named_runs(m: Mart) -> DataFrame:
    """Status lines of runs by name: a good table, an unknown one, and one that fails
    because nothing was staged for it; the failure stops neither of the others."""
    tables = Tables(m.spark, fresh_path(m.spark, "warehouse"))
    tables.replace("stg_customers_raw", raw.customers(m))
    names = ("CUSTOMERS", "ORDERS", "PRODUCTS")
    lines = {n: etl.run_named(tables, n, {}, m.as_of) for n in names}
    said = F.array(*[
        F.struct(F.lit(n).alias("table_name"), F.lit(line).alias("line")) for n, line in lines.items()
    ])
    clean = tables.read("stg_customers_clean").filter("validation_status = 'VALID'")
    loaded = clean.agg(F.count(F.lit(1))).scalar()
    return m.spark.range(1).select(F.inline(said)).select(
        "table_name",
        F.regexp_extract("line", "^[A-Z]+: ([A-Z]+)", 1).alias("status"),
        F.when(F.col("table_name") == "CUSTOMERS", loaded).alias("loaded"),
    )


ALL = {
    "s01_csv_scan": csv_scan,
    "s02_json_scan": json_scan,
    "s02_json_duplicate_keys": json_duplicate_keys,
    "s03_parquet_scan": parquet_scan,
    "s05_stage_scan": stage_scan,
    "s05_incremental_copy": incremental_copy,
    "s05_stage_accounts": stage_accounts,
    "s06_bulk_copy": bulk_copy,
    "s06_refused_rows": refused_rows,
    "s06a_copy_segments": copy_segments,
    "s06b_copy_categories": copy_categories,
    "s06c_copy_suppliers": copy_suppliers,
    "s06d_copy_products": copy_products,
    "s06e_copy_customers": copy_customers,
    "s06f_copy_addresses": copy_addresses,
    "s06g_copy_departments": copy_departments,
    "s06h_copy_positions": copy_positions,
    "s07_staged_rows": staged_rows,
    "s08_mapped_suppliers": mapped_suppliers,
    "s09_loaded_customers": loaded_customers,
    "s10_loaded_products": loaded_products,
    "s11_loaded_addresses": loaded_addresses,
    "s12_table_scan": table_scan,
    "s13_row_generator": row_generator,
    "s14_inline_values": inline_values,
    "e01_extract_counts": extract_counts,
    "e02_cleaned_customers": cleaned_customers,
    "e02_rejected_customers": rejected_customers,
    "e03_cleaned_products": cleaned_products,
    "e03_rejected_products": rejected_products,
    **{f"e04_clean_{n}": _cleaned(n) for n in raw.REFERENCE},
    "e05_load_segments": _loaded("segments", 2),
    "e05_load_categories": _loaded("categories", 3),
    "e05_load_suppliers": _loaded("suppliers"),
    "e05_load_departments": _loaded("departments"),
    "e05_load_positions": _loaded("positions"),
    "e06_full_run_log": full_run_log,
    "m01_truncate_and_load": truncate_and_load,
    "m02_overwrite_load": overwrite_load,
    "m03_inserted_rows": inserted_rows,
    "m04_deleted_rows": deleted_rows,
    "m05_updated_rows": updated_rows,
    "m06_updated_from_aggregate": updated_from_aggregate,
    "m09_process_log": process_log,
    "m10_lineage_rows": lineage_rows,
    "m11_restored_snapshot": restored_snapshot,
    "u03_named_runs": named_runs,
    "m12_exported_csv": exported_csv,
    "b09_stored_fact_months": stored_fact_months,
    "b09_stored_fact_territories": stored_fact_territories,
}
