from datetime import date, datetime

import pytest
from frames import rows
from pyspark.sql import functions as F

from martlet.plans import basics, builds, business, calendar, etl, features, models, reports, synth
from martlet.session import fresh_path
from martlet.sources import files
from martlet.sources.mart import Mart, Span
from martlet.sources.tables import Tables
from martlet.streaming.staging import copy_new_files, read_copied

REQUEST = ("request_id bigint, customer_id bigint, sales_rep_id bigint, ship_address string, "
           "items array<struct<product_id: bigint, quantity: bigint, unit_price: decimal(10,2), "
           "discount: decimal(5,4)>>")


def test_order_processing(spark):
    from decimal import Decimal as D

    requests = spark.createDataFrame([
        (1, 10, 1, "a", [(7, 2, D("10.00"), None)]),
        (2, 10, 1, "b", [(7, 1, D("9.99"), D("0.1")), (7, 3, D("0.05"), D("0")), (8, 1, D("1"), None)]),
        (3, 11, 1, "c", []),
        (4, None, 1, "d", [(7, 1, D("1"), None)]),
        (5, 12, 1, "e", [(7, None, D("1"), None)]),
    ], REQUEST)
    got = {r.request_id: r for r in business.process_orders(
        requests, datetime(2024, 5, 6, 7, 8, 9)).collect()}
    assert (got[1].subtotal, got[1].tax_amount, got[1].total_amount) == (20.0, 1.6, 21.6)
    assert got[1].order_number == "ORD202405060708091000"
    assert got[2].subtotal == 8.99 + 0.15 + 1.0 and got[2].item_count == 3
    assert (got[3].total_amount, got[3].status) == (0.0, "PENDING")
    assert got[4].order_number is None and "customer" in got[4].message
    assert got[5].status is None and "incomplete" in got[5].message
    stock = spark.createDataFrame(
        [(7, "MAIN", 50, 50, 0), (7, "WEST", 9, 9, 0), (8, "MAIN", 5, 5, 0)],
        "product_id bigint, location_code string, quantity_on_hand bigint, "
        "quantity_available bigint, quantity_allocated bigint")
    after = business.allocate_stock(stock, business.order_lines(requests))
    assert rows(after, "product_id", "location_code", "quantity_available", "quantity_allocated") == [
        (7, "MAIN", 44, 6), (7, "WEST", 9, 0), (8, "MAIN", 4, 1)]


@pytest.mark.parametrize("income,segment", [
    (10_000, 3), (9_999.99, 4), (100_000, 2), (1_000_000, 1), (None, 4)])
def test_onboarding_segment(spark, income, segment):
    got = spark.range(1).select(business.segment_for(F.lit(income).cast("double")).alias("s"))
    assert got.first().s == segment


@pytest.mark.parametrize("d,name", [
    (date(2018, 11, 22), "Thanksgiving"), (date(2019, 11, 28), "Thanksgiving"),
    (date(2020, 5, 25), "Memorial Day"), (date(2021, 5, 31), "Memorial Day"),
    (date(2025, 9, 1), "Labor Day"), (date(2020, 9, 7), "Labor Day"),
    (date(2020, 12, 25), "Christmas Day"), (date(2020, 2, 29), None), (date(2020, 11, 19), None)])
def test_holidays(spark, d, name):
    got = calendar.calendar(spark, d, d).first()
    assert got.holiday_name == name and got.is_holiday == (name is not None)


def test_fiscal_calendar(spark):
    got = {r.date_actual: (r.fiscal_year, r.fiscal_quarter, r.fiscal_month)
           for r in calendar.calendar(spark, date(2020, 6, 30), date(2020, 7, 1)).collect()}
    assert got == {date(2020, 6, 30): (2020, 4, 12), date(2020, 7, 1): (2021, 1, 1)}


def test_ten_year_calendar(spark):
    got = calendar.verify(calendar.calendar(spark, date(2020, 1, 1), date(2029, 12, 31))).first()
    assert (got.total_records, got.holiday_count) == (3653, 60)


RAW = ("customer_number string, customer_type string, company_name string, first_name string, "
       "last_name string, email string, phone string, birth_date string, gender string, "
       "annual_income string, address_line_1 string, address_line_2 string, city string, "
       "state_province string, postal_code string, country string, registration_date string, "
       "file_name string")


def raw_customer(number, kind, email, birth="1990-01-15"):
    return (number, kind, None, "A", "B", email, "123-456-7890", birth, "m", "50000", "x", None,
            "c", "s", "p", "usa", "2020-01-01", "f.csv")


def test_customer_rules(spark):
    raw = spark.createDataFrame([
        raw_customer(None, "INDIVIDUAL", "a@b.co"), raw_customer("c2 ", " individual", " A@B.Co "),
        raw_customer("C3", "INVALID", "a@b.co"), raw_customer("C4", "BUSINESS", "invalid-email"),
        raw_customer("C5", "BUSINESS", None), raw_customer("C6", "BUSINESS", "x@y.org", "soon"),
    ], RAW)
    got = etl.transform_customers(raw)
    assert rows(got.valid, "customer_number", "customer_type", "email", "phone") == [
        ("C2", "INDIVIDUAL", "a@b.co", "1234567890"), ("C6", "BUSINESS", "x@y.org", "1234567890")]
    assert got.valid.filter("birth_date IS NULL").count() == 1
    assert got.valid.count() + got.rejected.count() == raw.count()
    assert {r.reject_reason for r in got.rejected.collect()} == {
        "customer number is missing", "customer type is unknown", "e-mail is not valid"}
    wider = etl.transform_customers(raw, types=("INDIVIDUAL", "BUSINESS", "INVALID"))
    assert wider.valid.count() == 3


def test_run_isolates_failures(spark, caplog):
    tables = Tables(spark, fresh_path(spark, "t"))
    tables.replace("stg_customers_raw", spark.createDataFrame([raw_customer("C1", "BUSINESS", "a@b.co")], RAW))
    tables.replace("stg_products_raw", spark.createDataFrame([(1,)], "wrong int"))
    source = spark.createDataFrame([(1, "x")], "id int, name string")
    dims = {"customer_dim": (source, "id", ["name"])}
    got = etl.run(tables, ["CUSTOMERS", "PRODUCTS", "ORDERS"], dims, date(2020, 1, 1))
    assert got["CUSTOMERS"] == {"extracted": 1, "valid": 1, "invalid": 0, "loaded": 1}
    assert "error" in got["PRODUCTS"] and "ORDERS" not in got
    assert got["dimensional_updates"]["customer_dim"] == {"inserted": 1, "expired": 0}
    log = {r.process_name: r.status for r in tables.process_log().collect()}
    assert log == {"ETL_CUSTOMERS": "SUCCESS", "ETL_PRODUCTS": "ERROR", "FULL_ETL_PIPELINE": "SUCCESS"}
    changed = {"customer_dim": (spark.createDataFrame([(1, "y")], "id int, name string"), "id", ["name"])}
    again = etl.run(tables, [], changed, date(2020, 2, 1))
    assert again["dimensional_updates"]["customer_dim"] == {"inserted": 1, "expired": 1}
    assert etl.run_named(tables, "CUSTOMERS", {}, date(2020, 1, 1)) == "CUSTOMERS: SUCCESS, 1 loaded, 0 rejected"
    assert etl.run_named(tables, "OTHER", {}, date(2020, 1, 1)) == "OTHER: SKIPPED"


def test_versions_and_snapshots(spark):
    tables = Tables(spark, fresh_path(spark, "t"))
    df = spark.range(5)
    tables.replace("a", df)
    tables.replace("a", tables.read("a").filter("id > 1"))  # reads what it replaces
    assert tables.read("a").count() == 3
    tables.snapshot("s1", ["a"])
    tables.truncate("a")
    assert tables.read("a").count() == 0
    tables.restore("s1", ["a"])
    assert tables.read("a").count() == 3 and rows(tables.snapshots()) == [("s1",)]
    with pytest.raises(KeyError):
        tables.read("b")
    with pytest.raises(KeyError):
        tables.restore("s1", ["b"])


def write_lines(path, lines):
    path.write_text("\n".join(lines) + "\n")


def test_copy_skips_bad_rows(spark, tmp_path):
    write_lines(tmp_path / "x.csv", ["a,b", '1,"two, too"', "3", "4,five,six", "NULL,", "7,null"])
    good, bad = files.copy_rows(spark, str(tmp_path), 2)
    assert rows(good) == sorted([("1", "two, too"), (None, None), ("7", None)], key=repr)
    assert bad.count() == 2


def test_refused_rows_are_named(spark, tmp_path):
    for name, n in (("a.csv", 400), ("b.csv", 7)):
        lines = ["x,y"]
        for i in range(1, n + 1):
            lines.append({0: f'{i},"p, q",r', 1: f"{i}"}.get(i % 5, f'{i},"p, q"'))
        write_lines(tmp_path / name, lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = files.refused_rows(spark, str(tmp_path), 2).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {(f, i, 3 if i % 5 == 0 else 1) for f, n in (("a.csv", 400), ("b.csv", 7))
            for i in range(1, n + 1) if i % 5 < 2}
    assert {(r.file_name, r.row_number, r.n_fields) for r in got} == want
    assert all(r.record.split(",")[0] == str(r.row_number) for r in got)
    assert {r.reason for r in got} == {
        "too few fields: 2 expected, 1 found", "too many fields: 2 expected, 3 found"
    }


def test_file_accounts(spark, tmp_path):
    stage = tmp_path / "stage"
    spark.range(100).coalesce(1).write.parquet(str(stage / "good"))
    spark.range(10).coalesce(1).write.parquet(str(stage / "cut"))
    cut = next((stage / "cut").glob("*.parquet"))
    cut.with_name("x.parquet").write_bytes(cut.read_bytes()[:-20])
    write_lines(stage / "text.parquet", ["no parquet at all"])
    got = files.file_accounts(spark, str(stage), "parquet", "id bigint", "*.parquet").collect()
    found = sorted((r.status, r.n_rows, r.n_refused) for r in got)
    assert found == [("LOADED", 10, 0), ("LOADED", 100, 0), ("NO ROWS", 0, 0), ("NO ROWS", 0, 0)]
    assert all(r.bytes > 0 and (r.checksum is None) == (r.status == "NO ROWS") for r in got)


def test_account_of_refused_rows(spark, tmp_path):
    write_lines(tmp_path / "a.csv", ["1,2", "3", "4,5,6", "7,8"])
    write_lines(tmp_path / "b.csv", ["1,2"])
    (tmp_path / "c.csv").write_text("\n")
    (tmp_path / "d.csv").write_text("")
    got = files.file_accounts(spark, str(tmp_path), "csv", "x int, y int", "*.csv").collect()
    found = {r.path.rsplit("/", 1)[1]: (r.n_rows, r.n_refused, r.status) for r in got}
    assert found == {"a.csv": (2, 2, "REFUSED ROWS"), "b.csv": (1, 0, "LOADED"),
                     "c.csv": (0, 0, "NO ROWS")}


def test_file_row_numbers(spark, tmp_path):
    for name, n in (("a.csv", 500), ("b.csv", 3)):
        write_lines(tmp_path / name, ["v"] + [f"{name}{i}" for i in range(n)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = files.with_lineage(spark, str(tmp_path), ["v"]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 503
    assert all(r.v == f"{r.file_name}{r.row_number - 1}" for r in got)


def test_json_array_files(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"a": 1}, {"a": 2}]')
    assert rows(files.read_json(spark, str(tmp_path), "a int", array_files=True)) == [(1,), (2,)]
    texts = spark.createDataFrame([('{"a":1,"a":2}',), ('{"a":1,"b":2}',)], "t string")
    assert [r[0] for r in texts.select(files.has_duplicate_keys("t")).collect()] == [True, False]


def test_compressed_csv(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "x.csv.gz", "wt") as f:
        f.write("a,b\n1,x\n")
    assert rows(files.read_csv(spark, str(tmp_path), ["a", "b"])) == [("1", "x")]


def test_avro_is_optional(spark, tmp_path):
    if files.has_avro(spark):
        pytest.skip("the session has the Avro package")
    with pytest.raises(RuntimeError):
        files.read_avro(spark, str(tmp_path))


def test_incremental_copy_reads_a_file_once(spark, tmp_path):
    stage, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    stage.mkdir()
    columns = [f.split()[0] for f in RAW.split(", ")][:-1]

    def put(name, *numbers):
        lines = [",".join(columns)]
        for n in numbers:
            lines.append(",".join(x or "" for x in raw_customer(n, "BUSINESS", "a@b.co")[:-1]))
        write_lines(stage / name, lines)

    def copy():
        copy_new_files(spark, str(stage), target, state, columns, etl.transform_customers)
        return rows(read_copied(spark, target), "customer_number")

    put("one.csv", "C1", "C2")
    assert copy() == [("C1",), ("C2",)]
    assert copy() == [("C1",), ("C2",)]
    put("two.csv", "C3")
    assert copy() == [("C1",), ("C2",), ("C3",)]


def test_addresses_run_out(spark):
    customers = spark.range(10).withColumnRenamed("id", "customer_id")
    pool = spark.range(4).select(
        F.col("id").alias("address_id"), F.lit("BILLING").alias("address_type"),
        F.lit("s" * 60).alias("state_province"), F.lit("c").alias("country"))
    got = synth.assign_addresses(customers, pool).collect()
    assert sorted(r.address_id for r in got) == [0, 1, 2, 3]
    assert all(len(r.state_province) == 50 for r in got)


def test_order_totals_add_up(mart):
    totals = builds.order_totals(mart).agg(F.sum("subtotal")).first()[0]
    lines = mart.lines.agg(F.sum("line_c")).first()[0]
    assert abs(totals - lines / 100) < 0.01


def test_bad_parameters(mart):
    with pytest.raises(ValueError):
        Span(date(2001, 1, 1), date(2000, 1, 1))
    with pytest.raises(ValueError):
        reports.daily_sales(mart, date(2001, 1, 1), date(2000, 1, 1))
    with pytest.raises(ValueError):
        features.sales_time_series(mart, "hourly")
    with pytest.raises(ValueError):
        models.score_clv(None, None)


def test_income_and_age_bands(spark, sf_dir, monkeypatch):
    m = Mart(spark, sf_dir, as_of=date(2000, 6, 1))
    cases = [(1, 1976, 29999), (2, 1975, 30000), (3, 1966, 75000), (4, 1965, 150000),
             (5, 1936, None), (6, 1935, 1)]
    c = m.customer_master.limit(1).drop("customer_id", "birth_date", "annual_income")
    frame = spark.createDataFrame(
        [(i, date(y, 12, 31), inc) for i, y, inc in cases],
        "customer_id bigint, birth_date date, annual_income bigint")
    m.__dict__["customer_master"] = frame.crossJoin(c)
    got = {r.customer_id: (r.age_group, r.income_category) for r in builds.customer_source(m).collect()}
    assert got == {1: ("18-24", "Low"), 2: ("25-34", "Medium"), 3: ("25-34", "High"),
                   4: ("35-44", "Very High"), 5: ("55-64", "Very High"), 6: ("65+", "Low")}


def test_models_learn_and_repeat(mart):
    clv = features.clv_features(mart)
    first, second = models.train_clv(clv, trees=10), models.train_clv(clv, trees=10)
    assert first.metrics == second.metrics
    assert first.metrics["r2_score"] > 0.5
    assert abs(sum(first.importances.values()) - 1) < 1e-6


def test_churn_model_finds_the_leaked_label(mart):
    got = models.train_churn(features.churn_features(mart, threshold=300))
    assert got.metrics["auc_score"] > 0.9
    scores = models.churn_scores(got.model, features.churn_features(mart, threshold=300))
    assert scores.filter("churn_probability < 0 OR churn_probability > 1").isEmpty()


def test_splits_are_disjoint_and_whole(mart):
    df = mart.customers.select("customer_id")
    train, test = features.random_split(df, "customer_id")
    assert train.count() + test.count() == df.count()
    assert train.join(test, "customer_id").isEmpty()


def test_windows_follow_the_report_date(spark, sf_dir):
    m = Mart(spark, sf_dir, date(1996, 8, 1))
    dates = [r.order_date for r in m.orders.select("order_date").collect()]
    got = {r.period: r.n_orders for r in basics.union_all(m).collect()}
    starts = {"month": date(1996, 7, 1), "quarter": date(1996, 5, 1), "year": date(1995, 8, 1)}
    assert got == {k: sum(d >= v for d in dates) for k, v in starts.items()}
    late = m.orders.filter("order_date >= DATE '1996-07-25'").select("customer_id").distinct()
    assert rows(basics.semi_join(m), "customer_id") == rows(m.customers.join(late, "customer_id"), "customer_id")
    periods = [r.period_start for r in basics.period_join(m).select("period_start").distinct().collect()]
    assert min(periods) == date(1996, 1, 1) and max(periods) == date(1996, 7, 29)
