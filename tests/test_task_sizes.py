"""What one task of a retail job gets does not grow with the tables."""

import __spark_entry__ as entry
from martlet.llm import warc
from martlet.plans import features, models, synth
from martlet.session import small_tasks, written


def test_retail_jobs_ask_for_small_tasks(spark, sf_dir):
    session = spark.newSession()
    df = entry.queries()["v03_sales_rep_performance"](session, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "600), ENSURE_REQUIREMENTS" in plan and " 4), ENSURE_REQUIREMENTS" not in plan
    assert session.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    assert session.conf.get("spark.sql.files.maxPartitionBytes") == "32m"


def test_a_session_keeps_smaller_tasks_and_more_partitions(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8MB")
    session.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    session.conf.set("spark.sql.shuffle.partitions", "700")
    small_tasks(session)
    assert session.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8MB"
    assert session.conf.get("spark.sql.files.maxPartitionBytes") == str(1 << 20)
    assert session.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None


def test_customers_are_dealt_before_draws(spark):
    customers = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "customer_id long, name string")
    df = synth.copies_of(customers.coalesce(1), 3, "copy")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("hashpartitioning(customer_id")
    got = {(r.name, r.copy) for r in df.collect()}
    assert got == {(name, i) for name in "abc" for i in (1, 2, 3)} and df.count() == 9


def test_record_bytes_are_moved_once(spark):
    rows = [(i // 2 if i % 7 else None, f"u{i}", "x" * (i % 90)) for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    session_wide = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        records = warc.write_records(pages)
        plan = records._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        got = sorted(records.collect(), key=lambda r: (r.file, r.place))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", session_wide)
    assert [(r.file, r.place) for r in got] == [divmod(i, warc.PER_FILE) for i in range(3000)]
    assert [r.page_id for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    for file in range(3):
        inside = [r for r in got if r.file == file]
        assert [r.offset for r in inside] == [sum(len(x.data) for x in inside[:i]) for i in range(len(inside))]


def test_large_training_rows_are_dealt_evenly(spark, monkeypatch):
    rows = spark.range(2000).selectExpr("id AS customer_id", "id % 7 AS x")
    one, many = written(rows.coalesce(1), "one"), written(rows.repartition(13, "x"), "many")
    assert models._dealt(one, "customer_id") is one

    monkeypatch.setattr(models, "PART_ROWS", 50)
    cores = spark.sparkContext.defaultParallelism
    first, second = (models._dealt(df, "customer_id").rdd.glom().collect() for df in (one, many))
    assert first == second and len(first) == cores
    assert max(map(len, first)) < 2 * min(map(len, first))
    assert sorted(r.customer_id for part in first for r in part) == list(range(2000))


def test_value_forest_learns_from_dealt_rows(mart, monkeypatch):
    clv, labels = written(features.clv_features(mart), "clv"), []
    keep = models.written
    monkeypatch.setattr(models, "written", lambda df, label: labels.append(label) or keep(df, label))
    monkeypatch.setattr(models, "PART_ROWS", 1)
    got = models.train_clv(clv, trees=3)
    assert labels == ["clv", "dealt"]
    assert got.metrics["train_samples"] + got.metrics["test_samples"] == clv.count()
    assert got.model.stages[-1].getCacheNodeIds()


def test_value_features_write_only_what_they_read(mart, monkeypatch):
    seen, keep = {}, features.written
    monkeypatch.setattr(features, "written", lambda df, label: seen.setdefault(label, keep(df, label)))
    features.clv_features(mart)
    assert not {"units", "cost_c", "profit_c", "square_c", "active_months"} & {*seen["clv-base"].columns}


def test_lines_meet_their_orders_without_category_names(mart):
    plan = features._categories(mart)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner, (product_key") < plan.index("Join Inner, (order_id")
