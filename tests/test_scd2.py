from datetime import date

import pytest
from frames import rows
from pyspark.sql import functions as F

from martlet.operators import scd2

SCHEMA = "id int, name string, income int, phone string"
DAY1, DAY2, DAY3 = date(2020, 1, 1), date(2021, 1, 1), date(2022, 1, 1)
END = date(9999, 12, 31)


@pytest.fixture()
def start(spark):
    first = spark.createDataFrame(
        [(1, "same", 10, "a"), (2, "changes", 20, "b"), (3, "phone", 30, "c"),
         (4, "null to value", None, "d"), (5, "gone", 50, "e")], SCHEMA)
    return scd2.first_load(first, DAY1)


@pytest.fixture()
def source(spark):
    return spark.createDataFrame(
        [(1, "same", 10, "a"), (2, "changes", 21, "b"), (3, "phone", 30, "x"),
         (4, "null to value", 40, "d"), (6, "new", 60, "f")], SCHEMA)


def merged(target, source, as_of, **flags):
    return scd2.merge(target, source, "id", ["name", "income"], as_of, **flags)


def state(df):
    return rows(df, "id", "income", "effective_date", "expiry_date", "is_current", "version")


def test_merge_closes_and_opens_versions(start, source):
    got = state(merged(start, source, DAY2))
    assert got == sorted([
        (1, 10, DAY1, END, True, 1),
        (2, 20, DAY1, DAY2, False, 1), (2, 21, DAY2, END, True, 2),
        (3, 30, DAY1, END, True, 1),
        (4, None, DAY1, DAY2, False, 1), (4, 40, DAY2, END, True, 2),
        (5, 50, DAY1, END, True, 1),
        (6, 60, DAY2, END, True, 1),
    ], key=repr)


def test_second_run_changes_nothing(start, source):
    once = merged(start, source, DAY2)
    assert state(merged(once, source, DAY3)) == state(once)


def test_history_is_kept_over_many_versions(start, source):
    once = merged(start, source, DAY2)
    later = source.withColumn("income", F.when(F.col("id") == 2, 22).otherwise(F.col("income")))
    got = [r for r in state(merged(once, later, DAY3)) if r[0] == 2]
    assert got == sorted([
        (2, 20, DAY1, DAY2, False, 1), (2, 21, DAY2, DAY3, False, 2), (2, 22, DAY3, END, True, 3),
    ], key=repr)


def test_plain_comparison_ignores_null(start, source):
    got = state(merged(start, source, DAY2, null_safe=False))
    assert [r for r in got if r[0] == 4] == [(4, None, DAY1, END, True, 1)]


def test_single_pass_restarts_at_version_one(start, source):
    once = merged(start, source, DAY2, single_pass=True)
    assert [r for r in state(once) if r[0] == 2] == [(2, 20, DAY1, DAY2, False, 1)]
    twice = merged(once, source, DAY3, single_pass=True)
    assert (2, 21, DAY3, END, True, 1) in state(twice)


def test_one_current_row_per_key_and_counts(start, source):
    after = merged(start, source, DAY2)
    assert after.filter("is_current").groupBy("id").count().filter("count > 1").isEmpty()
    counts = scd2.merge_counts(start, after, DAY2).first()
    assert (counts.inserted, counts.expired) == (3, 2)


def test_expired_rows_have_an_end(start, source):
    after = merged(start, source, DAY2)
    assert after.filter("NOT is_current AND expiry_date = DATE '9999-12-31'").isEmpty()
