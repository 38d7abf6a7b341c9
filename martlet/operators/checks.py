"""Data-quality building blocks: issues, ratios and declared expectations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.money import half_up

ISSUE_KEY = ["table_name", "column_name", "issue_type", "record_identifier"]


def issue(
    df: DataFrame, table: str, column: str | None, kind: str, text: str, severity: str, record
) -> DataFrame:
    """Rows of a failing frame as open issues, each naming its record."""
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(column).cast("string").alias("column_name"),
        F.lit(kind).alias("issue_type"),
        F.lit(text).alias("issue_description"),
        F.col(record).cast("string").alias("record_identifier"),
        F.lit(severity).alias("severity"),
        F.lit("OPEN").alias("status"),
    )


def merge_issues(known: DataFrame, found: DataFrame) -> DataFrame:
    """Issue table after a run: resolved ones gone, found ones added unless already
    open, so that running twice changes nothing."""
    kept = known.filter(F.coalesce(F.col("status") != "RESOLVED", F.lit(True)))
    left, right = found.alias("f"), kept.select(*ISSUE_KEY).alias("k")
    same = reduce(
        lambda a, b: a & b, [F.col(f"f.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ISSUE_KEY]
    )
    return kept.unionByName(left.join(right, same, "left_anti").select(*kept.columns))


def filled_percent(column: str) -> Column:
    """Share of rows with a value, in percent with two places."""
    return half_up(F.count(column) * 10000, F.count(F.lit(1))) / F.lit(100.0)


def duplicates(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


RULES = ("exists", "not_null", "unique", "matches", "at_least", "at_most", "one_of")


def expect(df: DataFrame, table: str, specs: list[tuple]) -> DataFrame:
    """Check declared expectations ``(column, rule[, argument])``.

    All row rules of a table are counted in one aggregate pass. Uniqueness needs a
    grouping per column and runs as an aggregate of its own. Result: one row per
    expectation with the number of rows that fail it.
    """
    for column, rule, *_ in specs:
        if rule not in RULES:
            raise ValueError(f"unknown rule {rule}")
        if rule != "exists" and column not in df.columns:
            raise ValueError(f"no column {column} in {table}")

    def failing(column: str, rule: str, argument=None) -> Column:
        c = F.col(column)
        ok = {
            "not_null": lambda: c.isNotNull(),
            "matches": lambda: c.isNull() | c.rlike(argument),
            "at_least": lambda: c.isNull() | (c >= argument),
            "at_most": lambda: c.isNull() | (c <= argument),
            "one_of": lambda: c.isNull() | c.isin(*argument),
        }[rule]()
        return F.count_if(~ok)

    def row(column: str, rule: str, failed: Column) -> Column:
        return F.struct(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(rule).alias("rule"),
            failed.cast("bigint").alias("failed_rows"),
        )

    by_row = [s for s in specs if s[1] not in ("exists", "unique")]
    static = [
        row(s[0], s[1], F.lit(0 if s[0] in df.columns else 1)) for s in specs if s[1] == "exists"
    ]
    counted = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[failing(*s).alias(f"_f{i}") for i, s in enumerate(by_row)],
    ).select(
        F.inline(
            F.array(*static, *[row(s[0], s[1], F.col(f"_f{i}")) for i, s in enumerate(by_row)])
        )
    )
    for column, rule, *_ in specs:
        if rule == "unique":
            surplus = duplicates(df, column).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_n"))
            counted = counted.unionByName(
                surplus.select(F.inline(F.array(row(column, rule, F.col("_n")))))
            )
    return counted.withColumn("passed", F.col("failed_rows") == 0)


def missing_columns(df: DataFrame, required: tuple[str, ...]) -> list[str]:
    return [c for c in required if c not in df.columns]
