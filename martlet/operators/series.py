"""Time-series and chart-table operators over small, already aggregated frames.

The windows here run over one row per period or per category, so their single
sort partition holds thousands of rows at most, whatever the fact table holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lag_of(value: str, k: int, order: str) -> Column:
    return F.lag(value, k).over(Window.orderBy(order))


def full_window_sum(value: str, n: int, order: str) -> Column:
    """Sum over the last n rows; NULL until n rows exist."""
    w = Window.orderBy(order).rowsBetween(-(n - 1), 0)
    return F.when(F.count(value).over(w) == n, F.sum(value).over(w))


def ordinal(order: str) -> Column:
    """0, 1, 2, ... along ``order``."""
    return (F.row_number().over(Window.orderBy(order)) - 1).cast("bigint")


def waterfall(df: DataFrame, order: str, value: str, group: list[str] | None = None) -> DataFrame:
    """Running total after each step."""
    w = Window.partitionBy(*(group or [])).orderBy(order)
    return df.withColumn(
        "running_total", F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )


def first_step(df: DataFrame, step: str, value: str) -> Column:
    """Value of the first step, on every row."""
    return F.first(value).over(
        Window.orderBy(step).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )


def total_over(value: str) -> Column:
    """Grand total of a column on every row of a small frame."""
    return F.sum(value).over(Window.partitionBy(F.lit(1)))
