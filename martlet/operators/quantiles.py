"""Exact quantiles of a large column without sorting it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges that a pass cuts the values into: what a task and the driver hold.
RANGES = 4096


def median(df: DataFrame, column: str) -> Column:
    """Exact median of a column of finite numbers, as a literal; null without values.

    Selection by counting: values are counted by range, tasks send one row for each
    range, and the next pass looks only into the range that holds the middle, from its
    least to its greatest value. A pass narrows the values by the number of ranges, so
    two or three are enough; the last range holds one value, however many rows have it.
    ``df`` is read once for each pass.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    whole = values.agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    low, high, before = whole["low"], whole["high"], 0
    first, second = (whole["n"] + 1) // 2, (whole["n"] + 2) // 2
    if not whole["n"]:
        return F.lit(None).cast("double")
    while low < high:
        # halves, as the distance of two large values may not be a number
        share = (F.col("v") / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
        cut = F.least(F.floor(share * RANGES), F.lit(RANGES - 1))
        counted = (
            values.filter(F.col("v").between(low, high)).groupBy(cut.alias("cut"))
            .agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .orderBy("cut").collect()
        )
        held = None
        for part in counted:
            upto = before + part["n"]
            if held is not None:  # the middle lies between two ranges
                return F.lit((held + part["low"]) / 2)
            if second <= upto:
                low, high = part["low"], part["high"]
                break
            if first <= upto:
                held = part["high"]
            before = upto
    return F.lit(float(low))
