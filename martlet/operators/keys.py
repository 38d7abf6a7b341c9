"""Gap-free surrogate keys in a given order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.session import written

_LOW_BITS = 33  # bits below the task number in monotonically_increasing_id


def number_rows(
    df: DataFrame, order_by: list[str], start: int = 1, name: str = "row_id"
) -> DataFrame:
    """Number rows ``start, start + 1, ...`` along ``order_by``.

    Rows are range-partitioned on the whole sort key, so even a leading column with
    one dominant value spreads over tasks. Each task numbers its own sorted slab;
    the slabs are written once, their sizes are summed up (one row per task, hence
    broadcast), and the offsets are added. ``order_by`` has to be unique for the
    numbers to be reproducible.
    """
    slabs = written(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_slab", F.shiftright("_place", _LOW_BITS))
    before = Window.orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slabs.groupBy("_slab")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slab", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.col("_place").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    return (
        slabs.join(F.broadcast(offsets), "_slab")
        .withColumn(name, F.lit(start) + F.col("_offset") + within)
        .drop("_slab", "_place", "_offset")
    )


def padded(prefix, number, width: int) -> Column:
    """``prefix`` and a zero-padded number that keeps digits beyond ``width``."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    text = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.concat(prefix, F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))
