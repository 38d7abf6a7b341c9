"""Ordered stock movements: receipts and returns add, an adjustment sets.

Movements of one product may be a third of the table, so no step here sorts or
holds all movements of a product in one task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ADDING = ("RECEIPT", "RETURN")
SETTING = "ADJUSTMENT"
CHUNK = 100_000


def _known() -> Column:
    return F.col("transaction_type").isin(*ADDING, SETTING)


def closing(moves: DataFrame, key: list[str]) -> DataFrame:
    """Per key: the last set quantity (NULL if none) and what was added after it.

    Two map-side-combined aggregates: find the last adjustment by sequence, then sum
    the additions with a later sequence.
    """
    known = moves.filter(_known())
    last_set = (
        known.filter(F.col("transaction_type") == SETTING)
        .groupBy(*key)
        .agg(F.max(F.struct("seq", "quantity")).alias("last"))
    )
    later = (F.col("transaction_type") != SETTING) & (
        F.col("last").isNull() | (F.col("seq") > F.col("last.seq"))
    )
    return (
        known.join(last_set, key, "left")
        .groupBy(*key)
        .agg(
            F.max("last.quantity").alias("set_quantity"),
            F.coalesce(F.sum(F.when(later, F.col("quantity"))), F.lit(0)).alias("added"),
            F.max(F.col("transaction_type").isin(*ADDING)).alias("received"),
        )
    )


def running(moves: DataFrame, key: list[str], opening: Column, chunk: int = CHUNK) -> DataFrame:
    """``balance`` after every known movement, starting from ``opening``.

    A segmented scan in two levels. ``seq`` is cut into chunks; inside a chunk the
    last set value and the additions since then come from windows over at most
    ``chunk`` rows. Each chunk is then one row (set value or none, sum after it),
    and a window over those carries the balance into the next chunk.
    """
    known = moves.filter(_known()).withColumn(
        "_chunk", F.call_function("div", F.col("seq"), F.lit(chunk))
    )
    inside = Window.partitionBy(*key, "_chunk").orderBy("seq")
    is_set = F.col("transaction_type") == SETTING
    # A set starts a new segment; segment 0 precedes the chunk's first set.
    rows = known.withColumn("_seg", F.sum(is_set.cast("int")).over(inside))
    in_segment = Window.partitionBy(*key, "_chunk", "_seg").orderBy("seq")
    rows = rows.withColumn("_sum", F.sum("quantity").over(in_segment))

    # The last segment of a chunk says what the chunk hands on: an absolute value
    # if it began with a set, otherwise the amount it adds.
    ends = rows.groupBy(*key, "_chunk", "_seg").agg(F.sum("quantity").alias("_sum")).groupBy(
        *key, "_chunk"
    ).agg(F.max(F.struct("_seg", "_sum")).alias("end"))
    across = Window.partitionBy(*key).orderBy("_chunk")
    ends = ends.withColumn(
        "_run", F.sum((F.col("end._seg") > 0).cast("int")).over(across)
    )
    in_run = Window.partitionBy(*key, "_run").orderBy("_chunk")
    ends = ends.withColumn("_out", F.sum("end._sum").over(in_run))
    before = Window.partitionBy(*key).orderBy("_chunk")
    carry = ends.select(
        *key,
        "_chunk",
        F.lag("_out").over(before).alias("_in"),
        F.coalesce(F.lag("_run").over(before), F.lit(0)).alias("_in_run"),
    )
    # Without any earlier set the carried sum still rests on the opening balance.
    base = F.coalesce("_in", F.lit(0)) + F.when(F.col("_in_run") == 0, opening).otherwise(0)
    return (
        rows.join(carry, [*key, "_chunk"])
        .withColumn(
            "balance", F.when(F.col("_seg") > 0, F.col("_sum")).otherwise(F.col("_sum") + base)
        )
        .drop("_chunk", "_seg", "_sum", "_in", "_in_run")
    )


def stock_days(
    moves: DataFrame, key: list[str], opening: DataFrame, start: date, end: date
) -> DataFrame:
    """``stock_days`` per key of ``opening``: the closing stock of every day from
    ``start`` to ``end`` added up, that is, stock integrated over time.

    ``moves`` have a ``move_date``, and ``seq`` orders those of one day; ``opening``
    holds each key once with its ``opening`` stock before all moves. A stock stays as it
    is until the next day with a move, so each such day counts its balance times the
    days until then that lie in the span. Moves are first added up by key and day, on
    the map side; the windows that follow see one row per key and day, however many
    moves a hot key has. Moves after ``end`` are not read on; keys without moves keep
    their opening stock; moves of unknown keys count nowhere.
    """
    if start > end:
        raise ValueError("start date is after end date")
    first, after = F.lit(start), F.date_add(F.lit(end), 1)
    days = closing(moves.filter(F.col("move_date") < after), [*key, "move_date"])
    in_order = Window.partitionBy(*key).orderBy("move_date")
    # A day with a set starts a new run, in which balances are sums; run 0 rests on
    # the opening stock.
    runs = days.withColumn(
        "_run", F.count("set_quantity").over(in_order)
    ).withColumn("_amount", F.coalesce("set_quantity", F.lit(0)) + F.col("added"))
    in_run = Window.partitionBy(*key, "_run").orderBy("move_date")
    until = F.coalesce(F.lead("move_date").over(in_order), after)
    held = runs.select(
        *key,
        "_run",
        F.sum("_amount").over(in_run).alias("_sum"),
        F.greatest(F.datediff(until, F.greatest("move_date", first)), F.lit(0)).alias("_days"),
    )
    # What rests on the opening stock is its amount times the days no set has ruled.
    per_key = held.groupBy(*key).agg(
        F.sum(F.col("_sum") * F.col("_days")).alias("_moved"),
        F.sum(F.when(F.col("_run") > 0, F.col("_days")).otherwise(0)).alias("_set_days"),
    )
    all_days = (end - start).days + 1
    return opening.join(per_key, key, "left").select(
        *opening.columns,
        (
            F.col("opening") * (F.lit(all_days) - F.coalesce("_set_days", F.lit(0)))
            + F.coalesce("_moved", F.lit(0))
        ).alias("stock_days"),
    )
