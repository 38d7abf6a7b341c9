"""Sharding by sampled splitters.

A size-weighted sample of keys gives quantile boundaries of many ranges; records are
dealt to the ranges, ranges that turn out overfull are subdivided by a sample of their
own, and exact totals of the ranges place every record. The sample decides only how
the work is spread; shards and slots depend on the records alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import text_of
from martlet.session import written

SHARDS = 8
#: Ranges of one sampling round, and sampled keys for each; their product bounds what
#: the one task that cuts the sample holds.
RANGES = 256
SAMPLES_PER_RANGE = 24
#: A range with more than this many times its fair share is subdivided, unless it has
#: so few rows that any task can hold it.
OVERFULL = 2.0
FEW_ROWS = 1000
#: Rounds of subdividing; equal keys do not exist, so a round halves what is overfull.
ROUNDS = 4


def splitters(weighed: DataFrame, total: float, ranges: int, seed: int) -> DataFrame:
    """At most ``ranges`` - 1 keys that cut ``weighed`` (key, weight) evenly by weight.

    A key is drawn with probability weight x samples / total, at most 1, and stands
    for its weight divided by that probability.
    """
    chance = F.least(F.lit(1.0), F.col("weight") * (ranges * SAMPLES_PER_RANGE) / F.lit(total))
    drawn = weighed.withColumn("chance", chance).filter(F.rand(seed) < F.col("chance"))
    stands = F.col("weight") / F.col("chance")
    upto = F.sum(stands).over(
        Window.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = F.sum(stands).over(Window.partitionBy())
    return (
        drawn.select("key", F.ceil(upto * ranges / whole).alias("cell"))
        .groupBy("cell").agg(F.max("key").alias("key"))
        .filter(F.col("cell") < ranges)
        .select("key")
    )


def _deal(weighed: DataFrame, bounds: DataFrame) -> DataFrame:
    """Add ``range``, the number of ``bounds`` below the key, by binary search."""
    array = bounds.agg(F.sort_array(F.collect_list("key")).alias("bounds"))
    n = bounds.count()
    if not n:
        return weighed.withColumn("range", F.lit(0))
    steps = [1 << e for e in reversed(range(n.bit_length()))]

    def descend(low: Column, step: Column) -> Column:
        probe = low + step
        below = (probe <= F.lit(n)) & (F.element_at("_bounds", probe) < F.col("key"))
        return F.when(below, probe).otherwise(low)

    return (
        weighed.withColumn("_bounds", array.scalar())
        .withColumn("range", F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), descend))
        .drop("_bounds")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES) -> DataFrame:
    """Put every row of ``docs`` (doc_id, text) into shards of near equal bytes.

    Records are ordered by (CRC-32 of the text, id, position in the input), so equal
    texts lie next to each other and a group is cut only where a shard is full. A
    record belongs to the shard in which the middle of its bytes falls. Returns
    doc_id, size (UTF-8 bytes plus 1; a null text has none), text_crc32, law, shard,
    slot (gapless from 0 in the order of the key) and grown_shard (null: only a law by
    key has one). Null ids, empty and null texts, repeated rows and other columns of
    any name are placed like all others; an empty table gives an empty result.
    """
    text = text_of()
    slim = written(
        docs.select(
            F.col("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.struct(
                F.crc32(text.cast("binary")).alias("crc"),
                F.col("doc_id").cast("string").alias("id"),
                F.monotonically_increasing_id().alias("tie"),
            ).alias("key"),
        ),
        "shard",
    )
    whole = slim.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    total, rows = whole["bytes"] or 0, max(1, whole["rows"])
    # bytes decide the shards, rows the work: a weight of both keeps ranges even in either
    weighed = slim.withColumn("weight", F.col("size") + F.lit(total / rows))
    whole_weight = 2.0 * total or 1.0
    bounds = written(splitters(weighed, whole_weight, ranges, 1), "bounds")
    for round_ in range(ROUNDS):
        dealt = _deal(weighed, bounds)
        load = dealt.groupBy("range").agg(
            F.sum("weight").alias("load"), F.count(F.lit(1)).alias("rows")
        )
        heavy = F.col("load") > OVERFULL * whole_weight / ranges
        full = load.filter(heavy & (F.col("rows") > FEW_ROWS)).collect()
        if not full:
            break
        over = dealt.filter(F.col("range").isin([r["range"] for r in full]))
        excess = sum(r["load"] for r in full)
        more = min(ranges, int(2 * excess * ranges / whole_weight) + 2)
        finer = splitters(over.select("key", "weight"), excess, more, 2 + round_)
        bounds = written(bounds.unionByName(finer).distinct(), "bounds")
    dealt = _deal(weighed, bounds)
    inside = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    ordered = (
        dealt.withColumn("_w", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("_p", F.count(F.lit(1)).over(inside))
    )
    # a row for each range: bounded by ranges and rounds
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("range").agg(F.sum("size").alias("_s"), F.count(F.lit(1)).alias("_c"))
        .select(
            "range",
            F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_so"),
            F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_co"),
        )
    )
    middle = 2 * (F.col("_so") + F.col("_w")) + F.col("size")
    placed = written(
        ordered.join(F.broadcast(offsets), "range").select(
            "doc_id", "size", F.col("key.crc").alias("text_crc32"),
            F.floor(middle * shards / F.lit(2 * max(1, total))).cast("int").alias("shard"),
            (F.col("_co") + F.col("_p")).alias("place"),
        ),
        "placed",
    )
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))  # a row for each shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
