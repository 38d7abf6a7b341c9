"""Helpers the corpus operators share."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlet.session import written

#: What separates words: ASCII white space.
GAP = r"[\x20\x09-\x0D]+"
_LOW_BITS = 33  # bits below the task number in monotonically_increasing_id

#: A table of at most this many rows may be broadcast; a larger one is joined by shuffle.
SMALL_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(module: str) -> None:
    """Send the functions of ``module`` to Python tasks by value, so that executors
    need no copy of this repository on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    """Words between runs of ASCII white space; empty for an empty text."""
    return F.array_remove(F.split(text, GAP), "")


def small_side(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to be small, else as it is.

    ``df`` has to be cheap to count: a written table or an aggregate of one.
    """
    few = df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS
    return F.broadcast(df) if few else df


def running_totals(
    df: DataFrame, order_by: list[Column | str], values: list[str], label: str
) -> DataFrame:
    """Add ``before_<v>``, the total of ``v`` over all earlier rows, and ``place``, the
    number of earlier rows, along ``order_by``.

    Rows are range-partitioned on the whole key, written once, summed up inside each
    slab, and shifted by the totals of the slabs before (one row for each task, hence
    broadcast). ``order_by`` should be unique, so that no group of equal rows can
    fill a slab. ``df`` is read twice, once for the range boundaries.
    """
    slabs = written(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id()),
        label,
    ).withColumn("_slab", F.shiftright("_place", _LOW_BITS))
    inside = (
        Window.partitionBy("_slab").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = Window.orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    sums = slabs.groupBy("_slab").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(v).alias(f"_t_{v}") for v in values]
    )
    offsets = sums.select(
        "_slab",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_o"),
        *[F.coalesce(F.sum(f"_t_{v}").over(earlier), F.lit(0)).alias(f"_o_{v}") for v in values],
    )
    out = slabs
    for v in values:
        out = out.withColumn(f"_w_{v}", F.coalesce(F.sum(v).over(inside), F.lit(0)))
    within = F.col("_place").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    out = out.join(F.broadcast(offsets), "_slab").withColumn("place", F.col("_o") + within)
    for v in values:
        out = out.withColumn(f"before_{v}", F.col(f"_o_{v}") + F.col(f"_w_{v}"))
    drops = [f"_{k}_{v}" for v in values for k in ("w", "o")]
    return out.drop("_slab", "_place", "_o", *drops)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest node that each node reaches.

    ``nodes`` has ``node``, ``edges`` has ``a`` and ``b`` (either direction). Returns
    (node, root). Each round takes the smallest label among the neighbours, then
    follows labels one step (pointer jumping); rounds are written out, and only
    nodes that have an edge take part. Hubs are no problem: labels of neighbours are
    combined before the shuffle and the joins split skewed keys.
    """
    both = edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    ).filter("a <> b")
    links = written(both.distinct(), "links")
    state = written(
        links.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("root")
        ),
        "labels",
    )
    while True:
        # hook: the smallest root seen from any neighbour, for the node and its root
        seen = (
            links.join(state.withColumnRenamed("node", "b"), "b")
            .select(F.col("a").alias("node"), "root")
        )
        low = seen.unionByName(state).groupBy("node").agg(F.min("root").alias("low"))
        up = (
            state.join(low, "node")
            .filter("low < root")
            .groupBy(F.col("root").alias("node"))
            .agg(F.min("low").alias("low"))
        )
        merged = low.unionByName(up).groupBy("node").agg(F.min("low").alias("root"))
        # jump: the root of the root
        jumped = merged.join(
            merged.select(F.col("node").alias("root"), F.col("root").alias("root2")), "root", "left"
        ).select("node", F.least("root", F.coalesce("root2", "root")).alias("root"))
        after = written(jumped, "labels")
        moved = after.join(
            state.withColumnRenamed("root", "old"), "node"
        ).filter("root < old").isEmpty()
        state = after
        if moved:
            break
    return nodes.join(state, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )
