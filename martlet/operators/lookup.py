"""Lookup, existence and hierarchy joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.session import written


def lookup(
    df: DataFrame, table: DataFrame, on: Column, value: str, name: str, default=None
) -> DataFrame:
    """Left join that adds one looked-up column, with a default for no match."""
    joined = df.join(table, on, "left")
    found = F.col(value) if default is None else F.coalesce(F.col(value), F.lit(default))
    return joined.withColumn("_found", found).drop(*table.columns).withColumnRenamed(
        "_found", name
    )


def without_match(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_anti")


def with_match(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_semi")


def paths(df: DataFrame, key: str, parent: str, name: str, sep: str = " > ") -> DataFrame:
    """Path of names from the root to each row, and its depth.

    Pointer doubling: every round joins each row's open ancestor with that
    ancestor's own path, so a hierarchy of depth d needs about log2(d) joins. Each
    round is written out; the loop ends when no row has an ancestor left. A row that
    is its own ancestor would go on for ever: it raises an error that names such rows.
    """
    state = df.select(
        F.col(key).alias("node"),
        F.col(parent).alias("up"),
        F.col(name).alias("path"),
        F.lit(0).alias("depth"),
    )
    rounds = 0
    while True:
        state = written(state, "paths")
        if state.filter("up IS NOT NULL").isEmpty():
            break
        met = [r["node"] for r in state.filter("up = node").select("node").limit(10).collect()]
        if met or rounds > state.count().bit_length():
            raise ValueError(f"rows above themselves, such as {sorted(met)}")
        rounds += 1
        above = state.select(
            F.col("node").alias("up"),
            F.col("up").alias("up2"),
            F.col("path").alias("path2"),
            F.col("depth").alias("depth2"),
        )
        state = state.join(above, "up", "left").select(
            "node",
            F.col("up2").alias("up"),
            F.when(F.col("path2").isNull(), F.col("path"))
            .otherwise(F.concat("path2", F.lit(sep), "path"))
            .alias("path"),
            F.when(F.col("path2").isNull(), F.col("depth"))
            .otherwise(F.col("depth") + F.col("depth2") + 1)
            .alias("depth"),
        )
    return state.select(F.col("node").alias(key), "path", "depth")
