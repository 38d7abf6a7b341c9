"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import day

OPEN_END = "9999-12-31"
HOUSEKEEPING = ("effective_date", "expiry_date", "is_current", "version")


def first_load(source: DataFrame, as_of: date | None = None) -> DataFrame:
    """Version 1 of every source row, current and open-ended.

    Without ``as_of`` the source brings its own ``effective_date``.
    """
    if as_of is not None:
        source = source.withColumn("effective_date", day(as_of))
    return (
        source.withColumn("expiry_date", F.lit(OPEN_END).cast("date"))
        .withColumn("is_current", F.lit(True))
        .withColumn("version", F.lit(1))
    )


def merge(
    target: DataFrame,
    source: DataFrame,
    key: str,
    tracked: list[str],
    as_of: date,
    null_safe: bool = True,
    single_pass: bool = False,
) -> DataFrame:
    """The dimension after merging ``source``.

    One full outer join of the current rows with the source on the key decides for
    every key whether it is new, unchanged or changed; history rows pass through
    untouched and are not shuffled. A change in a ``tracked`` column closes the
    current row at ``as_of`` and opens the next version. Keys missing in the source
    stay as they are.

    ``null_safe=False`` compares with plain ``!=``, for which a change from or to
    NULL is no change. ``single_pass=True`` closes changed rows but leaves their
    successor to the next run, which then restarts at version 1.
    """
    columns = target.columns
    attributes = [c for c in columns if c not in HOUSEKEEPING and c != key]
    current = target.filter("is_current")
    history = target.filter("NOT is_current").select(*columns)

    old = current.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("old"))
    new = source.select(F.col(key).alias("_new_key"), F.struct(key, *attributes).alias("new"))
    pairs = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")

    def differs(c: str):
        a, b = F.col(f"old.{c}"), F.col(f"new.{c}")
        return ~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False))

    both = F.col("_old_key").isNotNull() & F.col("_new_key").isNotNull()
    changed = both & reduce(lambda a, b: a | b, [differs(c) for c in tracked])
    inserted = F.col("_old_key").isNull()
    if not single_pass:
        inserted = inserted | changed

    kept = F.struct(
        *[
            F.when(changed, day(as_of)).otherwise(F.col("old.expiry_date")).alias(c)
            if c == "expiry_date"
            else (~changed).alias(c)
            if c == "is_current"
            else F.col(f"old.{c}").alias(c)
            for c in columns
        ]
    )
    version_type = target.schema["version"].dataType
    opened = {
        "effective_date": day(as_of),
        "expiry_date": F.lit(OPEN_END).cast("date"),
        "is_current": F.lit(True),
        "version": (F.coalesce(F.col("old.version"), F.lit(0)) + 1).cast(version_type),
    }
    fresh = F.struct(
        *[opened.get(c, F.col(f"new.{c}")).alias(c) for c in columns]
    )
    out = pairs.select(
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("_old_key").isNotNull(), kept),
                    F.when(inserted, fresh),
                )
            )
        ).alias("row")
    ).select("row.*")
    return history.unionByName(out)


def with_version(
    facts: DataFrame, dim: DataFrame, key: str, when: str | None = None
) -> DataFrame:
    """Facts joined to the current dimension rows, or to the rows valid on ``when``.

    A fact matches at most one row either way: one version is current, and the
    periods of a key's versions do not overlap. Facts without a match are kept.
    """
    if when is None:
        return facts.join(dim.filter("is_current"), key, "left")
    f, d = facts.alias("f"), dim.alias("d")
    valid = (
        (F.col(f"f.{key}") == F.col(f"d.{key}"))
        & (F.col("d.effective_date") <= F.col(f"f.{when}"))
        & (F.col(f"f.{when}") < F.col("d.expiry_date"))
    )
    return f.join(d, valid, "left").select(
        "f.*", *[F.col(f"d.{c}") for c in dim.columns if c != key]
    )


def merge_counts(before: DataFrame, after: DataFrame, as_of: date) -> DataFrame:
    """Rows inserted and expired by a merge, from its result alone."""
    opened = F.col("is_current") & (F.col("effective_date") == day(as_of))
    closed = ~F.col("is_current") & (F.col("expiry_date") == day(as_of))
    return after.agg(
        F.count_if(opened).alias("inserted"), F.count_if(closed).alias("expired")
    )
