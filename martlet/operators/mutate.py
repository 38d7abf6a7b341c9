"""Row changes as new frames: parquet tables are replaced, never edited in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Append by column name; columns the rows lack become NULL."""
    return target.unionByName(rows, allowMissingColumns=True).select(*target.columns)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not true; unknown keeps the row."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def update_where(df: DataFrame, predicate: Column, **values: Column) -> DataFrame:
    """Set columns on matching rows, all from the values before the update."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.withColumns(
        {c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()}
    )


def update_from(
    df: DataFrame, measures: DataFrame, on: str | list[str], **values: Column
) -> DataFrame:
    """Set columns from per-key aggregates: one aggregate and one left join, however
    many columns it feeds. Keys without a match see NULL measures."""
    extra = [c for c in measures.columns if c not in ([on] if isinstance(on, str) else on)]
    return df.join(measures, on, "left").withColumns(values).drop(*extra)
