"""Small fixed tables as plan constants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Literal rows as one generated partition, without a Python-side data set."""
    fields = StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
