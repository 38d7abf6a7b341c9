"""Copy of new files only, as a bounded stream.

A bulk copy loads each file of a stage once, however often it is run. The file
source with a checkpoint does the same: it remembers which files it has read, and
the file sink commits a batch as a whole, so a run that is lost and repeated
neither skips nor doubles a file.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.text import null_token
from martlet.plans.etl import Cleaned
from martlet.sources.files import CSV_OPTIONS


def stage_stream(spark: SparkSession, path: str, columns: list[str], max_files: int) -> DataFrame:
    """New CSV files below ``path`` as a stream of text rows with their file name."""
    rows = (
        spark.readStream.options(**CSV_OPTIONS)
        .option("header", True)
        .option("maxFilesPerTrigger", max_files)
        .schema(", ".join(f"`{c}` string" for c in columns))
        .csv(path)
    )
    return rows.select(
        *[null_token(c).alias(c) for c in columns], F.col("_metadata.file_name").alias("file_name")
    )


def copy_new_files(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    columns: list[str],
    transform: Callable[[DataFrame], Cleaned],
    max_files: int = 10_000,
) -> None:
    """Clean every file not copied before into ``target`` and stop when none is left.

    ``max_files`` bounds one batch, not the run.
    """
    judged = transform(stage_stream(spark, path, columns, max_files)).judged
    query = (
        judged.writeStream.format("parquet")
        .partitionBy("validation_status")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_copied(spark: SparkSession, target: str) -> DataFrame:
    """The copied rows; only files of committed batches are listed."""
    return spark.read.parquet(target)
