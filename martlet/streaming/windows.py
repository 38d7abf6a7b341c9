"""Daily totals of an event stream, closed by a watermark.

Each run reads the files that came since the last one and adds their events to the
open days, which are the only state. A day that lies wholly before the watermark (the
newest event time less the allowed delay) is written once and for ever; an event of
such a day that comes later is left out. A run that is lost and repeated goes on from
the checkpoint and writes no day twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.money import cents

DAYS = "day timestamp, event_type string, n_events bigint, value_c bigint"


def by_day(events: DataFrame) -> DataFrame:
    """Events and values by one-day window and type, of a table or of a stream."""
    return (
        events.groupBy(F.window("ts", "1 day").alias("w"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.coalesce(F.sum(cents("value")), F.lit(0).cast("bigint")).alias("value_c"),
        )
        .select(F.col("w.start").alias("day"), "event_type", "n_events", "value_c")
    )


def close_days(
    spark: SparkSession, stage: str, schema, target: str, checkpoint: str,
    delay: str = "2 days", max_files: int = 10_000,
) -> None:
    """Read all new files of ``stage``, write the days that are closed now, and stop.

    ``max_files`` bounds one batch, not the run.
    """
    events = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(stage)
        .select("ts", "event_type", "value")
        .withWatermark("ts", delay)
    )
    query = (
        by_day(events)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def closed_days(spark: SparkSession, target: str) -> DataFrame:
    """The days written so far; only files of committed batches are listed."""
    return spark.read.schema(DAYS).parquet(target)


def days_so_far(spark: SparkSession, stage: str, schema, target: str) -> DataFrame:
    """Closed days as written, and the days after the last of them as they stand."""
    closed = closed_days(spark, target)
    last = closed.agg(F.max("day") + F.expr("interval 1 day")).scalar()
    still_open = F.coalesce(F.col("ts") >= last, F.lit(True))
    events = spark.read.schema(schema).parquet(stage)
    return closed.unionByName(by_day(events.filter(still_open)))
