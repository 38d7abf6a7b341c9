"""Reports over an activity log (``events``): statistics, slow entries, cost, access.

An entry's ``value`` is its execution time in hundredths of a second, its type the
resource it used. All windows look back from ``now``, a parameter.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.money import amount, cents, half_up
from martlet.sources.mart import Mart

NOW = datetime(2024, 1, 31, 0, 0, 0)
RATE_PER_UNIT = 2


def since(now: datetime, hours: int) -> Column:
    start = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.col("ts") >= start - F.expr(f"INTERVAL {hours} HOURS")


def execution_stats(m: Mart, pattern: str = "%e%", hours: int = 24, now: datetime = NOW):
    hits = m.table("events").filter(F.col("event_type").like(pattern) & since(now, hours))
    v = cents("value")
    return hits.agg(
        F.count(F.lit(1)).alias("execution_count"),
        amount(half_up(F.sum(v), F.count(F.lit(1)))).alias("avg_execution_time"),
        F.max("value").alias("max_execution_time"),
    )


def slow_entries(m: Mart, floor: float = 300.0, hours: int = 24, now: datetime = NOW) -> DataFrame:
    return (
        m.table("events")
        .filter((F.col("value") > floor) & since(now, hours))
        .select("event_id", "user_id", "event_type", "value")
        .orderBy(F.desc("value"), "event_id")
    )


def cost_per_day(m: Mart, days: int = 30, now: datetime = NOW) -> DataFrame:
    used = (
        m.table("events")
        .filter(since(now, days * 24))
        .groupBy("event_type", F.to_date("ts").alias("usage_date"))
        .agg(F.sum(cents("value")).alias("used_c"))
    )
    return used.select(
        "event_type",
        "usage_date",
        amount("used_c").alias("total_credits"),
        amount(F.col("used_c") * RATE_PER_UNIT).alias("estimated_cost_usd"),
    )


def access_patterns(m: Mart, days: int = 7, now: datetime = NOW) -> DataFrame:
    return (
        m.table("events")
        .filter(since(now, days * 24))
        .groupBy("user_id", "event_type")
        .agg(
            F.count(F.lit(1)).alias("access_count"),
            F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last_access"),
        )
    )


def slowest(m: Mart, k: int = 10, hours: int = 1, now: datetime = NOW) -> DataFrame:
    return (
        m.table("events")
        .filter(since(now, hours))
        .select("event_id", "event_type", "value")
        .orderBy(F.desc("value"), "event_id")
        .limit(k)
    )


ALL = {
    "o01_execution_stats": execution_stats,
    "o02_slow_entries": slow_entries,
    "o03_cost_per_day": cost_per_day,
    "o04_access_patterns": access_patterns,
    "o05_slowest": slowest,
}
