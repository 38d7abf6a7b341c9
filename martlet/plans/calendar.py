"""Date dimension: parts, fiscal calendar, seasons and holidays."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.dates import day, quarter_end, quarter_start, year_end


def days(spark: SparkSession, first, last) -> DataFrame:
    """One row per day in [first, last]; bounds are dates or column expressions."""
    first = day(first) if isinstance(first, date) else first
    last = day(last) if isinstance(last, date) else last
    return spark.range(0, 1, 1, 1).select(F.explode(F.sequence(first, last)).alias("date_actual"))


# Rules in order; the first that holds names the holiday.
HOLIDAY = """CASE
  WHEN month_number = 1 AND day_of_month = 1 THEN "New Year's Day"
  WHEN month_number = 7 AND day_of_month = 4 THEN 'Independence Day'
  WHEN month_number = 12 AND day_of_month = 25 THEN 'Christmas Day'
  WHEN month_number = 11 AND day_of_week = 5 AND day_of_month BETWEEN 22 AND 28 THEN 'Thanksgiving'
  WHEN month_number = 5 AND day_of_week = 2 AND day_of_month > 24 THEN 'Memorial Day'
  WHEN month_number = 9 AND day_of_week = 2 AND day_of_month <= 7 THEN 'Labor Day'
END"""


def describe(dates: DataFrame) -> DataFrame:
    """Calendar attributes of each ``date_actual``, beside the other columns. Sunday is
    day 1; fiscal years start in July and carry the number of the year they end in."""
    d = "date_actual"
    parts = dates.selectExpr(
        *[c for c in dates.columns if c != d],
        f"year({d}) * 10000 + month({d}) * 100 + day({d}) AS date_key",
        d,
        f"dayofweek({d}) AS day_of_week",
        f"dayname({d}) AS day_of_week_name",
        f"day({d}) AS day_of_month",
        f"dayofyear({d}) AS day_of_year",
        f"weekofyear({d}) AS week_of_year",
        f"month({d}) AS month_number",
        f"monthname({d}) AS month_name",
        f"left(monthname({d}), 3) AS month_abbr",
        f"quarter({d}) AS quarter_number",
        f"concat('Q', quarter({d})) AS quarter_name",
        f"year({d}) AS year_number",
        f"dayofweek({d}) IN (1, 7) AS is_weekend",
        f"year({d}) + if(month({d}) >= 7, 1, 0) AS fiscal_year",
        f"cast(ceil(((month({d}) + 5) % 12 + 1) / 3) AS int) AS fiscal_quarter",
        f"(month({d}) + 5) % 12 + 1 AS fiscal_month",
        f"element_at(array('Winter', 'Spring', 'Summer', 'Fall'), "
        f"cast(floor(month({d}) % 12 / 3) AS int) + 1) AS season",
    )
    return parts.selectExpr(
        "*", f"{HOLIDAY} AS holiday_name", f"({HOLIDAY}) IS NOT NULL AS is_holiday"
    )


def extend(dim: DataFrame) -> DataFrame:
    """Further attributes: epoch, day suffix, positions within week/month/quarter,
    and the first and last day of each enclosing period."""
    d, dom = F.col("date_actual"), F.col("day_of_month")
    suffix = (
        F.when(dom.isin(1, 21, 31), "st")
        .when(dom.isin(2, 22), "nd")
        .when(dom.isin(3, 23), "rd")
        .otherwise("th")
    )
    return dim.select(
        "*",
        (F.unix_date(d).cast("bigint") * 86400).alias("epoch"),
        suffix.alias("day_suffix"),
        (F.datediff(d, quarter_start(d)) + 1).alias("day_of_quarter"),
        F.ceil(dom / 7).cast("int").alias("week_of_month"),
        F.trunc(d, "week").alias("first_day_of_week"),
        F.date_add(F.trunc(d, "week"), 6).alias("last_day_of_week"),
        F.trunc(d, "month").alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        quarter_start(d).alias("first_day_of_quarter"),
        quarter_end(d).alias("last_day_of_quarter"),
        F.trunc(d, "year").alias("first_day_of_year"),
        year_end(d).alias("last_day_of_year"),
        (~F.col("is_weekend")).alias("is_weekday"),
    )


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    return describe(days(spark, first, last))


def covering(
    spark: SparkSession, dates: DataFrame, column: str,
    first: date | None = None, last: date | None = None,
) -> DataFrame:
    """Calendar of every whole year that ``column`` of ``dates`` touches, and at least
    of ``first`` to ``last``."""
    span = dates.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    low, high = F.trunc("lo", "year"), year_end("hi")
    if first is not None:
        low, high = F.least(low, day(first)), F.greatest(high, day(last))
    return describe(span.select(F.explode(F.sequence(low, high)).alias("date_actual")))


def verify(dim: DataFrame) -> DataFrame:
    """Row count, first and last day and number of holidays of a calendar."""
    return dim.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("date_actual").alias("start_date"),
        F.max("date_actual").alias("end_date"),
        F.count_if("is_holiday").alias("holiday_count"),
    )
