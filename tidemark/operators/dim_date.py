"""Calendar dimensions: a few thousand rows, so they may always be broadcast."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key

FIRST_DAY = date(2020, 1, 1)
LAST_DAY = date(2030, 12, 31)


def dim_date(
    spark: SparkSession, start: date = FIRST_DAY, end: date = LAST_DAY, style: str = "iso"
) -> DataFrame:
    """One row per day. ``style='iso'``: Monday is 1; ``style='fiscal'``: Sunday is 0."""
    first_to_last = F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
    days = spark.range(1).select(F.explode(first_to_last).alias("d"))
    if style == "fiscal":
        return _fiscal(days)
    year = F.year("d")
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    return days.select(
        date_key("d").alias("date_key"),
        F.col("d").alias("full_date"),
        (F.weekday("d") + 1).cast("smallint").alias("day_of_week"),
        F.date_format("d", "EEEE").alias("day_name"),
        F.dayofmonth("d").cast("smallint").alias("day_of_month"),
        F.dayofyear("d").cast("smallint").alias("day_of_year"),
        F.weekofyear("d").cast("smallint").alias("week_of_year"),
        F.month("d").cast("smallint").alias("month_num"),
        F.date_format("d", "MMMM").alias("month_name"),
        F.quarter("d").cast("smallint").alias("quarter"),
        F.concat(F.lit("Q"), F.quarter("d").cast("string")).alias("quarter_name"),
        year.cast("smallint").alias("year"),
        (F.weekday("d") >= 5).alias("is_weekend"),
        leap.alias("is_leap_year"),
    )


def _fiscal(days: DataFrame) -> DataFrame:
    return days.select(
        date_key("d").alias("date_key"),
        F.col("d").alias("full_date"),
        F.year("d").alias("year"),
        F.quarter("d").alias("quarter"),
        F.month("d").alias("month"),
        F.date_format("d", "MMMM").alias("month_name"),
        F.dayofmonth("d").alias("day"),
        (F.dayofweek("d") - 1).alias("day_of_week"),
        F.date_format("d", "EEEE").alias("day_name"),
        F.weekofyear("d").alias("week_of_year"),
        F.dayofweek("d").isin(1, 7).alias("is_weekend"),
        F.year("d").alias("fiscal_year"),
        F.quarter("d").alias("fiscal_quarter"),
        F.month("d").alias("fiscal_month"),
    )
