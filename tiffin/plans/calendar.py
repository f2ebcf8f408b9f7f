"""The calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin import settings
from tiffin.functions import any_of


def _days(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row per day from `start` to `end` of a one-row frame."""
    days = bounds.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("date"))
    weekday = F.date_format("date", "EEEE")
    return days.select(
        "date",
        weekday.alias("day_of_week"),
        any_of(weekday, settings.WEEKEND).alias("is_weekend"),
        any_of(F.date_format("date", "MM-dd"), settings.HOLIDAYS).alias("is_holiday"),
        (weekday == settings.SHORT_DAY).alias("is_short_friday"),
    )


def calendar(
    spark: SparkSession,
    start: str = settings.CALENDAR_START,
    end: str = settings.CALENDAR_END,
) -> DataFrame:
    """Calendar between two fixed days."""
    return _days(spark.range(1), F.to_date(F.lit(start)), F.to_date(F.lit(end)))


def calendar_of(df: DataFrame, time: str) -> DataFrame:
    """Calendar from the first to the last day found in a table's `time` column."""
    bounds = df.agg(F.min(F.to_date(time)).alias("first"), F.max(F.to_date(time)).alias("last"))
    return _days(bounds, F.col("first"), F.col("last"))
