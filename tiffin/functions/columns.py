"""Derived columns. All are built-in expressions, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tiffin import settings


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Minutes from `start` to `end`, both cut to whole seconds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60


def order_status(delay: Column) -> Column:
    """`on_time` up to a delay of 0, else `late`; a NULL delay reads `late`."""
    return F.when(delay <= 0, settings.ON_TIME).otherwise(settings.LATE)


def delay_category(delay: Column) -> Column:
    """Named delay band; a NULL delay falls into the last one."""
    (bound, name), *rest = settings.DELAY_STEPS
    category = F.when(delay < bound, name)
    for bound, name in rest:
        category = category.when(delay < bound, name)
    return category.otherwise(settings.EXTREME_DELAY)


def region_of_address(address: str | Column) -> Column:
    """Text after the first comma, up to the next one; NULL without a comma."""
    return F.trim(F.get(F.split(address, ","), F.lit(1)))


def city_key(name: Column) -> Column:
    """Join key of a city as a weather station writes it."""
    return F.lower(F.trim(name))


def is_severe_weather(precipitation: Column, wind_speed: Column) -> Column:
    """True for heavy rain or wind, never NULL."""
    severe = (precipitation > settings.SEVERE_PRECIPITATION) | (wind_speed > settings.SEVERE_WIND)
    return F.coalesce(severe, F.lit(False))


def any_of(column: Column, values: Iterable[str]) -> Column:
    return column.isin(list(values))


def present(df: DataFrame, *columns: str) -> Column:
    """True when all columns have a value; NaN is none.

    The same rows as `dropna`, but in a form that reaches the file scan.
    """
    checks = []
    for name in columns:
        checks.append(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            checks.append(~F.isnan(name))
    return reduce(lambda a, b: a & b, checks)
