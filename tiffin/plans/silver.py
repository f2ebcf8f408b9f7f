"""Cleaning and enrichment (J5-J9, J11). Pure functions: no clock, no catalog, no write.

`ingestion_time` is not added here but by the writer, so a row stays the same over reruns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin import settings
from tiffin.functions import (
    any_of,
    city_key,
    delay_category,
    minutes_between,
    order_status,
    present,
    region_of_address,
)
from tiffin.operators.band_join import left_band_join, left_count_join, left_first_join, left_stretch_join
from tiffin.operators.dedup import first_per_key
from tiffin.operators.intervals import with_end_time
from tiffin.plans.bronze import recent

# Names of the measures, and the columns of a delivery.
MEASURES = ["temperature", "precipitation", "wind_speed", "weather_condition"]

DELIVERY_COLUMNS = [
    "order_id",
    "customer_id",
    "store_id",
    "region",
    "delivery_address",
    "order_time",
    "estimated_delivery_time",
    "actual_delivery_time",
    "delivery_delay",
    "status",
    "complaint_type",
    "had_complaint",
    *MEASURES,
    "delay_category",
]


def orders_clean(bronze: DataFrame) -> DataFrame:
    """Valid orders with delay and status (J5). The raw filters reach the file scan."""
    # Columns that an order must have.
    required = ["order_id", "customer_id", "store_id", "delivery_address"]
    times = ["estimated_delivery_time", "actual_delivery_time"]
    delay = minutes_between(*times)
    valid = (
        bronze.filter(present(bronze, *required, *times))
        .filter((F.col("order_id") > 0) & (F.col("customer_id") > 0) & (F.col("store_id") > 0))
        .filter(F.col("actual_delivery_time") >= F.col("estimated_delivery_time"))
        .filter(delay < settings.MAX_DELAY_MINUTES)
    )
    # Distinct before deriving columns: they follow from the raw ones and need no comparison.
    return (
        valid.select(*required, "event_time", "timestamp", *times)
        .distinct()
        .withColumn("delivery_delay", delay)
        .select(
            "order_id",
            "customer_id",
            "store_id",
            "event_time",
            F.col("timestamp").alias("order_time"),
            "delivery_address",
            *times,
            "delivery_delay",
            order_status(F.col("delivery_delay")).alias("status"),
        )
    )


def order_events_clean(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Recent events of a known type."""
    known = bronze.filter(present(bronze, "order_id", "event_time", "event_type")).filter(
        any_of(F.col("event_type"), settings.EVENT_TYPES)
    )
    return recent(known, "event_time", as_of).distinct()


def complaints_clean(bronze: DataFrame) -> DataFrame:
    """Complaints with ids, a type and a description."""
    return (
        bronze.filter(present(bronze, "complaint_id", "order_id", "timestamp_received"))
        .filter(F.trim("complaint_type") != "")
        .filter(F.trim("description") != "")
        .filter((F.col("complaint_id") >= 1) & (F.col("order_id") >= 1))
        .distinct()
    )


def weather_enriched(
    orders: DataFrame,
    weather: DataFrame,
    band: int = settings.WEATHER_BAND_SECONDS,
    join: Callable[..., DataFrame] = left_band_join,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Each order with every observation of its city within `band` seconds.

    Orders without one are kept with NULL measures. `join` is one of the left joins of `band_join`.
    """
    placed = orders.select(
        "order_id", "order_time", region_of_address("delivery_address").alias("region")
    )
    observed = weather.filter(present(weather, "timestamp", "location", *MEASURES)).select(
        city_key(F.col("location")).alias("key"),
        F.unix_timestamp("timestamp").alias("at"),
        *measures,
    )
    return join(
        placed,
        F.lower("region"),
        F.unix_timestamp("order_time"),
        observed,
        band,
        measures,
    )


def observed_orders(
    orders: DataFrame, weather: DataFrame, band: int = settings.WEATHER_BAND_SECONDS
) -> DataFrame:
    """The rows of `weather_enriched`, of which no shuffle takes more than the inputs hold."""
    return weather_enriched(orders, weather, band, left_stretch_join)


def observation_counts(
    orders: DataFrame,
    weather: DataFrame,
    kinds: Mapping[str, Column],
    band: int = settings.WEATHER_BAND_SECONDS,
) -> DataFrame:
    """The rows of `weather_enriched` counted: each order once for each of the `kinds` (columns made of the measures) that
    its observations are of, with how many (`times`). Orders without observations are kept once, with NULL kinds.

    For reports that count rows. Work grows with the inputs, not with the observations of an order.
    """

    def join(rows, key, second, observed, band, measures):
        return left_count_join(rows, key, second, observed, band, kinds)

    return weather_enriched(orders, weather, band, join)


def first_observed(
    orders: DataFrame,
    weather: DataFrame,
    measures: Sequence[str] = MEASURES,
    band: int = settings.WEATHER_BAND_SECONDS,
) -> DataFrame:
    """Each order once, with the least observation by `measures` that `weather_enriched` gives it.

    For what reads the first observation only: deliveries, and the condition of a day. Work grows with the
    inputs, not with the observations of an order.
    """
    return weather_enriched(orders, weather, band, left_first_join, measures)


def deliveries_enriched(
    orders: DataFrame,
    complaints: DataFrame,
    weather: DataFrame,
    columns: Sequence[str] = DELIVERY_COLUMNS,
) -> DataFrame:
    """One row per order with its complaint type and weather (J9); only `columns` of it, and only
    the joins that these need.

    An order may have many complaints and observations; one of each is kept: the first by type,
    and the first by measures, NULL last. Since both hang on the order id alone, each input is
    cut to one row per order before the join instead of after two fan-outs.
    """
    orders = first_per_key(orders.filter(F.col("order_id") > 0), "order_id")
    found = orders.withColumn("delay_category", delay_category(F.col("delivery_delay")))
    if {"complaint_type", "had_complaint"} & set(columns):
        complaint = first_per_key(complaints.select("order_id", "complaint_type"), "order_id")
        found = found.join(complaint, "order_id", "left")
        found = found.withColumn("had_complaint", F.col("complaint_type").isNotNull())
    if {*MEASURES, "region"} & set(columns):
        observed = first_per_key(weather.select("order_id", *MEASURES, "region"), "order_id")
        found = found.join(observed, "order_id", "left")
    return found.select(*columns)


def order_status_history(events: DataFrame) -> DataFrame:
    """Status intervals per order; the last one is current.

    Events of one instant are put in order by type.
    """
    rest = [c for c in ("timestamp", "customer_id", "store_id") if c in events.columns]
    ended = with_end_time(events, "order_id", "event_time", ["event_type", *rest])
    return ended.select(
        "order_id",
        F.col("event_type").alias("status"),
        F.col("event_time").alias("effective_time"),
        "end_time",
        F.col("end_time").isNull().alias("is_current"),
    )
