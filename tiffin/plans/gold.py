"""Reports (J12-J18).

Facts that hang on an order (complaints, observations, step times) are first counted per order,
with partial counts in the map tasks, and then weighted. This gives the same sums as joining the
rows and counting afterwards, without the multiplied rows and without a hot order's rows in one
task. The last grouping has few groups and sends only partial sums.

`late` lists the delay categories counted as late, see `settings.REPORTED_LATE`.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin import settings
from tiffin.functions import any_of, is_severe_weather, minutes_between, region_of_address


def _late_count(late: Sequence[str]) -> Column:
    return F.count_if(any_of(F.col("delay_category"), late))


def _complaints_per_order(complaints: DataFrame) -> DataFrame:
    return complaints.groupBy("order_id").agg(F.count("*").alias("complaints"))


def complaints_by_type(complaints: DataFrame) -> DataFrame:
    """Complaints per type (J12). `percent_of_orders` is the share of all complaints, 0 to 1."""
    counts = complaints.groupBy("complaint_type").agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percent_of_orders", F.col("count") / total)


def delivery_metrics_by_region(
    deliveries: DataFrame, complaints: DataFrame, late: Sequence[str] = settings.REPORTED_LATE
) -> DataFrame:
    """Mean delay, late share and complaints per order, by region.

    `avg_delivery_time` is the mean delay. Several complaints of one order all count.
    """
    placed = deliveries.filter(F.col("region").isNotNull())
    placed = placed.select("order_id", "region", "delivery_delay", "delay_category")
    stats = (
        placed.join(_complaints_per_order(complaints), "order_id", "left")
        .groupBy("region")
        .agg(
            F.avg("delivery_delay").alias("delay"),
            _late_count(late).alias("late"),
            F.count("*").alias("orders"),
            F.coalesce(F.sum("complaints"), F.lit(0)).alias("complaints"),
        )
    )
    return stats.select(
        "region",
        F.coalesce("delay", F.lit(0.0)).alias("avg_delivery_time"),
        (F.col("late") / F.col("orders")).alias("late_deliveries_pct"),
        (F.col("complaints") / F.col("orders")).alias("complaints_pct"),
    )


def _order_key() -> Column:
    """A number that puts rows in order by `order_time` and then `order_id`, which is above 0."""
    micros = F.unix_micros("order_time").cast("decimal(18,0)")
    return micros * F.lit(Decimal(10**19)) + F.coalesce("order_id", F.lit(0)).cast("decimal(19,0)")


def delivery_summary_daily(
    deliveries: DataFrame, weather: DataFrame, late: Sequence[str] = settings.REPORTED_LATE
) -> DataFrame:
    """Orders and late orders per day, with the condition of the day's earliest order."""
    per_day = deliveries.groupBy(F.to_date("order_time").alias("date")).agg(
        F.count("*").alias("total_orders"), _late_count(late).alias("late_orders")
    )
    observed = weather.filter(F.col("weather_condition").isNotNull() & F.col("order_time").isNotNull())
    observed = observed.select(
        F.to_date("order_time").alias("date"), _order_key().alias("place"), "weather_condition"
    )
    # A number of fixed width is merged by hash; the text comes from the few rows that have the day's least.
    first = observed.groupBy("date").agg(F.min("place").alias("place"))
    summary = (
        observed.join(F.broadcast(first), ["date", "place"])  # one row per day
        .groupBy("date")
        .agg(F.array_min(F.collect_set("weather_condition")).alias("weather_summary"))
    )
    return per_day.join(summary, "date", "left")


def latest_per_kind(kind: str, time: str, kinds: Sequence[str]) -> list[Column]:
    """Latest `time` of each kind as one column per kind: a pivot in a single grouping (F8)."""
    return [F.max(F.when(F.col(kind) == k, F.col(time))).alias(k) for k in kinds]


def daily_business_summary(
    orders: DataFrame,
    complaints: DataFrame,
    events: DataFrame,
    weather: DataFrame,
    one_row_per_order: bool = False,
    severe: Column | None = None,
    times: Column | None = None,
) -> DataFrame:
    """Daily figures per store.

    `severe` is a column of `weather`, by default the rule for its measures, and `times` is how many observations a row
    of it stands for (`silver.observation_counts`), one by default.

    An order counts once per weather observation it matched, as the reports have always done.
    With `one_row_per_order` it counts once, and is severe if any observation is. Orders are merged
    per id and group in the tasks, so a frequent id meets its facts in few rows.
    """
    severe = is_severe_weather(F.col("precipitation"), F.col("wind_speed")) if severe is None else severe
    times = F.lit(1) if times is None else times
    sources = (
        events.select("order_id", "event_type", "event_time")
        .unionByName(complaints.select("order_id", F.lit(1).alias("complaint")), True)
        .unionByName(
            weather.select("order_id", times.cast("long").alias("observed"), severe.alias("severe")), True
        )
    )
    # One shuffle for all facts of an order; every buffer has a fixed width.
    facts = sources.groupBy("order_id").agg(
        *latest_per_kind("event_type", "event_time", settings.EVENT_TYPES),
        F.count("complaint").alias("complaints"),
        F.coalesce(F.sum("observed"), F.lit(0)).alias("observations"),
        F.coalesce(F.sum(F.when(F.col("severe"), F.col("observed"))), F.lit(0)).alias("severe"),
    )
    facts = facts.select(
        "order_id",
        minutes_between(settings.ORDER_RECEIVED, settings.ORDER_IN_PREPARATION).alias("prep"),
        minutes_between(settings.ORDER_SENT_OUT, settings.ORDER_DELIVERED).alias("delivery"),
        "complaints",
        "observations",
        "severe",
    )
    date = F.to_date("order_time").alias("date")
    orders = orders.groupBy("order_id", date, "store_id", "status").agg(
        F.count("*").alias("orders"),
        F.sum("delivery_delay").alias("delay"),
        F.count("delivery_delay").alias("delays"),
    )
    rows = orders.join(facts, "order_id", "left")

    if one_row_per_order:
        weight = F.lit(1).cast("long")
        severe_rows = F.when(F.col("severe") > 0, 1).otherwise(0)
    else:
        weight = F.greatest(F.coalesce("observations", F.lit(1)), F.lit(1))
        severe_rows = F.coalesce("severe", F.lit(0))
    rows = rows.withColumns({"times": weight, "weight": weight * F.col("orders")})

    def weighted_count(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("weight")).otherwise(0))

    def weighted_mean(value: str) -> Column:
        total = F.sum(F.col(value) * F.col("weight"))
        return F.try_divide(total, weighted_count(F.col(value).isNotNull()))

    delay = F.try_divide(
        F.sum(F.col("delay") * F.col("times")), F.sum(F.col("delays") * F.col("times"))
    )
    return rows.groupBy("date", "store_id").agg(
        F.sum("weight").alias("orders_count"),
        weighted_count(F.col("status") == settings.LATE).alias("late_count"),
        weighted_count(F.col("status") == settings.ON_TIME).alias("on_time_count"),
        weighted_count(F.col("complaints") > 0).alias("complaints_count"),
        delay.alias("avg_delivery_delay"),
        weighted_mean("prep").alias("avg_prep_time"),
        weighted_mean("delivery").alias("avg_delivery_time"),
        F.sum(severe_rows.cast("long") * F.col("orders")).alias("severe_weather_count"),
    )


def peak_hours(
    deliveries: DataFrame, late: Sequence[str] = settings.REPORTED_LATE
) -> DataFrame:
    """Orders, mean delay and late share by hour of day."""
    return deliveries.groupBy(F.hour("order_time").alias("hour_of_day")).agg(
        F.count("*").alias("order_count"),
        F.avg("delivery_delay").alias("avg_delivery_delay"),
        (_late_count(late) / F.count("*")).alias("late_orders_pct"),
    )


def store_performance(deliveries: DataFrame, complaints: DataFrame) -> DataFrame:
    """Mean delay, orders and complaints per order, by store and region of the address.

    Complaints of an unknown store or region are not counted; an unknown store reads 0.
    """
    placed = deliveries.select(
        "order_id",
        "store_id",
        region_of_address("delivery_address").alias("region"),
        "delivery_delay",
    )
    stats = (
        placed.join(_complaints_per_order(complaints), "order_id", "left")
        .groupBy("store_id", "region")
        .agg(
            F.avg("delivery_delay").alias("delay"),
            F.count("*").alias("orders_total"),
            F.coalesce(F.sum("complaints"), F.lit(0)).alias("complaints"),
        )
    )
    known = F.col("store_id").isNotNull() & F.col("region").isNotNull()
    return stats.select(
        F.coalesce("store_id", F.lit(0)).alias("store_id"),
        "region",
        F.coalesce("delay", F.lit(0.0)).alias("avg_delay"),
        "orders_total",
        (F.when(known, F.col("complaints")).otherwise(0) / F.col("orders_total")).alias(
            "complaints_rate"
        ),
    )


def weather_impact(
    deliveries: DataFrame,
    weather: DataFrame,
    complaints: DataFrame,
    late: Sequence[str] = settings.REPORTED_LATE,
    times: Column | None = None,
) -> DataFrame:
    """Mean delay, late share and complaints per order, by weather condition.

    `times` is how many observations a row of `weather` stands for (`silver.observation_counts`), one by default.
    A delivery counts once per matched observation. Complaints of an order count under all its
    observations, delivered or not; under the NULL condition they are not counted.
    """
    is_late = any_of(F.col("delay_category"), late)
    sources = deliveries.select(
        "order_id", F.lit(1).alias("delivered"), "delivery_delay", is_late.alias("late")
    ).unionByName(complaints.select("order_id", F.lit(1).alias("complaint")), True)
    facts = sources.groupBy("order_id").agg(
        F.count("delivered").alias("deliveries"),
        F.sum("delivery_delay").alias("delay"),
        F.count("delivery_delay").alias("delays"),
        F.count_if("late").alias("late"),
        F.count("complaint").alias("complaints"),
    )
    # Hundreds of observations of an order shrink to one row per condition in the map tasks.
    times = F.lit(1) if times is None else times
    seen = weather.groupBy("order_id", "weather_condition").agg(F.sum(times).alias("times"))

    def total(column: str) -> Column:
        return F.sum(F.col("times") * F.col(column))

    stats = (
        seen.join(facts, "order_id")
        .groupBy("weather_condition")
        .agg(
            total("delay").alias("delay"),
            total("delays").alias("delays"),
            total("late").alias("late"),
            total("deliveries").alias("orders"),
            total("complaints").alias("complaints"),
        )
        .filter(F.col("orders") > 0)
    )
    known = F.col("weather_condition").isNotNull()
    return stats.select(
        "weather_condition",
        F.coalesce(F.try_divide("delay", "delays"), F.lit(0.0)).alias("avg_delivery_delay"),
        (F.col("late") / F.col("orders")).alias("late_deliveries_pct"),
        (F.when(known, F.col("complaints")).otherwise(0) / F.col("orders")).alias("complaints_pct"),
    )
