"""Delivery-shaped projections of the test tables, in the layout of the bronze tables.

Ids keep the 64 bits of the test tables, here and in the messages, so that no size of them
overflows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A clock inside the test data's time range (orders run from 1995 to 2001).
AS_OF = "1996-01-03 00:00:00"

STEPS = (
    "order_received",
    "order_in_preparation",
    "order_sent_out_for_delivery",
    "order_delivered",
    "order_archived",
)

def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _later(base: str, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes.cast("int"), F.col(base)).cast("timestamp")


def _start(key: str = "o_orderkey") -> Column:
    return (F.col(key) * 7919) % 1440


def _region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/region.parquet").select(
        F.col("r_regionkey").cast("long").alias("r_key"), "r_name"
    )


def _order_ids() -> list[Column]:
    return [
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (101 + F.col("o_custkey") % 3).cast("int").alias("store_id"),
    ]


def orders_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2% of the addresses have no region; delays span -60 to 359 minutes."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").withColumn("r_key", F.col("o_custkey") % 5)
    address = F.when(key % 50 == 0, "no region").otherwise(
        F.concat(F.col("o_custkey").cast("string"), F.lit(" Main St, "), "r_name")
    )
    return orders.join(_region(spark, sf_dir), "r_key").select(
        *_order_ids(),
        _later("o_orderdate", _start()).alias("event_time"),
        _later("o_orderdate", _start() + (key * 31) % 120).alias("timestamp"),
        address.alias("delivery_address"),
        _later("o_orderdate", _start() + 30).alias("estimated_delivery_time"),
        _later("o_orderdate", _start() + 30 + (key * 37) % 420 - 60).alias("actual_delivery_time"),
    )


def order_events_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five steps per order, the last of an unknown type."""
    key = F.col("o_orderkey")
    steps = F.array(
        *[F.struct(F.lit(i).alias("step"), F.lit(s).alias("event_type")) for i, s in enumerate(STEPS)]
    )
    rows = table(spark, sf_dir, "orders").select("*", F.inline(steps))
    return rows.select(
        *_order_ids(),
        _later("o_orderdate", _start() + F.col("step") * (5 + (key * 17) % 40)).alias("event_time"),
        _later("o_orderdate", _start() + (key * 31) % 120).alias("timestamp"),
        "event_type",
    )


def complaints_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids repeat, 5% of the descriptions are blank, one type is not an accepted one."""
    line = F.col("l_linenumber") % 5
    kind = (
        F.when(line == 0, "Late delivery")
        .when(line == 1, "Wrong order")
        .when(line == 2, "Cold food")
        .when(line == 3, "Missing item")
        .otherwise("Bad service")
    )
    part = F.col("l_partkey")
    text = F.when(part % 20 == 0, "  ").otherwise(F.concat(F.lit("part "), part.cast("string")))
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("complaint_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp_received"),
        kind.alias("complaint_type"),
        text.alias("description"),
    )


def weather_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City names in lower case with padding; severe weather occurs."""
    sky = F.col("l_partkey") % 6
    condition = (
        F.when(sky == 0, "Clear")
        .when(sky == 1, "Partly Cloudy")
        .when(sky == 2, "Cloudy")
        .when(sky == 3, "Rain")
        .when(sky == 4, "Storm")
        .otherwise("Fog")
    )
    lines = table(spark, sf_dir, "lineitem").withColumn("r_key", F.col("l_suppkey") % 5)
    minute = (F.col("l_orderkey") * 13 + F.col("l_linenumber") * 101) % 1440
    return lines.join(_region(spark, sf_dir), "r_key").select(
        F.concat(F.lit(" "), F.lower("r_name"), F.lit(" ")).alias("location"),
        _later("l_shipdate", minute).alias("timestamp"),
        (F.col("l_quantity") - 10).alias("temperature"),
        F.round(F.col("l_discount") * 300, 2).alias("precipitation"),
        F.round(F.col("l_tax") * 600, 2).alias("wind_speed"),
        condition.alias("weather_condition"),
    )


BRONZE = {
    "orders": orders_bronze,
    "order_events": order_events_bronze,
    "complaints": complaints_bronze,
    "weather": weather_bronze,
}


def messages(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The rows of a topic as raw JSON; every 97th order message is damaged, and every 89th
    carries an id that is no number."""
    rows = BRONZE[topic](spark, sf_dir)
    text = F.to_json(F.struct(*rows.columns))
    if topic == "orders":
        key = F.col("order_id")
        bad_id = F.regexp_replace(text, '"order_id":[0-9]+', '"order_id":"x"')
        text = F.when(key % 97 == 0, "not json").when(key % 89 == 0, bad_id).otherwise(text)
    return rows.select(F.encode(text, "UTF-8").alias("value"))


def _null_every(df: DataFrame, key: str, primes: dict[str, int]) -> DataFrame:
    """NULL one column in every row whose key is a multiple of the column's prime."""
    number = F.col(key)
    return df.select(
        *[
            F.when(number % primes[c] != 0, F.col(c)).alias(c) if c in primes else F.col(c)
            for c in df.columns
        ]
    )


def dirty_orders(orders: DataFrame) -> DataFrame:
    """NULL customers, wrong delays and states, repeated and NULL order ids."""
    key = F.col("order_id")
    delay, status = F.col("delivery_delay"), F.col("status")
    # One pass: the marked row itself, a copy for every 53rd, one without an id for every 59th.
    marked = F.struct(
        key.alias("order_id"),
        F.when(key % 97 != 0, F.col("customer_id")).alias("customer_id"),
        F.when(key % 41 == 0, -5.0).when(key % 43 == 0, 301.0).otherwise(delay).alias(
            "delivery_delay"
        ),
        F.when(key % 61 == 0, "canceled").when(key % 67 != 0, status).alias("status"),
    )

    def copy(order_id: Column) -> Column:
        return F.struct(
            order_id.alias("order_id"),
            F.col("customer_id"),
            delay.alias("delivery_delay"),
            status.alias("status"),
        )

    rows = F.array(
        marked,
        F.when(key % 53 == 0, copy(key)),
        F.when(key % 59 == 0, copy(F.lit(None).cast("long"))),
    )
    return orders.select(F.inline(F.array_compact(rows)))


def dirty_weather(weather: DataFrame, *more: str) -> DataFrame:
    key = F.col("order_id")
    return weather.select(
        "order_id",
        "order_time",
        "region",
        F.when(key % 101 == 0, -60.0).otherwise(F.col("temperature")).alias("temperature"),
        F.when(key % 103 == 0, -1.0).otherwise(F.col("precipitation")).alias("precipitation"),
        F.when(key % 107 == 0, 301.0).otherwise(F.col("wind_speed")).alias("wind_speed"),
        "weather_condition",
        *more,
    )


def dirty_deliveries(deliveries: DataFrame) -> DataFrame:
    stamped = deliveries.withColumn("ingestion_time", F.col("order_time"))
    primes = {
        "customer_id": 11,
        "store_id": 13,
        "order_time": 17,
        "delay_category": 19,
        "ingestion_time": 23,
    }
    return _null_every(stamped, "order_id", primes)


def dirty_order_status(history: DataFrame) -> DataFrame:
    stamped = history.withColumn("ingestion_time", F.col("effective_time"))
    primes = {"status": 11, "effective_time": 13, "is_current": 17, "ingestion_time": 19}
    return _null_every(stamped, "order_id", primes)


def dirty_calendar(days: DataFrame) -> DataFrame:
    numbered = days.withColumn("number", F.unix_date("date"))
    primes = {"day_of_week": 11, "is_weekend": 13, "is_holiday": 17, "is_short_friday": 19}
    return _null_every(numbered, "number", primes).drop("number")
