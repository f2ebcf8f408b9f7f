"""Reports against the plain form: join every row, then count."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tiffin import settings
from tiffin.functions import is_severe_weather, region_of_address
from tiffin.plans import gold, silver

DELIVERIES = (
    "order_id int, store_id int, region string, delivery_address string, order_time timestamp, "
    "delivery_delay double, delay_category string, status string"
)
START = dt.datetime(2024, 1, 1)


class Data:
    """Small random silver tables with NULLs, repeated ids and ids only one table knows."""

    def __init__(self, spark, seed):
        rng = random.Random(seed)

        def maybe(value, share=0.15):
            return None if rng.random() < share else value

        def moment():
            return START + dt.timedelta(minutes=rng.randrange(3 * 1440))

        categories = ["on_time", "minor_delay", "major_delay", "late"]
        self.deliveries = spark.createDataFrame(
            [
                (
                    rng.randrange(60),
                    maybe(101 + i % 3),
                    maybe(rng.choice(["A", "B"])),
                    maybe(rng.choice(["x, North", "x, South", "x"])),
                    maybe(moment(), 0.05),
                    maybe(rng.randrange(300) / 4),
                    maybe(rng.choice(categories)),
                    rng.choice(["late", "on_time"]),
                )
                for i in range(80)
            ],
            DELIVERIES,
        )
        self.complaints = spark.createDataFrame(
            [(i, rng.randrange(70), rng.choice(["t", "u"])) for i in range(60)],
            "complaint_id int, order_id int, complaint_type string",
        )
        self.weather = spark.createDataFrame(
            [
                (
                    rng.randrange(65),
                    moment(),
                    maybe(rng.choice(["Rain", "Fog"])),
                    maybe(rng.randrange(40) * 1.0),
                    maybe(rng.randrange(80) * 1.0),
                )
                for _ in range(150)
            ],
            "order_id int, order_time timestamp, weather_condition string, "
            "precipitation double, wind_speed double",
        )
        self.events = spark.createDataFrame(
            [(rng.randrange(60), rng.choice(settings.EVENT_TYPES[:3]), moment()) for _ in range(120)]
            + [(i, "order_delivered", moment()) for i in range(0, 60, 2)],
            "order_id int, event_type string, event_time timestamp",
        )


@pytest.fixture(params=[1, 2])
def data(spark, request):
    return Data(spark, request.param)


def rounded(df):
    doubles = [c for c, kind in df.dtypes if kind == "double"]
    return rows(df.withColumns({c: F.round(c, 9) for c in doubles}))


def late_share():
    return F.count(F.when(F.col("delay_category") == "late", True)) / F.count("*")


def test_complaints_by_type(spark, data):
    total = data.complaints.count()
    want = data.complaints.groupBy("complaint_type").agg(F.count("*").alias("count"))
    want = want.withColumn("percent_of_orders", F.col("count") / total)
    assert rounded(gold.complaints_by_type(data.complaints)) == rounded(want)
    assert gold.complaints_by_type(data.complaints.filter("false")).isEmpty()


def test_metrics_by_region(data):
    placed = data.deliveries.filter("region is not null")
    stats = placed.groupBy("region").agg(
        F.avg("delivery_delay").alias("avg_delivery_time"),
        late_share().alias("late_deliveries_pct"),
        F.count("*").alias("n"),
    )
    said = data.complaints.join(placed.select("order_id", "region"), "order_id")
    said = said.groupBy("region").agg(F.count("*").alias("c"))
    want = stats.join(said, "region", "left").fillna(0)
    want = want.withColumn("complaints_pct", F.col("c") / F.col("n")).drop("c", "n")
    assert rounded(gold.delivery_metrics_by_region(data.deliveries, data.complaints)) == rounded(want)


def test_store_performance(data):
    placed = data.deliveries.withColumn("region", region_of_address("delivery_address"))
    keys = ["store_id", "region"]
    stats = placed.groupBy(*keys).agg(
        F.avg("delivery_delay").alias("avg_delay"), F.count("*").alias("orders_total")
    )
    said = data.complaints.join(placed.select("order_id", *keys), "order_id")
    said = said.groupBy(*keys).agg(F.count("*").alias("c"))
    want = stats.join(said, keys, "left").fillna(0)
    want = want.withColumn("complaints_rate", F.col("c") / F.col("orders_total")).drop("c")
    assert rounded(gold.store_performance(data.deliveries, data.complaints)) == rounded(want)


def test_weather_impact(data):
    seen = data.weather.select("order_id", "weather_condition")
    stats = data.deliveries.join(seen, "order_id").groupBy("weather_condition")
    stats = stats.agg(
        F.avg("delivery_delay").alias("avg_delivery_delay"),
        late_share().alias("late_deliveries_pct"),
        F.count("*").alias("n"),
    )
    said = data.complaints.join(seen, "order_id").groupBy("weather_condition")
    said = said.agg(F.count("*").alias("c"))
    want = stats.join(said, "weather_condition", "left").fillna(0)
    want = want.withColumn("complaints_pct", F.col("c") / F.col("n")).drop("c", "n")
    got = gold.weather_impact(data.deliveries, data.weather, data.complaints)
    assert rounded(got) == rounded(want)


def test_summary_daily(data):
    got = gold.delivery_summary_daily(data.deliveries, data.weather)
    first = {}
    for r in data.weather.collect():
        if r.weather_condition is not None:
            entry = (r.order_time, r.order_id, r.weather_condition)
            day = r.order_time.date()
            first[day] = min(first.get(day, entry), entry)
    want = {}
    for r in data.deliveries.collect():
        day = r.order_time.date() if r.order_time else None
        total, late = want.get(day, (0, 0))
        want[day] = (total + 1, late + (r.delay_category == "late"))
    assert {r.date: (r.total_orders, r.late_orders) for r in got.collect()} == want
    summaries = {r.date: r.weather_summary for r in got.collect()}
    assert summaries == {d: first[d][2] if d in first else None for d in want}


@pytest.mark.parametrize("one_row", [False, True])
def test_business_summary(data, one_row):
    severe = is_severe_weather(F.col("precipitation"), F.col("wind_speed"))
    weather = data.weather.select("order_id", severe.alias("severe"))
    if one_row:
        weather = weather.groupBy("order_id").agg(F.max("severe").alias("severe"))
    steps = data.events.groupBy("order_id").pivot("event_type").agg(F.max("event_time"))
    steps = steps.select(
        "order_id",
        *[F.col(t).cast("long").alias(t) for t in settings.EVENT_TYPES],
    )
    said = data.complaints.select("order_id", F.lit(True).alias("said")).distinct()
    joined = data.deliveries.join(said, "order_id", "left").join(steps, "order_id", "left")
    joined = joined.join(weather, "order_id", "left")
    received, prepared, sent, delivered = (F.col(t) for t in settings.EVENT_TYPES)
    want = joined.groupBy(F.to_date("order_time").alias("date"), "store_id").agg(
        F.count("*").alias("orders_count"),
        F.count_if(F.col("status") == "late").alias("late_count"),
        F.count_if(F.col("status") == "on_time").alias("on_time_count"),
        F.count_if("said").alias("complaints_count"),
        F.avg("delivery_delay").alias("avg_delivery_delay"),
        F.avg((prepared - received) / 60).alias("avg_prep_time"),
        F.avg((delivered - sent) / 60).alias("avg_delivery_time"),
        F.count_if("severe").alias("severe_weather_count"),
    )
    got = gold.daily_business_summary(
        data.deliveries, data.complaints, data.events, data.weather, one_row_per_order=one_row
    )
    assert rounded(got) == rounded(want)
    assert got.columns == want.columns


def test_peak_hours(data):
    want = data.deliveries.groupBy(F.hour("order_time").alias("hour_of_day")).agg(
        F.count("*").alias("order_count"),
        F.avg("delivery_delay").alias("avg_delivery_delay"),
        late_share().alias("late_orders_pct"),
    )
    assert rounded(gold.peak_hours(data.deliveries)) == rounded(want)
    corrected = gold.peak_hours(data.deliveries, late=settings.ALL_LATE)
    want = data.deliveries.groupBy(F.hour("order_time").alias("hour_of_day")).agg(
        (F.count_if(F.expr("delay_category like '%delay'")) / F.count("*")).alias("s")
    )
    assert rows(corrected.select("hour_of_day", "late_orders_pct")) == rows(
        want.select("hour_of_day", F.col("s").alias("late_orders_pct"))
    )


def test_silver_columns_feed_gold():
    assert {"order_id", "region", "delay_category"} <= set(silver.DELIVERY_COLUMNS)
