import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tiffin import schemas
from tiffin.plans import silver

T0 = "2024-01-01 10:00:00"


def order(order_id=1, customer_id=1, store_id=101, address="1 Main St, Haifa", est=T0, act=T0, stamp=T0):
    def time(text):
        return ts(text) if text else None

    return (order_id, customer_id, store_id, ts(T0), time(stamp), address, time(est), time(act))


def clean(spark, *orders):
    return silver.orders_clean(spark.createDataFrame(orders, schemas.ORDERS))


def test_orders_columns_and_values(spark):
    df = clean(spark, order(act="2024-01-01 10:00:30", stamp="2024-01-02 00:00:00"))
    assert df.columns == [c for c in schemas.SILVER_ORDERS.names if c != "ingestion_time"]
    row = df.first()
    assert (row["order_time"], row["delivery_delay"], row["status"]) == (
        ts("2024-01-02 00:00:00"),
        0.5,
        "late",
    )


@pytest.mark.parametrize(
    "bad",
    [
        dict(order_id=None),
        dict(order_id=0),
        dict(customer_id=-1),
        dict(store_id=None),
        dict(address=None),
        dict(est=None),
        dict(act=None),
        dict(act="2024-01-01 09:59:00"),
        dict(act="2024-01-01 15:00:00"),
    ],
)
def test_orders_dropped(spark, bad):
    assert clean(spark, order(**bad)).isEmpty()


def test_orders_kept_at_the_bounds(spark):
    df = clean(spark, order(), order(), order(act="2024-01-01 14:59:59"))
    assert rows(df, "status") == [("'late'",), ("'on_time'",)]


def test_order_events(spark):
    def event(order_id, kind, time="2024-01-02 00:00:00"):
        return (order_id, 1, 1, ts(time) if time else None, ts(T0), kind)

    df = spark.createDataFrame(
        [
            event(1, "order_received"),
            event(1, "order_received"),
            event(2, "order_archived"),
            event(3, None),
            event(None, "order_received"),
            event(4, "order_delivered", "2023-12-31 09:59:59"),
            event(5, "order_delivered", None),
            event(6, "order_delivered", "2024-01-01 10:00:00"),
        ],
        schemas.ORDER_EVENTS,
    )
    kept = silver.order_events_clean(df, F.lit("2024-01-03 10:00:00").cast("timestamp"))
    assert rows(kept, "order_id") == [("1",), ("6",)]


def test_complaints(spark):
    def complaint(i, order_id=1, kind="Cold food", text="x", time=T0):
        return (i, order_id, ts(time) if time else None, kind, text)

    df = spark.createDataFrame(
        [
            complaint(1),
            complaint(1),
            complaint(1, kind="Any type"),
            complaint(0),
            complaint(2, order_id=0),
            complaint(3, kind="  "),
            complaint(4, text=" "),
            complaint(5, text=None),
            complaint(6, time=None),
            complaint(None),
        ],
        schemas.COMPLAINTS,
    )
    assert rows(silver.complaints_clean(df), "complaint_type") == [("'Any type'",), ("'Cold food'",)]


def observation(city, time, temperature=1.0, condition="Clear"):
    return (city, ts(time) if time else None, temperature, 0.0, 0.0, condition)


def test_weather_band(spark):
    orders = clean(spark, order(1), order(2, address="nowhere"), order(3, address="x, Eilat"))
    weather = spark.createDataFrame(
        [
            observation(" HAIFA", "2024-01-01 11:00:00", 1.0),
            observation("haifa ", "2024-01-01 09:00:00", 2.0),
            observation("haifa", "2024-01-01 11:00:01", 3.0),
            observation("haifa", "2024-01-01 10:30:00", 1.0),
            observation("haifa", None, 4.0),
            observation("haifa", "2024-01-01 10:00:00", None),
            observation("acre", "2024-01-01 10:00:00", 5.0),
        ],
        schemas.WEATHER,
    )
    got = silver.weather_enriched(orders, weather)
    assert got.columns == ["order_id", "order_time", "region", *silver.MEASURES]
    assert rows(got, "order_id", "region", "temperature") == [
        ("1", "'Haifa'", "1.0"),
        ("1", "'Haifa'", "2.0"),
        ("2", "None", "None"),
        ("3", "'Eilat'", "None"),
    ]


def test_deliveries_keep_one_row(spark):
    orders = clean(spark, order(1, act="2024-01-01 10:06:00"), order(2))
    complaints = spark.createDataFrame(
        [(1, 1, ts(T0), "Wrong order", "x"), (2, 1, ts(T0), "Cold food", "x")], schemas.COMPLAINTS
    )
    weather = spark.createDataFrame(
        [
            observation("haifa", "2024-01-01 10:00:00", 9.0),
            observation("haifa", "2024-01-01 10:00:00", 3.0, "Rain"),
            observation("haifa", "2024-01-01 10:00:00", 3.0, "Fog"),
        ],
        schemas.WEATHER,
    )
    enriched = silver.weather_enriched(orders, weather)
    got = silver.deliveries_enriched(orders, complaints, enriched)
    assert got.columns == silver.DELIVERY_COLUMNS and len(got.columns) == 17
    first, second = got.orderBy("order_id").collect()
    assert (first.complaint_type, first.had_complaint, first.delay_category) == (
        "Cold food",
        True,
        "minor_delay",
    )
    assert (first.temperature, first.weather_condition, first.region) == (3.0, "Fog", "Haifa")
    assert (second.complaint_type, second.had_complaint) == (None, False)


def test_deliveries_of_a_repeated_order_id(spark):
    # Two orders share an id; only one has weather, and its region is the one kept.
    orders = clean(spark, order(1, address="nowhere"), order(1), order(1, customer_id=2))
    weather = spark.createDataFrame([observation("haifa", T0, 5.0)], schemas.WEATHER)
    none = spark.createDataFrame([], schemas.COMPLAINTS)
    got = silver.deliveries_enriched(orders, none, silver.weather_enriched(orders, weather))
    assert rows(got, "order_id", "customer_id", "region", "temperature") == [
        ("1", "1", "'Haifa'", "5.0")
    ]


def test_empty_inputs(spark):
    orders = spark.createDataFrame([], schemas.ORDERS)
    weather = spark.createDataFrame([], schemas.WEATHER)
    enriched = silver.weather_enriched(clean(spark, order(1)), weather)
    assert rows(enriched, "order_id", "temperature") == [("1", "None")]
    assert silver.weather_enriched(silver.orders_clean(orders), weather).isEmpty()


def test_status_history(spark):
    def event(order_id, time, kind):
        return (order_id, 1, 1, ts(time), ts(T0), kind)

    df = spark.createDataFrame(
        [
            event(1, "2024-01-01 10:00:00", "order_received"),
            event(1, "2024-01-01 10:10:00", "order_in_preparation"),
            event(1, "2024-01-01 10:10:00", "order_delivered"),
            event(2, "2024-01-01 09:00:00", "order_received"),
        ],
        schemas.ORDER_EVENTS,
    )
    got = silver.order_status_history(df)
    assert got.columns == ["order_id", "status", "effective_time", "end_time", "is_current"]
    table = {(r.order_id, r.status): (r.end_time, r.is_current) for r in got.collect()}
    assert table == {
        (1, "order_received"): (ts("2024-01-01 10:10:00"), False),
        (1, "order_delivered"): (ts("2024-01-01 10:10:00"), False),
        (1, "order_in_preparation"): (None, True),
        (2, "order_received"): (None, True),
    }
