import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tiffin.plans import quality
from tiffin.plans.quality import CHECKS, QualityError, run_check
from tiffin.sinks.tables import TableStore

ORDERS = "order_id int, customer_id int, delivery_delay double, status string"


def dirty_orders(spark):
    return spark.createDataFrame(
        [
            (1, 1, 0.0, "late"),
            (1, 2, 300.0, "on_time"),
            (2, None, -1.0, "canceled"),
            (3, 3, 301.0, None),
            (None, 4, None, "late"),
            (None, 5, 1.0, "late"),
        ],
        ORDERS,
    )


def test_report_counts_rows_and_keys(spark):
    report = dict(quality.ORDERS.report(dirty_orders(spark)).collect())
    # A NULL status is not flagged; the NULL order ids are one group of copies.
    assert report == {
        "null_customer_id": 1,
        "null_order_id": 2,
        "invalid_delivery_delay": 2,
        "invalid_status": 1,
        "duplicate_order_id": 2,
    }


def test_issues(spark):
    got = quality.ORDERS.issues(dirty_orders(spark))
    assert got.columns == [*dirty_orders(spark).columns, "issue"]
    assert rows(got, "order_id", "issue") == [
        ("1", "'duplicate_order_id'"),
        ("1", "'duplicate_order_id'"),
        ("2", "'invalid_delivery_delay'"),
        ("2", "'invalid_status'"),
        ("2", "'null_customer_id'"),
        ("3", "'invalid_delivery_delay'"),
        ("None", "'null_order_id'"),
        ("None", "'null_order_id'"),
    ]


def test_report_scans_once(spark):
    df = dirty_orders(spark).withColumn("order_id", F.col("order_id"))
    plan = quality.DELIVERIES.report(
        df.selectExpr("*", "1 store_id", "1 order_time", "1 delay_category", "1 ingestion_time")
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_weather_ranges(spark):
    schema = (
        "order_id int, order_time timestamp, region string, temperature double, "
        "precipitation double, wind_speed double, weather_condition string"
    )
    t = ts("2024-01-01")
    df = spark.createDataFrame(
        [
            (1, t, "a", -50.0, 0.0, 0.0, "x"),
            (2, t, "a", 60.0, 0.0, 300.0, "x"),
            (3, t, "a", -50.1, 0.0, 0.0, "x"),
            (4, t, "a", 60.1, -0.1, 300.1, "x"),
            (5, t, None, None, None, None, None),
        ],
        schema,
    )
    assert rows(quality.WEATHER.valid(df), "order_id") == [("1",), ("2",)]
    report = dict(quality.WEATHER.report(df).collect())
    assert report["invalid_temperature"] == 2 and report["null_region"] == 1
    assert report["invalid_wind_speed"] == 1 and report["invalid_precipitation"] == 1


def test_orders_check_saves_issues_and_fails(spark, database):
    store = TableStore(spark, database)
    store.create(dirty_orders(spark), "silver_orders_clean")
    for _ in range(2):  # the second run appends
        with pytest.raises(QualityError) as error:
            run_check(store, CHECKS["orders"])
    assert error.value.report["duplicate_order_id"] == 2
    assert store.read("silver_orders_clean_quality_issues").count() == 16


def test_orders_check_passes(spark, database):
    store = TableStore(spark, database)
    store.create(spark.createDataFrame([(1, 1, 0.0, "late")], ORDERS), "silver_orders_clean")
    assert not any(run_check(store, CHECKS["orders"], preview=5).values())
    assert not store.exists("silver_orders_clean_quality_issues")


def test_complaints_check(spark, database):
    schema = "complaint_id int, order_id int, complaint_type string"
    store = TableStore(spark, database)
    store.create(
        spark.createDataFrame(
            [(1, 1, "Cold food"), (1, 2, "Cold food"), (2, 2, "Bad service")], schema
        ),
        "silver_complaints_clean",
    )
    report = run_check(store, CHECKS["complaints"])
    assert report["duplicate_complaint_id"] == 1 and report["invalid_complaint_type"] == 1
    # Duplicates are counted but stay.
    assert store.read("silver_complaints_clean_valid").count() == 2
    store.replace(spark.createDataFrame([(2, 2, "Bad service")], schema), "silver_complaints_clean")
    with pytest.raises(QualityError):
        run_check(store, CHECKS["complaints"])


def test_status_check_keeps_whole_rows(spark, database):
    t = ts("2024-01-01")
    schema = (
        "order_id int, status string, effective_time timestamp, end_time timestamp, "
        "is_current boolean, ingestion_time timestamp"
    )
    store = TableStore(spark, database)
    store.create(
        spark.createDataFrame([(1, "a", t, None, True, t), (2, None, t, t, False, t)], schema),
        "silver_order_status_scd2",
    )
    run_check(store, CHECKS["order_status"])
    assert rows(store.read("silver_order_status_scd2_valid"), "order_id") == [("1",)]


def test_kinds_of_weather_break_the_rules_of_their_values(spark):
    numbers = [None, -400.0, -50.5, -50.0, -1.0, -0.0, 0.0, 60.0, 60.5, 300.0, 300.5, float("nan")]
    values = [(a, a, a, None if a is None else "Rain") for a in numbers]
    names = ["temperature", "precipitation", "wind_speed", "weather_condition"]
    df = spark.createDataFrame(values, "temperature double, precipitation double, wind_speed double, weather_condition string")
    df = df.select("*", *[F.lit(None).alias(c) for c in ("order_id", "order_time", "region")])
    kinds = df.select("*", *[k.alias(f"k_{n}") for n, k in quality.weather_kinds().items()]).drop(*names)
    kinds = kinds.withColumnsRenamed({f"k_{n}": n for n in names})
    assert rows(quality.WEATHER.report(kinds)) == rows(quality.WEATHER.report(df))
    twice = quality.WEATHER.report(kinds.withColumn("times", F.lit(2)), F.col("times"))
    assert rows(twice) == rows(quality.WEATHER.report(df.union(df)))
