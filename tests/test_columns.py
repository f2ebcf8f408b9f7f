import pytest
from pyspark.sql import functions as F

from tests.conftest import ts
from tiffin.functions import (
    city_key,
    delay_category,
    is_severe_weather,
    minutes_between,
    order_status,
    region_of_address,
)


def one(spark, schema, values, column):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(column).collect()]


def test_delay_category_bounds(spark):
    delays = [0.0, 4.99, 5.0, 14.99, 15.0, 59.99, 60.0, 299.99, None]
    assert one(spark, "d double", delays, delay_category(F.col("d"))) == [
        "on_time",
        "on_time",
        "minor_delay",
        "minor_delay",
        "major_delay",
        "major_delay",
        "extreme_delay",
        "extreme_delay",
        "extreme_delay",
    ]


def test_order_status(spark):
    got = one(spark, "d double", [-1.0, 0.0, 0.02, None], order_status(F.col("d")))
    assert got == ["on_time", "on_time", "late", "late"]


@pytest.mark.parametrize(
    "address, region",
    [("x", None), ("a, b", "b"), ("a, b, c", "b"), ("a,", ""), ("a,  Tel Aviv ", "Tel Aviv"), (None, None)],
)
def test_region_of_address(spark, address, region):
    assert one(spark, "a string", [address], region_of_address("a")) == [region]


def test_city_key(spark):
    assert one(spark, "a string", ["  Tel Aviv ", None], city_key(F.col("a"))) == ["tel aviv", None]


def test_minutes_use_whole_seconds(spark):
    df = spark.createDataFrame(
        [(ts("2024-01-01 10:00:00.900000"), ts("2024-01-01 10:01:30.100000"))],
        "a timestamp, b timestamp",
    )
    assert df.select(minutes_between("a", "b")).first()[0] == 1.5


def test_severe_weather(spark):
    df = spark.createDataFrame(
        [(20.0, 40.0), (20.1, 0.0), (0.0, 40.1), (None, 50.0), (None, 1.0), (None, None)],
        "p double, w double",
    )
    got = [r[0] for r in df.select(is_severe_weather(F.col("p"), F.col("w"))).collect()]
    assert got == [False, True, True, True, False, False]
