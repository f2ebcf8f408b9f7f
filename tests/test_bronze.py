import json

from pyspark.sql import functions as F

from tests.conftest import plan, rows, ts
from tiffin import schemas
from tiffin.plans import silver
from tiffin.plans.bronze import accepted, bronze, decode_json, recent, with_outcome
from tiffin.sources.messages import topic_options

def as_of():
    return F.lit("2024-01-03 10:00:00").cast("timestamp")



def messages(spark, *values):
    return spark.createDataFrame([(bytearray(v.encode()) if v else None,) for v in values], "value binary")


def test_damaged_messages(spark):
    df = decode_json(messages(spark, "not json", None, '{"order_id": 99999999999999999999}'), schemas.ORDERS)
    assert df.columns == schemas.ORDERS.names
    assert all(v is None for r in df.collect() for v in r)


def test_large_ids_survive_to_silver(spark):
    complaint = {
        "complaint_id": 2147483650,
        "order_id": 99999999999,
        "timestamp_received": "2024-01-02T00:00:00",
        "complaint_type": "Cold food",
        "description": "x",
    }
    rows_in = bronze(messages(spark, json.dumps(complaint)), "complaints", as_of())
    kept = silver.complaints_clean(rows_in).first()
    assert (kept.complaint_id, kept.order_id) == (2147483650, 99999999999)


def test_cut_off(spark):
    df = bronze(
        messages(
            spark,
            '{"order_id": 1, "event_time": "2024-01-01T10:00:00"}',
            '{"order_id": 2, "event_time": "2024-01-01T09:59:59.999"}',
            '{"order_id": 3, "event_time": "bad"}',
            '{"order_id": "x", "event_time": "2024-01-02 10:00:00"}',
            '{"order_id": 5, "event_time": "2030-01-01T10:00:00.123456"}',
            "not json",
        ),
        "orders",
        as_of(),
    )
    assert rows(df, "order_id") == [("1",), ("5",), ("None",)]


def test_a_message_is_decoded_once(spark):
    found = bronze(messages(spark, '{"location": "a", "timestamp": "2024-01-02 00:00:00"}'), "weather", as_of())
    assert plan(found).count("from_json") == 1


def test_cut_off_column_per_topic(spark):
    complaint = messages(spark, '{"complaint_id": 1, "timestamp_received": "2024-01-02T00:00:00"}')
    assert bronze(complaint, "complaints", as_of()).count() == 1
    weather = messages(spark, '{"location": "a", "timestamp": "2024-01-02 00:00:00", "temperature": 1}')
    assert bronze(weather, "weather", as_of()).first()["temperature"] == 1.0


def test_cut_off_follows_the_clock(spark):
    now = spark.range(1).select(F.current_timestamp().alias("t"), F.lit(ts("2020-01-01")).alias("old"))
    assert recent(now, "t").count() == 1
    assert recent(now, "old").count() == 0


def test_topic_options():
    assert topic_options("h:1", "orders-topic", startingOffsets="earliest") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "orders-topic",
        "startingOffsets": "earliest",
    }


OUTCOMES = {
    '{"order_id": 1, "event_time": "2024-01-02 10:00:00"}': "accepted",
    '{"order_id": "x", "event_time": "2024-01-02 10:00:00"}': "accepted",
    '{"order_id": 2, "event_time": "2023-01-02 10:00:00"}': "late",
    '{"order_id": "x", "event_time": "2023-01-02 10:00:00"}': "late",
    '{"order_id": 3}': "no_time",
    '{"order_id": 4, "event_time": null}': "no_time",
    '{"order_id": 5, "event_time": "bad"}': "undecodable",
    "not json": "undecodable",
    '{"order_id": 6, "event_ti': "undecodable",
    None: "undecodable",
}


def test_every_message_has_one_outcome(spark):
    sent = messages(spark, *OUTCOMES, *OUTCOMES)
    found = with_outcome(sent, "orders", as_of())
    assert found.columns == ["outcome", "message", *schemas.ORDERS.names]
    assert found.where("outcome <> 'accepted'").select("message", "outcome").distinct().count() == 8
    for r in found.collect():
        assert r.message is None if r.outcome == "accepted" else OUTCOMES[r.message] == r.outcome
    assert found.count() == 2 * len(OUTCOMES)
    assert rows(accepted(found, "orders")) == rows(bronze(sent, "orders", as_of()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert with_outcome(messages(spark, "x").limit(0), "orders").count() == 0
