"""Every registered query by name: (spark, folder of the test tables) -> DataFrame.

Doubles are rounded to 6 places and timestamps shown without a zone, for comparison with SQL.
Queries are composed, not run: building one starts no Spark job, and what a query does not need is
pruned. Only the stream queries and those of the full run write files, as that is what they show.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, TimestampType

from tiffin import schemas, settings
from tiffin.functions import city_key, is_severe_weather, region_of_address
from tiffin.operators.band_join import stretch_join
from tiffin.operators.intervals import with_end_time
from tiffin.plans import calendar, gold, jobs, quality, refresh, silver
from tiffin.plans.bronze import ACCEPTED, OUTCOME, accepted, bronze, decode_json, recent, with_outcome
from tiffin.plans.jobs import run_all
from tiffin.sinks.staging import delete, short_lived_shuffles, staging_path
from tiffin.sinks.tables import TableStore
from tiffin.sources.messages import message_files_stream
from tiffin.streaming.ingest import bronze_stream, ingest_to_files
from tiffin.testbed import fixtures

Query = Callable[[SparkSession, str], DataFrame]

EVENT_KINDS = ("click", "error", "purchase", "view")
#: Files that one batch of a stream takes.
MAX_FILES = 16
#: How messages lie in the inbox of a refresh: JSON shrinks to a fifth, and one task reads a file.
INBOX = {"compression": "lz4", "maxRecordsPerFile": 1 << 22}
EVENTS_AS_OF = "2024-01-12 00:00:00"


def _shown(df: DataFrame, rounded: bool) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        elif rounded and isinstance(field.dataType, DoubleType):
            column = F.round(column, 6)
        columns.append(column.alias(field.name))
    return df.select(*columns)


class Tables:
    """The silver tables of one query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def bronze(self, topic: str) -> DataFrame:
        return fixtures.BRONZE[topic](self.spark, self.sf_dir)

    def messages(self, topic: str) -> DataFrame:
        return fixtures.messages(self.spark, self.sf_dir, topic)

    def orders(self) -> DataFrame:
        return silver.orders_clean(self.bronze("orders"))

    def events(self) -> DataFrame:
        return silver.order_events_clean(self.bronze("order_events"), fixtures.as_of())

    def complaints(self) -> DataFrame:
        return silver.complaints_clean(self.bronze("complaints"))

    def weather(self) -> DataFrame:
        return silver.observed_orders(self.orders(), self.bronze("weather"))

    def weather_counts(self, **kinds: Column) -> DataFrame:
        return silver.observation_counts(self.orders(), self.bronze("weather"), kinds)

    def first_weather(self, *measures: str) -> DataFrame:
        return silver.first_observed(self.orders(), self.bronze("weather"), measures or silver.MEASURES)

    def deliveries(self, *columns: str) -> DataFrame:
        """All columns of the deliveries, or those a report reads, as it would from a stored table."""
        return silver.deliveries_enriched(
            self.orders(), self.complaints(), self.first_weather(), columns or silver.DELIVERY_COLUMNS
        )

    def timed_deliveries(self) -> DataFrame:
        return self.deliveries("order_id", "order_time", "delivery_delay", "delay_category")

    def placed_deliveries(self) -> DataFrame:
        return self.deliveries("order_id", "region", "delivery_delay", "delay_category")

    def history(self) -> DataFrame:
        return silver.order_status_history(self.events())

    def calendar(self) -> DataFrame:
        return calendar.calendar_of(self.orders(), "order_time")

    def dirty_orders(self) -> DataFrame:
        return fixtures.dirty_orders(self.orders())

    def dirty_weather(self) -> DataFrame:
        return fixtures.dirty_weather(self.weather())

    def dirty_weather_counts(self) -> DataFrame:
        """`dirty_weather` for counting rows by rule: `times` rows for each outcome of an order's observations."""
        return fixtures.dirty_weather(self.weather_counts(**quality.weather_kinds()), "times")

    def dirty_deliveries(self) -> DataFrame:
        columns = ("order_id", "customer_id", "store_id", "order_time", "delay_category")
        return fixtures.dirty_deliveries(self.deliveries(*columns))

    def dirty_history(self) -> DataFrame:
        return fixtures.dirty_order_status(self.history())


def _bronze_query(topic: str) -> Callable[[Tables], DataFrame]:
    return lambda t: bronze(t.messages(topic), topic, fixtures.as_of())


def _band_join(t: Tables) -> DataFrame:
    orders = t.orders().select(
        F.lower(region_of_address("delivery_address")).alias("key"),
        F.unix_timestamp("order_time").alias("second"),
    )
    observations = t.bronze("weather").select(
        city_key(F.col("location")).alias("key"),
        F.unix_timestamp("timestamp").alias("at"),
        *silver.MEASURES,
    )
    matches = stretch_join(orders.dropna().distinct(), observations, settings.WEATHER_BAND_SECONDS)
    return matches.withColumnsRenamed({"key": "city", "second": "order_second"})


def _stream(t: Tables, copies: int, replay_keys: list[str] | None) -> DataFrame:
    """Write the order messages to files as a producer would, then ingest them as a stream.

    Each copy of the messages arrives after the run that ingested the one before.
    """
    inbox, table, checkpoint = (
        staging_path(t.spark, name) for name in ("inbox", "orders_bronze", "checkpoint")
    )
    messages = t.messages("orders").select(F.col("value").cast("string").alias("value"))
    for _ in range(copies):
        messages.write.mode("append").text(inbox)
        rows = bronze_stream(
            message_files_stream(t.spark, inbox, MAX_FILES), "orders", fixtures.as_of(), replay_keys
        )
        ingest_to_files(rows, table, checkpoint).awaitTermination()
    return t.spark.read.schema(schemas.ORDERS).parquet(table)


def _outcomes(t: Tables) -> DataFrame:
    """Order messages by outcome and day, after a stream has written each of them once, by outcome.

    The accepted ones are counted among the bronze rows.
    """
    inbox, table, checkpoint = (
        staging_path(t.spark, name) for name in ("inbox", "orders_by_outcome", "checkpoint")
    )
    t.messages("orders").select(F.col("value").cast("string").alias("value")).write.text(inbox)
    rows = with_outcome(message_files_stream(t.spark, inbox, MAX_FILES), "orders", fixtures.as_of())
    ingest_to_files(rows, table, checkpoint, [OUTCOME]).awaitTermination()
    stored = t.spark.read.schema(rows.schema).parquet(table)
    found = accepted(stored, "orders").select(F.lit(ACCEPTED).alias(OUTCOME), "event_time")
    rest = stored.where(F.col(OUTCOME) != ACCEPTED).select(OUTCOME, "event_time")
    days = found.union(rest).groupBy(OUTCOME, F.to_date("event_time").alias("date"))
    return days.agg(F.count("*").alias("messages"))


def _content(table: str, df: DataFrame) -> DataFrame:
    """One row per column of a stored table: how many values, and what they range over and sum to."""
    lines, columns = [], []
    for i, field in enumerate(f for f in df.schema.fields if f.name != "ingestion_time"):
        value, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, TimestampType):
            number = F.floor(F.unix_micros(value) / 1_000_000)
        elif isinstance(kind, DateType):
            number = F.unix_date(value)
        elif isinstance(kind, StringType):
            number = F.char_length(value)
        else:
            number = value.cast("double")
        text = value if isinstance(kind, StringType) else F.lit(None).cast("string")
        columns += [
            F.count(value).alias(f"n{i}"),
            *[f(number.cast("double")).alias(f"{f.__name__}{i}") for f in (F.min, F.max, F.sum)],
            F.min(text).alias(f"low{i}"),
            F.max(text).alias(f"high{i}"),
        ]
        lines.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.col(f"n{i}").alias("value_count"),
                *[F.round(f"{f}{i}", 3).alias(f"{f}_value") for f in ("min", "max", "sum")],
                F.col(f"low{i}").alias("min_text"),
                F.col(f"high{i}").alias("max_text"),
            )
        )
    counted = df.agg(F.count("*").alias("row_count"), *columns)
    lines = F.inline(F.array(*lines))
    return counted.select(F.lit(table).alias("table_name"), "row_count", lines)


def _quality(store: TableStore) -> DataFrame:
    reports = [
        check.rules.report(store.read(check.table)).withColumn("table_name", F.lit(check.table))
        for check in quality.CHECKS.values()
    ]
    return reduce(DataFrame.unionByName, reports).select("table_name", "rule", "violations")


def _full_run(t: Tables, look: Callable[[TableStore, list[str]], DataFrame]) -> DataFrame:
    """Every job from messages to gold, on tables of their own; what `look` finds in them (a few
    rows per table), after which they are dropped."""
    database = f"tiffin_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{staging_path(t.spark, 'database')}'")
    try:
        with short_lived_shuffles(t.spark):
            store = TableStore(t.spark, database)
            tables = run_all(store, t.messages, fixtures.as_of())
            found = look(store, tables)
            return t.spark.createDataFrame(found.collect(), found.schema)
    finally:
        t.spark.sql(f"DROP DATABASE {database} CASCADE")


def _refreshed(t: Tables) -> DataFrame:
    """Deliveries after two ingests: tables built from most messages, then refreshed for the others."""
    database = f"tiffin_{uuid.uuid4().hex}"
    inbox, checkpoint, out = (staging_path(t.spark, n) for n in ("inbox", "checkpoint", "deliveries"))
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{staging_path(t.spark, 'database')}'")
    try:
        with short_lived_shuffles(t.spark):
            store = TableStore(t.spark, database)
            for late in (False, True):
                for table, topic in jobs.BRONZE.items():
                    if table in refresh.SOURCES:
                        text = t.messages(topic).select(F.col("value").cast("string").alias("value"))
                        part = (F.pmod(F.xxhash64("value"), F.lit(50)) == 0) == late
                        text.where(part).write.mode("append").options(**INBOX).text(f"{inbox}/{topic}")
                        jobs.ingest_bronze(
                            store,
                            table,
                            lambda topic: message_files_stream(t.spark, f"{inbox}/{topic}", MAX_FILES),
                            f"{checkpoint}/{table}",
                            fixtures.as_of(),
                        )
                        delete(t.spark, f"{inbox}/{topic}")  # all taken in
                if late:
                    refresh.refresh_silver(store, checkpoint)
                else:
                    last = refresh.taken_in(store, checkpoint)
                    for table in refresh.REFRESHED:
                        jobs.run_table_job(store, table, fixtures.as_of(), "overwrite")
                    refresh.settle(store, checkpoint, last)
            store.read(refresh.DELIVERIES).drop("ingestion_time").write.parquet(out)
    finally:
        t.spark.sql(f"DROP DATABASE {database} CASCADE")
        delete(t.spark, checkpoint)
    return t.spark.read.parquet(out)


def _contents(store: TableStore, tables: list[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [_content(name, store.read(name)) for name in tables])


def _impact(t: Tables, **options) -> DataFrame:
    seen = t.weather_counts(weather_condition=F.col("weather_condition"))
    return gold.weather_impact(t.timed_deliveries(), seen, t.complaints(), times=F.col("times"), **options)


def _business(t: Tables, **options) -> DataFrame:
    severe = is_severe_weather(F.col("precipitation"), F.col("wind_speed"))
    seen = t.weather_counts(severe=severe)
    return gold.daily_business_summary(
        t.orders(), t.complaints(), t.events(), seen, severe=F.col("severe"), times=F.col("times"), **options
    )


PLANS: dict[str, Callable[[Tables], DataFrame]] = {
    "bronze_orders": _bronze_query("orders"),
    "bronze_order_events": _bronze_query("order_events"),
    "bronze_complaints": _bronze_query("complaints"),
    "bronze_weather": _bronze_query("weather"),
    "stream_bronze_orders": lambda t: _stream(t, 1, None),
    "stream_drop_replays": lambda t: _stream(t, 2, schemas.ORDERS.names),
    "stream_order_outcomes": _outcomes,
    "silver_orders_clean": lambda t: silver.orders_clean(t.bronze("orders")),
    "silver_order_events_clean": lambda t: t.events(),
    "silver_complaints_clean": lambda t: t.complaints(),
    "silver_weather_enriched": lambda t: t.weather(),
    "band_join_bucketed": _band_join,
    "silver_deliveries_enriched": lambda t: t.deliveries(),
    "silver_dim_time": lambda t: t.calendar(),
    "silver_order_status_scd2": lambda t: t.history(),
    "gold_complaints_by_type": lambda t: gold.complaints_by_type(t.complaints()),
    "gold_delivery_metrics_by_region": lambda t: gold.delivery_metrics_by_region(
        t.placed_deliveries(), t.complaints()
    ),
    "gold_delivery_metrics_by_region_late_fixed": lambda t: gold.delivery_metrics_by_region(
        t.placed_deliveries(), t.complaints(), late=settings.ALL_LATE
    ),
    "gold_delivery_summary_daily": lambda t: gold.delivery_summary_daily(
        t.timed_deliveries(), t.first_weather("weather_condition")
    ),
    "gold_delivery_summary_daily_late_fixed": lambda t: gold.delivery_summary_daily(
        t.timed_deliveries(), t.first_weather("weather_condition"), late=settings.ALL_LATE
    ),
    "gold_daily_business_summary": _business,
    "gold_daily_business_summary_per_order": lambda t: _business(t, one_row_per_order=True),
    "gold_peak_hours_analysis": lambda t: gold.peak_hours(t.timed_deliveries()),
    "gold_peak_hours_analysis_late_fixed": lambda t: gold.peak_hours(
        t.timed_deliveries(), late=settings.ALL_LATE
    ),
    "gold_store_performance": lambda t: gold.store_performance(
        t.deliveries("order_id", "store_id", "delivery_address", "delivery_delay"), t.complaints()
    ),
    "gold_weather_impact_summary": _impact,
    "gold_weather_impact_summary_late_fixed": lambda t: _impact(t, late=settings.ALL_LATE),
    "dq_orders": lambda t: quality.ORDERS.report(t.dirty_orders()),
    "dq_orders_issues": lambda t: quality.ORDERS.issues(t.dirty_orders()),
    "dq_complaints": lambda t: quality.COMPLAINTS.report(t.complaints()),
    "dq_complaints_valid": lambda t: quality.COMPLAINTS.valid(t.complaints()),
    "dq_weather": lambda t: quality.WEATHER.report(t.dirty_weather_counts(), F.col("times")),
    "dq_weather_valid": lambda t: quality.WEATHER.valid(t.dirty_weather()),
    "dq_deliveries": lambda t: quality.DELIVERIES.report(t.dirty_deliveries()),
    "dq_order_status": lambda t: quality.ORDER_STATUS.report(t.dirty_history()),
    "dq_order_status_valid": lambda t: quality.ORDER_STATUS.valid(t.dirty_history()),
    "dq_dim_time": lambda t: quality.DIM_TIME.report(fixtures.dirty_calendar(t.calendar())),
    "json_decode_events": lambda t: decode_json(
        t.raw("events").select("event_id", F.col("props").alias("value")), "k int", ["event_id"]
    ),
    "late_cutoff_events": lambda t: recent(
        t.raw("events").select("event_id", "ts", "user_id", "event_type"),
        "ts",
        F.lit(EVENTS_AS_OF).cast("timestamp_ntz"),
    ),
    "scd2_events": lambda t: with_end_time(
        t.raw("events").select("user_id", "event_type", "ts", "event_id"),
        "user_id",
        "ts",
        ["event_id"],
    ).select(
        "user_id",
        F.col("event_type").alias("status"),
        F.col("ts").alias("effective_time"),
        "end_time",
        F.col("end_time").isNull().alias("is_current"),
    ),
    "pivot_events": lambda t: t.raw("events")
    .groupBy("user_id")
    .agg(*gold.latest_per_kind("event_type", "ts", EVENT_KINDS)),
    "full_run": lambda t: _full_run(t, _contents),
    "full_run_refreshed": _refreshed,
    "full_run_quality": lambda t: _full_run(t, lambda store, tables: _quality(store)),
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = name.startswith("gold_")
    return _shown(PLANS[name](Tables(spark, sf_dir)), rounded)


def _query(name: str) -> Query:
    return lambda spark, sf_dir: run(name, spark, sf_dir)


def queries() -> dict[str, Query]:
    return {name: _query(name) for name in PLANS}
