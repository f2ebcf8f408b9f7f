"""The named jobs: which tables each reads, how it computes, how it writes.

    spark-submit --py-files tiffin.zip run_job.py gold_peak_hours_analysis --namespace lake
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiffin import schemas, settings
from tiffin.plans import calendar, gold, refresh, silver
from tiffin.plans.bronze import bronze
from tiffin.session import CatalogBinding, build_session
from tiffin.sinks.tables import TableStore, stamped
from tiffin.sources.messages import (
    kafka_batch,
    kafka_stream,
    message_files,
    message_files_stream,
)
from tiffin.streaming.ingest import bronze_stream, ingest_to_table

#: Jobs that a whole run has under way, so that one's last tasks leave no cores idle.
JOBS_AT_ONCE = 4

MessageSource = Callable[[str], DataFrame]  # topic key -> raw messages


@dataclass(frozen=True)
class Job:
    """`build` gets the input tables in order, then `as_of` where the job needs a clock."""

    inputs: Sequence[str]
    build: Callable[..., DataFrame]
    mode: str = "append"
    clocked: bool = False
    schema: StructType | None = None  # fixed columns, created before the first append
    by_day: str | None = None  # the time that the table is laid out by, however it is written


BRONZE = {
    "orders_bronze": "orders",
    "order_events_bronze": "order_events",
    "complaints_bronze": "complaints",
    "weather_bronze": "weather",
}

ORDERS, EVENTS = "silver_orders_clean", "silver_order_events_clean"
COMPLAINTS, WEATHER = "silver_complaints_clean", "silver_weather_enriched"
DELIVERIES = "silver_deliveries_enriched"

SILVER = {
    ORDERS: Job(
        ["orders_bronze"],
        silver.orders_clean,
        schema=schemas.SILVER_ORDERS,
        by_day="event_time",
    ),
    EVENTS: Job(
        ["order_events_bronze"],
        silver.order_events_clean,
        clocked=True,
        schema=schemas.SILVER_ORDER_EVENTS,
        by_day="event_time",
    ),
    COMPLAINTS: Job(
        ["complaints_bronze"], silver.complaints_clean, by_day="timestamp_received"
    ),
    WEATHER: Job([ORDERS, "weather_bronze"], silver.observed_orders, by_day="order_time"),
    "silver_order_status_scd2": Job(
        [EVENTS], silver.order_status_history, "overwrite", by_day="effective_time"
    ),
    DELIVERIES: Job(
        [ORDERS, COMPLAINTS, WEATHER], silver.deliveries_enriched, by_day="order_time"
    ),
}

GOLD = {
    "gold_complaints_by_type": Job([COMPLAINTS], gold.complaints_by_type, "overwrite"),
    "gold_delivery_metrics_by_region": Job(
        [DELIVERIES, COMPLAINTS], gold.delivery_metrics_by_region, "overwrite"
    ),
    "gold_delivery_summary_daily": Job(
        [DELIVERIES, WEATHER], gold.delivery_summary_daily, "overwrite"
    ),
    "gold_daily_business_summary": Job(
        [ORDERS, COMPLAINTS, EVENTS, WEATHER], gold.daily_business_summary, "overwrite"
    ),
    "gold_peak_hours_analysis": Job([DELIVERIES], gold.peak_hours, "overwrite"),
    "gold_store_performance": Job([DELIVERIES, COMPLAINTS], gold.store_performance, "overwrite"),
    "gold_weather_impact_summary": Job(
        [DELIVERIES, WEATHER, COMPLAINTS], gold.weather_impact, "overwrite"
    ),
}

TABLE_JOBS = {**SILVER, **GOLD}
CALENDAR = "silver_dim_time"
QUALITY_ALL = "quality_all"


def run_bronze(
    store: TableStore, table: str, messages: MessageSource, as_of: Column | None = None
) -> None:
    topic = BRONZE[table]
    schema, time = schemas.MESSAGES[topic]
    store.ensure(table, schema, by_day=time)
    store.claim(table, "batch")
    store.append(bronze(messages(topic), topic, as_of), table, time)


def ingest_bronze(
    store: TableStore,
    table: str,
    messages: MessageSource,
    checkpoint: str,
    as_of: Column | None = None,
    replay_keys: Sequence[str] | None = None,
) -> None:
    """The incremental form of `run_bronze`: only what arrived since the last run."""
    topic = BRONZE[table]
    schema, time = schemas.MESSAGES[topic]
    store.ensure(table, schema, by_day=time)
    store.claim(table, "stream")
    rows = bronze_stream(messages(topic), topic, as_of, replay_keys)
    query = ingest_to_table(
        store.laid_out(rows, time),
        store.name(table),
        checkpoint,
        store.table_format,
        store.partitions(time),
    )
    query.awaitTermination()


def run_calendar(store: TableStore, mode: str = "overwrite") -> None:
    store.write(stamped(calendar.calendar(store.spark)), CALENDAR, mode)


def _since(as_of: Column | None) -> Column:
    """The instant before which a job with a late-data cut-off needs no rows."""
    clock = F.current_timestamp() if as_of is None else as_of
    return clock - F.expr(f"INTERVAL {settings.LATE_DATA_HORIZON}")


def run_table_job(
    store: TableStore, table: str, as_of: Column | None = None, mode: str | None = None
) -> None:
    """Compute one silver or gold table from stored tables and write it, stamped."""
    job = TABLE_JOBS[table]
    # An inherited stamp is no data: it must not keep copies apart.
    inputs = [
        store.read(name, _since(as_of) if job.clocked else None).drop("ingestion_time")
        for name in job.inputs
    ]
    df = stamped(job.build(*inputs, as_of) if job.clocked else job.build(*inputs))
    mode = mode or job.mode
    if job.schema is not None and mode == "append":
        store.ensure(table, job.schema, job.by_day)
        store.append(df.select(*job.schema.names), table, job.by_day)
    else:
        store.write(df, table, mode, job.by_day)


def run_in_order(steps: Mapping[str, tuple[Sequence[str], Callable[[], None]]], at_once: int = JOBS_AT_ONCE) -> None:
    """Run each step (what it waits for, what it does) once the steps it names are done; earlier ones first.

    The first error stops the run: steps under way end, no other begins.
    """
    waiting, running = dict(steps), {}
    with ThreadPoolExecutor(at_once) as pool:
        while waiting or running:
            unfinished = {*waiting, *running.values()}
            for name in [n for n, (inputs, _) in waiting.items() if not unfinished & set(inputs)]:
                if len(running) < at_once:
                    running[pool.submit(waiting.pop(name)[1])] = name
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for step in done:
                running.pop(step)
                step.result()


def run_all(
    store: TableStore,
    messages: MessageSource,
    as_of: Column | None = None,
    mode: str | None = None,
    checkpoint: str | None = None,
) -> list[str]:
    """Every job once, inputs before what reads them; returns the tables written.

    `mode` overrides the write mode of the silver and gold tables. With `checkpoint`, a folder,
    bronze tables take only what arrived since the last run, silver tables of files are refreshed for what that
    changes (`refresh`), and the others are replaced unless `mode` says otherwise; so running it
    again adds nothing.
    """
    steps = {}
    for table in BRONZE:
        if checkpoint is None:
            steps[table] = (), partial(run_bronze, store, table, messages, as_of)
        else:
            steps[table] = (), partial(ingest_bronze, store, table, messages, f"{checkpoint}/{table}", as_of)
    run_in_order(steps | {CALENDAR: ((), partial(run_calendar, store))})
    fresh: Sequence[str] = ()
    changed: dict[str, int | None] = {}
    if checkpoint is not None:
        if mode is None and refresh.can_refresh(store):
            refresh.refresh_silver(store, checkpoint)
            fresh = refresh.REFRESHED
        else:
            changed = refresh.taken_in(store, checkpoint)
        mode = mode or "overwrite"
    run_in_order(
        {
            table: (job.inputs, partial(run_table_job, store, table, as_of, mode))
            for table, job in TABLE_JOBS.items()
            if table not in fresh
        }
    )
    if changed:
        refresh.settle(store, checkpoint, changed)
    return [CALENDAR, *BRONZE, *TABLE_JOBS]


def main(argv: Sequence[str] | None = None) -> None:
    from tiffin.plans.quality import CHECKS, run_check, run_checks

    checks = {f"quality_{name}": check for name, check in CHECKS.items()}
    parser = argparse.ArgumentParser(prog="tiffin")
    parser.add_argument("job", choices=["all", CALENDAR, *BRONZE, *TABLE_JOBS, *checks, QUALITY_ALL])
    parser.add_argument("--namespace", help="catalog or catalog.schema of the tables")
    parser.add_argument("--format", default="parquet", help="table format, e.g. iceberg")
    parser.add_argument("--catalog", help="name of a catalog to bind")
    parser.add_argument("--warehouse", help="warehouse location of that catalog")
    parser.add_argument("--kafka", help="bootstrap servers")
    parser.add_argument("--files", help="folder with one folder of JSON lines per topic")
    parser.add_argument("--checkpoint", help="folder of incremental ingests; bronze jobs and all")
    parser.add_argument("--replay-key", action="append", help="column of the key of a message")
    parser.add_argument("--as-of", help="timestamp to use instead of the clock")
    parser.add_argument("--mode", choices=["append", "overwrite"])
    parser.add_argument("--input-bytes", type=int, help="size of the input, for the shuffle width")
    parser.add_argument("--preview", type=int, default=0, help="rows a quality job shows first")
    args = parser.parse_args(argv)
    if args.replay_key and not (args.checkpoint and args.job in BRONZE):
        parser.error("--replay-key belongs to a bronze job with --checkpoint")
    if args.checkpoint and args.job not in ("all", *BRONZE):
        parser.error("--checkpoint belongs to a bronze job or to all")

    binding = CatalogBinding(args.catalog, args.warehouse) if args.catalog else None
    spark = build_session(f"tiffin {args.job}", binding, args.input_bytes)
    store = TableStore(spark, args.namespace, args.format)
    as_of = F.lit(args.as_of).cast("timestamp") if args.as_of else None

    def messages(topic: str) -> DataFrame:
        name, streamed = settings.TOPICS[topic], args.checkpoint is not None
        if args.kafka:
            read = kafka_stream if streamed else kafka_batch
            return read(spark, args.kafka, name)
        if args.files:
            read = message_files_stream if streamed else message_files
            return read(spark, f"{args.files}/{name}")
        raise SystemExit("a bronze job needs --kafka or --files")

    if args.job == "all":
        run_all(store, messages, as_of, args.mode, args.checkpoint)
    elif args.job == CALENDAR:
        run_calendar(store, args.mode or "overwrite")
    elif args.job in BRONZE and args.checkpoint:
        ingest_bronze(store, args.job, messages, args.checkpoint, as_of, args.replay_key)
    elif args.job in BRONZE:
        run_bronze(store, args.job, messages, as_of)
    elif args.job in checks:
        run_check(store, checks[args.job], args.mode or "append", args.preview)
    elif args.job == QUALITY_ALL:
        run_checks(store, args.mode or "append", args.preview)
    else:
        run_table_job(store, args.job, as_of, args.mode)
