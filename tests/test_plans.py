"""The physical plans: what is shuffled, what reaches the scan, and what must not appear."""

import re

import pytest

from tests.conftest import plan
from tiffin.plans import gold, quality, silver
from tiffin.testbed import registry
from tiffin.testbed.registry import Tables


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Silver tables as files, and no broadcast joins: the plans large tables get."""
    base = tmp_path_factory.mktemp("silver")
    t = Tables(spark, sf_dir)
    tables = {
        "orders": t.orders(),
        "complaints": t.complaints(),
        "weather": t.weather(),
        "events": t.events(),
        "deliveries": t.deliveries(),
    }
    for name, df in tables.items():
        df.write.parquet(str(base / name))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {name: spark.read.parquet(str(base / name)) for name in tables}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def final(df):
    return plan(df).split("+- == Initial Plan ==")[0]


def shuffles(text):
    return len(re.findall(r"\bExchange (?:hash|range|Single|RoundRobin)", text))


def test_deliveries_shuffle_each_input_once(stored):
    text = final(
        silver.deliveries_enriched(stored["orders"], stored["complaints"], stored["weather"])
    )
    assert shuffles(text) == 3 and text.count("SortMergeJoin") == 2
    assert "SortAggregate" not in text
    assert text.count("WindowGroupLimit") == 6  # before and after each shuffle


def test_deliveries_join_only_what_is_asked_for(stored):
    tables = stored["orders"], stored["complaints"], stored["weather"]
    text = final(gold.peak_hours(silver.deliveries_enriched(
        *tables, ["order_id", "order_time", "delivery_delay", "delay_category"])))
    assert "Join" not in text and text.count("FileScan") == 1
    text = final(silver.deliveries_enriched(*tables, ["order_id", "had_complaint"]))
    assert text.count("FileScan") == 2


def test_status_history_shuffles_the_rows_once(stored):
    text = final(silver.order_status_history(stored["events"]))
    # rows by key and range, beside the cuts, a row in millions, by key
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+L?, _range", text)) == 1 and shuffles(text) <= 2
    assert text.count("Window [") == 1 and "SortAggregate" not in text and "SortMergeJoin" not in text


def test_region_report(stored):
    text = final(gold.delivery_metrics_by_region(stored["deliveries"], stored["complaints"]))
    assert shuffles(text) == 3  # deliveries, counts per order, sums per region
    assert "delivery_address" not in text and "PushedFilters: [IsNotNull(region)" in text


def test_business_summary(stored):
    text = final(
        gold.daily_business_summary(
            stored["orders"], stored["complaints"], stored["events"], stored["weather"]
        )
    )
    # orders merged per group, these by id, all facts together, sums per day and store
    assert shuffles(text) == 4
    assert "delivery_address" not in text and "temperature" not in text


def test_daily_summary_merges_by_hash(stored):
    text = final(gold.delivery_summary_daily(stored["deliveries"], stored["weather"]))
    assert "SortAggregate" not in text and "BroadcastHashJoin" in text


def test_weather_impact(stored):
    text = final(
        gold.weather_impact(stored["deliveries"], stored["weather"], stored["complaints"])
    )
    # counts per order and condition, these by order, facts by order, sums per condition
    assert shuffles(text) == 4


def test_peak_hours_reads_three_columns(stored):
    text = final(gold.peak_hours(stored["deliveries"]))
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert [c.split(":")[0] for c in schema.split(",")] == [
        "order_time",
        "delivery_delay",
        "delay_category",
    ]


def test_share_of_total_counts_once(stored):
    text = final(gold.complaints_by_type(stored["complaints"]))
    assert "ReusedExchange" in text


def test_band_join_joins_on_keys(stored, spark, sf_dir, tmp_path):
    path = str(tmp_path / "weather")
    Tables(spark, sf_dir).bronze("weather").write.parquet(path)
    text = final(silver.weather_enriched(stored["orders"], spark.read.parquet(path)))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert re.search(r"SortMergeJoin(\(skew=\w+\))? \[key#\d+, bucket#\d+L, part#\d+\]", text)
    assert re.search(r"SortMergeJoin(\(skew=\w+\))? \[key#\d+, second#\d+L\]", text)
    # pairs and these by bucket, observations and these by bucket, distinct matches and these by
    # pair, orders and these by pair
    assert shuffles(text) == 8


def test_observed_orders_shuffle_their_inputs_only(stored, spark, sf_dir, tmp_path):
    path = str(tmp_path / "weather")
    Tables(spark, sf_dir).bronze("weather").write.parquet(path)
    text = final(silver.observed_orders(stored["orders"], spark.read.parquet(path)))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    # orders and these by bucket; observations, these by values, and their stretches by bucket
    assert shuffles(text) == 5 and not re.search(r"Exchange.*\n.*SortMergeJoin", text)
    text = final(silver.first_observed(stored["orders"], spark.read.parquet(path)))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and text.count("SortMergeJoin") == 1


def test_queries_make_no_more_matches_than_they_need(spark, sf_dir):
    """Reports of the first observation do not make all; no query shuffles matches."""
    for name in ("silver_deliveries_enriched", "gold_delivery_metrics_by_region", "gold_delivery_summary_daily"):
        text = registry.run(name, spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "_first" not in text and "part#" not in text, name
    for name in ("silver_weather_enriched", "band_join_bucketed", "dq_weather", "gold_daily_business_summary"):
        text = registry.run(name, spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "_first" in text and "part#" not in text, name


def test_reports_that_count_matches_do_not_make_them(spark, sf_dir):
    """Matches of a band join come out of a join with a condition on the stretch; counts come out of running sums."""
    for name in ("dq_weather", "gold_daily_business_summary", "gold_weather_impact_summary"):
        text = registry.run(name, spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert not any("Join" in line and "_first" in line for line in text.splitlines()), name


@pytest.mark.parametrize("check", ["ORDERS", "COMPLAINTS", "WEATHER"])
def test_reports_read_a_table_once(stored, check):
    table = {"ORDERS": "orders", "COMPLAINTS": "complaints", "WEATHER": "weather"}[check]
    text = final(getattr(quality, check).report(stored[table]))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_building_a_query_starts_no_job(spark, sf_dir):
    tracker = spark.sparkContext.statusTracker()
    for name in registry.PLANS:
        if name.startswith(("stream", "full_run")):
            continue
        spark.sparkContext.setJobGroup(f"build {name}", name)
        registry.run(name, spark, sf_dir)
        # Reading a file's schema is a job of its own, over the file's footer.
        jobs = tracker.getJobIdsForGroup(f"build {name}")
        stages = [s for j in jobs for s in tracker.getJobInfo(j).stageIds]
        assert all(tracker.getStageInfo(s).numTasks == 1 for s in stages), name
    spark.sparkContext.setJobGroup("", "")


def test_order_filters_reach_the_scan(spark, sf_dir, tmp_path, capsys):
    path = str(tmp_path / "bronze")
    Tables(spark, sf_dir).bronze("orders").write.parquet(path)
    silver.orders_clean(spark.read.parquet(path)).explain("formatted")
    text = capsys.readouterr().out
    for pushed in ("GreaterThan(order_id,0)", "IsNotNull(delivery_address)"):
        assert pushed in text


@pytest.mark.parametrize(
    "name",
    [n for n in registry.PLANS if not n.startswith(("stream", "full", "gold")) or n.endswith("type")],
)
def test_no_python_and_no_all_pairs(spark, sf_dir, name):
    text = registry.run(name, spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert step not in text
