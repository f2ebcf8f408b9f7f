"""Hot keys, instants and hours: the operators give exactly the rows of the plain forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from tests.conftest import rows
from tiffin.operators import intervals
from tiffin.operators.band_join import (
    PARTS,
    first_matches,
    left_band_join,
    left_count_join,
    left_first_join,
    left_stretch_join,
    match_counts,
    stretch_join,
)
from tiffin.operators.dedup import first_per_key
from tiffin.operators.intervals import with_end_time
from tiffin.operators.rules import RuleSet, not_null
from tiffin.plans import gold

VALUES = ["v", "w"]


def band_tables(spark, seed):
    """A third of the rows at one key and instant, another third spread over that key's hour."""
    rng = random.Random(seed)

    def where(i):
        if i % 3 == 0:
            return "hot", 7200
        if i % 3 == 1:
            return "hot", 7200 + rng.randrange(3600)
        return rng.choice(["a", "b", "hot", None]), rng.randrange(30_000)

    left = [(i, *where(i)) for i in range(400)] + [(900, "hot", 7200)] * 3 + [(901, "alone", 5)]
    right = [(*where(i), i % 40, rng.choice("xy")) for i in range(400)]
    left_df = spark.createDataFrame(left, "id long, key string, second long").repartition(5)
    right_df = spark.createDataFrame(right, "key string, at long, v long, w string").repartition(5)
    return left_df, right_df


def band(left, right, width, parts=PARTS):
    """`id` is carried through; the pair of a row is looked up from it."""
    pair = [F.col("pair.key"), F.col("pair.second")]
    left = left.select("id", F.struct("key", "second").alias("pair"))
    return left_band_join(left, *pair, right, width, VALUES, parts).drop("pair")


def plain_band(left, right, width):
    near = (left.key == right.key) & (F.abs(left.second - right.at) <= width)
    return left.join(right, near, "left").select("id", *VALUES).distinct()


@pytest.mark.parametrize("parts, width", [(1, 3600), (4, 3600), (7, 100)])
def test_band_join_equals_plain_join(spark, parts, width):
    left, right = band_tables(spark, parts)
    observed = right.filter(F.col("key").isNotNull())
    assert rows(band(left, observed, width, parts)) == rows(plain_band(left, right, width))


def test_band_join_of_null_keys_and_empty_sides(spark):
    left, right = band_tables(spark, 9)
    assert rows(band(left, right, 3600)) == rows(plain_band(left, right, 3600))
    assert rows(band(left, right.limit(0), 3600)) == rows(plain_band(left, right.limit(0), 3600))
    assert band(left.limit(0), right, 3600).isEmpty()


def test_band_edges(spark):
    left = spark.createDataFrame(
        [(i, "k", s) for i, s in enumerate([-3600, -1, 0, 1, 3599, 3600, 3601, 7200, 10800])],
        "id long, key string, second long",
    )
    right = spark.createDataFrame(
        [("k", s, s, "x") for s in (-7200, -3601, -3600, -1, 0, 1, 3599, 3600, 7199, 7200, 7201)],
        "key string, at long, v long, w string",
    )
    got = band(left, right, 3600)
    assert rows(got) == rows(plain_band(left, right, 3600))


def by_join(join, left, right, width):
    left = left.select("id", F.struct("key", "second").alias("pair"))
    return join(left, F.col("pair.key"), F.col("pair.second"), right, width, VALUES).drop("pair")


@pytest.mark.parametrize("seed, width", [(1, 3600), (2, 100), (3, 1)])
def test_stretch_and_first_joins_equal_plain_join(spark, seed, width):
    left, right = band_tables(spark, seed)
    want = plain_band(left, right, width)
    assert rows(by_join(left_stretch_join, left, right, width)) == rows(want)
    assert rows(by_join(left_stretch_join, left, right.limit(0), width)) == rows(plain_band(left, right.limit(0), width))
    least = want.groupBy("id").agg(F.min(F.struct(*VALUES)).alias("v")).select("id", "v.*")
    # an id has one pair, so its rows are one row
    assert rows(by_join(left_first_join, left, right, width)) == rows(least)
    pairs = left.select("key", "second").dropna().distinct()
    near = (F.col("key") == F.col("_key")) & (F.abs(F.col("second") - F.col("at")) <= width)
    found = pairs.join(right.withColumnRenamed("key", "_key"), near)
    found = found.select("key", "second", *VALUES).distinct()
    assert rows(stretch_join(pairs, right, width)) == rows(found)
    first = found.groupBy("key", "second").agg(F.min(F.struct(*VALUES)).alias("v")).select("key", "second", "v.*")
    assert rows(first_matches(pairs, right, width)) == rows(first)


@pytest.mark.parametrize("seconds", [range(-7202, 10_803, 3600), range(-3601, 7300, 1200)])
def test_stretch_and_first_joins_at_edges(spark, seconds):
    places = sorted({s + d for s in seconds for d in (-1, 0, 1)})
    left = spark.createDataFrame([(i, "k", s) for i, s in enumerate(places)], "id long, key string, second long")
    right = spark.createDataFrame([("k", s, s % 5, "x") for s in places], "key string, at long, v long, w string")
    want = plain_band(left, right, 3600)
    assert rows(by_join(left_stretch_join, left, right, 3600)) == rows(want)
    least = want.groupBy("id").agg(F.min(F.struct(*VALUES)).alias("v")).select("id", "v.*")
    assert rows(by_join(left_first_join, left, right, 3600)) == rows(least)


def kinds_of_values():
    return {"odd": F.col("v") % 2 == 1, "w": F.col("w")}


@pytest.mark.parametrize("seed, width", [(1, 3600), (2, 100), (3, 1)])
def test_counts_equal_counted_matches(spark, seed, width):
    left, right = band_tables(spark, seed)
    right = right.withColumn("v", F.when(F.col("v") != 7, F.col("v")))  # a NULL kind too
    pairs = left.select("key", "second").dropna().distinct()
    near = (F.col("key") == F.col("_key")) & (F.abs(F.col("second") - F.col("at")) <= width)
    found = pairs.join(right.withColumnRenamed("key", "_key"), near).select("key", "second", *VALUES).distinct()
    kinds = kinds_of_values()
    want = found.select("key", "second", *[k.alias(n) for n, k in kinds.items()])
    want = want.groupBy("key", "second", *kinds).agg(F.count("*").alias("times"))
    assert rows(match_counts(pairs, right, width, kinds)) == rows(want)
    # Per row of the left, with those that find none
    joined = left_count_join(left.select("id", F.struct("key", "second").alias("pair")), F.col("pair.key"),
                             F.col("pair.second"), right, width, kinds).drop("pair")
    every = plain_band(left, right, width).select("id", *[k.alias(n) for n, k in kinds.items()])
    # `plain_band` keeps a row of NULLs for those that find none, whose kinds are NULL
    assert rows(joined) == rows(every.groupBy("id", *kinds).agg(F.count("*").alias("times")))
    assert rows(left_count_join(left, F.col("key"), F.col("second"), right.limit(0), width, kinds).select("id", "times")) == rows(
        left.select("id").distinct().withColumn("times", F.lit(1))
    )


@pytest.mark.parametrize("seconds", [range(-7202, 10_803, 3600), range(-3601, 7300, 1200), range(-7203, 14_405, 7201)])
def test_counts_at_edges(spark, seconds):
    places = sorted({s + d for s in seconds for d in (-1, 0, 1)})
    pairs = spark.createDataFrame([("k", s) for s in places], "key string, second long")
    right = spark.createDataFrame([("k", s, s % 5, "x") for s in places], "key string, at long, v long, w string")
    want = stretch_join(pairs, right, 3600).groupBy("key", "second", "w").agg(F.count("*").alias("times"))
    assert rows(match_counts(pairs, right, 3600, {"w": F.col("w")})) == rows(want)


def history_table(spark, seed):
    """A third of the rows at one key and instant, a third at that key, and a third without one."""
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    kinds = ["a", "b", "c", None]
    data = set()
    for i in range(1200):
        if i % 4 == 0:
            row = (1, base, rng.choice(kinds), i)
        elif i % 4 == 1:
            row = (1, base + dt.timedelta(seconds=rng.randrange(-200, 200)), rng.choice(kinds), i)
        elif i % 4 == 2:
            row = (None, base + dt.timedelta(hours=rng.randrange(300)), rng.choice(kinds), i)
        else:
            time = base + dt.timedelta(seconds=rng.randrange(9))
            row = (rng.randrange(50), time if i % 8 == 3 else None, rng.choice(kinds), i)
        data.add(row)
    return spark.createDataFrame(list(data), "k int, t timestamp, kind string, extra long")


@pytest.mark.parametrize("range_rows, chunk", [(1, 512), (3, 8), (40, 512), (1 << 22, 512)])
def test_end_time_equals_plain_window(spark, monkeypatch, range_rows, chunk):
    """With every row a cut, with few, and with none."""
    monkeypatch.setattr(intervals, "CHUNK", chunk)
    df = history_table(spark, range_rows % 100).repartition(6)
    window = Window.partitionBy("k").orderBy("t", "kind", "extra")
    want = df.withColumn("end_time", F.lead("t").over(window))
    got = with_end_time(df, "k", "t", ["kind", "extra"], range_rows)
    assert rows(got, *want.columns) == rows(want, *want.columns)


def test_ranges_cut_hot_keys_and_instants(spark):
    """No window holds much more than a range, although a third of the rows share a key and an instant."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("timestamp").alias("t"),
        "id",
    )
    order = F.struct("t", "id")
    cuts = intervals._cuts(df, "k", order, 100).collect()
    hot = next(r for r in cuts if r._key == 7)
    assert 50 < sum(map(len, hot._chunks)) < 200
    want = df.withColumn("end_time", F.lead("t").over(Window.partitionBy("k").orderBy("t", "id")))
    assert rows(with_end_time(df, "k", "t", ["id"], 100)) == rows(want)


def test_end_time_keeps_every_row(spark):
    df = history_table(spark, 3)
    got = with_end_time(df, "k", "t", ["kind", "extra"])
    assert rows(got, *df.columns) == rows(df, *df.columns)
    assert with_end_time(df.limit(0), "k", "t", ["kind", "extra"]).isEmpty()


def test_first_per_key_with_a_hot_key(spark):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 40).alias("k"),
        F.when(F.col("id") % 7 > 0, -F.col("id")).alias("a"),
        "id",
    )
    got = {r.k: (r.a, r.id) for r in first_per_key(df.repartition(5), "k").collect()}
    want = {}
    for r in df.collect():
        row = (r.a is None, r.a or 0, r.id)
        want[r.k] = min(want.get(r.k, row), row)
    assert got == {k: (None if none else a, i) for k, (none, a, i) in want.items()}


def test_issues_with_hot_duplicates(spark):
    rules = RuleSet({**not_null("a")}, unique_key="k")
    df = spark.range(200).select(
        F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 7 != 0, F.col("id")).alias("k"),
        F.when(F.col("id") % 10 != 0, 1).alias("a"),
    )
    copies = F.count("*").over(Window.partitionBy("k"))
    again = df.withColumn("n", copies).filter("n > 1 and k is not null").drop("n")
    want = df.filter("a is null").withColumn("issue", F.lit("null_a")).unionByName(
        again.withColumn("issue", F.lit("duplicate_k"))
    )
    for parts in (1, 8):
        assert rows(rules.issues(df, parts)) == rows(want)
    report = {r.rule: r.violations for r in rules.report(df).collect()}
    assert report == {"null_a": df.filter("a is null").count(), "duplicate_k": 2}


def test_report_of_no_rows(spark):
    rules = RuleSet({**not_null("a")}, unique_key="k")
    df = spark.createDataFrame([], "k long, a long")
    assert {r.rule: r.violations for r in rules.report(df).collect()} == {"null_a": 0, "duplicate_k": 0}


def test_business_summary_with_a_hot_order(spark, sf_dir):
    """Against the rows joined one by one."""
    from tiffin.testbed.registry import Tables

    t = Tables(spark, sf_dir)
    orders = t.orders().withColumn(
        "order_id", F.when(F.col("order_id") % 3 == 0, 33).otherwise(F.col("order_id"))
    )
    complaints, events, weather = t.complaints(), t.events(), t.weather()
    got = gold.daily_business_summary(orders, complaints, events, weather)
    seen = weather.groupBy("order_id").agg(F.count("*").alias("n"))
    odd = complaints.select("order_id").distinct().withColumn("odd", F.lit(1))
    joined = orders.join(seen, "order_id", "left").join(odd, "order_id", "left")
    times = F.greatest(F.coalesce("n", F.lit(1)), F.lit(1))
    joined = joined.select("*", F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
    want = joined.groupBy(F.to_date("order_time").alias("date"), "store_id").agg(
        F.count("*").alias("orders_count"),
        F.count("odd").alias("complaints_count"),
        F.round(F.avg("delivery_delay"), 6).alias("avg_delivery_delay"),
    )
    got = got.withColumn("avg_delivery_delay", F.round("avg_delivery_delay", 6))
    assert rows(got.select(*want.columns)) == rows(want)


def test_values_seen_all_day_are_one_stretch(spark):
    """Else a row is compared with each of them, and the comparisons grow faster than the rows."""
    from tiffin.operators import band_join

    seen = spark.range(0, 86_400, 60).selectExpr("'x' AS key", "id AS at", "id DIV 60 % 2 AS v")
    late = spark.range(1).selectExpr("'x' AS key", "86340L + 7202L AS at", "1L AS v")
    found = band_join._stretches(seen.union(late), 3_600).orderBy("v", "_first").collect()
    assert [(r.v, r._first, r._last) for r in found] == [(0, -3_600, 89_880), (1, -3_540, 89_940), (1, 89_942, 97_142)]
    pairs = spark.range(-4_000, 100_000, 7).selectExpr("'x' AS key", "id AS second")
    rows = band_join.stretch_join(pairs, seen.union(late), 3_600)
    want = band_join.band_matches(pairs, seen.union(late), 3_600)
    assert rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()
