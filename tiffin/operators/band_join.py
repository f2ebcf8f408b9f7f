"""Left join on a key and a time band: every match is kept, rows without a match stay once.

A plain join on the key would put all rows of a city into one task and compare every pair. Here

1. the left side shrinks to its distinct (key, second) pairs, since a match depends on nothing
   else. Their number is bounded by the seconds covered, not by the left rows;
2. time is cut into buckets of the band's width. A pair goes to the 3 buckets its band touches,
   an observation to the one it lies in, so each match is found exactly once by an equi-join;
3. observations are made distinct in the tasks and dealt to PARTS parts of their bucket by their
   content, and the pairs are repeated for each part, so that no task sees all of a busy hour;
4. matches are made distinct per pair while they are few, then the left rows pick them up in an
   ordinary join, whose left side Spark can split. The multiplied output is never shuffled.

The plan is the same for every size of input.

That form (`left_band_join`) shuffles the distinct matches, whose number grows with the square of the data where time
covered stays the same. Two others do not, and shuffle their inputs only:

* `stretch_join`, `left_stretch_join` give the same rows. Observations of a key and values stand for the seconds that they
  reach, in stretches that do not touch, so no match comes up twice and repeated values cost no comparison more. A row lies in
  one bucket, a stretch in each that it touches; every match, and every row without one, leaves the join once.
* `first_matches` gives the least match of each pair without making the others. The band is as wide as a bucket, so
  it is the end of one bucket and the beginning of the next, and each of these is a running least.
* `match_counts`, `left_count_join` give how many matches of each kind a pair has, without making them: a stretch is a
  step up where it begins and a step down behind its end, and a count is a running sum of steps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a bucket. Each costs one more copy of the (bounded) pairs.
PARTS = 4


def band_matches(
    pairs: DataFrame, observations: DataFrame, band: int, parts: int = PARTS
) -> DataFrame:
    """Inner matches of distinct (`key`, `second`) pairs with (`key`, `at`, ...) observations.

    Returns `key`, `second` and the other observation columns, made distinct.
    """
    values = [c for c in observations.columns if c not in ("key", "at")]
    first, last = F.floor((F.col("second") - band) / band), F.floor((F.col("second") + band) / band)
    left = pairs.withColumn("bucket", F.explode(F.sequence(first, last)))
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    content = F.xxhash64(F.col("at"), *[F.col(v) for v in values])
    right = (
        observations.distinct()
        .withColumn("bucket", F.floor(F.col("at") / band))
        .withColumn("part", F.pmod(content, F.lit(parts)).cast("int"))
    )
    near = F.abs(F.col("second") - F.col("at")) <= band
    matches = left.join(right, ["key", "bucket", "part"]).filter(near)
    return matches.select("key", "second", *values).distinct()


def left_band_join(
    rows: DataFrame,
    key: Column,
    second: Column,
    observations: DataFrame,
    band: int,
    values: Sequence[str],
    parts: int = PARTS,
) -> DataFrame:
    """Distinct `rows` with the observations (`key`, `at`, values) of their `key` and time.

    A row appears once per distinct combination of values, and rows that find none stay once.
    """
    carried = rows.columns
    rows = rows.withColumn("key", key).withColumn("second", second)
    pairs = rows.select("key", "second").dropna().distinct()
    matches = band_matches(pairs, observations, band, parts)
    return rows.distinct().join(matches, ["key", "second"], "left").select(*carried, *values)


def _stretches(observations: DataFrame, band: int) -> DataFrame:
    """`_key`, `_first`, `_last` and the values: the seconds at which distinct values are within the band of an
    observation. Those of a key and values are disjoint and do not touch, so a bucket holds two of them at most if as wide as
    the band, however often the values are observed; a window holds as many rows as different seconds."""
    values = [c for c in observations.columns if c not in ("key", "at")]
    run = Window.partitionBy("key", *values).orderBy("at")
    seen = observations.dropna(subset=["key", "at"]).distinct().withColumn("_before", F.lag("at").over(run))
    begins = F.col("_before").isNull() | (F.col("at") - F.col("_before") > 2 * band + 1)
    seen = seen.withColumn("_run", F.sum(begins.cast("long")).over(run.rowsBetween(Window.unboundedPreceding, 0)))
    ends = [(F.min("at") - band).alias("_first"), (F.max("at") + band).alias("_last")]
    found = seen.groupBy("key", *values, "_run").agg(*ends)
    return found.select(F.col("key").alias("_key"), "_first", "_last", *values)


def _buckets(stretches: DataFrame, width: int) -> DataFrame:
    """The stretches, by `_bucket` of so many seconds that they reach into."""
    reached = F.sequence(F.floor(F.col("_first") / width), F.floor(F.col("_last") / width))
    return stretches.select(F.explode(reached).alias("_bucket"), "*")


def _inside(band: int) -> Column:
    same = (F.col("key") == F.col("_key")) & (F.floor(F.col("second") / band) == F.col("_bucket"))
    return same & F.col("second").between(F.col("_first"), F.col("_last"))


def stretch_join(pairs: DataFrame, observations: DataFrame, band: int) -> DataFrame:
    """What `band_matches` returns, without a shuffle of the matches."""
    values = [c for c in observations.columns if c not in ("key", "at")]
    return pairs.join(_buckets(_stretches(observations, band), band), _inside(band)).select("key", "second", *values)


def left_stretch_join(
    rows: DataFrame, key: Column, second: Column, observations: DataFrame, band: int, values: Sequence[str]
) -> DataFrame:
    """What `left_band_join` returns, without a shuffle of the matches."""
    carried = rows.columns
    rows = rows.distinct().withColumn("key", key).withColumn("second", second)
    return rows.join(_buckets(_stretches(observations, band), band), _inside(band), "left").select(*carried, *values)


def first_matches(pairs: DataFrame, observations: DataFrame, band: int) -> DataFrame:
    """`key`, `second` and the least values, in column order, of the observations within the band of each of the
    distinct `pairs` that has any. A window holds the different seconds of a bucket at most."""
    values = [c for c in observations.columns if c not in ("key", "at")]
    width = 2 * band + 1
    seen = observations.dropna(subset=["key", "at"]).groupBy("key", "at").agg(F.min(F.struct(*values)).alias("v"))
    marks = F.array(
        *[
            F.struct((F.col("second") + band * side).alias("at"), F.lit(side).alias("side"))
            for side in (-1, 1)
        ]
    )
    asked = pairs.select("key", "second", F.inline(marks))
    both = seen.unionByName(asked, True).withColumn("bucket", F.floor(F.col("at") / width))
    bucket = Window.partitionBy("key", "bucket")

    def running(order: Column) -> Column:
        return F.min("v").over(bucket.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow))

    near = F.when(F.col("side") < 0, F.col("from")).otherwise(F.col("upto"))
    both = both.withColumns({"upto": running(F.col("at").asc()), "from": running(F.col("at").desc())})
    found = both.filter("side IS NOT NULL").groupBy("key", "second").agg(F.min(near).alias("v"))
    return found.filter("v IS NOT NULL").select("key", "second", "v.*")


def left_first_join(
    rows: DataFrame, key: Column, second: Column, observations: DataFrame, band: int, values: Sequence[str]
) -> DataFrame:
    """Distinct `rows`, each once, with the least of what `left_band_join` gives it."""
    carried = rows.columns
    rows = rows.distinct().withColumn("key", key).withColumn("second", second)
    pairs = rows.select("key", "second").dropna().distinct()
    found = first_matches(pairs, observations.select("key", "at", *values), band)
    return rows.join(found, ["key", "second"], "left").select(*carried, *values)


def match_counts(pairs: DataFrame, observations: DataFrame, band: int, kinds: Mapping[str, Column]) -> DataFrame:
    """`key`, `second`, the `kinds` and `times`: how many of the rows that `band_matches` returns for each of the distinct
    `pairs` are of these kinds, if any. Kinds are columns made of the observations' values. Work grows with the
    inputs, times the kinds that occur; a window holds the different seconds of a bucket at most."""
    width = 2 * band + 1
    low = F.col("bucket") * width
    found = _buckets(_stretches(observations, band), width).select(
        F.col("_key").alias("key"), F.col("_bucket").alias("bucket"), "_first", "_last",
        *[kind.alias(name) for name, kind in kinds.items()],
    )
    steps = F.array(
        F.struct(F.greatest("_first", low).alias("at"), F.lit(1).alias("step")),
        F.struct((F.col("_last") + 1).alias("at"), F.lit(-1).alias("step")),
    )
    place = ["key", "bucket", *kinds]
    steps = found.select(*place, F.inline(steps)).where(F.col("at") < low + width)
    steps = steps.groupBy(*place, "at").agg(F.sum("step").alias("step")).where("step <> 0")
    # The kinds of a bucket, for the pairs in it.
    asked = pairs.select("key", "second", F.floor(F.col("second") / width).alias("bucket"))
    asked = asked.join(steps.select(*place).distinct(), ["key", "bucket"]).withColumn("at", F.col("second"))
    upto = Window.partitionBy(*place).orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = steps.unionByName(asked, True).withColumn("times", F.sum("step").over(upto))
    return both.where("second IS NOT NULL AND times > 0").select("key", "second", *kinds, "times")


def left_count_join(
    rows: DataFrame,
    key: Column,
    second: Column,
    observations: DataFrame,
    band: int,
    kinds: Mapping[str, Column],
) -> DataFrame:
    """Distinct `rows` with the `kinds` of what `left_band_join` gives them, each once, and `times`: how many rows it
    gives of them. Rows that find none stay once, with NULL kinds."""
    carried = rows.columns
    rows = rows.distinct().withColumn("key", key).withColumn("second", second)
    pairs = rows.select("key", "second").dropna().distinct()
    found = rows.join(match_counts(pairs, observations, band, kinds), ["key", "second"], "left")
    return found.select(*carried, *kinds, F.coalesce("times", F.lit(1)).alias("times"))
