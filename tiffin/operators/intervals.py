"""Validity intervals: each row ends where the next row of its key starts.

A lead over all rows of a key would put a key into one task. Here a key's rows are cut into ranges of their
order, (time, ties), and each (key, range) is a window of its own, so the rows are shuffled once:

1. cuts are rows of the table itself, about one in RANGE_ROWS, chosen by hash. So a key has as many ranges as its
   rows call for, most keys have one range, and one instant with many rows is cut as well;
2. a row's range is the number of its key's cuts that are not after it;
3. inside a range the next row is a lead. The last row of a range is followed by the cut that the next range
   begins with, because a cut is a row: nothing has to be looked up in another task.

The cuts are broadcast: one row in RANGE_ROWS, about 25 MB for 100 TB of short rows. Nothing is counted or sampled
before the query runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows in a range, about.
RANGE_ROWS = 1 << 22
#: Cuts of a key are searched in chunks of so many: first the chunks' heads, then one chunk.
CHUNK = 512


def _cuts(df: DataFrame, key: str, order: Column, range_rows: int) -> DataFrame:
    """`_key`, `_heads` and `_chunks` of the keys that have cuts."""
    chosen = F.pmod(F.xxhash64(F.col(key), order), F.lit(range_rows)) == 0
    cuts = df.where(chosen).groupBy(F.col(key).alias("_key")).agg(F.sort_array(F.collect_set(order)).alias("_cuts"))
    last = F.floor((F.size("_cuts") - 1) / CHUNK).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice("_cuts", c * CHUNK + 1, CHUNK))
    cuts = cuts.select("_key", chunks.alias("_chunks"))
    return cuts.withColumn("_heads", F.transform("_chunks", lambda c: c[0]))


def with_end_time(
    df: DataFrame, key: str, time: str, ties: Sequence[str], range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Add `end_time`: `time` of the key's next row by (`time`, *ties), NULL on the last one.

    Rows are expected to differ in (`key`, `time`, *ties); of copies, each but the last ends at its own
    instant. A NULL key is a key, and NULL in `time` or ties comes first. `df` is read twice, once for the cuts, so its
    rows must not change from one reading to the next.
    """
    order = F.struct(*[F.col(c) for c in (time, *ties)])
    columns = df.columns
    cuts = F.broadcast(_cuts(df, key, order, range_rows))
    head = F.size(F.filter("_heads", lambda cut: cut <= F.col("_order"))) - 1
    within = F.size(F.filter(F.get("_chunks", F.col("_head")), lambda cut: cut <= F.col("_order")))
    number = F.when(F.col("_head") >= 0, F.col("_head") * CHUNK + within).otherwise(0)
    following = F.get(F.get("_chunks", F.floor(F.col("_range") / CHUNK).cast("int")), F.col("_range") % CHUNK)
    placed = (
        df.join(cuts, F.col(key).eqNullSafe(F.col("_key")), "left")
        .withColumn("_order", order)
        .withColumn("_head", F.coalesce(head, F.lit(-1)))
        .withColumn("_range", number)
        .select(*columns, "_range", following[time].alias("_following"))
    )
    in_range = Window.partitionBy(key, "_range").orderBy(time, *ties)
    has_next = F.lead(F.lit(True)).over(in_range).isNotNull()
    end = F.when(has_next, F.lead(time).over(in_range)).otherwise(F.col("_following"))
    return placed.select(*columns, end.alias("end_time"))
