import pytest
from pyspark.sql import functions as F

from tiffin.llm import exact_dedup, simhash
from tiffin.llm.common import per_salt, salt_of, salts_seen
from tiffin.llm.simhash import components


@pytest.mark.parametrize("salts", [1, 16, 63])
def test_groups_are_repeated_for_their_salts_only(spark, salts):
    rows = spark.range(2_000).select((F.col("id") % 7 * (F.col("id") % 2)).alias("key"), "id")
    rows = rows.withColumn("salt", salt_of(F.col("id"), salts))
    groups = rows.groupBy("key").agg(F.count("*").alias("n"), salts_seen(F.col("salt")).alias("bits"))
    spread = per_salt(groups, "bits", "salt", salts)
    assert spread.count() == rows.select("key", "salt").distinct().count()
    met = rows.join(spread, ["key", "salt"])
    assert met.count() == 2_000
    assert met.groupBy("key").agg(F.max("n") == F.count("*")).where("NOT `(max(n) = count(1))`").isEmpty()


def test_a_hub_and_a_chain_are_components(spark):
    hub = spark.range(1, 3_000).select(F.lit(5_000).cast("long").alias("a"), F.col("id").alias("b"))
    chain = spark.range(10_000, 10_200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = {r.node: r.component for r in components(hub.union(chain)).collect()}
    assert found == {**{i: 1 for i in [*range(1, 3_000), 5_000]}, **{i: 10_000 for i in range(10_000, 10_201)}}


def test_copies_of_one_text_meet_their_result_in_several_places(spark):
    docs = spark.range(5_000).select(F.col("id").alias("doc_id"), F.lit("Same").alias("text"))
    found = exact_dedup.exact_duplicates(docs)
    kept = found.where("kept").collect()
    assert [(r.doc_id, r.group_size) for r in kept] == [(4_999, 5_000)]
    assert found.where("keep_id = 4999 AND group_size = 5000").count() == 5_000


def test_rounds_write_few_files(spark, monkeypatch):
    """Not a file for each partition of a shuffle, in every round: each costs its task processes on local disks."""
    files, write = [], simhash.staged

    def counted(df, name, *rows):
        files.append((name, len((found := write(df, name, *rows)).inputFiles()), *rows))
        return found

    monkeypatch.setattr(simhash, "staged", counted)
    off = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(off, "false")
    try:
        edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b").where("a % 10 <> 9").repartition(4)
        found = {r.node: r.component for r in simhash.components(edges, rows=270).collect()}
    finally:
        spark.conf.unset(off)
    assert found == {i: i - i % 10 for i in range(300)}
    assert len(files) > 3 and all(n == 1 for _, n, *_ in files)
