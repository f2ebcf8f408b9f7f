import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tiffin.llm import language, mixing
from tiffin.llm.common import fold_ascii

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read back, the input first."""
    base = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF_DIR).write.parquet(str(base / name))
        out.append(spark.read.parquet(str(base / name)))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_are_those_dealt():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "mixing", "packing"
    ]


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_language_stage_keeps_what_has_a_language(stages):
    model = language.train(stages[0])
    texts = {r.doc_id: r.text for r in stages[0].collect()}
    shares = {i: model.shares(t) for i, t in texts.items()}
    want = [i for i, s in shares.items() if s is not None and s.max() >= corpus_pipeline.MIN_LANGUAGE_SHARE]
    assert ids(stages[1]) == sorted(want) and len(want) > 0.95 * len(texts)


def test_exact_stage(stages):
    top = stages[1].groupBy(fold_ascii(F.col("text")).alias("t")).agg(F.max("doc_id").alias("doc_id"))
    assert ids(stages[2]) == ids(top)


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_stage(stages):
    """One text of each group linked by a Jaccard similarity of 0.8 over five words, all pairs compared."""
    sets = {r.doc_id: shingles(r.text) for r in stages[2].collect()}
    label = {i: i for i in sets}
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and label[i] != label[j] and 5 * len(a & b) >= 4 * len(a | b):
                old, new = sorted((label[i], label[j]), reverse=True)
                label = {k: new if v == old else v for k, v in label.items()}
    assert ids(stages[3]) == sorted(set(label.values()))


def test_mixing_and_packing(spark, stages):
    before, drawn = set(ids(stages[3])), ids(stages[4])
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    copies = {r.doc_id: r.copies for r in mixing.mixed(stages[3], labels).collect()}
    assert set(copies) == before and drawn == sorted(i for i, n in copies.items() for _ in range(n))
    whole = {r.doc_id: r for r in stages[3].collect()}
    assert all(whole[r.doc_id] == r for r in stages[4].collect())
    first = stages[5].where("piece = 0")
    assert ids(first) == drawn
    fills = stages[5].groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert fills.where("n <> end or n > 4096").isEmpty()


def test_run_gives_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, SF_DIR)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = lambda df: sorted(map(tuple, df.select(key).collect()))
    assert rows(found) == rows(stages[5])


def test_odd_rows_pass_every_stage(spark):
    text = "the people of the house have been there for a long time and they are with us"
    rows = [(None, text, None, None, None), (1, None, "en", "s", None), (2, "", "en", None, 0), (3, text, "en", "s", 9),
            (3, text, "en", "s", 9), (4, text + " today", "en", "t", 9), (5, text + " x" * 30_000, None, "t", 9), (6, "123", "en", "s", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).withColumn("fp", F.lit("x")).withColumn("kept", F.lit(1))
    for n, data in ((1, docs), (0, docs.limit(0))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, data, SF_DIR)
            if name != "packing":
                assert out.columns == docs.columns
            data = spark.createDataFrame(out.collect(), out.schema)
        assert (data.count() > 0) == bool(n)
