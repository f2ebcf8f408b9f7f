import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiffin.llm import language

SCHEMA = "doc_id long, text string, lang string"
EN = "the quick brown fox jumps over the lazy dog and then it runs through the green field. "
DE = "der schnelle braune Fuchs springt über den faulen Hund und läuft dann durch das grüne Feld. "
ROWS = [(i, t * (1 + i % 3), l) for i in range(40) for t, l in ((EN, "en"), (DE, "de"))]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([*ROWS, (1, None, "xx"), (2, "", "yy"), (3, "?", "zz"), (4, EN, None)], SCHEMA)
    return language.train(docs)


def test_counts_are_those_of_all_labelled_texts(model):
    counts = np.zeros((language.BUCKETS, 2))
    for _, text, lang in ROWS:
        buckets, n = language.grams(text)
        counts[buckets, ["de", "en"].index(lang)] += n
    assert model.languages == ["de", "en"]
    want = language.LanguageModel.of_counts(["de", "en"], counts)
    assert np.allclose(model.probability, want.probability)


def test_long_texts_are_counted_in_pieces(monkeypatch):
    whole = language.grams(EN * 50)
    monkeypatch.setattr(language, "_CHUNK", 7)
    pieces = language.grams(EN * 50)
    # A run of non-letters may be cut in two, which adds a blank.
    assert abs(int(whole[1].sum()) - int(pieces[1].sum())) < 0.1 * whole[1].sum()


def test_single_and_mixed_texts(model):
    assert model.shares(EN).tolist() == [0, 1]
    assert model.shares(DE).tolist() == [1, 0]
    mixed = model.shares(EN * 10 + DE * 10)
    assert mixed.min() > 0.3 and math.isclose(mixed.sum(), 1)


def test_mixture_is_the_best_on_a_grid():
    random = np.random.default_rng(2)
    p = random.dirichlet(np.ones(300), 2).T
    counts = np.round(4000 * (0.7 * p[:, 0] + 0.3 * p[:, 1]))
    shares = language.mixture(p, counts)
    grid = np.linspace(0.001, 0.999, 999)
    values = [counts @ np.log(p @ np.array([x, 1 - x])) for x in grid]
    assert abs(grid[int(np.argmax(values))] - shares[0]) < 0.01


def test_untried_languages_could_not_have_been_added():
    """The slope bound against trying every language."""
    random = np.random.default_rng(4)
    for _ in range(20):
        p = random.dirichlet(np.full(60, 0.5), 4).T + 1e-6
        counts = random.integers(0, 9, 60).astype(float) + 0.0
        counts[0] += 1
        price = language.PENALTY * np.log(counts.sum())
        first = int(np.argmax(counts @ np.log(p)))
        value = (counts @ np.log(p))[first]
        gains = [
            language._fit(p[:, [first, l]], counts, np.array([0.9, 0.1]))[1] - value
            for l in range(4)
            if l != first
        ]
        assert (max(gains) > price) == ((language.mixture(p, counts) > 0).sum() > 1)


def test_odd_rows(spark, model):
    rows = [(1, None, "en"), (2, "", None), (3, "123 !? ½ ²", "de"), (None, EN, "de"), (4, DE * 3000, None), (4, "数字", "x")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit("x"), "t": F.lit(1), "shares": F.lit(2)})
    found = language.predict(docs, model).collect()
    got = [(r.doc_id, r.lang_pred, r.score) for r in found]
    assert got[:3] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert [g[1] for g in got[3:5]] == ["en", "de"]
    assert got[5][1] in ("en", "de") and 0 <= got[5][2] <= 1
    assert found[0].shares == 2


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, EN, None)], SCHEMA)
    model = language.train(docs)
    assert [r.lang_pred for r in language.predict(docs, model).collect()] == ["und"]
    assert language.predict(docs.limit(0), model).count() == 0


def test_query_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in language.op5_language_id(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(docs)
    right = []
    for d in docs:
        out = zlib.crc32(str(d.doc_id).encode()) % 4 == 2
        assert found[d.doc_id].held_out == out
        if out and d.lang:
            right.append(found[d.doc_id].lang_pred == d.lang)
    assert sum(right) / len(right) > 0.97
