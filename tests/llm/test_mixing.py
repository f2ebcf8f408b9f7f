import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiffin.llm import mixing

DOCS = "doc_id long, text string"
LABELS = "doc_id long, quality int, toxic int"
PLAIN = "tree house river stone cloud grass bread water light wind".split()
RUDE = ["scoundrel", "villain"]


def text_of(kind, rng):
    words = [rng.choice(PLAIN) + rng.choice(["", "s", "y"]) for _ in range(rng.randint(30, 120))]
    if kind == "toxic":
        words[::7] = [rng.choice(RUDE) for _ in words[::7]]
    if kind == "poor":
        words = [w + "###" for w in words[:3]] * 10
    return " ".join(words)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(1)
    kinds = ["good"] * 140 + ["poor"] * 40 + ["toxic"] * 20
    rng.shuffle(kinds)
    docs = [(i, text_of(k, rng)) for i, k in enumerate(kinds)]
    labels = [(i, int(k != "poor"), int(k == "toxic")) for i, k in enumerate(kinds) if i % 2 == 0]
    return docs, labels, kinds


def frames(spark, data, extra=()):
    return spark.createDataFrame([*data[0], *extra], DOCS), spark.createDataFrame(data[1], LABELS)


def test_classifier_finds_the_domains(spark, data):
    docs, labels = frames(spark, data)
    found = mixing.mixed(docs, labels).collect()
    right = [max(r.posterior, key=r.posterior.get) == data[2][r.doc_id] for r in found if r.doc_id % 2]
    assert sum(right) / len(right) > 0.9
    assert all(abs(sum(r.posterior.values()) - 1) < 1e-9 for r in found)


def plain_rates(n, p, wanted, steps=mixing.STEPS):
    """Projected gradient over whole arrays."""
    r, length = np.ones(len(n)), 1.0
    for _ in range(steps):
        miss = (r * n) @ p - wanted
        if np.abs(miss).max() <= mixing.TOLERANCE * wanted.sum() or length < 1e-3:
            break
        on = (r > 0) * n
        gram = (p * on[:, None]).T @ p
        gram += 1e-9 * max(np.trace(gram), 1e-9) * np.eye(len(wanted))
        moved = np.maximum(0, r - length * p @ np.linalg.solve(gram, miss))
        if np.abs((moved * n) @ p - wanted).max() < np.abs(miss).max():
            r, length = moved, min(1.0, 2 * length)
        else:
            length /= 2
    return r


def test_rates_match_plain_form_and_meet_the_targets(spark, data):
    docs, labels = frames(spark, data)
    targets = {"good": 0.8, "poor": 0.15, "toxic": 0.05}
    found = mixing.mixed(docs, labels, targets).collect()
    alone = {r.doc_id: r for r in mixing.rates(docs, labels, targets).collect()}
    for r in found:
        other = alone[r.doc_id]
        assert (r.n_tokens, r.copies) == (other.n_tokens, other.copies) and abs(r.rate - other.rate) < 1e-9
    n = np.array([r.n_tokens for r in found], dtype=float)
    p = np.array([[r.posterior[d] for d in ("good", "poor", "toxic")] for r in found])
    rates = np.array([r.rate for r in found])
    wanted = n.sum() * np.array([0.8, 0.15, 0.05])
    assert np.allclose(rates, plain_rates(n, p, wanted), atol=1e-6)
    assert np.allclose((rates * n) @ p, wanted, rtol=1e-3)
    assert rates.min() >= 0
    copies = np.array([r.copies for r in found])
    assert (np.abs(copies - rates) < 1).all()
    assert [r.n_tokens for r in found] == [len(dict(data[0])[r.doc_id].split()) for r in found]


def test_drawn_rows(spark, data):
    docs, labels = frames(spark, data)
    found = mixing.mixed(docs, labels)
    want = {r.doc_id: r.copies for r in found.collect()}
    got = {r.doc_id: r["count"] for r in mixing.drawn(found, docs.columns).groupBy("doc_id").count().collect()}
    assert got == {i: c for i, c in want.items() if c}


def test_odd_rows(spark, data):
    extra = [(None, "tree house"), (900, None), (901, ""), (902, " \n\t "), (903, "tree " * 60_000), (5, "tree"), (5, "tree")]
    docs, labels = frames(spark, data, extra)
    labels = labels.union(spark.createDataFrame([(None, 1, 1), (7777, 1, 0), (0, None, None), (0, 1, 0)], LABELS))
    docs = docs.withColumns({c: F.lit("x") for c in ("rate", "p", "n", "words", "domain", "__x")})
    found = mixing.mixed(docs, labels)
    rows = found.collect()
    assert len(rows) == len(data[0]) + len(extra)
    assert {r.doc_id: r.n_tokens for r in rows if r.doc_id in (900, 901, 902, 903)} == {900: 0, 901: 0, 902: 0, 903: 60_000}
    assert all(isinstance(r.rate, float) and r.p == "x" for r in rows)
    assert mixing.drawn(found, ["doc_id", "p"]).columns == ["doc_id", "p"]


def test_nothing_to_learn_from_and_empty(spark, data):
    docs, labels = frames(spark, data)
    found = mixing.mixed(docs, labels.limit(0)).collect()
    assert all(abs(x - 1 / 3) < 1e-9 for r in found for x in r.posterior.values())
    assert mixing.mixed(docs.limit(0), labels).count() == 0
    assert mixing.rates(docs.limit(0), labels).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    found = mixing.op4_mixing(spark, sf_dir)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
    rows = found.collect()
    total = sum(r.n_tokens for r in rows)
    for domain, share in mixing.TARGETS.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{domain}"] for r in rows) / total - share) < 1e-3
