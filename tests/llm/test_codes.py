import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiffin.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, entries, parts=4, rounds=4):
    """Every distance, in Python's integers."""
    good = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in good]
    kept.sort(key=lambda r: (math.inf if r[0] is None else r[0], r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    dim = len(kept[0][1])
    limits = [(i * dim // parts, (i + 1) * dim // parts) for i in range(parts)]
    books = [[v[a:b] for _, v, _ in kept[:entries]] for a, b in limits]

    def nearest(v):
        found = []
        for book, (a, b) in zip(books, limits):
            found.append(min((sum((x - y) ** 2 for x, y in zip(v[a:b], e)), n) for n, e in enumerate(book)))
        return found

    for _ in range(rounds):
        chosen = [nearest(v) for _, v, _ in kept]
        for p, (a, b) in enumerate(limits):
            for n in range(len(books[p])):
                mine = [v[a:b] for (_, v, _), c in zip(kept, chosen) if c[p][1] == n]
                if mine:
                    books[p][n] = [sum(xs) // len(mine) for xs in zip(*mine)]
    out = []
    for i, v, label in kept:
        found = nearest(v)
        out.append((i, "".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found), label))
    totals = {}
    for _, _, error, label in out:
        totals[label] = totals.get(label, 0) + error
    text = ",".join(str(x) for book in books for e in book for x in e)
    rows = [(i, code, error, totals[label]) for i, code, error, label in out]
    return sorted(rows, key=repr), hashlib.sha256(text.encode()).hexdigest()


def run(spark, rows, entries, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).repartition(3)
    found, coder = codes.coded(df, entries=entries)
    found = codes.summed_by(found, "label", "error", "label_error")
    got = [tuple(r) for r in found.select("vec_id", "code", "error", "label_error").collect()]
    return sorted(got, key=repr), codes.codebooks_sha256(coder.books)


def test_against_all_distances(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(10_000), [rng.gauss(0, 0.12) for _ in range(24)], rng.randrange(3)) for _ in range(150)]
    rows += [(20_000 + i, rows[i % 5][1], None) for i in range(40)]  # copies, and a null label
    rows += [(30_000, None, 1), (30_001, [], 1), (30_002, [float("nan")] * 24, 1)]
    rows += [(30_003, [float("inf")] + [0.0] * 23, 1), (30_004, [None] + [0.0] * 23, 1)]
    assert run(spark, rows, 16) == plain(rows, 16)


def test_ties_repeated_ids_and_odd_lengths(spark):
    rng = random.Random(6)
    grid = [0.0, 0.5, -0.5, 1.0]  # few different parts, so equal distances and empty entries
    rows = [(i // 3, [rng.choice(grid) for _ in range(10)], i % 2) for i in range(90)]
    rows += [(None, [0.25] * 10, 0), (0, [-3000.0] * 10, 0), (5, [1.0] * 9, 0)]
    rows += rows[:20]
    assert run(spark, rows, 8) == plain(rows, 8)


def test_fewer_vectors_than_entries_and_none(spark):
    rows = [(i, [float(i), 1.0, 2.0, 3.0], 0) for i in range(3)]
    assert run(spark, rows, 256) == plain(rows, 256)
    found, coder = codes.coded(spark.createDataFrame([(1, None, 1)], SCHEMA))
    assert found.columns == ["vec_id", "label", "code", "error"]
    assert found.collect() == [] and coder.books == []


@pytest.mark.parametrize("spread", [3, 300, 100_000])
def test_cells_keep_every_nearest_entry(spread):
    rng = np.random.default_rng(spread)
    book = rng.integers(-spread, spread, (64, 6))
    points = rng.integers(-spread, spread, (3_000, 6))
    points[:64] = book
    distance = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    nearest = codes.Nearest(book, cells=500)  # forgets its cells on the way
    index, error = nearest(points)
    assert (index == distance.argmin(axis=1)).all() and (error == distance.min(axis=1)).all()
    assert len(nearest.cells) <= codes.BLOCK
    again, _ = nearest(points[::-1])
    assert (again[::-1] == index).all()


def test_cells_leave_entries_out_and_are_reused():
    rng = np.random.default_rng(1)
    nearest = codes.Nearest(rng.integers(-400, 400, (256, 4)))
    points = np.repeat(rng.integers(-400, 400, (20, 4)), 50, axis=0)
    nearest(points)
    assert len(nearest.cells) <= 20
    assert np.mean([len(c) for c in nearest.cells.values()]) < 64


def test_smallest_ids_are_found_by_narrowing(spark, monkeypatch):
    monkeypatch.setattr(codes, "_FEW", 50)
    monkeypatch.setattr(codes, "_BINS", 7)
    rng = random.Random(9)
    for ids in (range(3_000), [rng.choice([-(2**63), 2**63 - 1, 0, 7]) for _ in range(400)], [4] * 300):
        df = spark.createDataFrame([(i,) for i in ids], "_order long")
        few = sorted(r[0] for r in codes._smallest(df, 20).collect())
        assert few[:20] == sorted(ids)[:20]
        assert len(few) <= max(50, 20 + max(map(list(ids).count, set(few))))


def test_hot_and_rare_labels(spark):
    rows = [(i, 1 if i < 500 else None if i < 700 else i, i) for i in range(1_000)]
    df = spark.createDataFrame(rows, "vec_id long, label int, error long")
    got = {r.vec_id: r.total for r in codes.summed_by(df, "label", "error", "total").collect()}
    totals = {}
    for _, label, error in rows:
        totals[label] = totals.get(label, 0) + error
    assert got == {i: totals[label] for i, label, _ in rows}


def test_other_columns_do_not_matter(spark):
    rows = [(i, [float(i % 7), 1.0, 2.0, 3.0], 0, "x", "y") for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA + ", _order string, code string")
    found, _ = codes.coded(df.withColumn("_v", F.lit(1)), entries=4)
    assert found.count() == 30
