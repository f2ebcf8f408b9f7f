import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tiffin.llm import periodic


def lyndon_by_definition(word):
    def is_lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))

    n = len(word)
    return [max(j - i for j in range(i + 1, n + 1) if is_lyndon(word[i:j])) for i in range(n)]


def plain_runs(word):
    """Every period at every place; a stretch that a smaller period has too is no run of the larger one."""
    n, found = len(word), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and word[j] == word[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((i, length, q) for (i, length), q in found.items()), key=lambda r: (r[0], r[2]))


def words_with_repeats(rng):
    n, letters = rng.randrange(0, 120), rng.choice([1, 2, 3, 4, 30])
    word = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        if n > 10:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randrange(3, 10)
            word = word[:a] + [word[a + i % p] for i in range(n - a)]
    return word


def test_lyndon_arrays():
    rng = random.Random(1)
    for _ in range(600):
        word = [rng.randrange(rng.choice([1, 2, 3, 4])) for _ in range(rng.randrange(1, 22))]
        _, word = np.unique(word, return_inverse=True)
        assert periodic.lyndon_array(word.tolist()) == lyndon_by_definition(word.tolist())


def test_runs_against_every_period():
    rng = random.Random(2)
    for _ in range(1_500):
        word = words_with_repeats(rng)
        assert periodic.find_runs(np.array(word, dtype=np.int64)) == plain_runs(word)


def test_fibonacci_and_nested_runs():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    nested = ([0, 0, 0, 0, 0, 0, 1] * 5 + [2]) * 5
    for word in (b, nested, [7] * 50, [1, 2] * 30 + [3] + [1, 2] * 30):
        assert periodic.find_runs(np.array(word)) == plain_runs(word)


def test_many_different_words():
    rng = np.random.default_rng(3)
    word = rng.permutation((1 << 20) + 50)  # triples of such numbers do not fit 64 bits
    word[1_000:1_060] = np.tile(word[1_000:1_010], 6)
    assert periodic.find_runs(word) == [(1_000, 60, 10)]


@pytest.mark.parametrize("word", [np.zeros(200_000, dtype=np.int64), np.arange(200_000) % 7])
def test_long_runs_take_no_quadratic_time(word):
    q = 1 if word.max() == 0 else 7
    assert periodic.find_runs(word) == [(0, 200_000, q)]


def test_first_of_equal_runs_is_on_top():
    assert periodic.top_run([(0, 8, 2), (10, 12, 3), (30, 16, 4)]) == (0, 8, 2)
    assert periodic.top_run([(0, 9, 2), (10, 14, 3), (30, 6, 1)]) == (30, 6, 1)
    assert periodic.top_run([]) is None


def test_collapse(spark):
    texts = ["a b\ta b\na b a b c", None, "", "\x1c x", "ö ö ö ö ö ö end", "a " * 5]
    df = spark.createDataFrame([(t, i, "old") for i, t in enumerate(texts)], "text string, id int, runs string")
    got = {r.id: r for r in periodic.collapse(df).collect()}
    assert [got[i].collapsed for i in range(6)] == ["a b c", None, "", "\x1c x", "ö end", "a a a a a"]
    assert [tuple(r) for r in got[0].runs] == [(0, 8, 2)]
    assert [tuple(r) for r in got[4].runs] == [(0, 6, 1)]
    assert got[1].runs == [] and set(got[0].asDict()) == {"text", "id", "runs", "collapsed"}


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a, source = g % n, list(words)
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else source[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *top, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_equals_every_period(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{x}" for x in words_with_repeats(rng)), i) for i in range(400)]
    rows += [(-5, None, 0), (None, "a a a a a a", 0), (7, "", 0), (7, "x x x x x x x", 0)]
    schema = "doc_id long, text string, period int"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [plain_row(i, t) for i, t, _ in rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert sum(r[1] > 0 for r in want) > 40

    empty = tmp_path / "none"
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    assert periodic.op13_periodic_runs(spark, str(empty)).count() == 0
