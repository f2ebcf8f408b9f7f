import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tiffin.llm import simhash

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def plain_components(pairs):
    """Brute force over (id, fingerprint): id -> smallest reachable id."""
    label = {i: i for i, _ in pairs}
    changed = True
    while changed:
        changed = False
        for i, f in pairs:
            for j, g in pairs:
                if (f ^ g).bit_count() <= 3 and label[j] > label[i]:
                    label[j], changed = label[i], True
    return label


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_matches_plain_form():
    texts = [None, "", " \n", "One", "one TWO", "a b c", "É b C d é", "x " * 70000, "a b c a b c d"]
    for text in texts:
        assert simhash.fingerprint_of((text or "").encode()) == plain_fingerprint(text)


def test_fingerprints_use_the_engine_hash(spark):
    text = "three words here"
    bits = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert simhash.fingerprint_of(text.encode()) == bits % (1 << 64)


@pytest.mark.parametrize("limits", [{}, {"shard_rows": 8, "tile_rows": 8}])
def test_components_match_brute_force(spark, limits):
    random = np.random.default_rng(5)
    centres = [int(x) for x in random.integers(0, 1 << 63, 25, dtype=np.uint64)]
    prints = list(centres)
    for c in centres[:12]:
        at = c
        for _ in range(int(random.integers(1, 9))):  # chains, whose ends are far apart
            for b in random.choice(64, int(random.integers(1, 4)), replace=False):
                at ^= 1 << int(b)
            prints.append(at)
    prints += [centres[0]] * 3 + [centres[1] ^ 0xF, 0, 0xFFFFFFFFFFFFFFFF]
    pairs = [(i, p) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame([(signed(p),) for p in set(prints)], "fp long")
    member = simhash.components(simhash.links(nodes, **limits))
    found = {r.node: r.component for r in member.collect()}
    want = plain_components(pairs)
    groups = {}
    for i, p in pairs:
        groups.setdefault(found.get(signed(p), signed(p)), set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(
        sorted(j for j in want if want[j] == i) for i in set(want.values())
    )


def test_large_dense_group_leaves_a_forest(spark):
    prints = [(1 << a) | (1 << b) for a in range(64) for b in range(a)]
    nodes = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    edges = simhash.links(nodes, shard_rows=64, tile_rows=128)
    member = simhash.components(edges)
    assert {r.component for r in member.collect()} == {min(map(signed, prints))}


def test_odd_rows(spark):
    rows = [(5, None), (3, ""), (9, "a b c d"), (9, "a b c d"), (None, "a b c d"), (None, "only me"), (4, "w")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(
        {"fp": F.lit("x"), "component": F.lit(1), "a": F.lit(None).cast("int")}
    )
    found = simhash.near_duplicates(docs).collect()
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in found)
    assert got == sorted([(5, 3), (3, 3), (9, 9), (9, 9), (-1, 9), (-1, -1), (4, 4)])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [
        (-1, "only me"), (3, ""), (4, "w"), (9, "a b c d")
    ]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_query_matches_brute_force(spark, sf_dir):
    found = {r.doc_id: r for r in simhash.op9_simhash(spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    pairs = [(i, plain_fingerprint(t)) for i, t in texts.items()]
    want = plain_components(pairs)
    assert {i: r.component_id for i, r in found.items()} == want
    assert all(found[i].fingerprint == f"{p:016x}" for i, p in pairs)
    kept = simhash.drop_near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
