import hashlib

import pytest
from pyspark.sql import functions as F

from tiffin.llm import exact_dedup

SCHEMA = "doc_id long, text string, source string"
ROWS = [
    (1, "Same text", "a"),
    (7, "same TEXT", "b"),
    (3, None, "c"),
    (4, "", None),
    (5, "É", "d"),
    (6, "é", "d"),
    (7, "same TEXT", "z"),
    (None, "same text", "e"),
    (None, "lone", "e"),
    (8, "x" * 300_000, "f"),
    (9, "X" * 300_000, "f"),
    (7, "other", "g"),
]


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(rows):
    groups = {}
    for doc_id, text, _ in rows:
        groups.setdefault(fold(text), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        seen = False
        for i in ids:
            kept = i == keep and not seen
            seen |= kept
            digest = hashlib.sha256(text.encode()).hexdigest()
            out.append((i, keep, len(ids), kept, digest))
    return sorted(out, key=repr)


def weak(text):
    return F.char_length(text).cast("string")


def docs_of(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_matches_plain_form(spark):
    found = exact_dedup.exact_duplicates(docs_of(spark), salts=2).collect()
    assert sorted(map(tuple, found), key=repr) == plain(ROWS)


def test_colliding_digests_do_not_merge_texts(spark):
    found = exact_dedup.exact_duplicates(docs_of(spark), digest=weak).collect()
    assert sorted((tuple(r)[:4] for r in found), key=repr) == sorted(
        (r[:4] for r in plain(ROWS)), key=repr
    )


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
def test_kept_rows_keep_their_columns(spark, digest):
    docs = docs_of(spark).withColumns(
        {c: F.lit(1) for c in ("digest", "keep_id", "n", "top", "texts", "kept")}
    )
    found = exact_dedup.drop_exact_duplicates(docs, digest=digest)
    assert found.columns == docs.columns
    got = sorted(((r.doc_id, fold(r.text)) for r in found.collect()), key=repr)
    groups = {}
    for i, text, _ in ROWS:
        groups[fold(text)] = max((x for x in (i, groups.get(fold(text))) if x is not None), default=None)
    assert got == sorted(((i, t) for t, i in groups.items()), key=repr)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert exact_dedup.drop_exact_duplicates(empty).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    found = exact_dedup.op3_exact_dedup(spark, sf_dir)
    found.collect()
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
