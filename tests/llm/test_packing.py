import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tiffin.llm import packing

SCHEMA = "doc_id long, text string"
ODD = [
    "",
    " \n\t",
    "Plain words, and MORE words.",
    "it's don't WE'LL 's '",
    "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|> <| endoftext|>",
    "É́ é ́x İstanbul ΟΔΟΣ ΣΑΣ ß ﬁ",
    "non breaking space\u0085next\x1cfile\x0bvt\x0cff",
    "数 字 12 345 ６７ ... ,,, ?!.,\x00zero",
    "a,b.c;d 🙂🙃 🙂, word,. word., ..word",
]


@pytest.fixture(scope="module")
def plain():
    inner = Tokenizer.from_file(packing.tokenizer_file())
    return lambda text: [*inner.encode(text or "", add_special_tokens=False).ids, 1]


def check(found, docs, plain, capacity):
    """Whole, right pieces; gapless sequences within the capacity. Returns their number."""
    by_row, want = {}, {}
    for doc_id, text in docs:
        ids = plain(text)
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], dtype="<u4")
            key = (doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))
            want[key] = want.get(key, 0) + 1
    fills = {}
    for r in found:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        by_row[key] = by_row.get(key, 0) + 1
        fills.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_row == want
    for parts in fills.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(fills)


def ids_of(tokenizer, texts):
    return [np.frombuffer(b, "<u4").tolist() for b in tokenizer(pa.array(texts, pa.string()))]


@pytest.fixture(scope="module")
def tokenizer():
    return packing.WordTokenizer(packing.tokenizer_file())


def test_words_give_the_ids_of_whole_texts(tokenizer, plain):
    assert ids_of(tokenizer, ODD) == [plain(t)[:-1] for t in ODD]
    assert ids_of(tokenizer, []) == []


LETTERS = [chr(c) for c in [*range(33, 127), *range(0xA0, 0x250), 0x300, 0x301, 0x3A3, 0x212B, 0x1E9E, 0xFB01]]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from([*LETTERS, *"aeiou'st,.!", "\u00e9t", " "]), max_size=9).map("".join))
def test_words_of_any_letters(tokenizer, plain, text):
    assert ids_of(tokenizer, [text]) == [plain(text)[:-1]]


def test_every_single_letter(tokenizer, plain):
    texts = [*LETTERS, *(f"x{c}y" for c in LETTERS), *(f"{c}{c}" for c in LETTERS)]
    assert ids_of(tokenizer, texts) == [plain(t)[:-1] for t in texts]


def test_forgetting_words_changes_nothing(plain, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    tokenizer = packing.WordTokenizer(packing.tokenizer_file())
    for t in ODD * 2:
        assert ids_of(tokenizer, [t]) == [plain(t)[:-1]]


def test_odd_rows(spark, plain):
    docs = [(i, t) for i, t in enumerate(ODD)]
    docs += [(3, None), (3, None), (None, "no id"), (50, "long text " * 3000), (51, "x" * 30000)]
    frame = spark.createDataFrame(docs, SCHEMA)
    frame = frame.withColumns({c: F.lit("x") for c in ("uid", "piece", "length", "ids", "t")})
    found = packing.pack(frame, capacity=64, shard_items=16)
    rows = found.collect()
    check(rows, docs, plain, 64)
    got = {r.sequence_id: r.ids for r in packing.sequences(found).collect()}
    assert all(len(ids) <= 64 for ids in got.values())
    for r in rows:
        assert got[r.sequence_id][r.offset : r.offset + r.length] == r.ids


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_items_of_known_optimum(spark):
    random = np.random.default_rng(3)
    lengths = []
    for _ in range(60):  # each bin is cut in parts, so 60 bins are the optimum
        cuts = np.sort(random.choice(np.arange(1, 1000), 3, replace=False))
        lengths += np.diff([0, *cuts, 1000]).tolist()
    items = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    for shard_items, most in ((1000, 61), (50, 62)):
        found = packing.best_fit(items, 1000, shard_items).collect()
        assert sorted(r.uid for r in found) == list(range(len(lengths)))
        assert len({r.sequence_id for r in found}) <= most


@pytest.mark.parametrize("long", [0, 200])
def test_many_tiny_items_over_several_shards(spark, long):
    """Tiny items of several shards fit in few bins, which were all reopened, level after level."""
    random = np.random.default_rng(5)
    lengths = [1] * 3000 + random.integers(1, 64, long).tolist()
    items = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    found = packing.best_fit(items, 64, 100).collect()
    assert sorted(r.uid for r in found) == list(range(len(lengths)))
    fills = {}
    for r in found:
        fills.setdefault(r.sequence_id, []).append((r.offset, lengths[r.uid]))
    for parts in fills.values():
        assert [at for at, _ in sorted(parts)] == np.cumsum([0, *(n for _, n in sorted(parts))])[:-1].tolist()
        assert sum(n for _, n in parts) <= 64
    assert len(fills) <= -(-sum(lengths) // 64) + 1


def test_empty_texts_over_several_shards(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "IF(id % 2 = 0, '', NULL) AS text")
    found = packing.pack(docs, with_ids=False).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sorted(r.n for r in found) == [904, 4096]


def test_children_hold_every_item_once():
    random = np.random.default_rng(1)
    lengths = random.integers(1, 90, 200).tolist()
    crowd = []
    for _ in range(2):
        p = packing.Packing([], lengths, 100)
        p.place(random.permutation(200).tolist())
        crowd.append(p)
    for child in (packing.crossed(*crowd, random), packing.mutated(crowd[0], random)):
        assert sorted(i for b in child.bins for i in b) == list(range(200))
        assert max(child.loads()) <= 100


def test_query_matches_plain_form(spark, sf_dir, plain):
    found = packing.op10_best_fit_packing(spark, sf_dir).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    used = check(found, docs, plain, 4096)
    assert used <= -(-sum(r.length for r in found) // 4096) + 1


def test_workers_keep_no_words_after_the_task(spark):
    """A Python worker is used again by later steps, whose memory would come on top."""

    def kept(batches):
        import gc

        from tiffin.llm.packing import Words

        for _ in batches:
            pass
        yield pa.RecordBatch.from_pydict({"n": [sum(isinstance(o, Words) for o in gc.get_objects())]})

    docs = spark.range(40, numPartitions=4).selectExpr("id AS doc_id", "concat('word', id) AS text")
    assert packing.pieces(docs, packing.tokenizer_file()).count() == 40
    found = spark.range(40, numPartitions=4).mapInArrow(kept, "n long").collect()
    assert [r.n for r in found] == [0] * 4
