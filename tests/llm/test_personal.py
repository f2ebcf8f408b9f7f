import hashlib
import random
import re
import time

import pytest

from tiffin.llm import personal
from tiffin.llm.common import table

# The base rules as they are stated.
RULES = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_luhn(digits):
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def plain_base(text):
    out = []
    for kind, rule in enumerate(RULES):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                16 <= len(digits) <= 19 and plain_luhn(digits),
                8 <= len(digits) <= 15,
            )
            if good[kind]:
                out.append((kind, *m.span()))
    return out


def test_base_spans_are_those_of_the_rules():
    rng = random.Random(3)
    alphabets = ["a@.1-%", "0123456789. ", "0123456789 -", "+0123()- .", "a.@1+ 2-é", "12.5"]
    for _ in range(20_000):
        text = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(50)))
        assert personal.base_spans(text) == plain_base(text)
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111 22", "0000000000000000", "4" * 19]
    assert [personal.base_spans(c) for c in cards] == [plain_base(c) for c in cards]


@pytest.mark.parametrize(
    "piece", ["1", "a", "1.", "1 ", "+1", "@a", "a@", "Anna ", "1:", "AB12 ", "x dot ", "a at a dot ", "A"]
)
def test_no_text_takes_quadratic_time(piece):
    start = time.time()
    personal._candidates_of(piece * (200_000 // len(piece)))
    assert time.time() - start < 30


def test_estimated_reliabilities():
    rng = random.Random(1)
    right, patterns = (0.95, 0.9, 0.7, 0.8, 0.6, 0.85), {}
    for _ in range(20_000):
        truth = rng.random() < 0.3
        votes = "".join(
            "0" if rng.random() < 0.2 else "+" if (rng.random() < r) == truth else "-" for r in right
        )
        patterns[votes] = patterns.get(votes, 0) + 1
    found = personal.reliabilities(patterns)
    assert abs(found.share - 0.3) < 0.03
    assert all(abs(a - b) < 0.04 for a, b in zip(found.right, right))
    assert personal.reliabilities({}).right == pytest.approx(personal.EXPECTED)


def prose(rng, n=40):
    return " ".join("".join(rng.choice("abdeghinorst") for _ in range(rng.randrange(2, 9))) for _ in range(n))


CARD, BAD_CARD = "4041894974608795", "4041894974608796"


@pytest.fixture(scope="module")
def found(spark):
    rng = random.Random(8)
    texts = [prose(rng) for _ in range(200)]
    for i in range(0, 120, 2):
        texts[i] += f" 12.44.35.{i} call +1 (988) 555-24{i:02d}x card {CARD} mail bo.{i}@mail{i}.example.com end"
    planted = {
        200: (f"and 28 {CARD} so on", [("card", CARD)]),
        201: ("see +1 (988) 555-2485 12.44.35.254 x", [("phone", "+1 (988) 555-2485")]),
        202: ("konto iban DE89370400440532013000 bank", [("iban", "DE89370400440532013000")]),
        203: ("contact jane.doe [at] example [dot] com now", [("email", "jane.doe [at] example [dot] com")]),
        204: ("signed by Dr Maria Keller on", [("name", "Maria Keller")]),
        205: (f"token=a{CARD}f and id {BAD_CARD}12345678", []),
        206: ("iban DE89370400440532013001 version 1.2.3.4.5", []),
        207: ("", []),
    }
    rows = [(i, t, "old") for i, t in enumerate(texts)]
    rows += [(i, t, "old") for i, (t, _) in planted.items()] + [(208, None, "old"), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(3)
    got = personal.find_personal_data(docs, ["doc_id", "spans"])
    assert got.columns == ["doc_id", "spans"]
    return planted, {r.doc_id: r.spans for r in got.collect()}, dict((i, t) for i, t, _ in rows)


def test_what_the_base_rules_miss_is_added(found):
    planted, got, _ = found
    for i, (text, want) in planted.items():
        added = [(s.kind, text[s.start : s.end]) for s in got[i] if not s.base]
        assert added == want, text


def test_base_spans_stay_and_clean_texts_get_none(found):
    _, got, texts = found
    for i, text in texts.items():
        base = [(s.kind, s.start, s.end) for s in got[i] if s.base]
        assert base == [(personal.KINDS[k], a, b) for k, a, b in plain_base(text or "")]
        order = [(personal.KINDS.index(s.kind), s.start) for s in got[i]]
        assert order == sorted(order)
        if i is not None and i < 200 and (i % 2 or i >= 120):
            assert got[i] == []
    assert got[None] == [] and got[208] == []


def test_query_against_one_process(spark, sf_dir):
    """Base columns by the stated rules; all spans by training on all rows in one process."""
    docs = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    all_of = {i: personal._candidates_of(t) for i, t in docs.items()}
    patterns = {}
    for c in (c for spans in all_of.values() for c in spans):
        kind = patterns.setdefault(c["kind"], {})
        kind[c["votes"]] = kind.get(c["votes"], 0) + 1
    labelers = {k: personal.reliabilities(p) for k, p in patterns.items()}
    rows = personal.op12_personal_data(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        base = plain_base(docs[r.doc_id])
        listed = [f"{personal.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        numbers = [sum(k == kind for k, _, _ in base) for kind in range(4)]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == numbers
        spans = r.spans.split(",") if r.spans else []
        assert set(listed) <= set(spans)
        for c in all_of[r.doc_id]:  # the classifier moves odds by less than the votes do
            odds = labelers[c["kind"]].odds(c["votes"])
            name = f"{personal.KINDS[c['kind']]}:{c['start']}:{c['end']}"
            if odds < -7:
                assert c["base"] or name not in spans


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert personal.find_personal_data(docs, ["doc_id"]).collect() == []
