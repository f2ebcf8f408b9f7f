import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tiffin.llm import warc

SCHEMA = "page_id long, url string, html string"
END = "\r\n\r\n"
ROWS = [
    (1, "http://a.example/x?y=1#z", "<p>one</p>"),
    (9, "http://b.example", "<p>one</p>"),
    (5, None, "<p>one</p>"),
    (2, "http://c.example/\r\nWARC/1.1 evil", f"{END}WARC/1.1{END}{END}"),
    (3, "no scheme", None),
    (4, "http://d.example/é", ""),
    (6, "http://e.example/", f"x{END}"),
    (7, "http://e.example/", f"\r\r\n\r\n\n{END[:2]}"),
    (8, "http://e.example/", "🙂é" * 50_000),
    (10, "http://f.example/", "\r\n"),
    (11, "http://f.example/", "ends\r\n\r"),
    (None, "http://n.example/", "no id"),
    (12, "http://r.example/1", "repeated"),
    (12, "http://r.example/1", "repeated"),
    (12, "http://r.example/0", "repeated"),
    (12, "http://r.example/0", "another payload"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def captures(spark, rows, path, **options):
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    warc.write_warc(pages.withColumns({c: F.lit("x") for c in ("bytes", "sha", "top", "copy")}), path, **options)
    return warc.assemble(warc.read_warc(spark, path)).collect()


def plain(rows, least=0):
    top = {}
    for i, _, h in rows:
        top[h or ""] = max((x for x in (top.get(h or ""), i) if x is not None), default=None)
    out, seen = [], set()
    for i, u, h in sorted(rows, key=lambda r: r[1] or ""):
        h = h or ""
        response = len(h.encode()) < least or (top[h] == i and h not in seen)
        if top[h] == i:
            seen.add(h)
        out.append((i, len(h.encode()), digest(h), "response" if response else "revisit",
                    None if response else top[h]))
    return sorted(out, key=repr)


def seen(found):
    number = lambda x: None if x in (None, "null") else int(x)
    return sorted(
        (
            (number(r.metadata.fields["page-id"]), r.response.payload_bytes, r.response.payload_digest,
             r.response.type, number(r.response.refers_to.split(":")[3]) if r.response.refers_to else None)
            for r in found
        ),
        key=repr,
    )


@pytest.mark.parametrize("least", [0, 9])
def test_round_trip(spark, tmp_path, least):
    found = captures(spark, ROWS, str(tmp_path / "w"), min_bytes=least)
    assert seen(found) == plain(ROWS, least)
    payloads = sorted(r.response.payload.decode() for r in found if r.response.type == "response")
    html = sorted(h or "" for _, _, h in ROWS)
    assert set(payloads) == set(html)
    assert len({r.capture_id for r in found}) == len(ROWS)
    assert all(r.request.http.startswith("GET /") for r in found)
    by_id = {r.capture_id: r for r in found}
    for r in found:
        if r.response.type == "revisit":
            assert by_id[r.response.refers_to].response.payload_digest == r.response.payload_digest


def test_archives_follow_the_format(spark, tmp_path):
    captures(spark, ROWS, str(tmp_path / "w"))
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("*.gz"))
    n = 0
    while raw:
        head, raw = raw.split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\n")
        size = int(dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])[b"Content-Length"])
        assert raw[size : size + 4] == b"\r\n\r\n"
        raw, n = raw[size + 4 :], n + 1
    assert n == 3 * len(ROWS)


def test_parser_takes_pieces_of_any_size():
    random.seed(2)
    blocks = [END, "a" + END, "", "WARC/1.1" + END, "\r\n", "\r\n\r", "z" * 99]
    raw = "".join(f"WARC/1.1\r\nContent-Length: {len(b)}{END}{b}{END}" for b in blocks).encode()
    for _ in range(50):
        parser, at, found = warc.Parser(), 0, []
        while at < len(raw):
            step = random.randint(1, 40)
            found += [block.decode() for _, block in parser.feed(raw[at : at + step])]
            at += step
        parser.close()
        assert found == blocks
    broken = warc.Parser()
    list(broken.feed(raw[:-120]))
    with pytest.raises(ValueError):
        broken.close()


def test_lone_records(spark):
    schema = "record_id string, type string, concurrent_to string, refers_to string, target_uri string, http string, payload binary, payload_bytes long, payload_digest string, fields map<string,string>"
    rows = [("a", "response", None, None, "u", "h", b"", 0, "d", None), ("b", "request", "zz", None, "u", "h", b"", None, None, None)]
    found = warc.assemble(spark.createDataFrame(rows, schema)).collect()
    assert [(r.capture_id, r.request, r.metadata) for r in found] == [("a", None, None)]


def test_empty(spark, tmp_path):
    assert captures(spark, [], str(tmp_path / "w")) == []


def test_query_matches_plain_form(spark, sf_dir):
    found = warc.op6_warc(spark, sf_dir).collect()
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r)[:5] for r in found), key=repr) == plain(pages)


def test_reading_some_types_gives_the_same_captures(spark, tmp_path):
    pages = [(i, f"http://h/{i}", f"<p>{i % 3}\r\n\r\n</p>") for i in range(9)]
    path = str(tmp_path / "some")
    warc.write_warc(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    whole = warc.read_warc(spark, path)
    parts = [warc.read_warc(spark, path, kind) for kind in (("response", "revisit"), ("request",), ("metadata",))]
    for part, kinds in zip(parts, ({"response", "revisit"}, {"request"}, {"metadata"})):
        assert {r.type for r in part.select("type").collect()} == kinds
    want = sorted(map(repr, warc.assemble(whole).collect()))
    assert sorted(map(repr, warc.assemble(*parts).collect())) == want and len(want) == 9


def test_query_reads_its_archive_once_and_leaves_payloads_there(spark, sf_dir, tmp_path):
    text = warc.op6_warc(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("MapInArrow") == 1
    pages = [(1, "http://h/1", "<p>é</p>"), (2, "http://h/2", "")]
    path = str(tmp_path / "bare")
    warc.write_warc(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    found = warc.read_warc(spark, path, payloads=False).where("type = 'response'").collect()
    assert sorted((r.payload, r.payload_bytes, r.payload_digest) for r in found) == sorted(
        (None, len(h.encode()), digest(h)) for _, _, h in pages
    )


def test_records_that_repeat_or_name_no_capture(spark):
    schema = "record_id string, type string, concurrent_to string, refers_to string, target_uri string, http string, payload binary, payload_bytes long, payload_digest string, fields map<string,string>"
    row = lambda i, kind, to: (i, kind, to, None, "u", "h", None, None, None, None)
    rows = [row("a", "response", "x"), row("x", "request", "a"), row("y", "request", "a"), row("m", "metadata", "a"),
            row(None, "revisit", None), row("z", "request", None), row("w", "warcinfo", "a")]
    found = warc.assemble(spark.createDataFrame(rows, schema)).collect()
    got = sorted(((r.capture_id, r.request and r.request.record_id, r.metadata and r.metadata.record_id) for r in found), key=repr)
    assert got == [("a", "x", "m"), ("a", "y", "m"), (None, None, None)]
