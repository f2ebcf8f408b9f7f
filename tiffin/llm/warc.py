"""WARC archives: pages out, transactions in.

Writing. Every page becomes three records - request, response or revisit, metadata - and request and
metadata name the second in WARC-Concurrent-To. Of the pages with equal payloads of at least
`min_bytes`, the one with the largest page_id is the response and the others are revisits that
refer to it; payloads are equal when SHA-256 and length are. A record ends with two line breaks, so
Spark's text writer with that separator writes valid archives to any file system, with its commit
protocol: a lost executor leaves no half-written file.

Reading. A task reads the files of its split piece by piece at the same separator and glues the
pieces together again; records are cut by their Content-Length, so payloads may hold anything, and one
record is in memory at a time. Payload digests are computed anew and must agree with the header.

Assembly. Requests and metadata meet their response or revisit through the concurrent-to identifiers, in
one grouping of one reading, giving one nested row per capture.

Defined results: a null html is an empty payload; a null url an empty target. Null page_ids are
smaller than any other. Rows that repeat page_id and payload are captures of their own, of which the
first by url is the response if any is. A capture without request or metadata has a null there. An
empty table gives an archive without records and no rows. Other columns of the input take no part.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Collection, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiffin.llm.common import shared_path, table

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
LINE, RECORD_END = "\r\n", "\r\n\r\n"
_HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of `payload` in upper-case base 32: five hexadecimal digits at a time are four."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _HEX32, _BASE32)


def captures(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Per row of `pages` (page_id, url, html): page_id, url, html, bytes, digest, copy, keep_id
    (the response's page_id where the row is a revisit, else null) and revisit."""
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    # A line break in a url would end its header.
    url = F.regexp_replace(F.coalesce(pages["url"].cast("string"), F.lit("")), r"[\x00-\x20\x7f]", "%20")
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), url.alias("url"), html.alias("html"))
    # The id as a key that is never null: join and window then share one shuffle of the payloads.
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    size = F.octet_length("html").cast("long")
    rows = rows.withColumns({"key": key, "bytes": size, "sha": F.sha2("html", 256)})
    # Small rows only: which page of each payload is the response.
    keys = rows.groupBy("key", "sha", "bytes").agg(F.max("page_id").alias("id"))
    top = keys.groupBy("sha", "bytes").agg(F.max("id").alias("top"))
    chosen = keys.join(top, ["sha", "bytes"]).select("key", "sha", "top")
    copy = F.row_number().over(Window.partitionBy("key", "sha").orderBy("url"))
    first = F.col("page_id").eqNullSafe(F.col("top")) & (F.col("copy") == 1)
    return (
        rows.join(chosen, ["key", "sha"])
        .withColumn("copy", copy)
        .withColumn("revisit", ~first & (F.col("bytes") >= min_bytes))
        .select(
            "page_id", "url", "html", "bytes", base32_sha1(F.col("html")).alias("digest"), "copy",
            F.col("top").alias("top_id"), "revisit",
        )
    )


def _lines(*lines: Column | str) -> Column:
    return F.concat(*[F.concat(x if isinstance(x, Column) else F.lit(x), F.lit(LINE)) for x in lines])


def _named(name: str, *value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), *[v if isinstance(v, Column) else F.lit(v) for v in value])


def records(found: DataFrame) -> DataFrame:
    """The three WARC records of each capture, without their record ends: one column, `value`."""
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))

    def urn(role: str, page: Column = page, copy: Column = F.col("copy")) -> Column:
        """Unique: the payload's digest tells pages apart that share an id."""
        return F.concat(F.lit(f"<urn:capture:{role}:"), page, F.lit(":"), F.col("digest"), F.lit(":"), copy.cast("string"), F.lit(">"))

    def record(kind: Column | str, role: str, media: str, block: Column, *more: Column) -> Column:
        head = _lines(
            VERSION,
            _named("WARC-Type", kind),
            _named("WARC-Record-ID", urn(role)),
            _named("WARC-Date", DATE),
            _named("WARC-Target-URI", F.col("url")),
            _named("Content-Type", media),
        )
        length = _named("Content-Length", F.octet_length(block).cast("string"))
        return F.concat(head, *more, _lines(length, ""), block)

    concurrent = _lines(_named("WARC-Concurrent-To", urn("response")))
    path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    request = _lines(
        F.concat(F.lit("GET "), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)), F.lit(" HTTP/1.1")),
        _named("Host", host),
        "",
    )
    http = _lines(
        "HTTP/1.1 200 OK",
        "Content-Type: text/html; charset=utf-8",
        _named("Content-Length", F.col("bytes").cast("string")),
        "",
    )
    digest = _lines(_named("WARC-Payload-Digest", "sha1:", F.col("digest")))
    top = F.coalesce(F.col("top_id").cast("string"), F.lit("null"))
    revisit = _lines(
        _named("WARC-Profile", PROFILE),
        _named("WARC-Refers-To", urn("response", top, F.lit(1))),
    )
    metadata = _lines(_named("page-id", page))
    three = F.array(
        record("request", "request", "application/http; msgtype=request", request, concurrent),
        record(
            F.when(F.col("revisit"), "revisit").otherwise("response"),
            "response",
            "application/http; msgtype=response",
            F.concat(http, F.when(F.col("revisit"), "").otherwise(F.col("html"))),
            digest,
            F.when(F.col("revisit"), revisit).otherwise(F.lit("")),
        ),
        record("metadata", "metadata", "application/warc-fields", metadata, concurrent),
    )
    return found.select(F.explode(three).alias("value"))


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Compressed archives under `path`."""
    found = records(captures(pages, min_bytes))
    found.write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


class Parser:
    """Records of one archive, fed in pieces."""

    def __init__(self):
        self.held = bytearray()
        self.head: dict[str, str] | None = None

    def feed(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.held += piece
        while True:
            if self.head is None:
                while self.held.startswith(b"\r\n"):  # what separates records
                    del self.held[:2]
                end = self.held.find(b"\r\n\r\n")
                if end < 0:
                    return
                lines = bytes(self.held[:end]).decode("utf-8", "replace").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
                pairs = (line.partition(":") for line in lines[1:])
                self.head = {name.strip().lower(): value.strip() for name, _, value in pairs}
                del self.held[: end + 4]
            size = int(self.head["content-length"])
            if len(self.held) < size:
                return
            block, head = bytes(self.held[:size]), self.head
            del self.held[:size]
            self.head = None
            yield head, block

    def close(self) -> None:
        if self.head is not None or bytes(self.held).strip(b"\r\n"):
            raise ValueError("the archive ends inside a record")


_RECORD = pa.schema(
    [
        ("record_id", pa.string()),
        ("type", pa.string()),
        ("concurrent_to", pa.string()),
        ("refers_to", pa.string()),
        ("target_uri", pa.string()),
        ("http", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())),
    ]
)


def _http(block: bytes) -> tuple[str, bytes]:
    head, found, payload = block.partition(b"\r\n\r\n")
    return head.decode("utf-8", "replace"), payload if found else b""


def _field_lines(text: str) -> list[tuple[str, str]]:
    parts = (line.partition(":") for line in text.split("\r\n") if ":" in line)
    return [(name.strip().lower(), value.strip()) for name, _, value in parts]


def _row(head: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind, http, payload, size, digest, fields = head.get("warc-type"), None, None, None, None, None
    if kind in ("request", "response", "revisit"):
        http, payload = _http(block)
    written = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response":
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if written and written != digest:
            raise ValueError(f"{head.get('warc-record-id')}: the payload does not match its digest")
        payload = payload if payloads else None
    elif kind == "revisit":  # its payload is that of the response; length and digest are kept
        payload, digest = None, written
        size = next((int(v) for k, v in _field_lines(http) if k == "content-length"), None)
    elif kind == "metadata":
        fields = dict(_field_lines(block.decode("utf-8", "replace")))
        fields = list(fields.items())
    return (
        head.get("warc-record-id"), kind, head.get("warc-concurrent-to"), head.get("warc-refers-to"),
        head.get("warc-target-uri"), http, payload, size, digest, fields,
    )


def read_warc(
    spark: SparkSession, path: str, types: Collection[str] | None = None, payloads: bool = True
) -> DataFrame:
    """One row per record of the archives under `path`, or of those of some WARC-Types; others are cut
    by their length and not looked into. Without `payloads` a response's is measured, hashed and compared
    with its header all the same, but null in the row."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, _RECORD, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=_RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, parser, rows, size = None, None, [], 0
        for pieces in batches:
            for value, name in zip(pieces.column(0), pieces.column(1).to_pylist(), strict=True):
                if name != file:
                    if parser:
                        parser.close()
                    file, parser = name, Parser()
                for head, block in parser.feed(value.as_buffer().to_pybytes() + b"\r\n\r\n"):
                    if types is not None and head.get("warc-type") not in types:
                        continue
                    rows.append(_row(head, block, payloads))
                    size += len(block)
                    if size > 8 << 20 or len(rows) >= 4096:
                        yield batch(rows)
                        rows, size = [], 0
        if parser:
            parser.close()
        if rows:
            yield batch(rows)

    # Compressed archives are not split, so a file's pieces come in order, in one task.
    pieces = spark.read.option("lineSep", RECORD_END).text(path)
    pieces = pieces.select(F.col("value").cast("binary"), F.input_file_name().alias("file"))
    layout = (
        "record_id string, type string, concurrent_to string, refers_to string, target_uri string,"
        " http string, payload binary, payload_bytes long, payload_digest string,"
        " fields map<string, string>"
    )
    return pieces.mapInArrow(run, layout)


def assemble(found: DataFrame, requests: DataFrame | None = None, metadata: DataFrame | None = None) -> DataFrame:
    """One row per capture of `found` (read_warc): capture_id, and the structs response (a response
    or revisit record), request and metadata; these two from readings of their own if given."""
    kinds = {
        "response": (found, ["response", "revisit"], "record_id",
                     ["type", "target_uri", "refers_to", "http", "payload", "payload_bytes", "payload_digest"]),
        "request": (found if requests is None else requests, ["request"], "concurrent_to", ["record_id", "target_uri", "http"]),
        "metadata": (found if metadata is None else metadata, ["metadata"], "concurrent_to", ["record_id", "fields"]),
    }
    wanted: dict[int, tuple[DataFrame, Column]] = {}  # per reading
    capture = F.lit(None).cast("string")
    for reading, types, key, _ in kinds.values():
        # What names no capture has none; a response without an id is a capture of its own.
        here = F.col("type").isin(types) & (F.col(key).isNotNull() | F.lit(key == "record_id"))
        capture = F.when(F.col("type").isin(types), F.col(key)).otherwise(capture)
        _, others = wanted.get(id(reading), (reading, F.lit(False)))
        wanted[id(reading)] = reading, others | here
    rows = reduce(DataFrame.unionByName, [reading.where(here) for reading, here in wanted.values()])
    lists = [
        F.collect_list(F.when(F.col("type").isin(types), F.struct(*columns))).alias(name)
        for name, (_, types, _, columns) in kinds.items()
    ]
    rows = rows.withColumn("capture_id", capture).groupBy("capture_id").agg(*lists).where(F.size("response") > 0)
    rows = rows.withColumn("response", F.explode("response"))
    for name in ("request", "metadata"):
        rows = rows.withColumn(name, F.explode_outer(name))
    return rows


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return assemble(read_warc(spark, path, payloads=False)).select(
        F.col("metadata.fields")["page-id"].try_cast("long").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.split("response.refers_to", ":")[3].try_cast("long").alias("refers_to"),
        F.col("response.target_uri").alias("target_uri"),
        F.col("request.http").startswith("GET ").alias("has_request"),
    )


OP6_SQL = """
WITH base AS (
  SELECT page_id, url, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS hex FROM pages
), coded AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS top,
    list_transform(range(8), lambda i: ('0x' || substr(hex, (5 * i + 1)::BIGINT, 5))::BIGINT) AS parts
  FROM base
)
SELECT page_id, strlen(h) AS payload_bytes,
  list_aggregate(flatten(list_transform(parts, lambda p: list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((p >> s) & 31) + 1, 1)))), 'string_agg', '')
    AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to,
  regexp_replace(coalesce(url, ''), '[\\x00-\\x20\\x7f]', '%20', 'g') AS target_uri,
  true AS has_request
FROM coded
"""
