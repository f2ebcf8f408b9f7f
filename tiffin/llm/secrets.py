"""Secret scan: keyword prefilter, anchored patterns near hits, embedded checksums.

1. One Aho-Corasick automaton finds every keyword of every kind in one pass over the text. Keywords
   that may be in either case are searched in a copy with A-Z lower-cased. A run of hexadecimal
   digits has no keyword of its own; a second automaton finds the first HEX_RUN digits of a run in
   a copy that maps every such digit to one character.
2. A kind's pattern is matched only at the places the automaton names (anchored there, never
   searched), left to right and without overlaps. A match that is too short is dropped after it has
   been matched, so no shorter match starts inside it.
3. Kinds with a checksum inside the secret are kept only if it is right: access tokens whose last six
   characters are the base-62 CRC-32 of the others, extended private keys (Base58Check), and
   Bech32-coded secret keys. So a look-alike costs nothing and is no finding.

Spans are code points, end exclusive. Spans of different kinds may overlap.

Defined results: a null or empty text has no spans. Whole texts are scanned, whatever their length.
Each row is scanned on its own, so repeated rows, null ids and other columns of any name do not
matter, and an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.common import LOWER, UPPER, table

HEX_RUN = 16
_FOLD = str.maketrans(UPPER, LOWER)
_HEX = "0123456789abcdef"
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"


def crc_token(secret: str) -> bool:
    """prefix_ and 36 characters, the last six the base-62 CRC-32 of the thirty before."""
    body = secret[secret.index("_") + 1 :]
    value, digits = zlib.crc32(body[:30].encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = _BASE62[digit] + digits
    return body[30:] == digits


def base58_check(secret: str) -> bool:
    """The last four bytes are those of the double SHA-256 of the others."""
    value = 0
    for c in secret:
        value = value * 58 + _BASE58.index(c)
    raw = value.to_bytes(82, "big") if value < 1 << 656 else b""
    again = hashlib.sha256(hashlib.sha256(raw[:78]).digest()).digest()
    return len(raw) == 82 and raw[78:] == again[:4]


def bech32(secret: str) -> bool:
    """The polynomial checksum of BIP 173 over prefix and data."""
    prefix, data = secret.lower().rsplit("1", 1)
    values = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix]
    values += [_BECH32.index(c) for c in data]
    check = 1
    for v in values:
        top, check = check >> 25, (check & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)):
            check ^= g if top >> i & 1 else 0
    return check == 1


@dataclass(frozen=True)
class Kind:
    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    folded: bool = False  # keywords in either case
    group: int = 0  # the part that must be long enough
    least: int = 1
    valid: Callable[[str], bool] | None = None


#: In the order of the output. The first three are the base kinds.
KINDS = (
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "api_key", "apikey"),
        re.compile(
            r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
            r"([A-Za-z0-9+/_.=-]+)",
            re.ASCII,
        ),
        folded=True,
        group=1,
        least=12,
    ),
    Kind("access", ("AKIA",), re.compile(r"AKIA[A-Z0-9]+"), least=18),
    Kind("hex", (), re.compile(r"[0-9a-f]+"), least=HEX_RUN),
    Kind(
        "crc_token",
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
        re.compile(r"(?:gh[pousr]|npm)_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
        valid=crc_token,
    ),
    Kind("extended_key", ("xprv",), re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![A-Za-z0-9])"), valid=base58_check),
    Kind(
        "bech32_key",
        ("AGE-SECRET-KEY-1",),
        re.compile(r"AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}(?![A-Za-z0-9])"),
        valid=bech32,
    ),
)
_HEX_KIND = 2


class Scanner:
    """Spans of the kinds in a text: (kind number, start, end)."""

    def __init__(self):
        self.exact, self.folded, self.runs = (ahocorasick.Automaton() for _ in range(3))
        for number, kind in enumerate(KINDS):
            for keyword in kind.keywords:
                (self.folded if kind.folded else self.exact).add_word(keyword, (number, len(keyword)))
        self.runs.add_word("h" * HEX_RUN, HEX_RUN)
        for automaton in (self.exact, self.folded, self.runs):
            automaton.make_automaton()
        self.hex = {ord(c): "h" for c in _HEX} | {ord("h"): " "}

    def hits(self, text: str) -> Iterator[tuple[int, int]]:
        """(kind, start) of the places worth a match."""
        for automaton, copy in ((self.exact, text), (self.folded, text.translate(_FOLD))):
            for last, (kind, width) in automaton.iter(copy):
                yield kind, last + 1 - width
        after = -2
        for last, width in self.runs.iter(text.translate(self.hex)):
            if last != after + 1:  # the first place of a run only
                yield _HEX_KIND, last + 1 - width
            after = last

    def __call__(self, text: str) -> list[tuple[int, int, int]]:
        spans, free = [], [0] * len(KINDS)
        for number, start in sorted(self.hits(text)):
            if start < free[number]:
                continue
            kind = KINDS[number]
            if not (m := kind.pattern.match(text, start)):
                continue
            if not kind.valid or kind.valid(m[0]):
                free[number] = m.end()
                if len(m[kind.group]) >= kind.least:
                    spans.append((number, *m.span()))
        return sorted(spans, key=lambda s: (s[1], s[0]))


_scanner: list[Scanner] = []


def _spans(text: str | None) -> list[dict]:
    if not _scanner:
        _scanner.append(Scanner())
    return [
        {"kind": KINDS[n].name, "start": a, "end": b, "secret": text[a:b]}
        for n, a, b in (_scanner[0](text) if text else ())
    ]


def find_secrets(docs: DataFrame, text_col: str = "text", to: str = "secrets") -> DataFrame:
    """`docs` with the spans of each text, by start and then kind, as an array of (kind, start, end,
    secret); an older column of that name is replaced."""

    @F.pandas_udf("array<struct<kind: string, start: long, end: long, secret: string>>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([_spans(t) for t in texts], dtype=object)

    return docs.withColumn(to, run(docs[text_col]))


def masked(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """`text` with the spans replaced; overlapping spans are replaced once."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, s: Column) -> Column:
        before = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        fresh = s["start"] >= state["at"]
        return F.struct(
            F.when(fresh, F.concat(state["out"], before, F.lit(mark))).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.char_length(text)))

    return F.when(text.isNull(), None).otherwise(F.aggregate(spans, start, step, finish))


def _listed(spans: Column) -> Column:
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(one, ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs)
    secrets = F.col("secrets")
    base = F.filter(secrets, lambda s: s["kind"].isin("assign", "access", "hex"))

    def number(kind: str) -> Column:
        return F.size(F.filter(secrets, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        number("assign"),
        number("access"),
        number("hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(secrets).alias("spans"),
    )
