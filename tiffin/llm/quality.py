"""Quality rules: counts over words and lines, and compression bands.

Text that repeats itself compresses too well, and random or encoded text hardly at all. The ratio of
a text's UTF-8 bytes to its zstandard frame is compared with a band for texts of that length (short
texts carry the frame's overhead and cannot repeat much). The same is done for fixed chunks of the
text, so that a long text is also judged by its parts: it fails when more than `MAX_BAD_CHUNKS` of
its bytes lie in chunks outside the chunk band. The rest of a text longer than a chunk is judged by the
chunk that ends where the text does. A text of less than a chunk is judged as a whole.

The limits are a parameter. The query takes those set with the labels of its corpus (`LABELLED`).

Words are runs of characters other than \\x20 and \\x09-\\x0D. A text also fails with fewer than
MIN_WORDS words, or when over MAX_REPEAT_PERCENT of its words lie in windows of three words that
occur at least twice.

Defined results: a null or empty text has no words, ratio 1 and fails. Each row is judged on its
own, so repeated rows, null ids and other columns of any name do not matter, and an empty table gives
no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.common import table, utf8

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
LEVEL = 3
CHUNK_BYTES = 4096
MAX_BAD_CHUNKS = 0.25


@dataclass(frozen=True)
class Limits:
    """`bands`: texts of up to so many bytes, and the least and largest ratio of them; `chunk`: the least and largest
    ratio of a chunk."""

    bands: tuple[tuple[int | None, float, float], ...]
    chunk: tuple[float, float]

    def band(self, size: int) -> tuple[float, float]:
        return next((low, high) for most, low, high in self.bands if most is None or size <= most)


#: For any prose. The least lies between what base64 and random letters and digits reach at that length and the
#: least of clean prose, the largest between clean prose and prose of which half is one phrase again and again.
GENERAL = Limits(
    (
        (256, 1.15, 2.0),
        (512, 1.25, 2.2),
        (1024, 1.35, 2.5),
        (2048, 1.5, 2.8),
        (4096, 1.7, 2.9),
        (8192, 1.85, 3.1),
        (16384, 1.85, 3.2),
        (None, 1.85, 3.4),
    ),
    (1.75, 3.0),
)
#: For the corpus of the query, set with its labels: the largest lies above every text labelled good, by 0.06 or so,
#: and below the median of those labelled poor from 1 kB on; shorter texts of the two kinds do not differ enough.
LABELLED = Limits(
    (
        (256, 1.15, 2.0),
        (512, 1.25, 2.0),
        (1024, 1.35, 2.06),
        (2048, 1.5, 2.23),
        (4096, 1.7, 2.3),
        (8192, 1.85, 2.42),
        (16384, 1.85, 2.49),
        (32768, 1.85, 2.56),
        (65536, 1.85, 2.64),
        (None, 1.85, 2.7),
    ),
    (1.75, 2.4),
)


def compression(raw: bytes, limits: Limits = GENERAL) -> tuple[float, float]:
    """The ratio of the whole text; the share of its bytes in chunks outside the chunk band."""
    if not raw:
        return 1.0, 0.0
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    bad = 0
    for start in range(0, len(raw) if len(raw) >= CHUNK_BYTES else 0, CHUNK_BYTES):
        end = min(start + CHUNK_BYTES, len(raw))
        ratio = CHUNK_BYTES / len(compressor.compress(raw[end - CHUNK_BYTES : end]))
        if not limits.chunk[0] <= ratio <= limits.chunk[1]:
            bad += end - start
    return len(raw) / len(compressor.compress(raw)), bad / len(raw)


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of `width` words found at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number = {w: i for i, w in enumerate(set(words))}
    ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
    key = ids[:n]
    for k in range(1, width):  # renumbered each time, so that keys stay small and exact
        key = np.unique(key * len(number) + ids[k : k + n], return_inverse=True)[1]
    again = np.bincount(key)[key] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(width):
        covered[k : k + n] |= again
    return int(covered.sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in raw.split(b"\n") if line.strip(WHITE)]
    return len(lines) - len(set(lines))


def measure(raw: bytes, limits: Limits = GENERAL) -> tuple:
    words = raw.split()
    inner = b"".join(words)
    # Code points: bytes that do not continue a character.
    characters = int((np.frombuffer(inner, dtype=np.int8) >= -64).sum())
    ratio, bad_chunks = compression(raw, limits)
    return (
        len(words),
        characters,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        duplicate_lines(raw),
        repeated_words(words),
        len(raw),
        ratio,
        bad_chunks,
    )


_COLUMNS = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "n_bytes": "long",
    "ratio": "double",
    "bad_chunks": "double",
}


def quality(docs: DataFrame, text_col: str = "text", prefix: str = "", limits: Limits = GENERAL) -> DataFrame:
    """`docs` with the measures, base_failed, compression_failed and kept; columns of `docs` with
    one of these names are replaced, unless `prefix` tells them apart."""

    @F.pandas_udf(", ".join(f"{name} {kind}" for name, kind in _COLUMNS.items()))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t, limits) for t in texts], columns=list(_COLUMNS))

    m = F.col("__quality")
    low, high = (
        F.coalesce(
            *[F.when(m["n_bytes"] <= b[0], b[side]) for b in limits.bands[:-1]], F.lit(limits.bands[-1][side])
        )
        for side in (1, 2)
    )
    base = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    compressed = ~m["ratio"].between(low, high) | (m["bad_chunks"] > MAX_BAD_CHUNKS)
    new = {name: m[name] for name in _COLUMNS}
    new |= {"base_failed": base, "compression_failed": compressed, "kept": ~base & ~compressed}
    new = {prefix + name: column for name, column in new.items()}
    old = [F.col(f"`{c}`") for c in docs.columns if c not in new]
    found = docs.withColumn("__quality", run(utf8(docs[text_col])))
    return found.select(*old, *[column.alias(name) for name, column in new.items()])


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality(docs, limits=LABELLED).drop("text")
