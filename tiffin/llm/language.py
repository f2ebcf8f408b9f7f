"""Language identification by multilingual mixture inference.

Each language has character n-gram probabilities, learned from labelled texts. A document is a
mixture: the probability of one of its n-grams is sum_l share_l * p_l(n-gram), and expectation
maximisation estimates the shares. The set of languages is grown from the best single one: the
language that raises the likelihood most is added while the gain in log-likelihood exceeds a
penalty of `PENALTY` * log(number of n-grams). The mixture's log-likelihood is concave in the
shares, so its slope towards a language bounds what adding it can gain; languages whose bound is
below the penalty are not tried.

N-grams are the trigrams of the lower-cased letters of a text, with one blank for each run of other
characters, counted in `BUCKETS` hash buckets. So the model is a languages x buckets table whatever
the corpus is; every labelled document is counted, in the tasks, and only bucket counts are shuffled.

Defined results: a null text and one without letters has language `und` and score 0. Null texts and
null languages teach nothing; without any labelled text every document is `und`. A null doc_id is
neither held out nor learned from. Repeated rows count as often as they occur and get equal
results. Ties go to the first language by name. An empty table gives no rows. Other columns of the
input take no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.common import table, utf8

UNDETERMINED = "und"
BUCKETS = 1 << 13
SMOOTHING = 0.5
#: Log-likelihood that one more language must gain, in units of log(number of n-grams). Repeated
#: words make n-grams depend on each other, so this is above the 1/2 of independent draws.
PENALTY = 3.0
MAX_STEPS = 60
TOLERANCE = 1e-4
_BLANK = 0x20
_MAYBE_LETTER = re.compile(r"[^\W\d_]")
_CHUNK = 1 << 20  # characters of a text that are folded at a time


def has_letter(text: str) -> bool:
    """Whether a character is a letter; the pattern also finds numbers such as fractions."""
    return any(m.group().isalpha() for m in _MAYBE_LETTER.finditer(text))


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, a blank for each run of other characters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    # Combining marks and scripts beyond Latin count as letters; ASCII is what needs a table.
    keep = (codes - np.uint32(0x61) < 26) | (codes >= 0xC0) | (codes == 0xAA) | (codes == 0xBA)
    codes = np.where(keep, codes, np.uint32(_BLANK))
    repeated = np.zeros(len(codes), dtype=bool)
    repeated[1:] = ~keep[1:] & ~keep[:-1]
    return codes[~repeated]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's trigrams, in order, and their counts."""
    total, tail = np.zeros(BUCKETS, dtype=np.int64), np.array([_BLANK, _BLANK], dtype=np.uint32)
    for start in range(0, len(text), _CHUNK):
        codes = np.concatenate([tail, _letters(text[start : start + _CHUNK])]).astype(np.uint32)
        key = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA6B)
        key = (key + codes[2:]) * np.uint32(0xC2B2AE35)
        total += np.bincount(key >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
        tail = codes[-2:]
    found = np.flatnonzero(total)
    return found, total[found]


@dataclass
class LanguageModel:
    languages: list[str]
    probability: np.ndarray  # buckets x languages

    @classmethod
    def of_counts(cls, languages: list[str], counts: np.ndarray) -> LanguageModel:
        smooth = counts + SMOOTHING
        return cls(languages, smooth / smooth.sum(axis=0))

    def shares(self, text: str) -> np.ndarray | None:
        """The share of each language, in the order of `languages`; None without letters."""
        if not self.languages or not has_letter(text):
            return None
        buckets, counts = grams(text)
        return mixture(self.probability[buckets], counts.astype(np.float64))


def _fit(p: np.ndarray, counts: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, float]:
    """Expectation maximisation of the shares of the columns of `p`; the log-likelihood."""
    total, before = counts.sum(), -np.inf
    for _ in range(MAX_STEPS):
        mix = p @ shares
        value = counts @ np.log(mix)
        if value - before < TOLERANCE * max(1.0, np.log(total)):
            break
        before = value
        shares = shares * ((counts / mix) @ p) / total
    return shares, float(value)


def mixture(p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Shares of all columns of `p` (n-grams x languages); those outside the chosen set are 0."""
    total = counts.sum()
    single = counts @ np.log(p)
    chosen = [int(np.argmax(single))]
    shares, value = np.ones(1), float(single[chosen[0]])
    price = PENALTY * np.log(max(total, 2.0))
    while len(chosen) < p.shape[1]:
        slope = (counts / (p[:, chosen] @ shares)) @ p - total
        tried = [l for l in range(p.shape[1]) if l not in chosen and slope[l] > price]
        best = None
        for l in tried:
            start = np.append(shares * 0.9, 0.1)
            found = _fit(p[:, [*chosen, l]], counts, start)
            if best is None or found[1] > best[2]:
                best = (l, *found)
        if best is None or best[2] - value <= price:
            break
        chosen.append(best[0])
        shares, value = best[1], best[2]
    out = np.zeros(p.shape[1])
    out[chosen] = shares / shares.sum()
    return out


def _texts(column: pa.Array) -> Iterator[str]:
    return (t.as_buffer().to_pybytes().decode("utf-8", "replace") for t in column)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """A model from all rows of `docs` with a text and a language. Tasks count the n-grams of
    their own rows; the driver gets languages x buckets numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), strict=True):
                if has_letter(text):
                    buckets, n = grams(text)
                    counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))[buckets] += n
        for lang, n in counts.items():
            found = np.flatnonzero(n)
            arrays = [pa.array([lang] * len(found)), pa.array(found), pa.array(n[found])]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "bucket", "n"])

    labelled = docs.where(docs[lang_col].isNotNull() & docs[text_col].isNotNull())
    rows = labelled.select(docs[lang_col].cast("string").alias("lang"), utf8(docs[text_col]).alias("t"))
    sums = rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket")
    # One row per language, so that the driver's share is small and its order is certain.
    found = (
        sums.agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("n"))
        .orderBy("lang")
        .collect()
    )
    counts = np.zeros((BUCKETS, len(found)))
    for l, row in enumerate(found):
        counts[list(row.n), l] = list(row.n.values())
    return LanguageModel.of_counts([row.lang for row in found], counts)


def predict(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", lang: str = "lang_pred",
    score: str = "score", shares: str = "lang_shares",
) -> DataFrame:
    """`docs` with three columns more: the main language, its share, and all shares above 0 as a
    map. The model has a fixed size, so each task gets a copy."""

    @F.pandas_udf("lang string, score double, shares map<string, double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            found = model.shares(text.decode("utf-8", "replace"))
            if found is None:
                rows.append((UNDETERMINED, 0.0, {}))
                continue
            main = int(np.argmax(found))
            kept = {model.languages[l]: float(found[l]) for l in np.flatnonzero(found)}
            rows.append((model.languages[main], min(1.0, float(found[main])), kept))
        return pd.DataFrame(rows, columns=["lang", "score", "shares"])

    found = docs.withColumn("__lang_found", run(utf8(docs[text_col])))
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in (lang, score, shares)]
    return found.select(
        *columns,
        F.col("__lang_found.lang").alias(lang),
        F.col("__lang_found.score").alias(score),
        F.col("__lang_found.shares").alias(shares),
    )


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(docs["doc_id"])
    model = train(docs.where(~out))
    found = predict(docs.select("doc_id", "text", F.coalesce(out, F.lit(False)).alias("held_out")), model)
    return found.drop("text")
