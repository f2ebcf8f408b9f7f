"""Periodic runs of words, found through Lyndon roots from the first phase of Baier's suffix sorter.

A run is a stretch of words with smallest period q that no neighbouring word extends with that period, and
whose length is at least max(LEAST_LENGTH, LEAST_POWER * q). Its words after the first q are repetition.

1. **Where runs can be.** In such a run every three consecutive words occur three times or more, so the words of a
   text in no such triple are in no run. What is left are stretches, and a run with the words beside it
   lies in one of them; all of a text's words are counted for this. Other steps see these stretches only.
2. **Grouping.** `lyndon_array` is phase one of Baier's sorter: suffixes start in groups by their first word and
   groups are taken from the highest to the lowest. For each suffix of a group the nearest suffix to the left in
   a lower group is its target; targets leave their groups for new ones just above, the more often hit ones
   higher, and the words that the members of the new group share grow by the group's own for each hit. When all
   groups are done, the words that a group's members share are the longest Lyndon word at each of them. So
   the phase alone yields the Lyndon array; the suffixes are never sorted further.
3. **Roots to runs.** Each run has a root that is the longest Lyndon word at its place, either in the order of
   words or in the reversed one. So both arrays together hold a root of every run. A root at i of
   length q is extended by the longest common extensions of i and i + q to the right and to the left, computed
   for all roots at once over names of blocks of 1, 2, 4, ... words. The names are exact: equal names are equal
   blocks.

Words are the stretches between blanks and control characters 9 to 13, compared as bytes in UTF-8.

Defined results: a null or empty text has no words and no runs. Whole texts are searched, whatever their length; the
work grows like n log n in the longest stretch. Runs may overlap and nest; a word is dropped if any run drops it. The
longest run by length over period is the first by (start, period) among equals. Rows are independent, so
repeated rows, null ids, empty tables and other columns of any name do not matter.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.common import byte_slices, table

LEAST_LENGTH, LEAST_POWER = 6, 4
_FEW_NAMES = 1 << 20
_SLICE_BYTES, _SLICE_ROWS = 4 << 20, 2_000

Run = tuple[int, int, int]  # start, length, period


def lyndon_array(word: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place, by Baier's grouping of suffixes.

    `word` holds the numbers 0, 1, ... without gaps.
    """
    n = len(word)
    order = sorted(range(n), key=word.__getitem__)  # suffixes by group
    place = [0] * n  # of a suffix in `order`
    group = [0] * n  # of a suffix: where its group starts in `order`
    size, shared = [0] * n, [0] * n  # of the group that starts there
    start = 0
    for at, suffix in enumerate(order):
        if word[suffix] != word[order[start]]:
            start = at
        place[suffix], group[suffix] = at, start
        size[start] += 1
        shared[start] = 1
    lower = [-1] * n  # nearest suffix to the left in a lower group, once its group is done
    end = n
    while end:
        start = group[order[end - 1]]
        hits: dict[int, int] = {}
        members = order[start:end]
        if len(members) > 1:
            members.sort()
        for suffix in members:
            target = suffix - 1
            while target >= 0 and group[target] >= start:
                target = lower[target]
            lower[suffix] = target
            if target >= 0:
                hits[target] = hits.get(target, 0) + 1
        by_hits: dict[tuple[int, int], list[int]] = {}
        for target, count in hits.items():
            by_hits.setdefault((count, group[target]), []).append(target)
        for count, old in sorted(by_hits, reverse=True) if len(by_hits) > 1 else by_hits:
            moved = by_hits[count, old]
            new = last = old + size[old]
            for target in moved:  # to the end of their group's places
                new -= 1
                other, at = order[new], place[target]
                order[at], order[new] = other, target
                place[other], place[target] = at, new
            length = shared[old] + count * shared[start]
            size[old] -= last - new
            size[new], shared[new] = last - new, length
            for target in moved:
                group[target] = new
        end = start
    return [shared[g] for g in group]


class Extensions:
    """Longest common extensions of pairs of places, over exact names of blocks of 2^k words."""

    def __init__(self, word: np.ndarray):
        self.n, self.names = len(word), [word]
        width = 1
        while 2 * width <= self.n:
            name = self.names[-1]
            pairs = name[: self.n - 2 * width + 1] * np.int64(self.n + 1) + name[width : self.n - width + 1]
            self.names.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))
            width *= 2

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For a < b: how many words from a equal those from b."""
        same = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, width = self.names[k], 1 << k
            fits = b + same + width <= self.n
            x, y = np.where(fits, a + same, 0), np.where(fits, b + same, 0)
            same += np.where(fits & (name[x] == name[y]), width, 0)
        return same

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For a < b: how many words before a equal those before b."""
        same = np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, width = self.names[k], 1 << k
            fits = a - same - width >= 0
            x, y = np.where(fits, a - same - width, 0), np.where(fits, b - same - width, 0)
            same += np.where(fits & (name[x] == name[y]), width, 0)
        return same


def runs_of(word: np.ndarray) -> set[Run]:
    """All runs in a sequence of numbers."""
    _, word = np.unique(word, return_inverse=True)
    word = word.astype(np.int64)
    extend, found = Extensions(word), set()
    places = np.arange(len(word))
    for ordered in (word, word.max() - word):
        period = np.array(lyndon_array(ordered.tolist()))
        right = np.where(places + period < len(word), extend.right(places, places + period), 0)
        # The first root of a run starts in its first period, so it has all but two periods to its right.
        at = np.flatnonzero(right > (LEAST_POWER - 2) * period)
        period, right = period[at], right[at]
        left = extend.left(at, at + period)
        length = left + period + right
        good = length >= np.maximum(LEAST_LENGTH, LEAST_POWER * period)
        found.update(zip((at - left)[good].tolist(), length[good].tolist(), period[good].tolist()))
    return found


def stretches(word: np.ndarray) -> list[tuple[int, int]]:
    """Starts and ends of the parts in which every word is in a triple that occurs three times."""
    n = len(word)
    if n < LEAST_LENGTH:
        return []
    base = np.int64(word.max()) + 1
    pairs = word[:-1] * base + word[1:]
    if base > _FEW_NAMES:  # three numbers would not fit 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    triple = pairs[:-1] * base + word[2:]
    ordered = np.sort(triple)
    often = ordered[2:][ordered[2:] == ordered[:-2]]
    if not len(often):
        return []
    often = np.isin(triple, often)
    inside = np.zeros(n, dtype=bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= often
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    return [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= LEAST_LENGTH]


def numbers(words: list[bytes]) -> np.ndarray:
    known = {word: number for number, word in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


def find_runs(words: list[bytes] | np.ndarray) -> list[Run]:
    """All runs among the words of a text, or among numbers that stand for them, by start and period."""
    word = words if isinstance(words, np.ndarray) else numbers(words)
    found = ((a + start, length, q) for a, b in stretches(word) for start, length, q in runs_of(word[a:b]))
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(count: int, runs: list[Run]) -> np.ndarray:
    """For each of `count` words: whether no run drops it."""
    change = np.zeros(count + 1, dtype=np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def top_run(runs: list[Run]) -> Run | None:
    """The run with the greatest length over period, compared as exact fractions."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(
    docs: DataFrame, text_col: str = "text", runs_to: str = "runs", text_to: str = "collapsed"
) -> DataFrame:
    """`docs` with the runs of each text (start, length, period) and the words that stay, joined by a
    blank (null for a null text); older columns of these names are replaced."""

    @F.pandas_udf(f"`{runs_to}` array<struct<start: long, length: long, period: long>>, `{text_to}` string")
    def run(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            words = (text or "").encode().split()
            runs = find_runs(words)
            kept = b" ".join(w for w, k in zip(words, kept_words(len(words), runs)) if k).decode()
            out.append(([dict(zip(("start", "length", "period"), r)) for r in runs], None if text is None else kept))
        return pd.DataFrame(out, columns=[runs_to, text_to])

    both = docs.withColumn("__collapsed", run(F.col(text_col)))
    both = both.withColumns({c: F.col(f"__collapsed.{c}") for c in (runs_to, text_to)})
    return both.drop("__collapsed")


def repeated_source(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's words for a document: for a tenth of the ids a tail that repeats its beginning."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // p)
    return words[:a] + (words[a : a + p] * times)[: n - a]


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_runs", pa.int64())]
    + [(c, pa.int64()) for c in ("start", "length", "period", "exponent_milli")]
    + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
)


def _reported(doc_id: int | None, text: bytes | None) -> tuple:
    words = repeated_source(doc_id, (text or b"").split())
    runs = find_runs(words)
    listed = "".join(f"{start},{length},{q}\n" for start, length, q in runs)
    if runs:
        keep = kept_words(len(words), runs)
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
        start, length, q = top_run(runs)
        top = (start, length, q, 1000 * length // q)
    else:
        top = (None,) * 4
    digests = (hashlib.sha256(part).hexdigest() for part in (listed.encode(), b" ".join(words)))
    return (doc_id, len(runs), *top, *digests)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in byte_slices(batch, 1, _SLICE_BYTES, _SLICE_ROWS):
            ids, texts = part.column(0).to_pylist(), part.column(1)
            rows = [_reported(i, texts[at].as_py()) for at, i in enumerate(ids)]
            columns = zip(*rows)
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, _RESULT)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_RESULT)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", "cast(text as binary) as text")
    types = {pa.int64(): "long", pa.string(): "string"}
    return docs.mapInArrow(_report, ", ".join(f"{f.name} {types[f.type]}" for f in _RESULT))
