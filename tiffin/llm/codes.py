"""Vector codes by product quantisation, with memoised grid cells for the nearest entries.

A component x becomes the integer floor(1024 * x). A vector is cut into PARTS equal parts, and each part
position has a codebook of up to ENTRIES entries, which starts as that part of the vectors with the smallest
ids. ROUNDS rounds of Lloyd's iteration follow: each part goes to its nearest entry (squared Euclidean
distance, ties to the lower index), then each entry becomes the floored mean of its parts, and an entry
without parts stays. All of it is integer arithmetic, so the result does not depend on the order of
the rows or on how they are spread over tasks.

The nearest entry of a part is found through its coarse grid cell:

1. the part's components, floored to multiples of `step`, name a cell, and the cell's bytes are its hash key;
2. for a cell not seen before, the least and the greatest distance of every entry to the cell's box are
   computed. An entry whose least distance is over the smallest greatest distance is farther than another
   entry everywhere in the box; the others are kept under the cell. Equal bounds keep an entry, so ties
   are still decided by the exact distances;
3. a part is compared exactly with the kept entries of its cell only.

A task remembers the last `cells` cells at most, and forgets all of them when that many are full, so memory
is bounded whatever the data. Parts that many rows share (copies, dense clusters) cost one box
each. Assignments never depend on the memory: a cell's entries follow from the cell and the codebook.

What is distributed how: rounds read one table of integer vectors from the shared folder; every task
adds up its parts per entry, and Spark sums at most PARTS * ENTRIES rows of each task, so no entry or label is a
hot key. The driver holds only the codebooks. The first codebook's ids are found by counting ids in bins that
narrow, so no task or driver takes a number of rows that grows with the table. Errors per label
are summed in the tasks first. Labels that hold a 256th of all rows or more, at most 256 of them, are joined from
a broadcast table and the rest by a shuffle in which no key is larger than that.

Defined results: a vector that is null, empty, or has a null or non-finite component is dropped, as is one whose
number of components differs from that of the vector with the smallest id. Where that number is no
multiple of PARTS, part i starts at floor(i * components / PARTS). Integers beyond the range in which a distance
could leave 64 bits are cut to it (131,072 for components of a vector of 64). Rows with equal ids are ordered by their
vectors; a null id comes after every other. Repeated rows are coded each, and count each in the means. With fewer
vectors than ENTRIES the codebook has an entry for each; an empty table gives no rows. Columns other than
those named are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.common import staged, table

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
#: Width of a cell along each component.
STEP = 48
#: Cells that a task remembers, and parts that are compared at a time.
CELLS, BLOCK = 16_384, 2_048
_BOXES, _SLACK = 128, 1e-9
_BINS = 1_024  # of ids, per narrowing
_FEW = 16_384  # ids that are few enough to be put in order
_LAST_ID = (1 << 63) - 1
_HOT = 256  # a label with this share of the rows is hot

#: Codebooks: one (entries, components) array of int64 per part.
Codebooks = list[np.ndarray]


class Nearest:
    """Nearest entries of one codebook, remembering the candidates of grid cells."""

    def __init__(self, book: np.ndarray, step: int = STEP, cells: int = CELLS):
        self.book, self.step, self.most = book, step, cells
        self.cells: dict[bytes, np.ndarray] = {}

    def _candidates(self, corners: np.ndarray) -> list[np.ndarray]:
        """For the boxes from each corner: entries that no other one beats in the whole box.

        The bounds are floating-point numbers, so they are compared with more slack than their
        rounding can make: an entry too many costs one exact comparison.
        """
        half, out = (self.step - 1) / 2, []
        for at in range(0, len(corners), _BOXES):
            centres = corners[at : at + _BOXES] + half
            least = np.zeros((len(centres), len(self.book)))
            most, apart, square = np.zeros_like(least), np.empty_like(least), np.empty_like(least)
            for centre, entry in zip(centres.T, self.book.T):
                np.abs(np.subtract(centre[:, None], entry[None], out=apart), out=apart)
                apart += half
                most += np.multiply(apart, apart, out=square)
                apart -= 2 * half
                np.maximum(apart, 0, out=apart)
                least += np.multiply(apart, apart, out=square)
            limit = most.min(axis=1, keepdims=True) * (1 + _SLACK)
            kept, entries = np.nonzero(least <= limit)
            out += np.split(entries, np.searchsorted(kept, np.arange(1, len(centres))))
        return out

    def __call__(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance, for each row of `points`."""
        index = np.empty(len(points), dtype=np.int64)
        error = np.empty(len(points), dtype=np.int64)
        for at in range(0, len(points), BLOCK):
            some = slice(at, at + BLOCK)
            index[some], error[some] = self._block(points[some])
        return index, error

    def _block(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        corners = np.ascontiguousarray(points // self.step * self.step)
        keys = [row.tobytes() for row in corners]
        fresh = {k: i for i, k in enumerate(keys) if k not in self.cells}
        if len(self.cells) + len(fresh) > self.most:
            self.cells.clear()
            fresh = {k: i for i, k in enumerate(keys)}
        if fresh:
            self.cells.update(zip(fresh, self._candidates(corners[list(fresh.values())])))
        lists = [self.cells[k] for k in keys]
        sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        starts = np.cumsum(sizes) - sizes
        entries = np.concatenate(lists)
        apart = np.repeat(points, sizes, axis=0) - self.book[entries]
        distance = np.einsum("pd,pd->p", apart, apart)
        best = np.minimum.reduceat(distance, starts)
        # Candidates are in order of their index, so the first of the nearest ones is the lowest.
        ties = np.flatnonzero(distance == np.repeat(best, sizes))
        first = ties[np.searchsorted(ties, starts)]
        return entries[first], best


def cuts(components: int, parts: int = PARTS) -> list[tuple[int, int]]:
    return [(i * components // parts, (i + 1) * components // parts) for i in range(parts)]


def _matrix(column: pa.Array, components: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(column), components)


def integer_vectors(df: DataFrame, vector: Column) -> DataFrame:
    """`df` with `_v`: the scaled and floored components, cut to what 31 bits hold; without
    the rows whose vector is null, empty or has a component that is null or not finite."""
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    )
    kept = df.where(vector.isNotNull() & (F.size(vector) > 0)).where(finite)
    top = float(1 << 30)

    def whole(x: Column) -> Column:
        scaled = F.floor(x.cast("double").__mul__(F.lit(float(SCALE))))
        return F.greatest(F.least(scaled, F.lit(top)), F.lit(-top)).cast("int")

    return kept.withColumn("_v", F.transform(vector, whole))


def _smallest(kept: DataFrame, count: int) -> DataFrame:
    """The rows with the `count` smallest ids and few others, found by counting in narrowing bins."""
    ids = kept.select("_order")
    low, high, rows = ids.agg(F.min("_order"), F.max("_order"), F.count("*")).first()
    while rows > _FEW and high > low:
        width = -(-(high - low + 1) // _BINS)
        # The difference of two ids may need 65 bits.
        place = F.floor((F.col("_order").cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / width)
        here = ids.where(F.col("_order").between(low, high))
        found = sorted(here.groupBy(place.cast("long").alias("bin")).count().collect())
        before = kept_before = 0
        for number, n in found:
            if before + n >= count:
                break
            before += n
        # Everything below this bin is needed too, but it is fewer than `count` rows.
        count -= before
        low, high, rows = low + number * width, min(high, low + (number + 1) * width - 1), n
    return kept if high is None else kept.where(F.col("_order") <= high)


def first_codebooks(kept: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> Codebooks:
    """The parts of the vectors with the smallest ids, one codebook per part."""
    few = _smallest(kept, entries).groupBy("_order", "_v").count()
    rows = few.orderBy("_order", "_v").limit(entries).collect()
    vectors = [r["_v"] for r in rows for _ in range(min(r["count"], entries))]
    vectors = [v for v in vectors[:entries] if len(v) == len(vectors[0])]
    if not vectors:
        return []
    whole = np.array(vectors, dtype=np.int64)
    return [whole[:, a:b] for a, b in cuts(whole.shape[1], parts)]


@dataclass(frozen=True)
class Coder:
    """Codebooks as they stand, and the work of a task with them."""

    books: Codebooks
    step: int = STEP
    cells: int = CELLS

    @property
    def components(self) -> int:
        return sum(b.shape[1] for b in self.books)

    def _assigned(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(batch, matrix, [(index, error) per part])"""
        nearest = [Nearest(b, self.step, self.cells) for b in self.books]
        limits = cuts(self.components, len(self.books))
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(batch.column(batch.num_columns - 1), self.components)
                yield batch, matrix, [n(matrix[:, a:b]) for n, (a, b) in zip(nearest, limits)]

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """`part`, `entry`, number of parts and sums of their components, once per task."""
        counts = [np.zeros(len(b), dtype=np.int64) for b in self.books]
        sums = [np.zeros_like(b) for b in self.books]
        limits = cuts(self.components, len(self.books))
        for _, matrix, found in self._assigned(batches):
            for part, ((index, _), (a, b)) in enumerate(zip(found, limits)):
                counts[part] += np.bincount(index, minlength=len(counts[part]))
                order = np.argsort(index, kind="stable")
                used, starts = np.unique(index[order], return_index=True)
                sums[part][used] += np.add.reduceat(matrix[order, a:b], starts, axis=0)
        for part, (n, s) in enumerate(zip(counts, sums)):
            used = np.flatnonzero(n)
            columns = {"part": np.full(len(used), part), "entry": used, "n": n[used]}
            width = max(b.shape[1] for b in self.books)
            padded = np.pad(s[used], ((0, 0), (0, width - s.shape[1])))
            columns |= {f"s{i}": padded[:, i] for i in range(width)}
            yield pa.RecordBatch.from_pydict(columns)

    def codes(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The batches' first columns with `code` and `error` in the place of the vector."""
        for batch, _, found in self._assigned(batches):
            index = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            code = pa.array([row.tobytes().hex() for row in index], type=pa.string())
            error = pa.array(sum(e for _, e in found), type=pa.int64())
            names = batch.schema.names[:-1]
            kept = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*kept, code, error], names=[*names, "code", "error"])


def trained(
    kept: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES, parts: int = PARTS, step: int = STEP
) -> Coder:
    """A coder fitted to `_v` of `kept`, whose rows are ordered by `_order` for the first codebooks."""
    coder = Coder(first_codebooks(kept, entries, parts), step)
    for _ in range(rounds if coder.books else 0):
        width = max(b.shape[1] for b in coder.books)
        names = ["n", *(f"s{i}" for i in range(width))]
        schema = "part long, entry long, " + ", ".join(f"{n} long" for n in names)
        tasks = of_length(kept, coder.components).select("_v").mapInArrow(coder.sums, schema)
        merged = tasks.groupBy("part", "entry").agg(*[F.sum(n).alias(n) for n in names])
        books = [b.copy() for b in coder.books]
        for part, entry, n, *sums in merged.collect():  # PARTS * ENTRIES rows at most
            book = books[part]
            book[entry] = np.array(sums[: book.shape[1]], dtype=np.int64) // n
        coder = Coder(books, step)
    return coder


def of_length(kept: DataFrame, components: int) -> DataFrame:
    """The rows with that many components, cut to where no distance can leave 64 bits."""
    top = math.isqrt((1 << 62) // components) // 2
    cut = F.transform("_v", lambda x: F.greatest(F.least(x, F.lit(top)), F.lit(-top)))
    return kept.where(F.size("_v") == components).withColumn("_v", cut)


def codebooks_sha256(books: Codebooks) -> str:
    numbers = ",".join(str(x) for b in books for x in b.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def summed_by(df: DataFrame, key: str, value: str, to: str) -> DataFrame:
    """`df` with the sum of `value` over the rows with an equal `key` (nulls are equal)."""
    sums = df.groupBy(key).agg(F.sum(value).alias("_sum"), F.count("*").alias("_rows"))
    hot = sums.where(F.col("_rows") * _HOT >= df.count())
    hot = hot.select(F.col(key).alias("_hot_key"), F.col("_sum").alias("_hot_sum"))
    rows = df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot_key")), "left")
    # Rows that are served already go to the shuffle under keys of their own.
    spread = F.when(F.col("_hot_sum").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(*df.columns), F.lit(9_973)))
    cold = sums.select(F.col(key).alias("_cold_key"), F.col("_sum").alias("_cold_sum"), F.lit(0).alias("_at"))
    same = F.col(key).eqNullSafe(F.col("_cold_key")) & (F.col("_spread") == F.col("_at"))
    rows = rows.withColumn("_spread", spread.cast("int")).join(cold, same, "left")
    return rows.select(*[df[c] for c in df.columns], F.coalesce("_hot_sum", "_cold_sum").alias(to))


def coded(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    rounds: int = ROUNDS,
    entries: int = ENTRIES,
    parts: int = PARTS,
    step: int = STEP,
) -> tuple[DataFrame, Coder]:
    """The id and label of the rows that are kept, with `code` and `error`, and the coder that gave them."""
    kept = integer_vectors(df.select(id_col, label_col, vector_col), F.col(vector_col))
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID))
    kept = staged(kept.select(id_col, label_col, order.alias("_order"), "_v"), "vectors")
    coder = trained(kept, rounds, entries, parts, step)
    fields = [f for f in kept.schema.fields if f.name in (id_col, label_col)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", code string, error long"
    if not coder.books:
        return df.sparkSession.createDataFrame([], schema), coder
    rows = of_length(kept, coder.components).select(id_col, label_col, "_v")
    return rows.mapInArrow(coder.codes, schema), coder


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, coder = coded(table(spark, sf_dir, "embeddings"))
    found = summed_by(staged(found, "codes"), "label", "error", "label_error")
    digest = F.lit(codebooks_sha256(coder.books)).alias("codebooks_sha256")
    return found.select("vec_id", "code", "error", "label_error", digest)


def _rounds_sql() -> str:
    steps = [
        f"""near{r} AS MATERIALIZED (
  SELECT p.vec_id, p.part, min(CAST(p.xx + b.xx - 2 * list_inner_product(p.x, b.x) AS BIGINT) * {ENTRIES} + b.entry) AS best
  FROM parts p JOIN book{r} b ON b.part = p.part GROUP BY 1, 2)"""
        + (
            ""
            if r == ROUNDS
            else f""",
mean{r} AS (
  SELECT part, entry, list(m ORDER BY pos) AS x FROM (
    SELECT part, entry, pos, floor(sum(c) / count(*)) AS m FROM (
      SELECT n.part, n.best % {ENTRIES} AS entry, unnest(p.x) AS c, generate_subscripts(p.x, 1) AS pos
      FROM near{r} n JOIN parts p ON p.vec_id = n.vec_id AND p.part = n.part)
    GROUP BY 1, 2, 3)
  GROUP BY 1, 2),
book{r + 1} AS MATERIALIZED (
  SELECT part, entry, x, list_inner_product(x, x) AS xx FROM (
    SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
    FROM book{r} b LEFT JOIN mean{r} m ON m.part = b.part AND m.entry = b.entry))"""
        )
        for r in range(ROUNDS + 1)
    ]
    return ",\n".join(steps)


OP11_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS place,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
parts AS MATERIALIZED (
  SELECT vec_id, label, place, part, x, list_inner_product(x, x) AS xx FROM (
    SELECT vec_id, label, place, part, v[part * len(v) // {PARTS} + 1:(part + 1) * len(v) // {PARTS}] AS x
    FROM kept, (SELECT unnest(range({PARTS})) AS part))),
book0 AS (SELECT part, place AS entry, x, xx FROM parts WHERE place < {ENTRIES}),
{_rounds_sql()},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY part) AS code,
    CAST(sum(best // {ENTRIES}) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY 1)
SELECT vec_id, code, error,
  CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos))
   FROM (SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS pos FROM book{ROUNDS})) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""
