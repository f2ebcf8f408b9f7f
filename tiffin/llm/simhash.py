"""Near duplicates by SimHash fingerprints, searched in vantage-point trees.

A text's fingerprint has bit b set if over half of its shingles' 64-bit hashes have it. Texts whose
fingerprints differ in at most `radius` bits are linked, and linked texts form components.

Distances between 64-bit fingerprints crowd around 32, where a triangle bound prunes nothing. So the
trees work on halves: of two fingerprints at most r bits apart, one of the two 32-bit halves is at
most floor(r/2) bits apart. Each half has its own vantage-point tree, searched with that smaller
radius:

* The upper levels (vantage points and median distances) are fitted on a bounded sample. They deal
  all different fingerprints to shards: a fingerprint lives in one shard per half, and is sent as a
  visitor to each shard across a boundary that its radius reaches, which the triangle bound
  |d(v,x) - d(v,y)| <= d(x,y) tells. So each linked pair meets in at least one shard.
* A shard of more than TILE_ROWS fingerprints, such as a large group of near copies, is cut into
  parts; each pair of parts is a task of its own.
* Inside a task pairs are compared exactly, over all 64 bits, in blocks. Only a spanning forest of
  the links leaves the task, so a group of n near copies gives n - 1 edges and not n^2.

Components come from alternating large-star and small-star steps on those edges (Kiveris et al.,
2014), each a grouped minimum and a join.

Defined results: null, empty and wordless texts have fingerprint zero and are linked like any other;
with fewer words than a shingle the whole sequence is one. A component's id is its smallest doc_id;
null ids are ignored there, so a component of rows without id has a null id. Repeated rows link as
equal fingerprints. An empty table gives no rows. Other columns of the input take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiffin.llm.common import hash_sample, per_salt, salt_of, salts_seen, staged, table, utf8

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
#: Fingerprints that the upper levels of the trees are fitted on.
SAMPLE_ROWS = 1 << 16
#: Fingerprints that live in a shard, about.
SHARD_ROWS = 2048
#: Fingerprints, visitors included, in the parts of a shard that has more. Well above what a shard
#: holds where fingerprints are spread out, so that only dense groups are cut.
TILE_ROWS = 1 << 15
MAX_DEPTH = 16
#: Places that the neighbours of one node meet it in.
SALTS = 16
_BLOCK_CELLS = 1 << 21


def _shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    text = b" ".join(words)
    starts, at = [], 0
    for word in words:
        starts.append(at)
        at += len(word) + 1
    ends = [start - 1 for start in starts[width:]] + [len(text)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(text[a:b], SEED) for a, b in zip(starts, ends, strict=False)),
        dtype=np.uint64,
        count=len(words) - width + 1,
    )


def fingerprint_of(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of a UTF-8 text."""
    words = text.lower().split()  # of bytes: A-Z, and white space \x20 \x09-\x0d, only
    return majority(_shingle_hashes(words, width)) if words else 0


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the `hashes` have set."""
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits
        block = hashes[start : start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS
) -> DataFrame:
    """Per row of `docs`: doc_id, fp (the fingerprint's bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (fingerprint_of(t.as_buffer().to_pybytes(), width) for t in batch.column(1))
            fps = np.fromiter(found, dtype=np.uint64, count=batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), utf8(docs[text_col]).alias("t"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _half(fps: np.ndarray, half: int) -> np.ndarray:
    return (fps.view(np.uint64) >> np.uint64(32 * half)).astype(np.uint32)


class HalfTree:
    """The upper levels of a vantage-point tree over one 32-bit half: complete, `depth` levels.
    Node n has children 2n + 1 (distance at most the median) and 2n + 2."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int):
        self.depth = depth
        nodes = (1 << depth) - 1
        self.points = np.zeros(nodes, dtype=np.uint32)
        self.limits = np.zeros(nodes, dtype=np.int16)
        random = np.random.default_rng(seed)
        members = {0: np.unique(sample)}
        for node in range(nodes):
            own = members.pop(node)
            if len(own):
                self.points[node] = random.choice(own)
            else:
                self.points[node] = random.integers(0, 1 << 32, dtype=np.uint32)
            away = np.bitwise_count(own ^ self.points[node])
            self.limits[node] = np.median(away) if len(own) else 16
            if 2 * node + 1 < nodes:
                inside = away <= self.limits[node]
                members[2 * node + 1], members[2 * node + 2] = own[inside], own[~inside]

    def shards(self, half: np.ndarray, radius: int) -> tuple[np.ndarray, ...]:
        """Positions in `half`, the shards they reach, and whether that shard is their home."""
        at = np.arange(len(half))
        node = np.zeros(len(half), dtype=np.int64)
        home = np.ones(len(half), dtype=bool)
        for _ in range(self.depth):
            away = np.bitwise_count(half[at] ^ self.points[node]).astype(np.int16)
            gap = away - self.limits[node]
            inside = gap <= 0
            near, far = 2 * node + 2 - inside, 2 * node + 1 + inside
            # Something within the radius may lie beyond the boundary.
            cross = np.where(inside, gap + radius > 0, gap - radius <= 0)
            at = np.concatenate([at, at[cross]])
            home = np.concatenate([home, np.zeros(int(cross.sum()), dtype=bool)])
            node = np.concatenate([near, far[cross]])
        return at, node - ((1 << self.depth) - 1), home


def _fit(nodes: DataFrame, shard_rows: int, sample_rows: int) -> list[HalfTree]:
    rows = nodes.count()
    depth = int(min(MAX_DEPTH, max(0, np.ceil(np.log2(max(rows, 1) / shard_rows)))))
    sample = (
        hash_sample(nodes.select("fp"), F.col("fp"), F.col("fp"), sample_rows, rows)
        if depth
        else nodes.select("fp").limit(0)
    )
    fps = sample.toPandas()["fp"].to_numpy(dtype=np.int64)
    return [HalfTree(_half(fps, half), depth, seed=half) for half in (0, 1)]


class _Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return self.parent
            self.parent = up

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return int(x)

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def spanning_links(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between `left` and `right` (fingerprints as uint64)."""
    both, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    i, j = place[: len(left)], place[len(left) :]
    forest, links = _Forest(len(both)), []
    step = max(1, _BLOCK_CELLS // max(1, len(right)))
    for start in range(0, len(left), step):
        block = left[start : start + step]
        near = np.bitwise_count(block[:, None] ^ right[None, :]) <= radius
        rows, cols = np.nonzero(near)
        a, b = i[start + rows], j[cols]
        roots = forest.roots()
        new = roots[a] != roots[b]
        a, b = a[new], b[new]
        while len(a):
            # One link for each row suffices at a time; the rest mostly turn out connected.
            _, first = np.unique(a, return_index=True)
            for x, y in zip(a[first].tolist(), b[first].tolist(), strict=True):
                if forest.union(x, y):
                    links.append((int(both[x]), int(both[y])))
            roots = forest.roots()
            new = roots[a] != roots[b]
            a, b = a[new], b[new]
    return links


def _shard_rows(nodes: DataFrame, trees: list[HalfTree], radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for start in range(0, len(fps), 4096):
                part = fps[start : start + 4096]
                for half, tree in enumerate(trees):
                    at, shard, home = tree.shards(_half(part, half), radius // 2)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(2 * shard + half), pa.array(home), pa.array(part[at])],
                        ["shard", "home", "fp"],
                    )

    return nodes.select("fp").mapInArrow(run, "shard long, home boolean, fp long")


def links(
    nodes: DataFrame,
    radius: int = RADIUS,
    shard_rows: int = SHARD_ROWS,
    tile_rows: int = TILE_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Edges (a, b) between different fingerprints of `nodes` (fp) that span all links."""
    trees = _fit(nodes, shard_rows, sample_rows)
    rows = _shard_rows(nodes, trees, radius)
    # At most two rows for each of the 2^MAX_DEPTH shards: small enough to broadcast.
    sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    parts = sizes.select("shard", F.ceil(F.col("n") / tile_rows).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    tiled = (
        rows.join(F.broadcast(parts), "shard")
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "shard",
            F.least("part", "other").alias("row"),
            F.greatest("part", "other").alias("col"),
            "part",
            "home",
            "fp",
        )
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        fps = group["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        home, part = group["home"].to_numpy(dtype=bool), group["part"].to_numpy()
        row, col = group["row"].iloc[0], group["col"].iloc[0]
        if row == col:
            found = spanning_links(fps[home], fps, radius)
        else:
            found = spanning_links(fps[home & (part == row)], fps[part == col], radius)
            found += spanning_links(fps[home & (part == col)], fps[part == row], radius)
        pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    keys = ["shard", "row", "col"]
    return tiled.groupBy(*keys).applyInPandas(run, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 60, rows: int | None = None) -> DataFrame:
    """node -> component (its smallest node) for every node of `edges` (a, b), about `rows` if known.

    A node's neighbours meet its smallest one in SALTS places, so a hub is no task's work alone. Rounds grow with
    the logarithm of a component's width; an error is raised if `max_rounds` do not settle it.
    """

    def both_ways(e: DataFrame) -> DataFrame:
        return e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        """Each node's larger (or smaller) neighbours, and itself, point to its smallest one."""
        turned = both_ways(e) if large else e.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        )
        turned = turned.withColumn("salt", salt_of(F.col("b"), SALTS))
        least = turned.groupBy("a").agg(F.min("b").alias("m"), salts_seen(F.col("salt")).alias("bits"))
        least = least.select("a", F.least("a", "m").alias("m"), "bits")
        moved = turned.join(per_salt(least, "bits", "salt", SALTS), ["a", "salt"])
        if large:
            moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = moved.select(
                F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")
            ).select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))
        return moved.where("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = staged(edges.where("a <> b"), "edges", rows)
    before, size = None, now.count()
    for _ in range(max_rounds):
        now = staged(star(star(now, large=True), large=False), "edges", size)
        if (after := state(now)) == before:
            break
        before, size = after, after[0]
    else:
        raise RuntimeError("components did not settle")
    # Settled: stars whose centres are the components' smallest nodes.
    centres = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres)


def _classes(prints: DataFrame, radius: int, **limits: int) -> DataFrame:
    """Per different fingerprint of `prints` (doc_id, fp): fp, first_id (its smallest doc_id),
    component_id (its component's), and keeps (whether it is the one fingerprint of its component
    that has that id)."""
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    member = components(links(nodes, radius, **limits))
    linked = nodes.join(member, nodes["fp"] == member["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    order = F.struct(F.col("first_id").isNull().alias("none"), "first_id", "fp")
    smallest = linked.groupBy("component").agg(F.min(order).alias("first"))
    return linked.join(smallest, "component").select(
        "fp",
        "first_id",
        F.col("first.first_id").alias("component_id"),
        (F.col("fp") == F.col("first.fp")).alias("keeps"),
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    **limits: int,
) -> DataFrame:
    """Per row of `docs`: doc_id, fp (signed long), component_id."""
    prints = staged(fingerprints(docs, id_col, text_col, width), "fingerprints")
    classes = _classes(prints, radius, **limits).select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    **limits: int,
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one for each component, of its smallest
    doc_id. Of rows that share fingerprint and doc_id the first by all columns' hash stays."""

    @F.pandas_udf("long")
    def print_of(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint_of(t, width) for t in texts], dtype=np.uint64)
        return pd.Series(found.view(np.int64))

    prints = staged(fingerprints(docs, id_col, text_col, width), "fingerprints")
    kept = _classes(prints, radius, **limits).where("keeps")
    # The id as a key that is never null: join and window then share one shuffle of the rows.
    name = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    kept = kept.select(F.col("fp").alias("__near_fp"), name(F.col("first_id")).alias("__near_id"))
    copies = Window.partitionBy("__near_fp", "__near_id").orderBy("__near_order")
    rows = docs.withColumns(
        {
            "__near_fp": print_of(utf8(docs[text_col])),
            "__near_id": name(docs[id_col].cast("long")),
            "__near_order": F.xxhash64(*[docs[c] for c in docs.columns]),
        }
    )
    return (
        rows.join(kept, ["__near_fp", "__near_id"], "left_semi")
        .withColumn("__near_copy", F.row_number().over(copies))
        .where(F.col("__near_copy") == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
