"""Near copies by shingle sets: pairs of texts with a Jaccard similarity of SIMILARITY or more.

A text's set holds the hashes of its runs of five words. Texts are linked when the sets of the two
have a Jaccard similarity of at least 0.8, which is always computed from the whole sets:

1. Candidates: texts whose SimHash fingerprints, over the same shingles, are linked by the search of
   `simhash` (vantage-point trees over both halves, exact), and, since similar texts may differ in more
   bits than its radius, texts that agree in one of BANDS bands of BAND_ROWS minhashes each. A pair with
   a similarity of 0.8 that the fingerprints do not link is missed with a chance of (1 - 0.8^5)^25 = 5 in
   100,000, a more similar one less often. The texts of a band, or of a component of fingerprints, are
   tied to the smallest of them, and tied texts form cells.
2. A cell's sets are compared in parts of bounded size. First each part together with the cell's
   smallest text, which a group of near copies mostly agrees with; then, for cells of several parts
   that are not one component by then, each pair of parts. Pairs already connected are skipped, and
   only a spanning forest of the links leaves a task.
3. Inside a task a pair is compared if the rarest elements of the two sets allow for the similarity
   (prefix filter, which loses no pair).

Defined results: words, and A-Z, are as in simhash. Null, empty and wordless texts are copies of one
another; with fewer words than a shingle the whole sequence is one. Texts with the same words are one
node, known by a 64-bit hash. Null ids are ignored where a component has others. An empty table gives
no rows. Other columns of the input take no part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tiffin.llm.common import FILE_ROWS, per_salt, salt_of, salts_seen, staged, utf8
from tiffin.llm import simhash
from tiffin.llm.simhash import SALTS, _Forest, _shingle_hashes, components, majority

SHINGLE_WORDS = 5
#: Least Jaccard similarity of a link, as numerator and denominator.
SIMILARITY = (4, 5)
BANDS, BAND_ROWS = 25, 5
SEED = 7
#: Texts, and elements of their sets, in a part of a cell, about.
PART_TEXTS, PART_ELEMENTS = 512, 1 << 20
#: Rows of fingerprints and band keys, and sets, that a staged file holds, about.
FILE_PRINTS, FILE_SETS = 1 << 15, 1 << 13
_random = np.random.default_rng(SEED)
_FLIPS = _random.integers(0, 1 << 64, (BANDS * BAND_ROWS, 1), dtype=np.uint64)
_FACTORS = _random.integers(0, 1 << 64, (BANDS * BAND_ROWS, 1), dtype=np.uint64) | np.uint64(1)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: A-Z, and white space \x20 \x09-\x0d, only


def node_of(words: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(words), SEED)


def set_of(words: list[bytes]) -> np.ndarray:
    """The sorted different hashes of the shingles."""
    return np.unique(_shingle_hashes(words, SHINGLE_WORDS))


def band_keys(elements: np.ndarray) -> np.ndarray:
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max)
    for start in range(0, len(elements), 1024):  # bounds the mixed hashes
        mixed = (elements[start : start + 1024] ^ _FLIPS) * _FACTORS
        np.minimum(least, mixed.min(axis=1), out=least)
    bands = least.reshape(BANDS, BAND_ROWS)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(bands)], dtype=np.uint64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets without repeated elements are similar enough, exactly."""
    over, under = SIMILARITY
    if under * min(len(a), len(b)) < over * max(len(a), len(b)):
        return False
    both = np.intersect1d(a, b, assume_unique=True).size
    return under * both >= over * (len(a) + len(b) - both)


def similar_links(
    sets: list[np.ndarray], labels: np.ndarray | None = None, parts: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """A spanning forest of the similar pairs of `sets`, by position. Sets of one label count as
    connected, and sets of one part are not compared."""
    over, under = SIMILARITY
    forest, links = _Forest(len(sets)), []
    if labels is not None:
        _, first, inverse = np.unique(labels, return_index=True, return_inverse=True)
        for i, j in enumerate(first[inverse].tolist()):
            forest.union(i, j)
    _, ids, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    ends = np.cumsum([len(s) for s in sets])
    sets = np.split(ids, ends[:-1])
    found: dict[int, list[int]] = defaultdict(list)
    for i, own in enumerate(sets):
        rarest = own[np.lexsort((own, counts[own]))]
        prefix = rarest[: len(own) - -(-over * len(own) // under) + 1]
        shared = prefix[counts[prefix] > 1].tolist()
        for j in sorted({j for e in shared for j in found[e]}):
            if parts is not None and parts[i] == parts[j]:
                continue
            if forest.find(i) != forest.find(j) and similar(own, sets[j]):
                forest.union(i, j)
                links.append((i, j))
        for e in shared:
            found[e].append(i)
    return links


def _dealt(df: DataFrame, rows: int, file_rows: int = FILE_ROWS) -> DataFrame:
    """`df`, about `rows` rows, to be written in few files. What makes its rows keeps its tasks, unlike under `coalesce`."""
    return df.repartition(-(-max(rows, 1) // file_rows))


def _prints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: doc_id, node, fp (its fingerprint), keys (of its bands)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, fps, keys = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_buffer().to_pybytes())
                hashes = _shingle_hashes(words, SHINGLE_WORDS)
                nodes.append(node_of(words))
                fps.append(majority(hashes) if words else 0)
                keys.append(band_keys(np.unique(hashes)).view(np.int64))
            numbers = [pa.array(np.array(c, dtype=np.uint64).view(np.int64)) for c in (nodes, fps)]
            columns = [batch.column(0), *numbers, pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "fp", "keys"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), utf8(docs[text_col]).alias("t"))
    return rows.mapInArrow(run, "doc_id long, node long, fp long, keys array<long>")


@F.pandas_udf(LongType())
def _node(texts: pd.Series) -> pd.Series:
    nodes = np.array([node_of(words_of(t)) for t in texts], dtype=np.uint64)
    return pd.Series(nodes.view(np.int64))


def _linked_prints(prints: DataFrame, rows: int) -> DataFrame:
    """node, key: nodes whose fingerprints are linked, directly or through others, have one key."""
    salt = salt_of(F.col("node"), SALTS)
    fps = prints.groupBy("fp").agg(
        F.min("node").alias("least"), F.max("node").alias("most"), salts_seen(salt).alias("bits")
    )
    fps = staged(fps, "fingerprints", rows)
    member = components(simhash.links(fps.select("fp")), rows=rows).withColumnRenamed("node", "fp")
    several = fps.join(member, "fp", "left").where("component IS NOT NULL OR least < most")
    several = several.select("fp", F.coalesce("component", "fp").alias("key"), "bits")
    places = prints.select("node", "fp", salt.alias("salt"))
    return places.join(per_salt(several, "bits", "salt", SALTS), ["fp", "salt"]).select("node", "key")


def _cells(prints: DataFrame) -> DataFrame:
    """node, cell of every node that shares a band, or linked fingerprints, with another one. What many
    texts share meets them in SALTS places."""
    rows = prints.count()
    linked = staged(_linked_prints(prints, rows), "linked", rows)
    keyed = prints.select("node", F.explode("keys").alias("key")).union(linked)
    keyed = keyed.withColumn("salt", salt_of(F.col("node"), SALTS))
    bands = keyed.groupBy("key").agg(
        F.min("node").alias("least"), F.max("node").alias("most"), salts_seen(F.col("salt")).alias("bits")
    )
    bands = bands.where("least < most").select("key", "least", "bits")
    ties = keyed.join(per_salt(bands, "bits", "salt", SALTS), ["key", "salt"]).where("node > least")
    ties = ties.select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    return components(ties, rows=rows * BANDS).withColumnRenamed("component", "cell")


def _sets(docs: DataFrame, cells: DataFrame, text_col: str) -> DataFrame:
    """node, cell, elements of the nodes in cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # bounds the sets held at a time
                part = batch.slice(at, 64)
                sets = [set_of(words_of(t.as_buffer().to_pybytes())).view(np.int64) for t in part.column(2)]
                columns = [part.column(0), part.column(1), pa.array(sets, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "cell", "elements"])

    texts = docs.select(_node(utf8(docs[text_col])).alias("node"), utf8(docs[text_col]).alias("t"))
    rows = texts.join(cells, "node").groupBy("node", "cell").agg(F.min("t").alias("t"))
    return rows.mapInArrow(run, "node long, cell long, elements array<long>")


def _verified(group: pd.DataFrame) -> pd.DataFrame:
    sets = [np.asarray(e).view(np.uint64) for e in group["elements"]]
    pairs = [group[c].to_numpy() if c in group else None for c in ("label", "part")]
    nodes = group["node"].to_numpy(dtype=np.int64)
    found = np.array(similar_links(sets, *pairs), dtype=np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": nodes[found[:, 0]], "b": nodes[found[:, 1]]})


def links(sets: DataFrame, part_texts: int = PART_TEXTS, part_elements: int = PART_ELEMENTS) -> DataFrame:
    """Edges (a, b) that span all links between the nodes of a cell."""
    sizes = sets.groupBy("cell").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / part_texts, F.sum(F.size("elements")) / part_elements)).cast("int").alias("parts")
    )
    rows = sets.count()
    # Cells of several parts: few, as each holds many texts or long ones.
    large = F.broadcast(staged(sizes.where("parts > 1"), "large", rows))
    parts = F.coalesce("parts", F.lit(1))
    dealt = sets.join(large, "cell", "left").withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
    everywhere = F.when(F.col("node") == F.col("cell"), F.sequence(F.lit(0), parts - 1)).otherwise(F.array("part"))
    alone = dealt.select("cell", F.explode(everywhere).alias("tile"), "node", "elements")
    first = alone.groupBy("cell", "tile").applyInPandas(_verified, "a long, b long")
    first = staged(_dealt(first, rows), "links")
    # Cells that are not one component yet.
    joined = components(first, rows=first.count())
    several = sets.join(large, "cell").select("cell", "node").join(joined, "node", "left")
    several = several.select("cell", "node", F.coalesce("component", "node").alias("label"))
    several = staged(several, "labels", rows)
    open_cells = several.groupBy("cell").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    rest = dealt.where("parts > 1").join(F.broadcast(open_cells.select("cell")), "cell", "left_semi")
    rest = rest.join(several.drop("cell"), "node")
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("other <> part")
    tiles = rest.select("cell", F.least("part", "other").alias("row"), F.greatest("part", "other").alias("col"),
                        "part", "label", "node", "elements")
    second = tiles.groupBy("cell", "row", "col").applyInPandas(_verified, "a long, b long")
    return _dealt(first.union(second), rows)


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: int
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one for each component, of its smallest
    doc_id. Of rows that share words and doc_id the first by all columns' hash stays."""
    prints = staged(_dealt(_prints(docs, id_col, text_col), docs.count(), FILE_PRINTS), "prints")
    cells = _cells(prints)
    sets = staged(_dealt(_sets(docs, cells, text_col), cells.count(), FILE_SETS), "sets")
    member = components(links(sets, **limits))
    nodes = prints.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    linked = nodes.join(member, "node", "left").withColumn("component", F.coalesce("component", "node"))
    order = F.struct(F.col("first_id").isNull().alias("none"), "first_id", "node")
    kept = linked.groupBy("component").agg(F.min(order).alias("first"))

    # The id as a key that is never null: join and window then share one shuffle of the rows.
    def name(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("null"))

    kept = kept.select(F.col("first.node").alias("__near_node"), name(F.col("first.first_id")).alias("__near_id"))
    copies = Window.partitionBy("__near_node", "__near_id").orderBy("__near_order")
    rows = docs.withColumns(
        {
            "__near_node": _node(utf8(docs[text_col])),
            "__near_id": name(docs[id_col].cast("long")),
            "__near_order": F.xxhash64(*[docs[c] for c in docs.columns]),
        }
    )
    return (
        rows.join(kept, ["__near_node", "__near_id"], "left_semi")
        .withColumn("__near_copy", F.row_number().over(copies))
        .where(F.col("__near_copy") == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
