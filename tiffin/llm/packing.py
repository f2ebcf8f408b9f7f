"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

A document is its token ids and one end id. Documents of more than `capacity` tokens are cut into
full pieces and a rest; full pieces are sequences of their own, and all other pieces are packed.

* Pieces are dealt to shards of about SHARD_ITEMS by a hash of their row, so every shard is small
  whatever the documents are. Shards of tiny pieces take more of them, up to the tokens of SHARD_BINS
  sequences. A shard's problem is one row: lengths, and a population of packings.
* Each shard lives on several islands. An island breeds its population: a child takes whole
  well-filled bins from one parent, loses the bins of the other that now hold a document twice, and
  places the displaced documents into the remaining bins by best fit, largest first. The packing
  with fewer bins, then with more unequal fills, is the better one.
* Between epochs each island's elite migrates to the next island of its shard.
* The least filled bins of every shard are opened and packed again together, level by level, until
  one shard is left, so the sharding itself costs no more than about one sequence in all. Each level
  has less than half the tokens of the one before: s > 1 shards have over (s - 1) * SHARD_BINS
  sequences' tokens, and at most s * REOPENED_BINS of them are reopened.

An island stops early where a packing has as few bins as the token count allows.

Defined results: a null or empty text is one end id. Repeated rows are packed each. A null doc_id
stays null. An empty table gives no rows. Other columns of the input take no part.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.common import byte_slices, staged, table

CAPACITY = 4096
END_ID = 1
SHARD_ITEMS = 2048
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
GENERATIONS = 8
#: Bins of each shard that the next level packs again.
REOPENED_BINS = 2
#: Sequences that a shard's tokens fill at least, on average, so that a level reopens at most half of them.
SHARD_BINS = 4 * REOPENED_BINS
#: Words whose ids a task remembers; it forgets all when there are more.
CACHED_WORDS = 500_000
#: Text whose words are numbered at a time, and ids that are returned at a time.
_TEXT_BYTES, _BATCH_BYTES = 8 << 20, 16 << 20


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Letters whose lower case is one letter, and which have no other composed form.
_LATIN = "a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u01bf\u01c4-\u024f"
#: Punctuation, a Latin word, punctuation. An apostrophe before letters may belong to them.
_PARTS = re.compile(rf"([!-&(-/:-@\[-`{{-~]*)([{_LATIN}]+)([!-/:-@\[-`{{-~]*)")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in printable)
    return [chr(c) for _, c in sorted([*zip(printable, printable, strict=True), *zip(others, itertools.count(256))])]


class Words(dict):
    """Ids of words, as bytes; computed when first asked for.

    A word of Latin letters is one unit of the merges, so the tokenizer's model takes it without the
    steps before. Punctuation around such a word is a unit of its own. All else goes through the
    whole tokenizer."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(path)
        self.merge = self.inner.model.tokenize
        self.alphabet = {b: c for b, c in enumerate(byte_alphabet())}

    def _ids(self, word: str) -> bytes:
        if "<|" not in word and (m := _PARTS.fullmatch(word)):
            before, core, after = m.groups()
            if before or after:
                # Through the memory, as the same word occurs with other punctuation.
                return b"".join([self[part] for part in (before, core, after) if part])
            if not core.isascii():
                core = "".join(map(str.lower, core)).encode()
                core = "".join(map(self.alphabet.__getitem__, core))
            return array("I", [t.id for t in self.merge(core)]).tobytes()
        return array("I", self.inner.encode(word, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        found = self._ids(word)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found
        return found


class WordTokenizer:
    """Ids of texts, as bytes of unsigned 32-bit numbers in the machine's order.

    The tokenizer drops white space and never merges across it, so the ids of a text are those of
    its words one after another. Words are numbered by Arrow, a batch of texts at a time, and each
    different word is looked up once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.words = Words(path)

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        # The vocabulary is lower case; only the special tokens' strings are matched before that.
        special = pc.match_substring(texts, "<|")
        split = pc.ascii_split_whitespace(pc.if_else(special, texts, pc.ascii_lower(texts)))
        coded = split.flatten().dictionary_encode()
        new = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.words.__getitem__, new))
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(ids), dtype=np.uint32)
        word = coded.indices.to_numpy(zero_copy_only=False)
        ends = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        begin = 0
        for end in ends.tolist():
            here = word[begin:end]
            size, begin = sizes[here], end
            shift = starts[here] - (np.cumsum(size) - size)
            yield flat[np.repeat(shift, size) + np.arange(size.sum())].tobytes()


_PIECE = pa.schema(
    [
        ("uid", pa.int64()),
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = True,
) -> DataFrame:
    """Rows uid (unique), doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    schema = _PIECE if with_ids else pa.schema([f for f in _PIECE if f.name != "ids"])
    end, width = np.array([END_ID], dtype="<u4").tobytes(), 4 * capacity

    def as_batch(rows: list[list]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), schema, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, type=field.type) for column, field in columns], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from numbered(batches)
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
            pool.release_unused()

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ends with the task: a worker lives on, idle or for other steps, and would keep some 100 MB of words.
        encode = WordTokenizer(tokenizer)
        uid = TaskContext.get().partitionId() << 36
        for whole in batches:
            for batch in byte_slices(whole, 1, _TEXT_BYTES, whole.num_rows):
                rows, size = [], 0
                doc_ids = batch.column(0).to_pylist()
                for doc_id, ids in zip(doc_ids, encode(batch.column(1)), strict=True):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), width)):
                        part = ids[start : start + width]
                        row = [uid, doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part)]
                        if with_ids:
                            row.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
                            size += len(part)
                        rows.append(row)
                        uid += 1
                    if size > _BATCH_BYTES:
                        yield as_batch(rows)
                        rows, size = [], 0
                if rows:
                    yield as_batch(rows)

    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("t"))
    layout = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(run, layout + (", ids array<int>" if with_ids else ""))


class Packing:
    """Bins of item numbers. Fewer bins are better, then fuller ones."""

    __slots__ = ("bins", "lengths", "capacity")

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.bins, self.lengths, self.capacity = bins, lengths, capacity

    def loads(self) -> list[int]:
        return [sum(self.lengths[i] for i in b) for b in self.bins]

    def rank(self) -> tuple[int, float]:
        return len(self.bins), -sum((load / self.capacity) ** 2 for load in self.loads())

    def place(self, items: list[int]) -> None:
        """Each item, in the order given, goes where it leaves the least room."""
        room = sorted((self.capacity - load, k) for k, load in enumerate(self.loads()))
        for item in items:
            length = self.lengths[item]
            at = bisect_left(room, (length, -1))
            if at < len(room):
                left, k = room.pop(at)
                self.bins[k].append(item)
            else:
                left, k = self.capacity, len(self.bins)
                self.bins.append([item])
            insort(room, (left - length, k))

    def dissolve(self, chosen: set[int]) -> list[int]:
        """Removes bins; returns their items, largest first."""
        loose = [i for k in chosen for i in self.bins[k]]
        self.bins = [b for k, b in enumerate(self.bins) if k not in chosen]
        return sorted(loose, key=lambda i: (-self.lengths[i], i))

    def labels(self) -> np.ndarray:
        out = np.zeros(len(self.lengths), dtype=np.int32)
        for k, items in enumerate(self.bins):
            out[items] = k
        return out


def from_labels(labels: np.ndarray, lengths: list[int], capacity: int) -> Packing:
    bins: list[list[int]] = [[] for _ in range(int(labels.max()) + 1)]
    for item, k in enumerate(labels.tolist()):
        bins[k].append(item)
    return Packing(bins, lengths, capacity)


def crossed(a: Packing, b: Packing, random: np.random.Generator) -> Packing:
    """A child of `a` with about half of the well-filled bins of `b`."""
    loads = np.array(b.loads())
    full = np.flatnonzero(loads >= np.median(loads))
    chosen = full[random.random(len(full)) < 0.5]
    taken = [b.bins[k] for k in chosen.tolist()]
    held = {i for items in taken for i in items}
    kept, loose = [list(items) for items in taken], []
    for items in a.bins:
        if held.isdisjoint(items):
            kept.append(list(items))
        else:
            loose += [i for i in items if i not in held]
    child = Packing(kept, a.lengths, a.capacity)
    child.place(sorted(loose, key=lambda i: (-a.lengths[i], i)))
    return child


def mutated(parent: Packing, random: np.random.Generator) -> Packing:
    """The emptiest bin and a few others are opened and their items placed anew."""
    child = Packing([list(b) for b in parent.bins], parent.lengths, parent.capacity)
    chosen = {int(np.argmin(child.loads()))}
    chosen |= set(random.integers(0, len(child.bins), 4).tolist())
    loose = child.dissolve(chosen)
    child.place([loose[i] for i in random.permutation(len(loose))])
    return child


def evolve(
    lengths: list[int], seeds: list[np.ndarray], capacity: int, random: np.random.Generator
) -> list[Packing]:
    """An island's population, best first, after its generations."""
    least = -(-sum(lengths) // capacity)
    crowd = [from_labels(s, lengths, capacity) for s in seeds]
    largest_first = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    while len(crowd) < POPULATION:
        order = largest_first
        if crowd:  # near the decreasing order, each in its own way
            noisy = np.array(lengths) * random.uniform(0.8, 1.2, len(lengths))
            order = np.argsort(-noisy, kind="stable").tolist()
        crowd.append(Packing([], lengths, capacity))
        crowd[-1].place(order)
        if len(crowd[-1].bins) == least:
            break
    crowd.sort(key=Packing.rank)
    for _ in range(GENERATIONS):
        if len(crowd[0].bins) == least:
            break
        young = []
        for _ in range(max(1, len(crowd) // 2)):
            a, b = (min(random.integers(0, len(crowd), 2).tolist()) for _ in range(2))
            young += [crossed(crowd[a], crowd[b], random), mutated(crowd[a], random)]
        crowd = sorted(crowd + young, key=Packing.rank)[:POPULATION]
    return crowd


_STATE = "shard long, island int, uids array<long>, lengths array<long>, crowd array<array<int>>"


def _epoch(state: DataFrame, number: int, capacity: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            crowds, best = [], []
            for row in frame.itertuples():
                random = np.random.default_rng([row.shard, row.island, number])
                lengths = [int(x) for x in row.lengths]
                seeds = [np.asarray(s, dtype=np.int32) for s in row.crowd]
                found = evolve(lengths, seeds, capacity, random)
                crowds.append([p.labels() for p in found])
                best.append(found[0].rank())
            yield frame.assign(
                crowd=crowds, bins=[b for b, _ in best], fill=[-f for _, f in best]
            )

    return state.mapInPandas(run, _STATE + ", bins int, fill double")


def _pack_shards(items: DataFrame, shards: int, level: int, capacity: int) -> DataFrame:
    """The best packing of every shard: uid, length, shard, bin, place, emptiest."""
    item = F.struct("uid", "length")
    problem = (
        items.withColumn("shard", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(shards)))
        .groupBy("shard")
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
        .select(
            "shard",
            F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
            F.col("items.uid").alias("uids"),
            F.col("items.length").alias("lengths"),
            F.array().cast("array<array<int>>").alias("crowd"),
        )
    )
    state = staged(_epoch(problem, 0, capacity), "islands")
    for number in range(1, EPOCHS):
        elite = state.select(
            "shard",
            F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"),
            F.col("crowd")[0].alias("elite"),
        )
        joined = state.drop("bins", "fill").join(elite, ["shard", "island"])
        joined = joined.withColumn("crowd", F.concat("crowd", F.array("elite"))).drop("elite")
        state = staged(_epoch(joined, number, capacity), "islands")
    best = state.groupBy("shard").agg(
        F.max_by(
            F.struct("uids", "lengths", F.col("crowd")[0].alias("labels")),
            F.struct(-F.col("bins"), "fill", -F.col("island")),
        ).alias("best")
    )

    def lay(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                lengths = np.asarray(row.lengths, dtype=np.int64)
                labels = np.asarray(row.labels, dtype=np.int64)
                order = np.argsort(labels, kind="stable")
                ends = np.cumsum(lengths[order])
                loads = np.bincount(labels, weights=lengths).astype(np.int64)
                before = np.cumsum(loads) - loads
                emptiness = np.empty(len(loads), dtype=np.int64)
                emptiness[np.argsort(loads, kind="stable")] = np.arange(len(loads))
                yield pd.DataFrame(
                    {
                        "uid": np.asarray(row.uids, dtype=np.int64)[order],
                        "length": lengths[order],
                        "shard": row.shard,
                        "bin": labels[order],
                        "place": ends - lengths[order] - before[labels[order]],
                        "reopened": emptiness[labels[order]] < REOPENED_BINS,
                    }
                )

    flat = best.select("shard", "best.uids", "best.lengths", "best.labels")
    return flat.mapInPandas(
        lay, "uid long, length long, shard long, bin long, place long, reopened boolean"
    )


def best_fit(
    items: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS
) -> DataFrame:
    """Packs `items` (uid unique, length in 1..capacity): uid, sequence_id, offset."""
    full = items.where(F.col("length") == capacity)
    done = full.select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest, level = items.where(F.col("length") < capacity).select("uid", "length"), 0
    while True:
        count, tokens = rest.agg(F.count(F.lit(1)), F.sum("length")).first()
        if not count:
            break
        shards = min(-(-count // shard_items), -(-tokens // (SHARD_BINS * capacity)))
        packed = staged(_pack_shards(rest, shards, level, capacity), "packed")
        number = F.lit(level << 58) + F.shiftleft(F.col("shard"), 20) + F.col("bin")
        final = packed if shards == 1 else packed.where(~F.col("reopened"))
        done = done.union(final.select("uid", number, "place"))
        if shards == 1:
            break
        rest, level = packed.where("reopened").select("uid", "length"), level + 1
    return done


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    shard_items: int = SHARD_ITEMS,
    with_ids: bool = True,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for,
    ids."""
    tokenizer = tokenizer or tokenizer_file()
    cut = staged(pieces(docs, tokenizer, id_col, text_col, capacity, with_ids), "pieces")
    places = best_fit(cut.select("uid", "length"), capacity, shard_items)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return cut.join(places, "uid").select(*columns, *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """Training sequences of `pack`'s rows: sequence_id, ids (at most `capacity` of them)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
