"""What the operators of this subpackage share: text folding, tables, staged results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.sinks.staging import delete

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Rows of a few numbers that a staged file holds, about, where their number is known.
FILE_ROWS = 1 << 18

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_own_roots: dict[str, str] = {}  # by application, for local sessions without the setting


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_ascii(text: Column) -> Column:
    """`text` with A-Z lower-cased and every other character as it is; null becomes empty.

    `lower` is enough for pure ASCII and much faster than `translate`; on other texts it would
    also change letters beyond A-Z.
    """
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def utf8(text: Column) -> Column:
    """The bytes of `text`; null becomes empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def byte_slices(
    batch: pa.RecordBatch, column: int, most_bytes: int, most_rows: int
) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with so many bytes in a text column at most, but for a single longer text."""
    lengths = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start, before = 0, 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(ends, before + most_bytes, side="right"))
        stop = min(max(stop, start + 1), start + most_rows)
        yield batch.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])


def hash_sample(df: DataFrame, key: Column, order: Column, most: int, rows: int) -> DataFrame:
    """`most` of the `rows` of `df`, those first by hash of `key` and then `order`.

    A bound on the hash leaves about twice as many before they are put in order, so what the
    tasks send for that does not grow with their number.
    """
    hashed = F.xxhash64(key, F.lit(1))
    if rows > 2 * most:
        bound = -(1 << 63) + int(2 * most / rows * (1 << 64))
        df = df.where(hashed < bound)
    return df.orderBy(hashed, order).limit(most)


def salt_of(column: Column, salts: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(salts)).cast("int")


def _bit(salt: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), salt)


def salts_seen(salt: Column) -> Column:
    """An aggregate of fixed width: a bit for each of the salts, 63 at most, that a group's rows have."""
    return F.bit_or(_bit(salt))


def per_salt(groups: DataFrame, bits: str, salt: str, salts: int) -> DataFrame:
    """`groups` once for each salt that their `bits` name, so that rows meet their group by key and salt."""
    named = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda s: F.col(bits).bitwiseAND(_bit(s)) != 0)
    return groups.withColumn(salt, F.explode(named)).drop(bits)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the session's shared one, deleted when the session ends."""
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    context = spark.sparkContext
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors can reach")
        if context.applicationId not in _own_roots:
            _own_roots[context.applicationId] = tempfile.mkdtemp(prefix="tiffin-llm-")
        root = _own_roots[context.applicationId]
    path = f"{root.rstrip('/')}/tiffin-llm/{uuid.uuid4().hex}/{name}"
    jvm = context._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def staged(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """`df` written to the shared folder and read back, so that later jobs and retries see the
    same rows and nothing is computed twice.

    With `rows`, about how many small rows there are, files are as few as these need and not one for
    each partition of a shuffle: a file costs its task requests, or processes, of the file system."""
    if rows is not None:
        df = df.coalesce(-(-max(rows, 1) // FILE_ROWS))
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstaged(df: DataFrame) -> None:
    """Delete the files of a staged frame that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        delete(df.sparkSession, folder)
