"""Folders for what a job writes on its way, under the one that the cluster shares."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staging_root(spark: SparkSession) -> str:
    """The session's checkpoint folder, set by configuration or call, else one in the warehouse."""
    root = spark.conf.get(_SETTING, None)
    if not root:
        chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = chosen.get() if chosen.isDefined() else spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder for `name`, deleted when the session ends."""
    folder = f"{staging_root(spark)}/tiffin/{uuid.uuid4().hex}"
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return f"{folder}/{name}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def kept(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """`df` written to the shared folder and read back, for several uses; deleted behind the block."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run in the block delete their shuffle files as they end, instead of when the driver's garbage is
    collected; so a run of many jobs needs the disk of one."""
    before = spark.conf.get(_SHUFFLE_CLEANUP)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)
