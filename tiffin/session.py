"""Spark session and catalog settings, in one place for every job."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

ENGINE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Two days of message keys do not fit on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


@dataclass(frozen=True)
class CatalogBinding:
    """A table catalog registered under `name`; options are passed through as given.

    Object-store credentials belong in the cluster's credential provider, not here.
    """

    name: str
    warehouse: str
    implementation: str = "org.apache.iceberg.spark.SparkCatalog"
    kind: str = "hadoop"
    options: dict[str, str] = field(default_factory=dict)

    def settings(self) -> dict[str, str]:
        prefix = f"spark.sql.catalog.{self.name}"
        return {
            prefix: self.implementation,
            f"{prefix}.type": self.kind,
            f"{prefix}.warehouse": self.warehouse,
            **self.options,
        }


#: More shuffle partitions than this cost the driver more than they spare the tasks.
MAX_SHUFFLE_PARTITIONS = 100_000


def shuffle_partitions(input_bytes: int, bytes_per_task: int = 256 << 20) -> int:
    """Initial shuffle width for a job that reads `input_bytes`; AQE merges what is too small, and
    splits what is too large beyond the widest."""
    return min(MAX_SHUFFLE_PARTITIONS, max(8, -(-input_bytes // bytes_per_task)))


def build_session(
    app: str,
    catalog: CatalogBinding | None = None,
    input_bytes: int | None = None,
    **settings: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    merged = dict(ENGINE_SETTINGS)
    if input_bytes is not None:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    if catalog is not None:
        merged.update(catalog.settings())
    merged.update(settings)
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
