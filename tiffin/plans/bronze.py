"""Messages to typed rows (C1) and the late-data cut-off (D2). No shuffle, for batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tiffin import schemas, settings

#: What became of a message.
OUTCOME = "outcome"
ACCEPTED, LATE, NO_TIME, UNDECODABLE = "accepted", "late", "no_time", "undecodable"
_DAMAGED = "_damaged"


def decode_json(
    messages: DataFrame, schema: StructType | str, keep: Sequence[str] = ()
) -> DataFrame:
    """`value` (binary or text JSON) to columns, after the columns in `keep`.

    Text that is not JSON gives a row of NULLs.
    """
    text = F.col("value").cast("string")
    return messages.select(*keep, F.from_json(text, schema).alias("data")).select(*keep, "data.*")


def recent(
    df: DataFrame,
    time: str,
    as_of: Column | None = None,
    horizon: str = settings.LATE_DATA_HORIZON,
) -> DataFrame:
    """Rows no older than `horizon` before `as_of` (the query's clock by default); NULL drops."""
    return df.filter(F.col(time) >= _cut(as_of, horizon))


def _cut(as_of: Column | None, horizon: str = settings.LATE_DATA_HORIZON) -> Column:
    clock = F.current_timestamp() if as_of is None else as_of
    return clock - F.expr(f"interval {horizon}")


def bronze(messages: DataFrame, topic: str, as_of: Column | None = None) -> DataFrame:
    """Rows of one of the four topics, decoded and recent.

    The cut-off is applied to the decoded value: as a filter on rows Spark would push it below the
    decoding, and make and decode every message twice.
    """
    schema, time = schemas.MESSAGES[topic]
    data = F.array(F.from_json(F.col("value").cast("string"), schema))
    return messages.select(F.inline(F.filter(data, lambda row: row[time] >= _cut(as_of))))


def with_outcome(messages: DataFrame, topic: str, as_of: Column | None = None) -> DataFrame:
    """Every message once: its outcome, its text unless accepted, and its decoded columns.

    `bronze` takes what is accepted. The others are late, or have no time that can be read; of these a
    message that is not whole JSON of the topic's types is undecodable. Written by outcome
    (`ingest_to_files`), accepted and rejected messages part in one reading and one write.
    """
    schema, time = schemas.MESSAGES[topic]
    checked = StructType([*schema.fields, StructField(_DAMAGED, StringType())])
    decoded = F.from_json("message", checked, {"columnNameOfCorruptRecord": _DAMAGED})
    rows = messages.select(F.col("value").cast("string").alias("message")).withColumn("data", decoded)
    cut = _cut(as_of)
    at, damaged = F.col("data")[time], F.col("data")[_DAMAGED]
    unread = F.when(F.col("data").isNull() | damaged.isNotNull(), UNDECODABLE).otherwise(NO_TIME)
    outcome = F.when(at >= cut, ACCEPTED).when(at < cut, LATE).otherwise(unread)
    return rows.withColumn(OUTCOME, outcome).select(
        OUTCOME,
        F.when(F.col(OUTCOME) != ACCEPTED, F.col("message")).alias("message"),
        *[F.col("data")[name].alias(name) for name in schema.names],
    )


def accepted(stored: DataFrame, topic: str) -> DataFrame:
    """The bronze rows of a table written by outcome; the files of others are not opened."""
    return stored.where(F.col(OUTCOME) == ACCEPTED).select(*schemas.MESSAGES[topic][0].names)
