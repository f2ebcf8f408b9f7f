"""A corpus pipeline of five operators of tiffin.llm, each applied to what the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns the columns of `docs`, but for the last one, which
returns packed pieces. Null values, empty and repeated rows and other columns are treated as the
operators' docstrings say; no stage looks at a row's id or position to decide on its text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import exact_dedup, language, mixing, near_copies, packing
from tiffin.llm.common import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document whose main language has less than this share is rejected, as is one without letters.
MIN_LANGUAGE_SHARE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language was found or none is dominant."""
    model = language.train(docs)
    names = {"lang": "__lang_pred", "score": "__lang_score", "shares": "__lang_shares"}
    found = language.predict(docs, model, **names)
    rejected = (F.col("__lang_pred") == language.UNDETERMINED) | (F.col("__lang_score") < MIN_LANGUAGE_SHARE)
    return found.where(~rejected).drop(*names.values())


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the one with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked near copies stays: the one with the smallest id."""
    return near_copies.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say: none, one or several rows for each."""
    found = mixing.mixed(docs, table(spark, sf_dir, "labels"))
    return mixing.drawn(found, docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's pieces and their places in sequences."""
    return packing.pack(docs, with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mix),
    ("packing", pack),
]

#: Trained models, similarity searches and a genetic algorithm cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
