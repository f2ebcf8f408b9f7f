"""Exact duplicates, combined in three steps that no group of copies can overload.

Texts are equal when they are identical after lower-casing A-Z; a null text counts as empty. Every
step groups by the whole text, not only by its digest:

1. each task merges the equal texts of its own input (partial aggregation before the shuffle);
2. groups of (digest, salt, text) are merged, the salt being a hash of the id, so that the copies of
   one text meet in `salts` places;
3. the winners of the salts are merged by (digest, text), with a bit for each salt that they came from.

The way back is salted too: a group's result is repeated for the salts that its bits name, which is
once for a text of one document, and a document meets it by digest and salt. Where step 3 saw several
texts for a digest, its documents are matched by digest, salt and text. So a collision costs time and
never merges different texts. Only rows that repeat both id and text share one place.

Defined results: null and empty texts form one group. The largest doc_id of a group stays; null is
smaller than any id. If rows repeat both doc_id and text, one of them stays. An empty table gives
no rows. Other columns of the input, whatever their names, take no part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiffin.llm.common import fold_ascii, per_salt, salt_of, salts_seen, staged, table

SALTS = 16
_ID, _TEXT, _DIGEST, _COPY = "__dedup_id", "__dedup_text", "__dedup_digest", "__dedup_copy"
_SALT, _BITS = "__dedup_salt", "__dedup_bits"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _groups(keyed: DataFrame) -> DataFrame:
    """One row per different text: digest, text, largest id, number of rows, salts that it has."""
    return (
        keyed.groupBy(_DIGEST, _SALT, _TEXT)
        .agg(F.max(_ID).alias("top"), F.count(F.lit(1)).alias("n"))
        .groupBy(_DIGEST, _TEXT)
        .agg(
            F.max("top").alias("keep_id"),
            F.sum("n").alias("group_size"),
            salts_seen(F.col(_SALT)).alias(_BITS),
        )
    )


def _winners(keyed: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Per digest: keep_id, group_size and salts; and, if digests collide, the same per (digest, text)."""
    groups = _groups(keyed)
    per_digest = staged(
        groups.groupBy(_DIGEST).agg(
            F.count(F.lit(1)).alias("texts"),
            F.max("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
            F.bit_or(_BITS).alias(_BITS),
        ),
        "digests",
    )
    collided = per_digest.where("texts > 1").select(_DIGEST)
    alone = per_digest.where("texts = 1").drop("texts")
    if collided.isEmpty():
        return alone, None
    exact = _groups(keyed.join(collided, _DIGEST, "left_semi"))
    return alone, exact


def _keyed(docs: DataFrame, id_col: str, text_col: str, salts: int, digest: Callable) -> DataFrame:
    text = fold_ascii(docs[text_col])
    salt = salt_of(docs[id_col], salts)
    return docs.withColumns({_ID: docs[id_col], _SALT: salt, _TEXT: text, _DIGEST: digest(text)})


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """Per row of `docs`: doc_id, keep_id, group_size, kept, digest. `salts` are 63 at most."""
    keyed = _keyed(docs, id_col, text_col, salts, digest).select(_ID, _SALT, _TEXT, _DIGEST)
    alone, exact = _winners(keyed)

    def found(rows: DataFrame, winners: DataFrame, keys: list[str]) -> DataFrame:
        # An id has one salt, so its copies are already where the join has put them.
        copies = Window.partitionBy(*keys, _ID).orderBy(_ID)
        joined = rows.join(per_salt(winners, _BITS, _SALT, salts), keys).withColumn(_COPY, F.row_number().over(copies))
        return joined.select(
            F.col(_ID).alias("doc_id"),
            "keep_id",
            "group_size",
            (F.col(_ID).eqNullSafe(F.col("keep_id")) & (F.col(_COPY) == 1)).alias("kept"),
            F.col(_DIGEST).alias("digest"),
        )

    rows = found(keyed.drop(_TEXT), alone, [_DIGEST, _SALT])
    return rows if exact is None else rows.union(found(keyed, exact, [_DIGEST, _SALT, _TEXT]))


def drop_exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Of rows that repeat doc_id and text,
    the first by the other columns' hash stays."""
    keyed = _keyed(docs, id_col, text_col, salts, digest)
    alone, exact = _winners(keyed.select(_ID, _SALT, _TEXT, _DIGEST))
    order = F.xxhash64(*[docs[c] for c in docs.columns]) if docs.columns else F.lit(0)

    def one_each(rows: DataFrame, winners: DataFrame, keys: list[str]) -> DataFrame:
        top = winners.select(*keys, F.col("keep_id").alias("__dedup_top"))
        same = [rows[k] == top[k] for k in keys]
        same.append(rows[_ID].eqNullSafe(top["__dedup_top"]))
        copies = Window.partitionBy(*[rows[k] for k in keys], rows[_ID]).orderBy("__dedup_order")
        return (
            rows.join(top, same, "left_semi")
            .withColumn(_COPY, F.row_number().over(copies))
            .where(F.col(_COPY) == 1)
            .select(docs.columns)
        )

    rows = keyed.withColumn("__dedup_order", order)
    found = one_each(rows.drop(_TEXT), alone, [_DIGEST])
    return found if exact is None else found.union(one_each(rows, exact, [_DIGEST, _TEXT]))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("digest", "text_sha256")


OP3_SQL = """
WITH folded AS (
  SELECT doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM folded
WINDOW same AS (PARTITION BY t)
"""
