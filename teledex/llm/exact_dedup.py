"""Exact dedup on DataFrame functions alone.

Rows are grouped by a 128-bit hash of their normalised text; the smallest id of a group
stays. The texts behind each hash are compared byte by byte, by grouping on hash *and*
text: equal texts fold together in the map tasks, so a group with a third of all rows
costs one text a task. Hashes shared by different texts are grouped again by the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import content_hash, filled, spare

WHITE_SPACE = "[\\x20\\x09-\\x0D]+"


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space; null counts as empty."""
    return F.regexp_replace(filled(text), WHITE_SPACE, " ")


def _firsts(rows: DataFrame, *keys: str) -> DataFrame:
    """Per group its size and its first row by (id, row number). Null ids come last."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    return rows.groupBy(*keys).agg(F.count("*").alias("group_size"), first)


def _judged(rows: DataFrame, groups: DataFrame, *keys: str) -> DataFrame:
    """Rows with their group's answer. Only groups of several rows are joined."""
    several = groups.filter("group_size > 1")
    joined = rows.join(several, list(keys), "left")
    same = (F.col("row") == F.col("first.row")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    return joined.select(
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("first").isNull() | same).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "hash",
    )


def judge_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the
    normalised text) and hash.

    Null text is empty; empty texts are equal. Of rows that repeat even the id, exactly
    one is kept. A null id is kept only if its whole group has no id. An empty table gives
    an empty result; other columns are ignored.
    """
    text = normalised(F.col(text_col))
    own = [F.col(id_col).alias("doc_id"), hash_of(text).alias("hash"), F.unhex(F.sha2(text, 256)).alias("sha")]
    rows = materialize(docs.select(*own, F.monotonically_increasing_id().alias("row")), "hashes")
    texts = docs.select(hash_of(text).alias("hash"), text.alias("content")).groupBy("hash", "content").count()
    collided = materialize(texts.groupBy("hash").count().filter("count > 1").select("hash"), "collisions")
    judged = _judged(rows.join(collided, "hash", "left_anti"), _firsts(rows, "hash"), "hash")
    if collided.isEmpty():
        return judged
    again = docs.select(*own, text.alias("content"), F.monotonically_increasing_id().alias("row"))
    again = materialize(again.join(collided, "hash", "left_semi"), "collided-texts")
    return judged.unionByName(_judged(again, _firsts(again, "hash", "content"), "hash", "content"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns; see ``judge_duplicates``."""
    hash_, own = spare(docs, "hash", "own")
    judged = materialize(judge_duplicates(docs, id_col, text_col), "judged")
    # A struct of the id is never null itself: one plain key for both steps, which then move
    # the texts once.
    stay = judged.filter("kept").select(F.col("hash").alias(hash_), F.struct(F.col("doc_id").alias("id")).alias(own))
    hashed = docs.withColumns({hash_: content_hash(normalised(F.col(text_col))), own: F.struct(F.col(f"`{id_col}`").alias("id"))})
    rows = hashed.join(stay, [hash_, own], "left_semi")
    return rows.dropDuplicates([hash_, own]).select(*[f"`{c}`" for c in docs.columns])
