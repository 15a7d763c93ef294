"""Match HTML records with wiki records on normalized title and year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import normalize_title, normalize_year
from ..schemas import HTML_RECORD, WIKI_ADDITIONS

KEYS = ["normalized_title", "normalized_year"]


def with_keys(records: DataFrame) -> DataFrame:
    """Add the two key columns; rows whose title key is empty are dropped."""
    return records.withColumns(
        {
            KEYS[0]: normalize_title(F.col("title")),
            KEYS[1]: normalize_year(F.col("year")),
        }
    ).filter(F.col(KEYS[0]) != "")


def left_join_keys(html: DataFrame, wiki: DataFrame) -> DataFrame:
    """Every HTML record with each wiki record of the same key; a null year never
    matches, and several wiki records of one key each give a row.

    Both sides come with keys (:func:`with_keys`). Columns of a side are reached as
    ``t.<name>`` and ``w.<name>``.
    """
    t, w = html.alias("t"), wiki.alias("w")
    same = [F.col(f"t.{k}") == F.col(f"w.{k}") for k in KEYS]
    return t.join(w, same[0] & same[1], "left")


def merge_records(html: DataFrame, wiki: DataFrame) -> DataFrame:
    """Matched records: the HTML fields plus the wiki additions, null lists as empty.

    The filter on the wiki title lets the optimizer turn the join into an inner one.
    """
    matched = left_join_keys(with_keys(html), with_keys(wiki)).filter(F.col("w.title").isNotNull())
    columns = []
    for field in HTML_RECORD:
        value = F.col(f"t.{field.name}")
        if field.dataType.typeName() == "array":
            value = F.coalesce(value, F.array().cast(field.dataType))
        columns.append(value.alias(field.name))
    return matched.select(*columns, *[F.col(f"w.{name}").alias(name) for name in WIKI_ADDITIONS])


def merge_stats(html: DataFrame, wiki: DataFrame) -> DataFrame:
    """One row: both totals, matched rows, and the match rate in % of HTML records.

    Counts per key are taken before the join, so no matched pair is ever built and a
    hot key is a single row.
    """

    def key_counts(records: DataFrame, name: str) -> DataFrame:
        return with_keys(records).groupBy(KEYS).agg(F.count(F.lit(1)).alias(name))

    counts = key_counts(html, "html").join(key_counts(wiki, "wiki"), KEYS, "full")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    totals = counts.agg(
        total(F.col("html")).alias("html_rows"),
        total(F.col("wiki")).alias("wiki_rows"),
        total(F.col("html") * F.col("wiki")).alias("matched_rows"),
    )
    rate = F.round(F.col("matched_rows") / F.nullif("html_rows", F.lit(0)) * 100, 1)
    return totals.withColumn("match_rate", rate)
