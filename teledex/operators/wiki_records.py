"""Wiki dump pages -> typed series records."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import wikitext as wt
from ..functions.regex import capture


def gate_pages(pages: DataFrame) -> DataFrame:
    """``(title, text)`` of the pages that pass the title, namespace and redirect tests.

    The three captures are generated as one struct and filtered there: a plain
    filter would be pushed below them and repeat the captures for every test.
    """
    page = F.col("page")
    parts = F.struct(
        capture(page, r"<title>(.+?)</title>").alias("title"),
        capture(page, r"<ns>(\d+)</ns>").alias("ns"),
        wt.page_text(page).alias("text"),
    )
    accepted = F.filter(
        F.array(parts),
        lambda p: p["text"].isNotNull() & wt.page_accepted(p["title"], p["ns"], p["text"]),
    )
    return pages.select(F.inline(accepted)).select("title", "text")


def classify_pages(titled: DataFrame) -> DataFrame:
    """Keep the series pages of ``(title, text)`` rows."""
    return titled.filter(wt.is_series(F.col("text")))


def with_infobox(titled: DataFrame, balanced: bool = False) -> DataFrame:
    """Add ``infobox``; rows without a closed, non-empty one are dropped.

    Generated for the same reason as in :func:`gate_pages`: one evaluation.
    """
    boxes = F.filter(
        F.array(wt.infobox_body(F.col("text"), balanced)), lambda box: F.coalesce(box, F.lit("")) != ""
    )
    return titled.select("title", "text", F.explode(boxes).alias("infobox"))


def infobox_fields(boxed: DataFrame) -> DataFrame:
    """The eight-field record from ``(title, text, infobox)`` rows."""
    box = F.col("infobox")
    names = ["country", "num_seasons", "num_episodes", "runtime", "network"]
    return boxed.select(
        "title", "text", wt.infobox_year(box).alias("year"), F.inline(F.array(wt.field_values(box, names)))
    ).select("title", "year", *names, wt.lead_paragraph(F.col("text")).alias("plot"))


def extract_wiki_records(pages: DataFrame, balanced: bool = False) -> DataFrame:
    """Dump pages -> records, in one narrow stage, cheapest tests first."""
    candidates = pages.filter(F.lower("page").contains(wt.INFOBOX_START_TEXT))
    return infobox_fields(with_infobox(classify_pages(gate_pages(candidates)), balanced))


def completeness(records: DataFrame) -> DataFrame:
    """Flags telling which fields of a record are useful, and how many."""
    flags = {
        "has_" + name: F.coalesce(F.col(name), F.lit("")) != ""
        for name in ("year", "country", "num_seasons", "num_episodes", "network")
    }
    flags["has_plot"] = F.coalesce(F.length("plot"), F.lit(0)) > wt.LEAD_MIN_LENGTH
    flagged = records.withColumns(flags)
    return flagged.withColumns(
        {
            "has_episode_data": F.col("has_num_seasons") | F.col("has_num_episodes"),
            "useful_count": reduce(add, [F.col(name).cast("int") for name in flags]),
        }
    )


def partition_counts(records: DataFrame) -> DataFrame:
    """Rows per task: ``(partition, rows)``; their sum is the total."""
    return records.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("rows")
    )
