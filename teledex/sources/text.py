"""Raw inputs: MediaWiki dumps and crawled HTML files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.regex import sub
from ..storage import listed

# --- Fixed values: names a dump is known by, the first that is there counts. ------
DUMP_NAMES = ["enwiki-latest-pages-articles.xml.bz2", "enwiki-latest-pages-articles.xml"]
DUMP_ENDINGS = (".xml", ".bz2", ".gz")
# --------------------------------------------------------------------------------


def find_dump(spark: SparkSession, folder: str) -> str:
    """Path of the one dump to read in a folder of any file system Spark knows: a known
    name, else the first by name of those that hold ``wiki`` and end like a dump. A dump
    is a file, or a folder of part files.

    One dump often lies there in several forms; reading each would repeat its pages.
    """
    names = listed(spark, folder)
    others = sorted(x for x in names if "wiki" in x.lower() and x.endswith(DUMP_ENDINGS))
    chosen = [x for x in DUMP_NAMES if x in names] or others
    if not chosen:
        raise FileNotFoundError(f"no wiki dump in {folder}")
    return f"{folder.rstrip('/')}/{chosen[0]}"


def split_pages(records: DataFrame) -> DataFrame:
    """``page`` of the records (``value``) of a text scan that ends them at ``<page>``."""
    record = F.col("value")
    body = F.substring_index(record, "</page>", 1)
    return records.filter(record.contains("</page>")).select(
        F.concat(F.lit("<page>"), body, F.lit("</page>")).alias("page")
    )


def read_wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``<page>…</page>`` of a dump (``.xml``, ``.bz2`` or ``.gz``).

    Records are delimited by the opening tag, so a page that spans input splits is
    read whole by exactly one task, and a page without a closing tag is dropped.

    A ``.gz`` file can't be split: one task unpacks it and finds its pages, which are then
    dealt to all, so that parsing them, the costly part, is not that task's too.
    """
    pages = split_pages(spark.read.option("lineSep", "<page>").text(path))
    return pages.repartition(F.xxhash64("page")) if path.endswith(".gz") else pages


def _unix_lines(text: Column) -> Column:
    return sub(text, r"\r\n?", "\n")


def html_rows(files: DataFrame) -> DataFrame:
    """``(path, html)`` from a whole-text scan, batch or streaming.

    Files that are not valid UTF-8 are skipped.
    """
    return files.filter(F.is_valid_utf8("value")).select(
        F.col("_metadata.file_path").alias("path"), _unix_lines(F.col("value")).alias("html")
    )


def read_html_files(spark: SparkSession, folder: str, glob: str = "*.html") -> DataFrame:
    """One row per HTML file. Executors read the files; vanished ones are skipped."""
    files = (
        spark.read.option("pathGlobFilter", glob)
        .option("ignoreMissingFiles", True)
        .text(folder, wholetext=True)
    )
    return html_rows(files)
