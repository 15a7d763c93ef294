"""Registered queries on HTML extraction, with their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import keywords
from ..functions.regex import block_find_all, find_all, first_match, to_int
from ..operators.html_records import extract_html_records
from ..schemas import HTML_RECORD
from ..sources.jsonl import read_jsonl, write_jsonl
from ..sources.text import read_html_files
from ..storage import new_path
from ..streaming.ingest import ingest
from .rendered import html_pages, table


def flat(df: DataFrame, *columns: str) -> DataFrame:
    """Lists as text, so that results compare by value."""
    lists = {f.name for f in df.schema if f.dataType.typeName() == "array"}
    return df.select(
        *[F.array_join(c, "|").alias(c) if c in lists else F.col(c) for c in columns or df.columns]
    )


def html_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        first_match(html, r"<title>([^<]+)</title>").alias("title"),
        first_match(html, r'<html lang="([a-z]+)"').alias("lang"),
        to_int(first_match(html, r"track\((\d+)\)")).alias("track"),
        first_match(html, r"<nosuch>([^<]+)<").alias("missing"),
    )


def html_find_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = find_all(F.col("html"), r'<a href="([^"]+)"')
    return table(spark, sf_dir, "pages").select(
        "page_id", F.size(links).alias("n_links"), F.array_join(links, "|").alias("links")
    )


def html_block_find_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    nav = block_find_all(html, r"<nav>(.*?)</nav>", r">([^<]+)</a>", "s")
    none = block_find_all(html, r"<nosuch>(.*?)</nosuch>", r">([^<]+)</a>", "s")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.array_join(nav, "|").alias("nav_items"), F.size(none).alias("n_missing")
    )


def html_keywords_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_pages(table(spark, sf_dir, "part"))
    return flat(pages.select("p_partkey", keywords(F.col("html")).alias("keywords")))


def html_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_pages(table(spark, sf_dir, "part"))
    return flat(extract_html_records(pages, keep=["p_partkey"]))


def html_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of sixteen pages each, every file read back as one value."""
    folder = new_path(spark, "html")
    bundle = F.floor(F.col("page_id") / 16).alias("bundle")
    pages = F.sort_array(F.collect_list(F.struct("page_id", "html")))["html"]
    files = table(spark, sf_dir, "pages").groupBy(bundle).agg(F.array_join(pages, "\n").alias("value"))
    files.write.partitionBy("bundle").text(folder)
    scanned = read_html_files(spark, folder, "*.txt")
    return scanned.select(
        F.regexp_extract("path", r"bundle=(\d+)", 1).cast("bigint").alias("bundle"),
        F.length("html").cast("bigint").alias("n_chars"),
        F.md5("html").alias("digest"),
    )


def html_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "part").schema
    part = spark.readStream.schema(schema).option("pathGlobFilter", "part.parquet").parquet(sf_dir)
    output = new_path(spark, "ingested")
    query = ingest(html_pages(part), output, keep=["p_partkey"])
    query.awaitTermination()
    return flat(spark.read.parquet(output))


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "jsonl")
    write_jsonl(extract_html_records(html_pages(table(spark, sf_dir, "part"))), path)
    return flat(read_jsonl(spark, path, HTML_RECORD))


QUERIES = {
    f.__name__: f
    for f in (
        html_first_match,
        html_find_all,
        html_block_find_all,
        html_keywords_sentinel,
        html_record,
        html_scan,
        html_ingest_stream,
        jsonl_roundtrip,
    )
}

_KEYWORDS = "CASE WHEN p_partkey % 7 = 0 THEN '' ELSE replace(p_name, ' ', '|') END"
_RECORD = f"""
    p_name AS title, CAST(1950 + p_size AS INTEGER) AS year, p_brand AS certification,
    replace(p_name, ' ', '|') AS genres, CAST(p_size AS INTEGER) AS score,
    CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name END AS creator,
    CASE WHEN p_partkey % 2 = 0 THEN 'Ended' ELSE 'Returning Series' END AS status,
    p_type AS type,
    CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'English' END AS language,
    {_KEYWORDS} AS keywords, replace(p_name, ' ', '|') AS "cast"
"""

ORACLES = {
    "html_first_match": r"""
        SELECT page_id,
            regexp_extract_all(html, '<title>([^<]+)</title>', 1)[1] AS title,
            regexp_extract_all(html, '<html lang="([a-z]+)"', 1)[1] AS lang,
            TRY_CAST(regexp_extract_all(html, 'track\((\d+)\)', 1)[1] AS INTEGER) AS track,
            CAST(NULL AS VARCHAR) AS missing
        FROM pages""",
    "html_find_all": """
        SELECT page_id, CAST(len(links) AS INTEGER) AS n_links,
            array_to_string(links, '|') AS links
        FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]+)"', 1) AS links FROM pages)""",
    "html_block_find_all": """
        SELECT page_id,
            array_to_string(regexp_extract_all(
                regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '>([^<]+)</a>', 1), '|') AS nav_items,
            CAST(0 AS INTEGER) AS n_missing
        FROM pages""",
    "html_keywords_sentinel": f"SELECT p_partkey, {_KEYWORDS} AS keywords FROM part",
    "html_record": f"SELECT p_partkey, {_RECORD} FROM part",
    "html_scan": """
        SELECT bundle, CAST(length(html) AS BIGINT) AS n_chars, md5(html) AS digest
        FROM (SELECT CAST(page_id // 16 AS BIGINT) AS bundle,
                string_agg(html, chr(10) ORDER BY page_id) || chr(10) AS html
            FROM pages GROUP BY 1)""",
    "html_ingest_stream": f"SELECT p_partkey, {_RECORD} FROM part",
    "jsonl_roundtrip": f"SELECT {_RECORD} FROM part",
}
