"""Registered queries on matching, with their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import merge
from .html_queries import flat
from .rendered import _text, html_records, table, wiki_records


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, sf_dir, "part")
    return html_records(part), wiki_records(part)


def normalize_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    title = F.when(key % 17 == 0, F.lit(None)).otherwise(
        _text("  The ", F.col("text"), "\tan (", F.col("source"), ") A&B", key)
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", keys.normalize_title(title).alias("normalized_title")
    )


def normalize_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    year = (
        F.when(key % 6 == 0, F.lit(None))
        .when(key % 6 == 1, _text("c. ", 1950 + F.col("p_size"), "–", 2000 + F.col("p_size")))
        .when(key % 6 == 2, _text(1950 + F.col("p_size"), "s"))
        .when(key % 6 == 3, _text("1850, 2150 and 20", F.lpad(F.col("p_size").cast("string"), 2, "0")))
        .otherwise((1850 + F.col("p_size") * 3).cast("string"))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", keys.normalize_year(year).alias("normalized_year")
    )


def left_join_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    html, wiki = _sides(spark, sf_dir)
    joined = merge.left_join_keys(merge.with_keys(html), merge.with_keys(wiki))
    return joined.select(
        F.col("t.title").alias("html_title"),
        F.col("t.normalized_title").alias("normalized_title"),
        F.col("t.normalized_year").alias("normalized_year"),
        F.col("w.title").alias("wiki_title"),
        F.col("w.plot").alias("wiki_plot"),
    )


def merge_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(merge.merge_records(*_sides(spark, sf_dir)))


def merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_stats(*_sides(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (normalize_title, normalize_year, left_join_keys, merge_records, merge_stats)
}

_HTML = """
    SELECT 'The ' || p_name || ' (' || p_brand || ')' AS title, p_name AS normalized_title,
        CASE WHEN p_partkey % 10 <> 9 THEN 1950 + p_size END AS year,
        CASE WHEN p_partkey % 10 <> 9 THEN CAST(1950 + p_size AS VARCHAR) END AS normalized_year,
        p_brand, p_name, p_type, p_partkey
    FROM part"""
_WIKI = """
    SELECT CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE 'PART ' || p_partkey END || '!' AS title,
        CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE 'part ' || p_partkey END AS normalized_title,
        CASE WHEN p_partkey % 12 <> 0 THEN CAST(1950 + p_size AS VARCHAR) END AS normalized_year,
        p_brand AS country, CAST(p_partkey % 8 AS VARCHAR) AS num_seasons,
        CAST(p_size AS VARCHAR) AS num_episodes, '45 minutes' AS runtime, p_type AS network,
        CAST(p_partkey AS VARCHAR) AS plot
    FROM part WHERE p_partkey % 30 <> 0"""
_ON = "t.normalized_title = w.normalized_title AND t.normalized_year = w.normalized_year"

ORACLES = {
    "normalize_title": r"""
        SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN '' ELSE
            array_to_string(list_filter(list_transform(regexp_extract_all(regexp_replace(
                lower('  The ' || text || chr(9) || 'an (' || source || ') A&B' || doc_id),
                '\([^)]*\)', '', 'g'), '[\p{L}\p{N}]+|[^\p{L}\p{N}]+'),
                lambda x: CASE WHEN x IN ('the', 'a', 'an') THEN '' ELSE x END),
                lambda x: x <> ''), '') END AS joined,
            trim(regexp_replace(regexp_replace(joined, '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g'))
                AS normalized_title
        FROM documents""",
    "normalize_year": """
        SELECT p_partkey, CASE
            WHEN p_partkey % 6 = 1 THEN CAST(1950 + p_size AS VARCHAR)
            WHEN p_partkey % 6 = 3 THEN '20' || lpad(CAST(p_size AS VARCHAR), 2, '0')
            WHEN p_partkey % 6 IN (4, 5) AND 1850 + p_size * 3 BETWEEN 1900 AND 2099
                THEN CAST(1850 + p_size * 3 AS VARCHAR)
            END AS normalized_year
        FROM part""",
    "left_join_keys": f"""
        SELECT t.title AS html_title, t.normalized_title, t.normalized_year,
            w.title AS wiki_title, w.plot AS wiki_plot
        FROM ({_HTML}) t LEFT JOIN ({_WIKI}) w ON {_ON}""",
    "merge_records": f"""
        SELECT t.title, CAST(t.year AS INTEGER) AS year, p_brand AS certification,
            replace(p_name, ' ', '|') AS genres, CAST(p_partkey % 100 AS INTEGER) AS score,
            CASE WHEN p_partkey % 4 <> 0 THEN p_type ELSE '' END AS creator,
            'Ended' AS status, p_type AS type, 'English' AS language, p_brand AS keywords,
            CAST(p_partkey AS VARCHAR) AS "cast",
            country, num_seasons, num_episodes, runtime, network, plot
        FROM ({_HTML}) t JOIN ({_WIKI}) w ON {_ON}""",
    "merge_stats": f"""
        SELECT html_rows, wiki_rows, matched_rows,
            round(matched_rows / html_rows * 100, 1) AS match_rate
        FROM (SELECT count(*) AS html_rows FROM ({_HTML})),
            (SELECT count(*) AS wiki_rows FROM ({_WIKI})),
            (SELECT count(*) AS matched_rows FROM ({_HTML}) t JOIN ({_WIKI}) w ON {_ON})""",
}
ORACLES["normalize_title"] = (
    f"SELECT doc_id, normalized_title FROM ({ORACLES['normalize_title']})"
)
