"""All registered queries, and the flagship job over the whole chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.html_records import extract_html_records
from ..operators.index import index_records
from ..operators.merge import merge_records
from ..operators.search import BOOSTS, hydrate, report, search
from ..operators.wiki_records import extract_wiki_records
from ..schemas import MERGED_RECORD
from ..sources.jsonl import read_numbered_jsonl, write_jsonl
from ..storage import new_path
from . import html_queries, merge_queries, search_queries, wiki_queries
from .rendered import html_pages, series_pages, table

_GROUPS = (html_queries, wiki_queries, merge_queries, search_queries)

QUERIES = {name: query for group in _GROUPS for name, query in group.QUERIES.items()}
ORACLES = {name: sql for group in _GROUPS for name, sql in group.ORACLES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: HTML pages and dump pages to records, matched, indexed, searched
    with one query per part type, and shown."""
    part = table(spark, sf_dir, "part")
    html = extract_html_records(html_pages(part), keep=["p_partkey"])
    wiki = extract_wiki_records(series_pages(part))
    path = new_path(spark, "merged")
    write_jsonl(merge_records(html, wiki), path)
    merged = read_numbered_jsonl(spark, path, MERGED_RECORD)
    queries = part.groupBy("p_type").agg(F.min("p_partkey").alias("query_id"))
    queries = queries.select("query_id", F.concat_ws(" ", "p_type", F.lit("plate ring")).alias("text"))
    hits = search(queries, index_records(merged), boosts=BOOSTS)
    return report(hydrate(hits, merged))
