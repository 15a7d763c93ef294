"""Nothing is lost or silently empty: line numbers, fresh streams, odd clauses, slow texts."""

import time

import pytest
from pyspark.sql import functions as F

from teledex.functions.entities import unescape_entities
from teledex.functions.wikitext import strip_comments, strip_tags
from teledex.operators.clauses import CLAUSE_SCHEMA, search_clauses
from teledex.operators.index import index_records
from teledex.schemas import MERGED_RECORD, WIKI_RECORD
from teledex.sources.jsonl import read_numbered_jsonl
from teledex.streaming.ingest import ingest, stream_html_files


def test_line_numbers_survive_other_splits_and_new_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part-{i}.json").write_text("".join(f'{{"title": "t{i}-{j}"}}\n' for j in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = read_numbered_jsonl(spark, str(tmp_path), WIKI_RECORD)
        want = {i * 5000 + j: f"t{i}-{j}" for i in range(3) for j in range(5000)}
        (tmp_path / "part-00.json").write_text('{"title": "late"}\n')
        for size in ("64k", "20k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert {r.doc_id: r.title for r in rows.collect()} == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_run_without_checkpoint_starts_over(spark, tmp_path):
    output = str(tmp_path / "out")
    for run in ("old", "new"):
        folder = tmp_path / run
        folder.mkdir()
        for i in range(3):
            (folder / f"{run}{i}.html").write_text(f"<p>{run}{i}</p>")
        ingest(stream_html_files(spark, str(folder), files_per_batch=2), output, keep=["path"]).awaitTermination()
        got = sorted(r.path.rsplit("/", 1)[-1] for r in spark.read.parquet(output).collect())
        assert got == [f"{run}{i}.html" for i in range(3)]


@pytest.fixture(scope="module")
def index(spark):
    rows = [(i, f"star number {i}") for i in range(12)]
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in MERGED_RECORD)
    titles = spark.createDataFrame(rows, "doc_id bigint, title string")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in MERGED_RECORD if f.name != "title"]
    assert "title" in names
    return index_records(titles.select("doc_id", "title", *nulls))


def test_a_wordless_must_clause_demands_nothing(spark, index):
    rows = [(1, 1, "must", "term", None, "star", None), (1, 2, "must", "term", None, "!!", None), (2, 1, "must", "phrase", None, "--", None), (2, 2, "should", "term", None, "star", None)]
    got = search_clauses(spark.createDataFrame(rows, CLAUSE_SCHEMA), index).groupBy("query_id").count().collect()
    assert sorted(map(tuple, got)) == [(1, 10), (2, 10)]


@pytest.mark.parametrize(("kind", "text"), [("wildcard", "*tar"), ("wildcard", "?tar"), ("prefix", ""), ("prefix", None)])
def test_patterns_without_a_literal_start_are_refused(spark, index, kind, text):
    rows = [(1, 1, "must", kind, None, text, None)]
    with pytest.raises(ValueError):
        search_clauses(spark.createDataFrame(rows, CLAUSE_SCHEMA), index).collect()


def seconds(spark, text, change):
    df = spark.createDataFrame([(text,)], "t string").select(change(F.col("t")).alias("x"))
    df.collect()
    began = time.perf_counter()
    df.collect()
    return time.perf_counter() - began


def test_unclosed_tags_and_comments_cost_little(spark):
    assert seconds(spark, "<a " * 350_000, strip_tags) < 3
    assert seconds(spark, "<!-- " * 200_000, strip_comments) < 3
    rows = spark.createDataFrame([("a<b>c</b> <i",), ("x > y",), ("none",), ("<a",), ("<!-- q --> r <!-- s",)], "t string")
    got = [tuple(r) for r in rows.select(strip_tags(F.col("t")), strip_comments(F.col("t"))).collect()]
    assert [g[0] for g in got[:4]] == ["ac <i", "x > y", "none", "<a"] and got[4][1] == " r <!-- s"


def test_unknown_names_cost_little(spark):
    known, unknown = "&amp;x " * 30_000, "&page=1 " * 30_000
    assert seconds(spark, unknown, unescape_entities) < 3 * seconds(spark, known, unescape_entities) + 1
