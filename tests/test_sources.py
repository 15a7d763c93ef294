"""Readers, writers and the stream: nothing lost at splits, encodings and restarts."""

import bz2
import gzip
import json

import pytest
from pyspark.sql import functions as F

from teledex.operators.html_records import extract_html_records
from teledex.plans.rendered import html_pages, table, wiki_pages
from teledex.schemas import HTML_RECORD, WIKI_RECORD
from teledex.sources.jsonl import read_jsonl, read_numbered_jsonl, write_jsonl
from teledex.sources.text import DUMP_NAMES, find_dump, read_html_files, read_wiki_pages
from teledex.storage import materialize, new_path, shared_folder
from teledex.streaming.ingest import ingest, stream_html_files


@pytest.fixture(scope="module")
def dump(spark, sf_dir, tmp_path_factory):
    pages = [r.page.strip() for r in wiki_pages(table(spark, sf_dir, "documents")).collect()]
    text = "<mediawiki>\n <siteinfo/>\n  " + "\n  ".join(pages) + "\n</mediawiki>\n"
    folder = tmp_path_factory.mktemp("dump")
    (folder / "my-Wiki.xml").write_text(text, encoding="utf-8")
    (folder / "wiki.xml.bz2").write_bytes(bz2.compress(text.encode(), 1))
    (folder / "wiki.xml.gz").write_bytes(gzip.compress(text.encode()))
    (folder / "notes.txt").write_text("<page>no</page>")
    return folder, sorted(pages)


@pytest.mark.parametrize("name", ["my-Wiki.xml", "wiki.xml.bz2", "wiki.xml.gz"])
@pytest.mark.parametrize("split", [997, 40_000, 10_000_000])
def test_pages_survive_input_splits(spark, dump, name, split):
    if split == 997 and name.endswith("2"):
        split = 20_000
    folder, pages = dump
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        read = read_wiki_pages(spark, str(folder / name))
        if split < 1000 and name.endswith("xml"):
            assert read.rdd.getNumPartitions() > 100
        assert sorted(r.page for r in read.collect()) == pages
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_dump_is_chosen(spark, dump, tmp_path):
    folder, pages = dump  # the dump in three forms: each page comes once
    assert find_dump(spark, str(folder)).endswith("/my-Wiki.xml")
    assert sorted(r.page for r in read_wiki_pages(spark, find_dump(spark, str(folder))).collect()) == pages
    for name in ("a-wiki.gz", DUMP_NAMES[1], DUMP_NAMES[0]):  # each goes before those before it
        (tmp_path / name).write_text("")
        assert find_dump(spark, str(tmp_path)) == str(tmp_path / name)
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "wiki.txt").write_text("")
    with pytest.raises(FileNotFoundError):
        find_dump(spark, str(tmp_path / "empty"))


def test_packed_pages_are_dealt_to_all_tasks(spark, dump):
    folder, pages = dump
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        read = read_wiki_pages(spark, str(folder / "wiki.xml.gz"))
        parsed = read.select(F.spark_partition_id().alias("task"), F.length("page").alias("n"))
        assert parsed.select("task").distinct().count() > 4 and parsed.count() == len(pages)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_page_shapes(spark, tmp_path):
    path = tmp_path / "wiki.xml"
    path.write_text("<x><page>one</page><page>two\n</page>\n<page>broken\n<page>three</page> tail\n<page>cut off")
    pages = sorted(r.page for r in read_wiki_pages(spark, str(path)).collect())
    assert pages == ["<page>one</page>", "<page>three</page>", "<page>two\n</page>"]


def test_html_files(spark, tmp_path):
    (tmp_path / "a.html").write_bytes("é\r\nb\rc\n".encode())
    (tmp_path / "bad.html").write_bytes(b"\xff\xfe")
    (tmp_path / "c.txt").write_text("no")
    rows = read_html_files(spark, str(tmp_path)).collect()
    assert [(r.path.rsplit("/", 1)[1], r.html) for r in rows] == [("a.html", "é\nb\nc\n")]


def test_jsonl(spark, tmp_path):
    rows = [("é <b>", 1999, None, ["a"], None, [], None, None, None, None, ["x", "y"])]
    df = spark.createDataFrame(rows, HTML_RECORD)
    out = str(tmp_path / "out")
    assert write_jsonl(df, out, files=1) == 1
    assert write_jsonl(df, out, mode="append") == 1
    files = [p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("*.json")]
    line = next(text for text in files if text)
    assert json.loads(line)["certification"] is None and "é <b>" in line
    assert read_jsonl(spark, out, HTML_RECORD).collect() == df.collect() * 2
    (tmp_path / "blank.jsonl").write_text('\n{"title":"a"}\n\n  \n')
    assert read_jsonl(spark, str(tmp_path / "blank.jsonl"), WIKI_RECORD).count() == 1
    (tmp_path / "bad.jsonl").write_text('{"title":"a"}\n{"title":\n')
    with pytest.raises(Exception, match="FAILFAST|[Mm]alformed"):
        read_jsonl(spark, str(tmp_path / "bad.jsonl"), WIKI_RECORD).collect()


def test_line_numbers_follow_files_and_offsets(spark, tmp_path):
    expected, number = {}, 0
    for name in ("a", "b", "c"):
        lines = []
        for i in range(1000 if name != "b" else 37):
            blank = i % 7 == 3
            lines.append("" if blank else json.dumps({"title": f"{name}{i}", "plot": "x" * (i % 50)}))
            if not blank:
                expected[f"{name}{i}"] = number
            number += 1
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 5000)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        rows = read_numbered_jsonl(spark, str(tmp_path), WIKI_RECORD).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {r.title: r.doc_id for r in rows} == expected


def test_stream_equals_batch_in_batches_and_continues(spark, sf_dir, tmp_path):
    folder, output, checkpoint = tmp_path / "pages", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()
    pages = html_pages(table(spark, sf_dir, "part").filter("p_partkey < 14")).collect()
    for row in pages[:12]:
        (folder / f"{row.p_partkey}.html").write_text(row.html)

    def run():
        stream = stream_html_files(spark, str(folder), files_per_batch=5)
        query = ingest(stream, output, checkpoint, keep=["path"])
        query.awaitTermination()
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]

    assert run() == [5, 5, 2]
    for row in pages[12:]:
        (folder / f"{row.p_partkey}.html").write_text(row.html)
    assert run() == [len(pages) - 12]
    batch = extract_html_records(read_html_files(spark, str(folder)), keep=["path"])
    streamed = spark.read.parquet(output)
    order = lambda df: sorted(df.collect(), key=lambda r: r.path)
    assert order(streamed) == order(batch) and streamed.count() == len(pages)


class FakeSession:
    """A session with a given master and shared folder."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})


def test_shared_folder_is_the_one_the_session_names():
    assert shared_folder(FakeSession("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert new_path(FakeSession("yarn", "s://b/x/"), "t").startswith("s://b/x/t-")
    with pytest.raises(ValueError):
        shared_folder(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert shared_folder(local) == shared_folder(local)


def test_materialize(spark):
    df = spark.range(5).withColumn("x", F.lit("a"))
    kept = materialize(df, "t")
    assert sorted(kept.collect()) == sorted(df.collect()) and kept.columns == df.columns
    assert new_path(spark, "t") != new_path(spark, "t")
