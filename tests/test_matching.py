"""Matching records: semantics, and plans that hold under skew."""

import pytest
from pyspark.sql import functions as F

from teledex.operators import merge
from teledex.schemas import HTML_RECORD, MERGED_RECORD, WIKI_RECORD


def html(spark, *rows):
    full = [(t, y, None, None, None, None, None, None, None, None, None) for t, y in rows]
    return spark.createDataFrame(full, HTML_RECORD)


def wiki(spark, *rows):
    return spark.createDataFrame([(t, y, None, None, None, None, None, p) for t, y, p in rows], WIKI_RECORD)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sides(spark):
    left = html(spark, ("The Show", 2001), ("Show (US)", 2001), ("Other", 2002), ("Null", None), ("The", 2001))
    right = wiki(
        spark, ("show", "c. 2001", "p1"), ("SHOW!", "2001", "p2"), ("null", None, "p3"), ("a", "2001", "p4"),
        ("Other", "2003", "p5"),
    )
    return left, right


def test_matches_fan_out_and_null_years_never_match(sides):
    merged = merge.merge_records(*sides)
    assert [f.name for f in merged.schema] == [f.name for f in MERGED_RECORD]
    assert [f.dataType for f in merged.schema] == [f.dataType for f in MERGED_RECORD]
    assert sorted((r.title, r.plot) for r in merged.collect()) == [
        ("Show (US)", "p1"), ("Show (US)", "p2"), ("The Show", "p1"), ("The Show", "p2"),
    ]
    assert all(r.genres == [] and r.cast == [] for r in merged.collect())


def test_left_join_keeps_unmatched(sides):
    joined = merge.left_join_keys(*map(merge.with_keys, sides))
    rows = sorted((r[0], r[1] or "") for r in joined.select("t.title", "w.plot").collect())
    assert rows == [
        ("Null", ""), ("Other", ""), ("Show (US)", "p1"), ("Show (US)", "p2"), ("The Show", "p1"),
        ("The Show", "p2"),
    ]


def test_stats(spark, sides):
    assert tuple(merge.merge_stats(*sides).first()) == (4, 4, 4, 100.0)
    assert tuple(merge.merge_stats(html(spark), wiki(spark)).first()) == (0, 0, 0, None)


def test_left_join_becomes_inner(sides):
    text = plan(merge.merge_records(*sides))
    assert "LeftOuter" not in text and "Inner" in text


@pytest.fixture
def confs(spark):
    saved = {}

    def set_all(**values):
        for key, value in values.items():
            name = "spark.sql." + key.replace("__", ".")
            saved.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_all
    for name, value in saved.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_hot_key_is_split_and_nothing_is_lost(spark, confs, tmp_path):
    """A third of all rows share one key; without broadcast the join splits it."""
    n = 60_000
    left = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "Hot").otherwise(F.concat(F.lit("t"), "id")).alias("title"),
        F.lit(2001).alias("year"),
        F.sha2(F.col("id").cast("string"), 256).alias("status"),
    )
    for field in HTML_RECORD:
        if field.name not in left.columns:
            left = left.withColumn(field.name, F.lit(None).cast(field.dataType))
    right = spark.range(n).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("T"), "id")).alias("title"),
        F.lit("2001").alias("year"),
        *[F.lit(None).cast("string").alias(f.name) for f in WIKI_RECORD if f.name not in ("title", "year")],
    )
    left.write.parquet(str(tmp_path / "l"))
    confs(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="100KB",
    )
    left = spark.read.parquet(str(tmp_path / "l"))
    merged = merge.merge_records(left, right)
    hot, rest = n // 3, n - n // 3
    rows = merged.collect()
    assert len(rows) == hot + rest
    assert "skew=true" in plan(merged)
    assert merge.merge_stats(left, right).first().matched_rows == hot + rest
