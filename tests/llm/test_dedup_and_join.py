"""Exact dedup, n-gram join and components against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
from cases import passage, rows, table
from pyspark.sql import functions as F

from teledex.llm.common import bitmap, in_bitmap
from teledex.llm.components import components
from teledex.llm.exact_dedup import exact_dedup, judge_duplicates
from teledex.llm.ngram_join import near_dedup, near_groups
from teledex.llm.queries import ORACLES, QUERIES


def expected_duplicates(given):
    groups = defaultdict(list)
    for row in given:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", row[1] or "")].append(row[0])
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_exact_dedup_on_hard_rows(spark):
    got = judge_duplicates(table(spark)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == expected_duplicates(rows())
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1}
    stay = exact_dedup(table(spark))
    assert stay.columns == table(spark).columns and stay.count() == len(kept)


def test_exact_dedup_tells_collisions_apart(spark):
    given = rows()
    weak = judge_duplicates(table(spark), hash_of=lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 2), 2, "0")))
    got = sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in weak.collect()], key=str)
    assert got == expected_duplicates(given)


def test_exact_dedup_equals_sql(spark, sf_dir):
    want = duckdb.connect()
    want.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want.execute(ORACLES["op2_exact_dedup"])
    columns = [d[0] for d in want.description]
    got = QUERIES["op2_exact_dedup"](spark, sf_dir).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def shingle_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words)} if len(words) < k else {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute_groups(given, k, percent):
    sets = [shingle_set(t, k) for _, t in given]
    root = list(range(len(given)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (doc_id, _) in enumerate(given):
        if doc_id is not None and sets[i]:
            least[find(i)] = doc_id if least[find(i)] is None else min(least[find(i)], doc_id)
    return sorted([(d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(given)], key=str)


def near_rows():
    """Chains, a large group of near copies, and a passage that unlike texts share."""
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(400)]
    common = [rng.choice(vocabulary) for _ in range(30)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    given = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        given.append(" ".join(words))
    for i in range(60):
        given.append(" ".join(common + [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]))
    words = [rng.choice(vocabulary) for _ in range(80)]
    for i in range(25):  # each like the one before, ends unlike
        given.append(" ".join(words))
        words = words[2:] + [rng.choice(vocabulary) for _ in range(2)]
    return [(i, t) for i, t in enumerate(given)]


def test_near_groups_equal_brute_force(spark, sf_dir, monkeypatch):
    import teledex.llm.ngram_join as module

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    hard = [(r[0], r[1]) for r in rows()]
    for given, k, percent in ((docs, 4, 85), (near_rows(), 4, 85), (near_rows(), 5, 80), (hard, 4, 85)):
        df = spark.createDataFrame(given, "doc_id bigint, text string").repartition(4)
        got = sorted([tuple(r) for r in near_groups(df, k, percent).collect()], key=str)
        assert got == brute_groups(given, k, percent)
    monkeypatch.setattr(module, "CENTRES", 1)
    monkeypatch.setattr(module, "SMALL_GROUP", 3)
    monkeypatch.setattr(module, "FREQUENT", 8)
    df = spark.createDataFrame(near_rows(), "doc_id bigint, text string").repartition(4)
    got = sorted([tuple(r) for r in near_groups(df, 4, 85).collect()], key=str)
    assert got == brute_groups(near_rows(), 4, 85)


def test_near_groups_without_ids_or_with_one_for_all(spark):
    """Different texts under one id, or none, are documents of their own."""
    for given in ([(None, t) for _, t in near_rows()], [(i % 2, t) for i, t in near_rows()]):
        df = spark.createDataFrame(given, "doc_id bigint, text string").repartition(4)
        got = sorted([tuple(r) for r in near_groups(df, 4, 85).collect()], key=str)
        assert got == brute_groups(given, 4, 85)


def kept_by_brute_force(given, k, percent):
    """Rows that stay: of each group the smallest id, then the smallest digest of the row."""
    groups = brute_groups([(i, t) for i, (_, t) in enumerate(given)], k, percent)
    root = {i: r for i, _, r in groups}
    name = lambda row: hashlib.md5(f"{'null' if row[0] is None else row[0]} {row[1] or ''}".encode()).digest()
    best = {}
    for i, row in enumerate(given):
        if shingle_set(row[1], k):
            best[root[i]] = min(best.get(root[i], (True, 0, b"\xff" * 17)), (row[0] is None, row[0] or 0, name(row)))
    return sorted([r for i, r in enumerate(given) if not shingle_set(r[1], k) or best[root[i]][2] == name(r)], key=str)


def test_near_dedup_drops_rows_not_ids(spark):
    near = near_rows()
    for given in ([(None, t) for _, t in near], [(i % 3, t) for i, t in near], [(r[0], r[1]) for r in rows()] + near[:20] + [(None, near[0][1]), (0, near[150][1])]):
        df = spark.createDataFrame(given, "doc_id bigint, text string").repartition(4)
        assert sorted([tuple(r) for r in near_dedup(df).collect()], key=str) == kept_by_brute_force(given, 5, 80)


def test_near_dedup_keeps_columns_and_one_of_each_group(spark):
    df = table(spark, [(i, passage(1) + " " + passage(2) + (" tail" if i else ""), "s", i) for i in range(4)] + [(9, passage(5), "s", 1), (10, "", None, None)])
    stay = near_dedup(df)
    assert stay.columns == df.columns
    assert sorted(r.doc_id for r in stay.collect()) == [0, 9, 10]


def test_empty_tables(spark):
    empty = table(spark, rows()[:1]).limit(0)
    assert judge_duplicates(empty).count() == near_groups(empty).count() == near_dedup(empty).count() == exact_dedup(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(1, 40)] + [(305, 301), (301, 303), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{200 + i: 200 for i in range(1, 40)}, 305: 301, 303: 301}


def test_exact_dedup_moves_texts_once(spark):
    """The rows that stay and, of equal ones, one are found in the same place."""
    given = [(1, "a b"), (1, "a  b"), (2, "a b"), (None, "c"), (None, "c"), (3, None), (4, "")]
    docs = table(spark, [(i, t, "s0", 1) for i, t in given])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = exact_dedup(docs)
        assert kept._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 2  # texts, ids
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 3), (True, 0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bitmap_is_fetched_by_few_jobs_whatever_the_partitions(spark):
    values = spark.range(0, 70_000, 7).select((F.col("id") * 1_000_003).alias("x"))
    names = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        spark.sparkContext.setJobGroup("bitmap", "bitmap")
        known = bitmap(values, "x")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("bitmap")
    finally:
        spark.sparkContext.setJobGroup("", "")
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert 0 < len(jobs) <= 8  # an iterator over partitions ran a job for each
    assert in_bitmap(np.arange(0, 70_000, 7) * 1_000_003, known).all()
    places = np.unique(np.arange(0, 70_000, 7) * 1_000_003 & (len(known) * 32 - 1))
    assert np.bitwise_count(known).sum() == len(places)
