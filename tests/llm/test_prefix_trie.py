"""The prefix trie against brute force: hard rows, small blocks, many forests, SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from teledex.llm import prefix_trie as module
from teledex.llm.prefix_trie import prefix_trie, sequences, with_shared_heads
from teledex.llm.queries import ORACLES, QUERIES

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(rows):
    """conv_id -> turns (role, text), in the order the operator states."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        if conv is not None:
            digest = hashlib.md5(f"{len(role.encode())} {role}{text}".encode()).hexdigest()
            found[conv].append(((turn is not None, turn or 0, role, digest), (role, text)))
    return {c: tuple(t for _, t in sorted(x)) for c, x in found.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c / 100) * 100  # the remainder of truncated division
        out[c] = convs.get(c - base, ())[:h] + turns[h:]
    return out


def trie_rows(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, own in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(own) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(own), len(path), parent, len(own), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def hard_rows():
    rng = random.Random(3)
    say = ["hi", "héllo \U0001f600", "", "ok", "why"]
    rows = []
    for c in [*range(60), *range(100, 160), 305, 306, -7, -120]:
        for t in range(rng.choice((0, 1, 1, 2, 3, 5, 9))):
            rows.append((c, t, rng.choice(("user", "assistant")), rng.choice(say[: 1 + t % 5])))
    rows += [(400 + i, t, "user", f"same {t}") for i in range(80) for t in range(7)]  # copies
    rows += [(600, None, None, None), (600, None, "user", None), (600, 0, None, "x"), (600, 0, None, "x"), (600, 0, "a", "y")]
    rows += [(None, 0, "user", "lost"), (None, None, None, None), (700, 3, "user", "long " * 40_000)]
    rows += [(800, t, "user", str(t % 3)) for t in range(500)] + [(801, t, "user", str(t % 3)) for t in range(450)]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame([(*r, 1, "k", "d") for r in rows], "conv_id bigint, turn bigint, role string, text string, n bigint, key string, depth string")
    return df.repartition(5)


def got(df):
    return sorted([tuple(r) for r in df.select(*COLUMNS).collect()], key=str)


@pytest.mark.parametrize("block, group", [(20_000, 64), (3, 2)])
def test_equals_brute_force(spark, block, group):
    df = frame(spark, hard_rows())
    convs = sequences(df)
    assert got(prefix_trie(convs, block, group)) == trie_rows(conversations(hard_rows()))
    conv = F.col("conv_id")
    again = with_shared_heads(convs, conv - conv % 100, (F.crc32(conv.cast("string").cast("binary")) % 6).cast("int"), 5)
    assert got(prefix_trie(again, block, group)) == trie_rows(rebuilt(conversations(hard_rows())))


def test_any_cut_into_blocks_and_forests_gives_the_same_nodes():
    convs = {c: tuple(x[1] for x in t) for c, t in conversations(hard_rows()).items() if len(t) < 30}
    paths = sorted((b"".join(hashlib.md5(x.encode()).digest() for x in t), c, [len(x) for x in t]) for c, t in convs.items())

    def run(cuts):
        rows, forests = [], []
        for a, b in zip([0, *cuts], [*cuts, len(paths)]):
            items = [module._Path(p, n, {len(n): module._Node(1, c, ids=[c])}) for p, c, n in paths[a:b]]
            if items:
                forests += module._read(module._spines(module._merged(items, False, rows), 0))
        module._merged(forests, True, rows)
        return sorted([(r["conv_id"], r["depth"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) for r in rows if "depth" in r])

    want = run([])
    rng = random.Random(1)
    for _ in range(40):
        assert run(sorted(rng.sample(range(1, len(paths)), rng.randint(1, 60)))) == want


def test_turnless_and_empty(spark):
    empty = frame(spark, hard_rows()[:1]).limit(0)
    assert prefix_trie(sequences(empty)).count() == 0
    only = spark.createDataFrame([(5, []), (4, [])], "conv_id bigint, turns array<struct<digest:string,chars:bigint>>")
    assert got(prefix_trie(only)) == trie_rows({4: (), 5: ()})


def test_query_equals_brute_force_and_sql(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = got(QUERIES["op13_prefix_trie"](spark, sf_dir))
    assert found == trie_rows(rebuilt(conversations(rows)))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    assert found == sorted(db.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op13_prefix_trie']})").fetchall(), key=str)
