"""Suffix arrays, repeated byte strings and vector links against brute force."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from cases import passage, rows, table

from teledex.llm import embedding_pairs, suffix_dedup
from teledex.llm.embedding_pairs import near_vectors
from teledex.llm.queries import QUERIES
from teledex.llm.suffix_arrays import permuted_lcp, suffix_array
from teledex.llm.suffix_dedup import LENGTH, anchors, cut_repeats


def test_suffix_arrays_equal_sorted_suffixes():
    rng = np.random.default_rng(3)
    for _ in range(150):
        s = np.append(rng.integers(1, rng.integers(2, 5), rng.integers(0, 70)), 0)
        sa = suffix_array(s)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        lcp = permuted_lcp(s, sa)
        for a, b in zip(sa, sa[1:]):
            x, y = s[a:], s[b:]
            n = min(len(x), len(y))
            differs = np.flatnonzero(x[:n] != y[:n])
            assert lcp[b] == (differs[0] if len(differs) else n)


def test_anchors_depend_on_the_string_alone():
    rng = random.Random(1)
    data = bytes(rng.choice(b"abcd") for _ in range(1500))
    hashes, first, count = anchors(data)
    assert count.sum() == len(data) - LENGTH + 1 and (np.diff(first) == count[:-1]).all()
    at = {p: h for h, f, c in zip(hashes, first, count) for p in range(f, f + c)}
    for p in range(0, 1300, 97):
        assert anchors(data[p : p + LENGTH])[0].tolist() == [at[p]]


def test_places_left_out_of_arrays_are_not_repeated():
    rng = random.Random(5)
    base = bytes(rng.choice(b"abcdefgh ") for _ in range(3000))
    texts = [base]
    for _ in range(12):  # copies of stretches of the base, with changes a few hundred bytes apart
        own = bytearray(base[rng.randrange(1200) : 1600 + rng.randrange(1400)])
        for i in range(rng.randrange(150, 400), len(own), rng.randrange(210, 500)):
            own[i] = ord("#")
        texts.append(bytes(own))
    rows_ = sorted({(a, t[f : f + n + LENGTH - 1], at) for t in texts for a, f, n, at in zip(*(x.tolist() for x in suffix_dedup._anchored(t)))})
    data = [d for _, d, _ in rows_]
    parts = suffix_dedup.shared_parts([a for a, _, _ in rows_], data, [at for _, _, at in rows_])
    got = [np.zeros(len(d) - LENGTH + 1, bool) for d in data]
    for (i, low, high), marks in zip(parts, suffix_dedup.mark_repeats([data[i][a : b + LENGTH] for i, a, b in parts])):
        assert not got[i][low : high + 1].any()
        got[i][low : high + 1] = marks
    assert sum(b - a + 1 for _, a, b in parts) < sum(map(len, got))
    assert sum(x.sum() for x in got) > 0
    assert all((a == b).all() for a, b in zip(got, suffix_dedup.mark_repeats(data)))


@pytest.mark.parametrize("letters", [b"abcdefgh ", b"ab"])
def test_arrays_hold_cores_as_letters(letters, monkeypatch):
    rng = random.Random(7)
    base = bytes(rng.choice(letters) for _ in range(2500))
    texts = [base, b"a" * 700, b"ab" * 300]
    for _ in range(15):
        own = bytearray(base[rng.randrange(900) : 1400 + rng.randrange(1100)])
        for i in range(rng.randrange(150, 400), len(own), rng.randrange(205, 500)):
            own[i] = ord("#")
        texts.append(bytes(own))
    rows_ = sorted({(a, t[f : f + n + LENGTH - 1], at) for t in texts for a, f, n, at in zip(*(x.tolist() for x in suffix_dedup._anchored(t)))})
    keys, data, at = map(list, zip(*rows_))
    sizes, sort = [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda s: (sizes.append(len(s)), sort(s))[1])
    want = suffix_dedup.mark_repeats(data)
    parts = suffix_dedup.shared_parts(keys, data, at)
    suffix_dedup.mark_repeats([data[i][a : b + LENGTH] for i, a, b in parts])
    got = [np.zeros(len(d) - LENGTH + 1, bool) for d in data]
    for i, low, marks in suffix_dedup.zone_repeats(keys, data, at):
        got[i][low : low + len(marks)] = marks
    assert sum(x.sum() for x in want) > 0 and all((a == b).all() for a, b in zip(got, want))
    assert sizes[2] < 0.8 * sizes[1]  # letters in the arrays: with cores folded, and without
    assert suffix_dedup.zone_repeats([], [], []) == []


def test_anchors_of_texts_found_together(monkeypatch):
    rng = random.Random(9)
    texts = [bytes(rng.choice(b"abcd") for _ in range(n)) for n in (0, 199, 200, 201, 5000, 30, 1000, 200, 0)] + [b"a" * 600] * 2
    alone = [suffix_dedup._anchored(t) for t in texts]
    for block, chunk in ((1, 1 << 22), (1500, 1 << 22), (1 << 16, 1 << 22), (1 << 16, 700)):
        monkeypatch.setattr(suffix_dedup, "_BLOCK", block)
        monkeypatch.setattr(suffix_dedup, "_CHUNK", chunk)
        number, *found = suffix_dedup._anchored_texts(texts)
        for i, own in enumerate(alone):
            spread = [np.repeat(h, c) for h, c in ((own[0], own[2]), (found[0][number == i], found[2][number == i]))]
            assert spread[0].tolist() == spread[1].tolist()  # a piece may split a run
    assert len(suffix_dedup._anchored_texts([])[0]) == len(suffix_dedup._anchored_texts([b"x"])[0]) == 0


def brute_cut(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + LENGTH] for d in data for i in range(len(d) - LENGTH + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - LENGTH + 1):
            if seen[d[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(d), int(gone.sum()), runs, bytes(b for b, g in zip(d, gone) if not g)))
    return out


@pytest.mark.parametrize("many", [suffix_dedup.MANY_SEGMENTS, 2])
def test_cut_equals_brute_force(spark, sf_dir, many, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MANY_SEGMENTS", many)
    docs = [(r.doc_id, r.text, "s", 1) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    shared = " ".join(passage(i, 30) for i in range(8))
    docs += [(1000 + i, f"{passage(i + 20, 30)} {shared[i * 11 : 700 + i * 7]} {passage(i + 40, 20)}", "s", 1) for i in range(12)]
    docs += [(2000, "a" * 900, "s", 1), (2001, "ab" * 300 + "c", "s", 1), (2002, "x" * 199, "s", 1), (2003, "x" * 199, "s", 1), (2004, "y" * 200, "s", 1), (2005, "y" * 200, "s", 1)]
    for given in (docs, rows()):
        got = cut_repeats(table(spark, given)).collect()
        key = lambda x: (str(x[0]), x[1:])
        want = [(r[0], *x) for r, x in zip(given, brute_cut([r[1] for r in given]))]
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=key) == sorted(want, key=key)
    assert cut_repeats(table(spark).limit(0)).count() == 0


def brute_links(vectors, cosine=0.95):
    unit = np.array(vectors, float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    return unit @ unit.T >= cosine


def test_vector_links(spark):
    sf = "/root/testdata/sf0.01"
    data = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    got = {r.vec_id: r for r in QUERIES["op8_embedding_pairs"](spark, sf).collect()}
    near = brute_links([r.embedding for r in data])
    want = {r.vec_id: int(n) - 1 for r, n in zip(data, near.sum(axis=1))}
    assert set(got) == set(want) and all(got[i].n_links <= n for i, n in want.items())
    assert sum(r.n_links for r in got.values()) >= 0.9 * sum(want.values())
    assert all(r.kept == (r.vec_id == r.component_id) and r.component_id <= r.vec_id for r in got.values())


def test_vector_links_on_hard_rows(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=8)
    given = [(i, [float(x) for x in base + rng.normal(size=8) * 0.01]) for i in range(40)]
    given += [(100 + i, [float(x) for x in -base]) for i in range(300)] + [(100, [float(x) for x in -base])]
    given += [(500, None), (501, [0.0] * 8), (502, [float("nan")] * 8), (503, [1.0, None] + [0.0] * 6), (504, [float("inf")] + [1.0] * 7), (505, []), (None, [float(x) for x in -base]), (506, [1.0, 2.0]), (507, [1.0, 2.0])]
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in given], "vec_id bigint, embedding array<double>, c int, root string")
    got = near_vectors(df).collect()
    by = defaultdict(list)
    for r in got:
        by[r.vec_id].append(r)
    assert len(got) == len(given)
    assert all(by[i][0].n_links == 39 and by[i][0].component_id == 0 for i in range(40))
    assert all(r.n_links == 301 and r.component_id == 100 for i in [*range(100, 400), None] for r in by[i]) and len(by[100]) == 2
    assert all(by[i][0].n_links == 0 and by[i][0].kept for i in range(500, 506))
    assert by[506][0].n_links == by[507][0].n_links == 1 and by[507][0].component_id == 506
    assert near_vectors(df.limit(0)).count() == 0


def meetings(n, pivots, rng):
    """Pairs of random vectors that meet in lists, per vector."""
    vectors = rng.normal(size=(n, 24))
    order = np.sort(embedding_pairs.permutation_prefix(vectors, embedding_pairs.spread_pivots(vectors[:4096], pivots)), axis=1)
    counts = Counter(x for row in order.tolist() for x in combinations(row, 3))
    return sum(c * (c - 1) // 2 for c in counts.values()) / n


def test_lists_stay_short_as_tables_grow(monkeypatch):
    monkeypatch.setattr(embedding_pairs, "FEW_VECTORS", 2000)
    rng = np.random.default_rng(4)
    few, many = (meetings(n, embedding_pairs.pivots_for(n, 64), rng) for n in (2000, 16_000))
    assert many < 2 * few < 6 * few < meetings(16_000, 64, rng)
    assert embedding_pairs.pivots_for(2000, 64) == 64 and embedding_pairs.pivots_for(10**12, 64) == embedding_pairs.MOST_PIVOTS
    assert embedding_pairs.pivots_for(10**6, 1000) == 1000


@pytest.mark.parametrize("block", [embedding_pairs.BLOCK, 8])
def test_a_pair_is_given_once(spark, block, monkeypatch):
    written = {}
    keep = embedding_pairs.materialize
    monkeypatch.setattr(embedding_pairs, "materialize", lambda df, name: written.setdefault(name, keep(df, name)))
    monkeypatch.setattr(embedding_pairs, "BLOCK", block)
    rng = np.random.default_rng(6)
    centres = np.concatenate([np.repeat(rng.normal(size=(25, 16)), 40, axis=0), rng.normal(size=(500, 16))])
    vectors = centres + rng.normal(size=centres.shape) * 0.12
    got = near_vectors(spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id bigint, embedding array<double>").repartition(5), pivots=40)
    near = np.triu(brute_links(vectors), 1)
    n_links = {r.vec_id: r.n_links for r in got.collect()}
    assert near.sum() > 5000 and 0.95 * near.sum() <= sum(n_links.values()) / 2 <= near.sum()
    number = {tuple(r.embedding): r.c for r in written["vectors"].select("embedding", "c").collect()}
    true = {tuple(sorted((number[tuple(vectors[i])], number[tuple(vectors[j])]))) for i, j in zip(*np.nonzero(near))}
    links = [tuple(r) for r in written["vector-links"].collect()]
    assert len(links) == len(set(links)) and set(links) <= true
    # The same lists, each pair looked up in any that it shares.
    met = defaultdict(set)
    for r in written["described-vectors"].collect():
        for name in r.lists:
            met[name].add(r.c)
    meet = {(a, b) for m in met.values() for a in m for b in m if a < b}
    assert set(links) == true & meet
