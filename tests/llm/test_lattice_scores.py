"""The lattice against all cuts, and document scores against the plain formulas."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import rows, table
from pyspark.sql import functions as F

from teledex.llm import lattice_scores as module
from teledex.llm.lattice_scores import PIECES, Model, lattice, lattice_scores, urn
from teledex.llm.queries import QUERIES



def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def cuts(word, arcs):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in arcs:
            for rest in cuts(word[n:], arcs):
                yield [arcs[word[:n]], *rest]


def test_sums_over_all_cuts():
    own = lattice(PIECES)
    arcs = {x: i for i, x in enumerate(own.arcs)}
    weights = own.weights()
    words = ["a", "the", "there", "ñandú", "日本", "x" * 9, "\x00é", "thinking", "the"]
    words = [w.encode() for w in words]
    values = own.log_probability(words, weights)
    uses = np.zeros(len(weights))
    for word, value in zip(words, values):
        found = [(math.exp(sum(weights[i] for i in c) + weights[-1]), c) for c in cuts(b" " + word, arcs)]
        total = sum(p for p, _ in found)
        assert value == pytest.approx(math.log(total), rel=1e-12)
        for p, cut in found:
            for i in cut:
                uses[i] += p / total
        uses[-1] += 1
    assert np.allclose(own.expected(words, weights), uses, atol=1e-9)
    first = np.append(own.first, False)
    for w in (weights, own.weights(uses)):
        assert np.exp(w[first]).sum() == pytest.approx(1) and np.exp(w[~first]).sum() == pytest.approx(1)
    assert own.log_probability([], weights).size == 0 and math.isfinite(own.log_probability([b"long" * 20_000], weights)[0])


def test_urn_adds_up_uses():
    logp = np.log(np.array([[0.3, 1e-9], [1e-5, 0.2], [1e-3, 1e-320]]))
    times = np.array([1, 5, 200])
    want = [[sum(math.log(j + module.URN * math.exp(x)) if j else math.log(module.URN) + x for j in range(t)) for x in row] for t, row in zip(times, logp)]
    assert np.allclose(urn(times, logp), want)


def brute(given):
    """Contract columns of (doc_id, text) rows, and the score by the formulas in use."""
    docs = []
    for doc_id, text, kind in given:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2
        docs.append((doc_id, held, words, kind or ""))
    counts = Counter(w for _, held, words, _ in docs if not held for w in [*words, None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, held, words, _ in docs:
        own = [*words, None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        out.append((doc_id, held, len(own), sum(counts[w] > 0 for w in own), n, base))
    return docs, counts, out


def scores(docs):
    """Scores computed word by word, without batches, tables or joins."""
    kinds = sorted({d[3] for d in docs}, key=lambda k: (-sum(d[3] == k for d in docs), k))
    by_kind = {k: Counter(w for d in docs if not d[1] and d[3] == k for w in d[2]) for k in kinds}
    whole = sum(by_kind.values(), Counter())
    own = lattice(PIECES)
    weights = own.weights()
    for _ in range(module.ROUNDS):
        weights = own.weights(own.expected([w.encode() for w in whole], weights))

    def counted(c):
        values = list(c.values())
        return module._Counted(sum(values), len(values), values.count(1), values.count(2))

    model = Model(counted(whole), [counted(by_kind[k]) for k in kinds], [sum(not d[1] and d[3] == k for d in docs) for k in kinds])
    out = []
    for _, _, words, _ in docs:
        parts = np.zeros(len(kinds))
        for word, times in Counter(words).items():
            value = own.log_probability([word.encode()], weights)
            logp = model.log_probabilities(np.array([[by_kind[k][word] for k in kinds]]), value)[0]
            parts += [sum(math.log(module.URN * math.exp(x) + j) if j else math.log(module.URN) + x for j in range(times)) for x in logp]
        out.append(model.text(len(words), parts))
    return out, model


@pytest.mark.parametrize("frequent", [1 << 17, 3])
def test_rows_equal_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(module, "FREQUENT_WORDS", frequent)
    given = rows() + [(200 + i, "The cat the CAT sat " * (i % 4) + f"w{i}", None, i) for i in range(40)]
    df = table(spark, given).withColumn("lang", F.when(F.col("score") % 3 == 0, "fr").when(F.col("score") % 3 == 1, "en"))
    docs, _, want = brute([(r.doc_id, r.text, r.lang) for r in df.collect()])
    want_scores, model = scores(docs)
    found = sorted([tuple(r) for r in lattice_scores(df, held_out()).collect()], key=str)
    want = sorted([(*w, s) for w, s in zip(want, want_scores)], key=str)
    assert [f[:5] for f in found] == [w[:5] for w in want]
    assert np.allclose([f[5:] for f in found], [w[5:] for w in want], rtol=1e-9)
    assert model.tokens == want[0][4]


def test_word_probabilities_sum_to_at_most_one():
    docs = [(0, False, ["a", "b", "a", "ab"], "x"), (1, False, ["b", "ba"], "y")]
    _, model = scores(docs)
    own = lattice(PIECES)
    weights = own.weights()
    words = ["".join(x) for n in range(1, 4) for x in itertools.product("abc", repeat=n)]
    counts = np.array([[(d[2].count(w)) for d in docs] for w in words])
    total = np.exp(model.log_probabilities(counts, own.log_probability([w.encode() for w in words], weights))).sum(0)
    assert (total < 1).all() and (total > 0.3).all()


def test_edge_tables(spark):
    empty = table(spark, rows()[:1]).limit(0)
    assert lattice_scores(empty, held_out()).count() == 0
    nothing = lattice_scores(table(spark), F.lit(True)).collect()
    assert {r.train_tokens for r in nothing} == {0} and all(math.isfinite(r.score) and r.n_known == 0 for r in nothing)


def test_query_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    _, _, want = brute(docs)
    found = sorted([tuple(r) for r in QUERIES["op11_lattice_scores"](spark, sf_dir).collect()])
    assert [f[:5] for f in found] == [w[:5] for w in sorted(want)]
    assert np.allclose([f[5] for f in found], [w[5] for w in sorted(want)], rtol=1e-9)
    assert all(f[6] < 0 for f in found)
