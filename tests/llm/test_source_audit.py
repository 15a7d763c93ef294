"""The source audit against brute force on hard rows, and against SQL."""

import re
from collections import Counter, defaultdict

import duckdb
from cases import rows, table

from teledex.llm.divergence_audit import audit_sources
from teledex.llm.queries import ORACLES, QUERIES

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def brute(given, least=3, top=200):
    """``given``: (lang, source, text)."""
    docs = [(a or "", b or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))) for a, b, t in given]
    out = []
    for lang in {d[0] for d in docs}:
        df, counts, whole = Counter(), defaultdict(Counter), Counter()
        for _, source, words in [d for d in docs if d[0] == lang]:
            df.update(words.keys())
            counts[source].update(words)
            whole.update(words)
        kept = [t for t in df if df[t] >= least]

        def shares(own):
            n = sum(own[t] for t in kept)
            return {t: 1 + 10**9 * (own[t] + 1) // (n + len(kept)) for t in kept}

        q = shares(whole)
        p = {s: shares(c) for s, c in counts.items()}
        for s in counts:
            pairs = [(-sum((p[s][w] - p[t][w]) ** 2 // p[t][w] for w in kept), t) for t in counts if t != s]
            more = [(-((p[s][w] - q[w]) ** 2 // q[w]), w.encode(), w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            out += [(lang, s, "pair", t, -v, i + 1) for i, (v, t) in enumerate(sorted(pairs, key=lambda x: (x[0], x[1].encode())))]
            out += [(lang, s, "term", w, -v, i + 1) for i, (v, _, w) in enumerate(sorted(more)[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def hard(spark):
    given = []
    for i in range(120):
        words = [f"{'ab'[j % 2]}{'wörd日'[: 1 + (i * j) % 5]}{'x' * (j % 4)}" for j in range(i % 9)]
        given.append((("en", "de", None, "xx")[i % 4 if i % 7 else 3], f"s{i % 5}" if i % 11 else None, " ".join(words + ["The,the"] * (i % 3)) if i % 13 else None))
    given += [("zz", "only", ""), ("zz", None, "Once upon"), ("en", "s9", "the " * 50_000), ("en", "s9", "the " * 50_000)]
    schema = "lang string, source string, text string, term string, count int, `held` int"
    return given, spark.createDataFrame([(*g, "t", 1, 2) for g in given], schema).repartition(4)


def test_equals_brute_force(spark):
    given, df = hard(spark)
    assert got(audit_sources(df)) == brute(given)
    assert got(audit_sources(df, min_documents=1, top_terms=2)) == brute(given, 1, 2)
    shared = [(r.lang, r.source, r.text) for r in table(spark).collect()]
    assert got(audit_sources(table(spark), min_documents=2)) == brute(shared, 2)
    assert audit_sources(table(spark, rows()[:1]).limit(0)).count() == 0


def test_query_equals_sql(spark, sf_dir):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = sorted(db.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op12_source_audit']})").fetchall())
    assert got(QUERIES["op12_source_audit"](spark, sf_dir)) == want
