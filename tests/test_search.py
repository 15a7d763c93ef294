"""Ranked search against brute force on small fixtures, and the shape of the plans."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from teledex.operators import clauses as cl
from teledex.operators import index as ix
from teledex.operators import search as se
from teledex.operators.html_records import extract_html_records
from teledex.operators.wiki_records import extract_wiki_records
from teledex.plans.rendered import benchmark_queries, catalogue, html_pages, table, wiki_pages
from teledex.schemas import MERGED_RECORD
from teledex.sources.jsonl import numbered_lines, write_jsonl
from teledex.storage import listed, new_path

WORDS = "the a star ship captain lost found night day show drama war love écran".split()


@pytest.fixture(scope="module")
def records():
    rng = random.Random(11)
    rows = []
    for i in range(60):
        rows.append(
            {
                "title": " ".join(rng.choices(WORDS, k=rng.randint(1, 3))).title(),
                "year": rng.choice([None, 0, 1999, 2001, 2008]),
                "certification": rng.choice([None, "", "TV-MA"]),
                "genres": rng.sample(["Drama", "War & Politics", "Love"], rng.randint(0, 2)),
                "score": rng.choice([0, 7, 89, None]),
                "creator": [],
                "status": rng.choice(["Ended", "Returning Series", None]),
                "type": "Scripted",
                "language": rng.choice(["English", None]),
                "keywords": rng.sample(WORDS, rng.randint(0, 3)),
                "cast": None,
                "country": None,
                "num_seasons": rng.choice(["0", "5", None]),
                "num_episodes": "62",
                "runtime": "45 minutes",
                "network": "HBO",
                "plot": " ".join(rng.choices(WORDS, k=rng.randint(0, 40))) + " the.",
            }
        )
    return rows


@pytest.fixture(scope="module")
def frame(spark, records):
    data = [(i, *[r[f.name] for f in MERGED_RECORD]) for i, r in enumerate(records)]
    schema = "doc_id bigint, " + ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in MERGED_RECORD
    )
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def index(frame):
    return ix.index_records(frame)


def words(text):
    return re.findall(r"\w+", text.lower())


def field_tokens(records):
    """{field: {doc: tokens}}, absent values left out."""
    out = {f: {} for f in ix.FIELDS}
    for i, record in enumerate(records):
        for field in ix.FIELDS:
            value = record[field]
            if not value:
                continue
            text = " ".join(value) if isinstance(value, list) else str(value)
            tokens = [text] if field in ix.EXACT_FIELDS else words(text)
            if tokens:
                out[field][i] = tokens
    return out


def idf(tokens, field, term):
    n = sum(term in t for t in tokens[field].values())
    return math.log(1 + (len(tokens[field]) - n + 0.5) / (n + 0.5)) if n else 0.0


def norm(tokens, field, doc, tf):
    docs = tokens[field]
    mean = sum(map(len, docs.values())) / len(docs)
    return tf / (tf + 1.2 * (0.25 + 0.75 * len(docs[doc]) / mean))


def brute(records, text, boosts=None, fields=ix.FIELDS):
    tokens, scores = field_tokens(records), {}
    for term in words(text):
        for field in fields:
            for doc, t in tokens[field].items():
                if term in t:
                    part = idf(tokens, field, term) * norm(tokens, field, doc, t.count(term))
                    scores[doc] = scores.get(doc, 0) + part * (boosts or {}).get(field, 1)
    best = sorted(scores.items(), key=lambda x: (-round(x[1], 6), x[0]))[:10]
    return [(d, round(s, 6)) for d, s in best]


QUERY_TEXTS = {1: "The Lost ship", 2: "star star drama", 3: "ended 2001 5", 4: "   ", 5: "zzz", 6: "écran war 89"}


def ranked(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.doc_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def same(got, want):
    assert [d for d, _ in got] == [d for d, _ in want]
    assert all(abs(a[1] - b[1]) < 2e-6 for a, b in zip(got, want))


@pytest.mark.parametrize("boosts", [None, se.BOOSTS])
def test_search_equals_brute_force(spark, records, index, boosts):
    queries = spark.createDataFrame(list(QUERY_TEXTS.items()), "query_id bigint, text string")
    got = ranked(se.search(queries, index, boosts=boosts))
    for key, text in QUERY_TEXTS.items():
        same(got.get(key, []), brute(records, text, boosts))


def test_exact_fields_keep_their_capitals(spark, records, index):
    queries = spark.createDataFrame([(1, "Ended 2008")], "query_id bigint, text string")
    got = ranked(se.search(queries, index, fields=ix.EXACT_FIELDS))
    same(got[1], brute(records, "2008", fields=["year"]))


def test_ties_follow_document_order(spark, index):
    queries = spark.createDataFrame([(1, "scripted")], "query_id bigint, text string")
    assert [d for d, _ in ranked(se.search(queries, index))[1]] == list(range(10))


def test_index_can_be_read_again(spark, frame):
    path = new_path(spark, "index")
    ix.index_records(frame, path=path)
    ix.index_records(frame, path=path)  # starts over
    again = ix.read_index(spark, path)
    assert again.fields.filter("field = 'plot'").first().docs == 60
    assert again.postings.count() == ix.build_postings(ix.search_fields(frame)).count()


def test_report(spark, index, frame):
    queries = spark.createDataFrame([(1, "the")], "query_id bigint, text string")
    rows = se.report(se.hydrate(se.search(queries, index), frame)).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, 11))
    for r in rows:
        assert r.cast is None and r.creator is None and re.fullmatch(r"\d+\.\d\d", r.relevance)
        assert r.heading.endswith(")") and r.language in ("English", "N/A")


# --- clauses ---------------------------------------------------------------------


def run(spark, index, *rows):
    data = [(1, i, *row, *[None] * (5 - len(row))) for i, row in enumerate(rows)]
    return ranked(cl.search_clauses(spark.createDataFrame(data, cl.CLAUSE_SCHEMA), index, k=1000)).get(1, [])


def docs_with(records, field, test):
    return {d for d, t in field_tokens(records)[field].items() if test(t)}


def found(hits):
    return {d for d, _ in hits}


def test_must_and_must_not(spark, records, index):
    hits = run(
        spark, index, ("must", "term", "plot", "star"), ("must_not", "term", "plot", "war"),
        ("should", "term", None, "love"),
    )
    assert found(hits) == docs_with(records, "plot", lambda t: "star" in t and "war" not in t)
    assert run(spark, index, ("must_not", "term", "plot", "war")) == []
    assert run(spark, index, ("must", "term", "plot", "zzz"), ("should", "term", "plot", "war")) == []


def test_unknown_kind_is_refused(spark, index):
    with pytest.raises(ValueError, match="kinds"):
        run(spark, index, ("must", "regex", "plot", "x"))


@pytest.mark.parametrize("phrase", ["lost ship", "the the", "star", "the star the", "zzz star"])
def test_phrase(spark, records, index, phrase):
    wanted = words(phrase)
    tokens = field_tokens(records)
    expected = []
    for doc, t in tokens["plot"].items():
        freq = sum(t[i : i + len(wanted)] == wanted for i in range(len(t)))
        if freq:
            total = sum(idf(tokens, "plot", w) for w in wanted)
            expected.append((doc, round(total * norm(tokens, "plot", doc, freq), 6)))
    same(run(spark, index, ("must", "phrase", "plot", phrase)), sorted(expected, key=lambda x: (-x[1], x[0])))


def test_phrase_beside_words(spark, records, index):
    hits = run(spark, index, ("must", "phrase", "plot", "the star"), ("must", "term", "plot", "war"))
    expected = docs_with(records, "plot", lambda t: "the star" in " ".join(t) and "war" in t)
    assert found(hits) == expected


@pytest.mark.parametrize(
    "kind,text,regex",
    [("prefix", "S", "s.*"), ("prefix", "cap", "cap.*"), ("prefix", "captain", "captain.*"),
     ("wildcard", "s*p", "s.*p"), ("wildcard", "l?s?", "l.s."), ("wildcard", "st%r", "st%r")],
)
def test_patterns(spark, records, index, kind, text, regex):
    hits = run(spark, index, ("should", kind, "plot", text))
    assert found(hits) == docs_with(records, "plot", lambda t: any(re.fullmatch(regex, x) for x in t))
    assert all(s == 1.0 for _, s in hits)


def test_range(spark, records, index):
    hits = run(spark, index, ("must", "range", "year", "1999", "2001"))
    assert found(hits) == docs_with(records, "year", lambda t: "1999" <= t[0] <= "2001")
    assert found(run(spark, index, ("must", "range", "year", "2001"))) == docs_with(
        records, "year", lambda t: t[0] >= "2001"
    )


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_terms_equal_all_pairs(spark):
    rng = random.Random(5)
    terms = sorted({"".join(rng.choices("abé", k=rng.randint(1, 9))) for _ in range(400)})
    dictionary = spark.createDataFrame([("plot", t, 1.0) for t in terms], "field string, term string, idf double")
    needles = sorted(set(rng.sample(terms, 30) + ["a", "ab", "bbb", "éa"]))
    rows = [(1, i, "should", "fuzzy", "plot", n, None) for i, n in enumerate(needles)]
    got = {
        (r.clause_id, r.term)
        for r in cl._fuzzy(spark.createDataFrame(rows, cl.CLAUSE_SCHEMA), dictionary).collect()
    }
    want = {
        (i, t)
        for i, n in enumerate(needles)
        for t in terms
        if edits(n, t) <= 2 and edits(n, t) < min(len(n), len(t))
    }
    assert got == want


# --- plans -----------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_workers(spark, sf_dir):
    html = extract_html_records(html_pages(spark.read.parquet(f"{sf_dir}/part.parquet")))
    wiki = extract_wiki_records(wiki_pages(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    postings = ix.build_postings(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select(
            "doc_id", F.lit("plot").alias("field"), F.col("text").alias("value")
        )
    )
    for df in (html, wiki, postings):
        text = plan(df)
        assert "EvalPython" not in text and "MapIn" not in text
        assert "Exchange" not in text  # narrow: one stage


def test_expensive_captures_run_once(spark, sf_dir):
    """Page captures and the infobox sit in a generator, not repeated in filters."""
    wiki = extract_wiki_records(spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("text").alias("page")))
    text = wiki._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("<text[^>]*>.*?</text>") == 1
    assert text.count(r"[^{}]*+(?:") == 1


def above_postings(df):
    """Per postings scan the operators above it up to the first aggregate, from the plan's
    tree: each line is the child of the last line that is indented less."""
    stack, found = [], []
    for line in plan(df).split("\n"):
        depth = len(line) - len(line.lstrip(" :+-*"))
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, line.lstrip(" :+-*")))
        if "Scan parquet" in line and "teledex_postings" in line:
            assert "Bucketed: true" in line
            names = []
            for _, above in reversed(stack[:-1]):
                if "Aggregate" in above:
                    break
                names.append(above)
            found.append(names)
    return found


QUERY_ROWS = "query_id bigint, text string"


def no_postings_move(df):
    scans = above_postings(df)
    assert scans and not any("Exchange" in name for names in scans for name in names)


def test_no_search_moves_postings(spark, index):
    queries = spark.createDataFrame([(1, "the lost ship"), (2, "the star war")], QUERY_ROWS)
    words = se.materialize(se.query_weights(queries, index), "weights")
    df = se.search(queries, index, k=2)
    no_postings_move(df)
    no_postings_move(se.summed_hits(words, index))
    no_postings_move(se.score_documents(queries, index))
    text = plan(df)
    assert "WindowGroupLimit" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    for rows in (
        [("must", "term", "plot", "lost"), ("should", "prefix", None, "st")],
        [("must", "phrase", "plot", "the star"), ("should", "fuzzy", "plot", "starx"), ("must", "range", "year", "1999", "2001")],
    ):
        data = [(1, i, *row, *[None] * (5 - len(row))) for i, row in enumerate(rows)]
        no_postings_move(cl.clause_hits(spark.createDataFrame(data, cl.CLAUSE_SCHEMA), index))


def test_indexing_moves_each_record_once(spark, frame):
    fields = ix.search_fields(frame.repartition(8, "doc_id"))
    assert plan(ix.build_postings(fields.repartition(8, "doc_id"))).count("Exchange") == 1


def test_phrases_read_positions_of_whole_matches_only(spark, index):
    data = [(1, 0, "must", "phrase", "plot", "the star", None)]
    text = plan(cl.clause_hits(spark.createDataFrame(data, cl.CLAUSE_SCHEMA), index))
    scans = [line for line in text.split("\n") if "Scan parquet" in line and "teledex_postings" in line]
    assert sum("positions:array<int>" in line.split("ReadSchema")[1] for line in scans) == 1 and len(scans) == 2


def test_ranges_join_terms_by_their_lead(spark, index):
    dictionary = ix.with_idf(index.terms, index.fields)
    data = [(1, 0, "must", "range", "year", "1999", "2001")]
    text = plan(cl._ranges(spark.createDataFrame(data, cl.CLAUSE_SCHEMA), dictionary))
    assert re.search(r"Join \[field#\d+, lead#\d+\], \[field#\d+, lead#\d+\]", text)


@pytest.mark.parametrize("low, high", [("a", "captainz"), (None, "lost"), ("sh", None), ("love", "love"), ("z", "a"), (None, None), ("", "n")])
def test_ranges_equal_comparison(spark, records, index, low, high):
    hits = run(spark, index, ("must", "range", "plot", low, high))
    inside = lambda x: (low is None or x >= low) and (high is None or x <= high)
    assert found(hits) == docs_with(records, "plot", lambda t: any(map(inside, t)))


def test_boosts_weigh_clauses(spark, records, index):
    rows = [(1, 0, "should", "term", None, "star", None), (1, 1, "should", "prefix", "title", "st", None), (1, 2, "should", "phrase", "title", "star", None)]
    clauses = spark.createDataFrame(rows, cl.CLAUSE_SCHEMA)
    boosts = {"title": 3.0, "plot": 0.25, "keywords": 0.0}
    tokens, want = field_tokens(records), {}
    for field in ix.FIELDS:
        for doc, t in tokens[field].items():
            if "star" in t:
                part = idf(tokens, field, "star") * norm(tokens, field, doc, t.count("star")) * boosts.get(field, 1)
                want[doc] = want.get(doc, 0) + part * (2 if field == "title" else 1)
            if field == "title" and any(x.startswith("st") for x in t):
                want[doc] = want.get(doc, 0) + boosts["title"]
    got = ranked(cl.search_clauses(clauses, index, k=100, boosts=boosts))[1]
    same(got, sorted(((d, round(s, 6)) for d, s in want.items()), key=lambda x: (-x[1], x[0])))


def test_only_near_documents_are_scored(spark, sf_dir):
    """Pruned search gives the rows of scoring everything, from far fewer sums."""
    docs = table(spark, sf_dir, "documents")
    index = ix.index_records(catalogue(docs))
    queries = benchmark_queries(table(spark, sf_dir, "benchmark"))
    for boosts in (None, se.BOOSTS):
        every = se.score_documents(queries, index, boosts=boosts)
        want = sorted(map(tuple, se.top_k(every).select("query_id", "doc_id", "score", "rank").collect()))
        assert sorted(map(tuple, se.search(queries, index, boosts=boosts).select("query_id", "doc_id", "score", "rank").collect())) == want
        near, left_out = se.candidates(queries, index, boosts=boosts)
        assert not left_out.isEmpty() and near.count() < every.count() / 3


def test_queries_too_many_to_broadcast(spark, records, index):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        queries = spark.createDataFrame(list(QUERY_TEXTS.items()), QUERY_ROWS)
        df = se.search(queries, index)
        assert "BroadcastHashJoin" not in plan(df)
        got = ranked(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for key, text in QUERY_TEXTS.items():
        same(got.get(key, []), brute(records, text))


def test_lines_are_parsed_after_the_join(spark, frame, index, tmp_path):
    write_jsonl(frame.orderBy("doc_id").drop("doc_id"), str(tmp_path / "records"), files=None)
    lines = numbered_lines(spark, str(tmp_path / "records"))
    hits = se.search(spark.createDataFrame([(1, "the star")], QUERY_ROWS), index)
    df = se.hydrate_lines(hits, lines, MERGED_RECORD)
    tree = df._jdf.queryExecution().optimizedPlan().toString()
    assert tree.index("from_json") < tree.index("LeftSemi")  # parents come first
    key = lambda r: (r.query_id, r.rank, r.doc_id, r.title, r.plot)
    assert sorted(map(key, df.collect())) == sorted(map(key, se.hydrate(hits, frame).collect()))


def test_a_new_version_leaves_readers_alone(spark, frame):
    path = new_path(spark, "index")
    old = ix.index_records(frame, path=path)
    new = ix.index_records(frame.filter("doc_id < 10"), path=path)
    assert old.postings.count() > new.postings.count() and old.terms.count() > new.terms.count()
    ix.index_records(frame.filter("doc_id < 5"), path=path)
    assert len(listed(spark, path)) == 2  # the first is gone
    with pytest.raises(ValueError, match="no index"):
        ix.read_index(spark, path + "-nowhere")


# --- work that grows with the collection only ------------------------------------


def test_buckets_grow_with_the_text(spark, frame, monkeypatch):
    """A bucket's postings, which one task sorts and scores, stay as many on larger input."""
    fields = ix.search_fields(frame)
    total = sum(len(r.value.encode()) for r in fields.collect())
    monkeypatch.setattr(ix, "BUCKET_BYTES", total // 20)
    index = ix.index_records(frame)
    name = re.search(r"teledex_postings_\w+", plan(index.postings))[0]
    described = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()
    assert 20 <= int(described.data_type) <= 21


def test_pruned_words_leave_postings_where_they_are(spark, index, monkeypatch):
    """The words that remain are few, whatever the optimizer makes of the joins before."""
    plans, write = {}, se.materialize
    monkeypatch.setattr(se, "materialize", lambda df, name: (plans.setdefault(name, df), write(df, name))[1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        se.candidates(spark.createDataFrame(list(QUERY_TEXTS.items()), QUERY_ROWS), index, k=2)
        no_postings_move(plans["sums"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_common_words_ask_for_no_phrase(spark, index):
    """Each phrase is asked of documents with its rarest word, once for all clauses."""
    texts = ["the star", "the lost", "lost the", "the captain the"]
    rows = [(q, i, "should", "phrase", "plot", t, None) for q in (1, 2) for i, t in enumerate(texts)]
    wanted = cl._wanted(spark.createDataFrame(rows, cl.CLAUSE_SCHEMA), index, None)
    words, clauses = cl._phrase_words(cl.materialize(wanted, "clauses"))
    df = {r.term: r.df for r in index.terms.filter("field = 'plot'").collect()}
    asked = {r.term: len(r.asks) for r in words.filter("asks IS NOT NULL").collect()}
    want = {}
    for text in texts:
        rarest = min(set(text.split()), key=lambda w: df[w])
        want[rarest] = want.get(rarest, 0) + 1
    assert asked == want and "the" not in asked and clauses.count() == len(rows)


def test_phrases_of_ids_that_repeat(spark, frame):
    """Ids that several records have don't change the phrases of other records."""
    copies = frame.filter("doc_id % 3 = 0").unionByName(frame.filter("doc_id % 6 = 0").withColumn("plot", F.lit("the star lost ship")))
    alone, mixed = ix.index_records(frame), ix.index_records(frame.unionByName(copies))
    rows = [(1, i, "should", "phrase", "plot", t, None) for i, t in enumerate(("the star", "lost ship", "the the", "star"))]
    wanted = [cl.materialize(cl._wanted(spark.createDataFrame(rows, cl.CLAUSE_SCHEMA), x, None).withColumn("weight", F.lit(1.0)).withColumn("mean_length", F.lit(9.0)), "clauses") for x in (alone, mixed)]
    got = lambda hits: sorted((r.clause_id, r.doc_id, round(r.score, 6)) for r in hits.collect())
    one, two = got(cl._phrase_hits(alone, wanted[0])), got(cl._phrases_found(mixed, wanted[1]))
    assert one == got(cl._shared_phrase_hits(alone, wanted[0]))
    assert [x for x in two if x[1] % 3] == [x for x in one if x[1] % 3]
    assert two == got(cl._shared_phrase_hits(mixed, wanted[1]))


def test_words_are_summed_once(spark, index):
    """Words and their fields don't make groups of their own: numbers are the only keys."""
    rows = [(1, 0, "must", "term", None, "the star", None), (1, 1, "should", "range", "year", "1999", "2001")]
    text = plan(cl.search_clauses(spark.createDataFrame(rows, cl.CLAUSE_SCHEMA), index))
    keys = set(re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", text))
    assert any("doc_id" in k for k in keys)
    assert not any(name in k for k in keys if "doc_id" in k for name in ("occur", "field", "clause_id"))


@pytest.mark.parametrize("n", [1, 60, 61, 130])
def test_many_must_clauses(spark, records, index, n):
    rows = [("must", "term", "plot", "the")] * n + [("should", "term", "plot", "star"), ("must_not", "term", "plot", "war")]
    tokens = field_tokens(records)
    hits = run(spark, index, *rows)
    assert found(hits) == docs_with(records, "plot", lambda t: "the" in t and "war" not in t)
    doc, score = hits[0]
    part = lambda w: idf(tokens, "plot", w) * norm(tokens, "plot", doc, tokens["plot"][doc].count(w))
    assert abs(score - n * part("the") - part("star")) < 1e-5
    assert run(spark, index, *rows, ("must", "term", "plot", "zzz")) == []


def test_patterns_score_once_beside_words(spark, records, index):
    hits = run(spark, index, ("must", "prefix", "plot", "s"), ("should", "term", "plot", "star"), ("must_not", "range", "year", "1999", "2001"))
    tokens = field_tokens(records)
    years = docs_with(records, "year", lambda t: "1999" <= t[0] <= "2001")
    want = {}
    for doc, t in tokens["plot"].items():
        if any(x.startswith("s") for x in t) and doc not in years:
            want[doc] = 1 + (idf(tokens, "plot", "star") * norm(tokens, "plot", doc, t.count("star")) if "star" in t else 0)
    same(hits, sorted(((d, round(s, 6)) for d, s in want.items()), key=lambda x: (-x[1], x[0])))


def test_a_search_over_some_fields_reads_no_others(spark, records, index, tmp_path):
    # Folders of fields, so that files of one can be spoiled; pruning at run time is off.
    path = str(tmp_path / "by-field")
    index.postings.write.partitionBy("field").parquet(path)
    apart = se.SearchIndex(spark.read.parquet(path), index.terms, index.fields)
    for file in (tmp_path / "by-field" / "field=plot").glob("*.parquet"):
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
        file.write_bytes(b"spoiled")
    queries = spark.createDataFrame([(1, "1999 2008"), (2, "Ended 3")], "query_id bigint, text string")
    name = "spark.sql.optimizer.dynamicPartitionPruning.enabled"
    spark.conf.set(name, False)
    try:
        got = {(r.query_id, r.doc_id, r.score) for r in se.search(queries, apart, fields=ix.EXACT_FIELDS).collect()}
        assert not se.score_documents(queries, apart, fields=ix.EXACT_FIELDS).isEmpty()
    finally:
        spark.conf.unset(name)
    assert got == {(r.query_id, r.doc_id, r.score) for r in se.search(queries, index, fields=ix.EXACT_FIELDS).collect()} != set()
