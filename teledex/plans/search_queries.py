"""Registered queries on indexing and search, with their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.analysis import tokenize as tokens_of
from ..operators import index as ix
from ..operators import search as se
from ..operators.clauses import search_clauses
from ..schemas import MERGED_RECORD, WIKI_RECORD
from ..sources.jsonl import read_numbered_jsonl, write_jsonl
from ..storage import materialize, new_path
from .rendered import benchmark_queries, catalogue, table


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue(table(spark, sf_dir, "documents"))


_INDEX_PATHS: dict[tuple[str, str], str] = {}


def shared_index(spark: SparkSession, sf_dir: str) -> ix.SearchIndex:
    """Indexed by the first query that asks, then read by all of the application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INDEX_PATHS:
        path = new_path(spark, "index")
        ix.index_records(_records(spark, sf_dir), path=path)
        _INDEX_PATHS[key] = path
    return ix.read_index(spark, _INDEX_PATHS[key])


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_queries(table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tokens_of(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(tokens).alias("n_tokens"), F.array_join(tokens, " ").alias("tokens")
    )


def jsonl_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written in order, read back with their line numbers as ids."""
    path = new_path(spark, "numbered")
    titles = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("network"), F.col("text").alias("plot")
    )
    ordered = titles.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    write_jsonl(ordered.drop("doc_id"), path)
    return read_numbered_jsonl(spark, path, WIKI_RECORD).select("doc_id", "network", "plot")


def search_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ix.search_fields(_records(spark, sf_dir))


def build_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = ix.build_postings(ix.search_fields(_records(spark, sf_dir)))
    return postings.select(
        "doc_id", "field", "term", "tf", "length", F.array_join("positions", ",").alias("positions")
    )


def field_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = shared_index(spark, sf_dir).fields
    return stats.select("field", "docs", F.round("mean_length", 6).alias("mean_length"))


def term_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = shared_index(spark, sf_dir)
    known = ix.with_idf(index.terms, index.fields)
    return known.select("field", "term", "df", F.round("idf", 6).alias("idf"))


def bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.search(_queries(spark, sf_dir), shared_index(spark, sf_dir), fields=["plot"])


def search_exact_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``status`` keeps its capitals and so never matches; digits do."""
    return se.search(_queries(spark, sf_dir), shared_index(spark, sf_dir), fields=ix.EXACT_FIELDS)


def bm25_multi_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.search(_queries(spark, sf_dir), shared_index(spark, sf_dir))


def bm25_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.search(_queries(spark, sf_dir), shared_index(spark, sf_dir), boosts=se.BOOSTS)


_LINES: dict[tuple[str, str], DataFrame] = {}


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The indexed records as numbered lines of JSON, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LINES:
        record = F.to_json(F.struct(*MERGED_RECORD.fieldNames()))
        _LINES[key] = materialize(_records(spark, sf_dir).select("doc_id", record.alias("value")), "record-lines")
    return _LINES[key]


def _hydrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.hydrate_lines(bm25_multi_field(spark, sf_dir), _lines(spark, sf_dir), MERGED_RECORD)


def search_hydrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields of the records; lists as one string."""
    lists = [f.name for f in MERGED_RECORD if f.dataType.typeName() == "array"]
    shown = [F.array_join(f, "|").alias(f) if f in lists else F.col(f) for f in MERGED_RECORD.fieldNames()]
    return _hydrated(spark, sf_dir).select("query_id", "rank", "doc_id", "relevance", *shown)


def search_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.report(_hydrated(spark, sf_dir))


# --- clause queries: clause rows derived from all words of the benchmark texts -----


def _clauses(spark: SparkSession, sf_dir: str, *rows: tuple) -> DataFrame:
    """One set of clauses per benchmark item; a row is (occur, kind, field, texts, upper)
    with SQL expressions over ``w`` (all of the item's words) and ``item_id``. Each of the
    texts makes a clause."""
    items = table(spark, sf_dir, "benchmark").select("item_id", tokens_of(F.col("text")).alias("w"))
    structs = [
        f"transform({texts}, (text, i) -> named_struct('clause_id', {n * 10_000} + i, 'occur', '{occur}', "
        f"'kind', '{kind}', 'field', {field}, 'text', text, 'upper', {upper}))"
        for n, (occur, kind, field, texts, upper) in enumerate(rows)
    ]
    typed = "array<struct<clause_id:int,occur:string,kind:string,field:string,text:string,upper:string>>"
    every = ", ".join(f"cast({x} AS {typed})" for x in structs)
    return items.selectExpr("item_id AS query_id", f"inline(concat({every}))")


def _clause_search(rows: list[tuple], boosts: dict[str, float] | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return search_clauses(_clauses(spark, sf_dir, *rows), shared_index(spark, sf_dir), boosts=boosts)

    return run


_TEXT = "array(array_join(w, ' '))"
_LONG, _MIDDLE, _SHORT = (f"filter(w, x -> length(x) {test})" for test in (">= 9", "BETWEEN 4 AND 8", "< 4"))
# Neighbours of which one is long.
_PAIRS = (
    "transform(filter(sequence(1, size(w) - 1), i -> length(get(w, i - 1)) >= 9 OR length(get(w, i)) >= 9), "
    "i -> array_join(slice(w, i, 2), ' '))"
)
_FIELD_TERM = ("should", "term", "'plot'", _TEXT, "NULL")
_CLAUSE_QUERIES = {
    "search_field_term": [
        _FIELD_TERM,
        ("should", "term", "'title'", "array(concat('doc ', item_id))", "NULL"),
    ],
    "search_must": [
        ("must", "term", "NULL", f"array(array_join({_LONG}, ' '))", "NULL"),
        ("must", "term", "'plot'", f"array(array_join({_MIDDLE}, ' '))", "NULL"),
        ("should", "term", "'plot'", f"array(array_join({_SHORT}, ' '))", "NULL"),
    ],
    "search_must_not": [
        ("should", "term", "'plot'", f"array(array_join({_MIDDLE}, ' '))", "NULL"),
        ("must_not", "term", "'plot'", f"array(array_join({_LONG}, ' '))", "NULL"),
        ("must_not", "term", "'language'", "array('de')", "NULL"),
    ],
    "search_phrase": [
        ("should", "phrase", "'plot'", _TEXT, "NULL"),
        ("should", "phrase", "'plot'", _PAIRS, "NULL"),
    ],
    "search_prefix": [
        ("should", "prefix", "'plot'", f"transform({_LONG}, x -> left(x, 6))", "NULL"),
        ("should", "wildcard", "'plot'", f"transform({_LONG}, x -> concat(left(x, 4), '*', right(x, 1), '?'))", "NULL"),
    ],
    "search_fuzzy": [("should", "fuzzy", "'plot'", f"transform({_LONG}, x -> concat(x, 'x'))", "NULL")],
    "search_range": [
        ("must", "range", "'year'", "array(cast(1950 + item_id % 60 AS string))", "cast(1952 + item_id % 60 AS string)"),
        ("should", "term", "'plot'", _TEXT, "NULL"),
    ],
}
_BOOSTED_CLAUSES = [
    ("must", "term", "NULL", _TEXT, "NULL"),
    ("should", "term", "'title'", "array(concat('doc ', item_id))", "NULL"),
    ("should", "term", "'keywords'", "array(concat('kw', item_id % 9))", "NULL"),
    ("should", "term", "'creator'", "array(concat('creator ', item_id % 6))", "NULL"),
    ("should", "prefix", "'runtime'", "array('minu')", "NULL"),
    ("should", "range", "'num_seasons'", "array('2')", "'5'"),
]

QUERIES = {
    f.__name__: f
    for f in (
        tokenize,
        jsonl_line_numbers,
        search_docs,
        build_postings,
        field_stats,
        term_idf,
        bm25_search,
        search_exact_field,
        bm25_multi_field,
        bm25_boosted,
        search_hydrated,
        search_report,
    )
} | {name: _clause_search(rows) for name, rows in _CLAUSE_QUERIES.items()}
QUERIES["search_clauses_boosted"] = _clause_search(_BOOSTED_CLAUSES, se.BOOSTS)

# --- SQL -----------------------------------------------------------------------------

_WORD_SQL = r"(?:\p{L}+(?:[''’.:·]\p{L}+)*|\p{N}+(?:[.,;''’]\p{N}+)*)+"


def _tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{_WORD_SQL}')"


_TEXT_FIELDS = {
    "title": "'Doc ' || doc_id",
    "year": "CAST(1950 + doc_id % 70 AS VARCHAR)",
    "certification": "CASE WHEN doc_id % 3 <> 0 THEN 'TV ' || (doc_id % 5) END",
    "genres": "source || ' ' || lang",
    "keywords": "CASE WHEN doc_id % 7 <> 0 THEN 'kw' || (doc_id % 9) || ' series' END",
    "cast": "'Person ' || (doc_id % 10)",
    "creator": "CASE WHEN doc_id % 4 <> 0 THEN 'Creator ' || (doc_id % 6) END",
    "language": "lang",
    "status": "CASE WHEN doc_id % 2 = 0 THEN 'Ended' END",
    "type": "'Scripted'",
    "score": "CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id % 5 AS VARCHAR) END",
    "country": "lang",
    "network": "source",
    "plot": "text",
    "num_seasons": "CAST(doc_id % 8 AS VARCHAR)",
    "num_episodes": "CAST(n_chars AS VARCHAR)",
    "runtime": "(20 + doc_id % 50) || ' minutes'",
}
_DOCS = " UNION ALL ".join(
    f"SELECT doc_id, '{name}' AS field, {value} AS value FROM documents WHERE {value} <> ''"
    for name, value in _TEXT_FIELDS.items()
)
_WITH = f"""
    WITH docs AS ({_DOCS}),
    toks AS (SELECT doc_id, field,
        CASE WHEN field IN ('year', 'status', 'num_seasons', 'num_episodes') THEN [value] ELSE {_tokens("value")} END AS t
        FROM docs),
    words AS (SELECT doc_id, field, len(t) AS length, unnest(t) AS term,
        unnest(range(len(t))) AS position FROM toks),
    postings AS (SELECT doc_id, field, term, count(*) AS tf, any_value(length) AS length
        FROM words GROUP BY ALL),
    fields AS (SELECT field, count(*) AS docs, avg(len(t)) AS mean_length
        FROM toks WHERE len(t) > 0 GROUP BY field),
    terms AS (SELECT field, term, count(*) AS df FROM postings GROUP BY ALL),
    idf AS (SELECT field, term, df, mean_length,
        ln(1 + (docs - df + 0.5) / (df + 0.5)) AS idf FROM terms JOIN fields USING (field)),
    queries AS (SELECT item_id AS query_id, text || ' ' || (1950 + item_id % 70) || ' person creator minutes Ended kw'
        || (item_id % 9) || ' tv src' || (item_id % 20) || ' ' || (item_id % 10) AS text FROM benchmark),
    qterms AS (SELECT query_id, term, count(*) AS repeats
        FROM (SELECT query_id, unnest({_tokens("text")}) AS term FROM queries) GROUP BY ALL)"""

_SATURATION = "tf / (tf + 1.2 * (0.25 + 0.75 * length / mean_length))"
_RANKED = """
    SELECT query_id, doc_id, score, rank FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER)
            AS rank
        FROM ({}))
    WHERE rank <= 10"""
_BOOST = f"coalesce(map {se.BOOSTS!r}[field], 1.0)"


def _bm25(where: str = "TRUE", boost: str = "1.0") -> str:
    return _RANKED.format(f"""
        SELECT query_id, doc_id, round(sum(repeats * idf * {boost} * {_SATURATION}), 6) AS score
        FROM postings JOIN idf USING (field, term) JOIN qterms USING (term)
        WHERE {where} GROUP BY query_id, doc_id""")


ORACLES = {
    "tokenize": f"""
        SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens
        FROM (SELECT doc_id, {_tokens("text")} AS t FROM documents)""",
    "jsonl_line_numbers": """
        SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_id, source AS network, text AS plot
        FROM documents""",
    "search_docs": _DOCS,
    "build_postings": f"""{_WITH}
        SELECT doc_id, field, term, CAST(count(*) AS INTEGER) AS tf,
            CAST(any_value(length) AS INTEGER) AS length,
            string_agg(position, ',' ORDER BY position) AS positions
        FROM words GROUP BY doc_id, field, term""",
    "field_stats": f"{_WITH} SELECT field, docs, round(mean_length, 6) AS mean_length FROM fields",
    "term_idf": f"{_WITH} SELECT field, term, df, round(idf, 6) AS idf FROM idf",
    "bm25_search": _WITH + _bm25("field = 'plot'"),
    "search_exact_field": _WITH + _bm25("field IN ('year', 'status', 'num_seasons', 'num_episodes')"),
    "bm25_multi_field": _WITH + _bm25(),
    "bm25_boosted": _WITH + _bm25(boost=_BOOST),
    "search_hydrated": f"""{_WITH}
        SELECT query_id, rank, h.doc_id, score AS relevance, 'Doc ' || h.doc_id AS title,
            CAST(1950 + h.doc_id % 70 AS INTEGER) AS year,
            CASE WHEN h.doc_id % 3 <> 0 THEN 'TV ' || (h.doc_id % 5) END AS certification,
            source || '|' || lang AS genres, CAST(h.doc_id % 5 AS INTEGER) AS score,
            CASE WHEN h.doc_id % 4 <> 0 THEN 'Creator ' || (h.doc_id % 6) END AS creator,
            CASE WHEN h.doc_id % 2 = 0 THEN 'Ended' ELSE '' END AS status, 'Scripted' AS type, lang AS language,
            CASE WHEN h.doc_id % 7 = 0 THEN '' ELSE 'kw' || (h.doc_id % 9) || '|series' END AS keywords,
            'Person ' || (h.doc_id % 10) AS "cast", lang AS country, CAST(h.doc_id % 8 AS VARCHAR) AS num_seasons,
            CAST(n_chars AS VARCHAR) AS num_episodes, (20 + h.doc_id % 50) || ' minutes' AS runtime,
            source AS network, text AS plot
        FROM ({_bm25()}) h JOIN documents d ON h.doc_id = d.doc_id""",
    "search_report": f"""{_WITH}
        SELECT query_id, rank, h.doc_id, CAST(CAST(CAST(score AS DECIMAL(18,6)) AS DECIMAL(18,2)) AS VARCHAR)
                AS relevance,
            'Doc ' || h.doc_id || ' (' || (1950 + h.doc_id % 70) || ')' AS heading,
            CASE WHEN h.doc_id % 3 <> 0 THEN 'TV ' || (h.doc_id % 5) ELSE 'N/A' END AS certification,
            lang AS language, source || ', ' || lang AS genres,
            CAST(h.doc_id % 5 AS VARCHAR) AS user_rating,
            CASE WHEN h.doc_id % 2 = 0 THEN 'Ended' ELSE '' END AS status, 'Scripted' AS type,
            CASE WHEN h.doc_id % 4 <> 0 THEN 'Creator ' || (h.doc_id % 6) END AS creator,
            'Person ' || (h.doc_id % 10) AS "cast",
            CASE WHEN h.doc_id % 7 <> 0 THEN 'kw' || (h.doc_id % 9) || ', series' END AS keywords
        FROM ({_bm25()}) h JOIN documents d ON h.doc_id = d.doc_id""",
}

# Clause searches: the matching documents of each clause, then set logic.
_ITEMS = f"""{_WITH}, items AS (SELECT item_id, w, list_filter(w, lambda x: length(x) >= 9) AS long,
        list_filter(w, lambda x: length(x) BETWEEN 4 AND 8) AS middle, list_filter(w, lambda x: length(x) < 4) AS short
        FROM (SELECT item_id, {_tokens('text')} AS w FROM benchmark))"""


def _term_hits(clause: int, occur: str, words: str, field: str | None, boost: str = "1.0") -> str:
    scope = f"field = '{field}'" if field else "TRUE"
    return f"""
        SELECT item_id AS query_id, {clause} AS clause_id, '{occur}' AS occur, doc_id,
            idf * {boost} * {_SATURATION} AS score
        FROM (SELECT item_id, unnest({words}) AS term FROM items)
        JOIN postings USING (term) JOIN idf USING (field, term) WHERE {scope}"""


def _constant_hits(clause: int, occur: str, field: str, words: str, condition: str, boost: str = "1.0") -> str:
    """A clause for each of the words; ``condition`` is over ``word`` and ``term``."""
    return f"""
        SELECT DISTINCT item_id AS query_id, {clause * 10_000} + i AS clause_id, '{occur}' AS occur, doc_id,
            CAST({boost} AS DOUBLE) AS score
        FROM (SELECT item_id, unnest({words}) AS word, unnest(range(len({words}))) AS i FROM items) x
        JOIN (SELECT term FROM terms WHERE field = '{field}') t ON {condition}
        JOIN (SELECT term, doc_id FROM postings WHERE field = '{field}') p ON p.term = t.term"""


def _clause_sql(musts: str, *hits: str) -> str:
    """``musts``: how many clauses an item demands, an expression over ``items``."""
    return _ITEMS + _RANKED.format(f"""
        SELECT query_id, doc_id, round(sum(score) FILTER (WHERE occur <> 'must_not'), 6) AS score
        FROM ({" UNION ALL ".join(hits)}) JOIN (SELECT item_id AS query_id, {musts} AS musts FROM items) USING (query_id)
        GROUP BY query_id, doc_id, musts
        HAVING count(DISTINCT clause_id) FILTER (WHERE occur = 'must') = musts
            AND count(*) FILTER (WHERE occur = 'must_not') = 0
            AND (musts > 0 OR count(*) FILTER (WHERE occur = 'should') > 0)""")


def _single_bytes(text: str) -> str:
    """DuckDB's levenshtein counts bytes: give each accented letter of the (lower-case)
    texts a capital of its own, so that it counts characters."""
    return f"translate({text}, 'áàâäãçéèêëíîïñóôöúüß', 'ABCDEFGHIJKLMNOPQRST')"


_FIELD_TERM_SQL = _term_hits(0, "should", "w", "plot")
_TITLE_SQL = _term_hits(1, "should", "['doc', CAST(item_id AS VARCHAR)]", "title")
_YEARS = "term BETWEEN CAST(1950 + word % 60 AS VARCHAR) AND CAST(1952 + word % 60 AS VARCHAR)"


def _phrase_hits(starts: str) -> str:
    """``starts``: rows (item_id, clause, slot, slots, term) of the phrases' words."""
    return f"""
        SELECT query_id, doc_id, round(sum(total * {_SATURATION}), 6) AS score
        FROM (
            SELECT item_id AS query_id, clause, doc_id, any_value(length) AS length, count(*) AS tf
            FROM (
                SELECT item_id, clause, doc_id, position - slot AS start, any_value(length) AS length
                FROM ({starts}) s JOIN words x ON x.field = 'plot' AND x.term = s.term
                GROUP BY ALL HAVING count(*) = any_value(slots))
            GROUP BY ALL)
        JOIN (SELECT item_id AS query_id, clause, sum(idf) AS total FROM ({starts}) s
            JOIN idf ON idf.field = 'plot' AND idf.term = s.term GROUP BY ALL) USING (query_id, clause),
        (SELECT mean_length FROM fields WHERE field = 'plot')
        GROUP BY query_id, doc_id"""


_PHRASES = """
        SELECT item_id, 0 AS clause, unnest(range(len(w))) AS slot, len(w) AS slots, unnest(w) AS term FROM items
        UNION ALL SELECT item_id, i AS clause, slot, 2 AS slots, w[i + slot] AS term
        FROM (SELECT item_id, w, unnest(range(1, len(w))) AS i FROM items), (SELECT unnest([0, 1]) AS slot)
        WHERE length(w[i]) >= 9 OR length(w[i + 1]) >= 9"""

ORACLES |= {
    "search_field_term": _clause_sql("0", _FIELD_TERM_SQL, _TITLE_SQL),
    "search_must": _clause_sql(
        "CAST(len(long) > 0 AS INTEGER) + CAST(len(middle) > 0 AS INTEGER)",
        _term_hits(0, "must", "long", None),
        _term_hits(1, "must", "middle", "plot"),
        _term_hits(2, "should", "short", "plot"),
    ),
    "search_must_not": _clause_sql(
        "0",
        _term_hits(0, "should", "middle", "plot"),
        _term_hits(1, "must_not", "long", "plot"),
        _term_hits(2, "must_not", "['de']", "language"),
    ),
    "search_phrase": _ITEMS + _RANKED.format(_phrase_hits(_PHRASES)),
    "search_prefix": _clause_sql(
        "0",
        _constant_hits(0, "should", "plot", "long", "starts_with(t.term, left(word, 6))"),
        _constant_hits(1, "should", "plot", "long", "t.term LIKE left(word, 4) || '%' || right(word, 1) || '_'"),
    ),
    "search_fuzzy": _ITEMS
    + _RANKED.format(rf"""
        SELECT item_id AS query_id, doc_id, round(sum(idf * (1 - edits / shorter) * {_SATURATION}), 6) AS score
        FROM (SELECT item_id, i, term, levenshtein({_single_bytes("word || 'x'")}, {_single_bytes("term")}) AS edits,
                least(length(word) + 1, length(term)) AS shorter
            FROM (SELECT item_id, unnest(long) AS word, unnest(range(len(long))) AS i FROM items),
                (SELECT term FROM terms WHERE field = 'plot')
            WHERE abs(length(term) - length(word) - 1) <= 2)
        JOIN postings USING (term) JOIN idf USING (field, term)
        WHERE edits <= 2 AND edits < shorter AND field = 'plot'
        GROUP BY ALL"""),
    "search_range": _clause_sql(
        "1",
        _constant_hits(0, "must", "year", "[item_id]", _YEARS),
        _term_hits(1, "should", "w", "plot"),
    ),
    "search_clauses_boosted": _clause_sql(
        "1",
        _term_hits(0, "must", "w", None, _BOOST),
        _term_hits(1, "should", "['doc', CAST(item_id AS VARCHAR)]", "title", _BOOST),
        _term_hits(2, "should", "['kw' || (item_id % 9)]", "keywords", _BOOST),
        _term_hits(3, "should", "['creator', CAST(item_id % 6 AS VARCHAR)]", "creator", _BOOST),
        _constant_hits(4, "should", "runtime", "['minu']", "starts_with(t.term, word)", str(se.BOOSTS["runtime"])),
        _constant_hits(5, "should", "num_seasons", "['2']", "t.term BETWEEN word AND '5'", str(se.BOOSTS["num_seasons"])),
    ),
}
