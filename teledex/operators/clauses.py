"""Structured search: queries given as clause rows.

A clause row is ``(query_id, clause_id, occur, kind, field, text, upper)``:

``occur``  ``must``, ``should`` or ``must_not``
``kind``   ``term``, ``phrase``, ``prefix``, ``wildcard`` (``*``, ``?``), ``fuzzy``
           or ``range`` (``text`` to ``upper``, both included)
``field``  one field, or null for all

Every clause is first resolved against the term dictionary; one pass over the postings
then serves all word clauses, and two the phrases if there are any. Terms, phrases and
fuzzy terms score by BM25, the pattern kinds score 1 per matching field; ``boosts`` weigh
the fields. Postings are bucketed by document and never move. Scores of words are summed
per query and document at once; which clauses matched is kept in the bits of numbers.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.analysis import tokenize
from ..storage import materialize
from .index import FIELDS, SearchIndex, saturation, with_idf
from .search import SCORE_DIGITS, TOP_K, boost, top_k

CLAUSE_SCHEMA = (
    "query_id bigint, clause_id int, occur string, kind string, "
    "field string, text string, upper string"
)
MAX_EDITS = 2
_LEAD = 3  # literal characters of a pattern used as join key
_CLAUSE = ["query_id", "clause_id", "occur"]


def _scoped(clauses: DataFrame, *kinds: str) -> DataFrame:
    """Clauses of the given kinds, one row per field they cover."""
    every = F.array(*[F.lit(f) for f in FIELDS])
    covered = F.when(F.col("field").isNull(), every).otherwise(F.array("field"))
    return clauses.filter(F.col("kind").isin(*kinds)).withColumn("field", F.explode(covered))


def _resolved(
    rows: DataFrame, weight: Column, constant: bool = False, slot: Column | None = None,
    slots: Column | None = None, df: Column | None = None,
) -> DataFrame:
    null = F.lit(None)
    return rows.select(
        *_CLAUSE,
        "field",
        "term",
        weight.cast("double").alias("weight"),
        F.lit(constant).alias("constant"),
        (null if slot is None else slot).cast("int").alias("slot"),
        (null if slots is None else slots).cast("int").alias("slots"),
        (null if df is None else df).cast("long").alias("df"),
    )


def _terms(clauses: DataFrame, dictionary: DataFrame) -> DataFrame:
    words = _scoped(clauses, "term").select(
        *_CLAUSE, "field", F.explode(tokenize(F.col("text"))).alias("term")
    )
    counted = words.groupBy(*_CLAUSE, "field", "term").agg(F.count(F.lit(1)).alias("repeats"))
    return _resolved(
        dictionary.join(counted, ["field", "term"]), F.col("repeats") * F.col("idf")
    )


def _phrases(clauses: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row per word with its place; the weight is the sum of all words' idf."""
    words = _scoped(clauses, "phrase").withColumn("words", tokenize(F.col("text")))
    placed = words.select(
        *_CLAUSE, "field", F.size("words").alias("slots"), F.posexplode("words").alias("slot", "term")
    )
    found = dictionary.join(placed, ["field", "term"])
    total = found.groupBy(*_CLAUSE, "field").agg(
        F.sum("idf").alias("total_idf"), F.count(F.lit(1)).alias("known")
    )
    complete = found.join(total, [*_CLAUSE, "field"]).filter(F.col("known") == F.col("slots"))
    return _resolved(complete, F.col("total_idf"), slot=F.col("slot"), slots=F.col("slots"), df=F.col("df"))


def _like_pattern(text: Column, kind: Column) -> Column:
    literal = F.regexp_replace(text, r"([\\%_])", r"\\$1")
    wild = F.translate(literal, "*?", "%_")
    return F.when(kind == "prefix", F.concat(literal, F.lit("%"))).otherwise(wild)


def _patterns(clauses: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Prefix and wildcard: joined on the pattern's first literal characters, so a
    term meets only patterns that start like it. A wildcard needs a literal start."""
    text = F.lower("text")
    literal = F.when(F.col("kind") == "prefix", text).otherwise(
        F.regexp_extract(text, r"^[^*?]*", 0)
    )
    wanted = _scoped(clauses, "prefix", "wildcard").select(
        *_CLAUSE,
        "field",
        _like_pattern(text, F.col("kind")).alias("pattern"),
        F.substring(literal, 1, _LEAD).alias("lead"),
    )
    leads = F.transform(
        F.sequence(F.lit(1), F.least(F.length("term"), F.lit(_LEAD))),
        lambda n: F.substr(F.col("term"), F.lit(1), n),
    )
    offered = dictionary.select("field", "term", F.explode(leads).alias("lead"))
    found = offered.join(wanted, ["field", "lead"]).filter(F.expr(r"term LIKE pattern"))
    return _resolved(found, F.lit(1.0), constant=True)


def _segments(length: Column, i: Column) -> tuple[Column, Column]:
    """1-based start and length of segment ``i`` when ``length`` characters are cut
    into MAX_EDITS + 1 near-equal segments, longer ones last."""
    parts = MAX_EDITS + 1
    base = F.floor(length / parts).cast("int")
    short = parts - length % parts
    start = 1 + i * base + F.greatest(F.lit(0), i - short)
    return start, base + F.when(i >= short, 1).otherwise(0)


def _fuzzy(clauses: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Within two edits, found without comparing all pairs.

    Two edits leave one of a term's three segments intact, moved by at most two
    places (Pass-Join; Li et al. 2011). So terms and clauses meet on equal segments
    and only those pairs are measured.
    """
    parts = MAX_EDITS + 1
    segment = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    text, length = F.col("needle"), F.col("length")

    start, size = _segments(length, F.col("segment"))
    offered = (
        dictionary.select("field", "term", "idf", F.length("term").alias("length"))
        .withColumn("segment", segment)
        .withColumn("piece", F.substr(F.col("term"), start, size))
    )
    at = start + F.col("shift")
    probes = (
        _scoped(clauses, "fuzzy")
        .select(*_CLAUSE, "field", F.lower("text").alias("needle"))
        .withColumn(
            "length",
            F.explode(
                F.sequence(
                    F.greatest(F.lit(1), F.length(text) - MAX_EDITS), F.length(text) + MAX_EDITS
                )
            ),
        )
        .withColumn("segment", segment)
        .withColumn("shift", F.explode(F.sequence(F.lit(-MAX_EDITS), F.lit(MAX_EDITS))))
        .filter((at >= 1) & (at + size - 1 <= F.length(text)))
        .select(
            *_CLAUSE, "field", "needle", "length", "segment", F.substr(text, at, size).alias("piece")
        )
        .distinct()
    )
    edits = F.levenshtein("needle", "term", MAX_EDITS)
    shorter = F.least(F.length("needle"), F.length("term"))
    found = (
        offered.join(probes, ["field", "length", "segment", "piece"])
        .withColumn("edits", edits)
        .filter(F.col("edits") >= 0)
        .select(*_CLAUSE, "field", "term", (F.col("idf") * (1 - F.col("edits") / shorter)).alias("w"))
        .distinct()
    )
    return _resolved(found.filter(F.col("w") > 0), F.col("w"))


def _ranges(clauses: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Lexicographic, both ends included; a null end is open.

    A range is split into leads, the first characters its terms can have. The dictionary's
    few distinct leads are compared with the ends; its terms join by equality on the lead.
    All terms of an inner lead belong to the range, so only those of the leads at either
    edge are compared themselves.
    """
    lead = F.substring("term", 1, _LEAD).alias("lead")
    wanted = _scoped(clauses, "range").select(
        *_CLAUSE, "field", F.lower("text").alias("low"), F.lower("upper").alias("high"),
        F.substring(F.lower("text"), 1, _LEAD).alias("low_lead"),
        F.substring(F.lower("upper"), 1, _LEAD).alias("high_lead"),
    )
    leads = dictionary.select("field", lead).distinct()
    above, below = F.col("low").isNull(), F.col("high").isNull()
    met = leads.join(wanted, "field").filter(
        (above | (F.col("lead") >= F.col("low_lead"))) & (below | (F.col("lead") <= F.col("high_lead")))
    )
    # At an edge the end itself is kept to compare with; inside it no longer matters.
    met = met.withColumns(
        {
            "low": F.when(F.col("lead") == F.col("low_lead"), F.col("low")),
            "high": F.when(F.col("lead") == F.col("high_lead"), F.col("high")),
        }
    )
    term = F.col("term")
    inside = (above | (term >= F.col("low"))) & (below | (term <= F.col("high")))
    found = dictionary.select("field", "term", lead).join(met, ["field", "lead"]).filter(inside)
    return _resolved(found, F.lit(1.0), constant=True)


_KINDS = {
    "term": _terms,
    "phrase": _phrases,
    "prefix": _patterns,
    "wildcard": _patterns,
    "fuzzy": _fuzzy,
    "range": _ranges,
}


def resolve_clauses(
    clauses: DataFrame, index: SearchIndex, boosts: dict[str, float] | None = None
) -> DataFrame:
    """Dictionary terms behind every clause, weighted. Only the kinds in use enter the plan."""
    dictionary = with_idf(index.terms, index.fields)
    unknown = clauses.filter(~F.coalesce(F.col("kind").isin(list(_KINDS)), F.lit(False)))
    if not unknown.isEmpty():
        raise ValueError(f"clause kinds must be among {sorted(_KINDS)}")
    starts = F.regexp_extract(F.coalesce("text", F.lit("")), r"^[^*?]*", 0)
    empty = F.when(F.col("kind") == "prefix", F.coalesce("text", F.lit("")) == "")
    bare = clauses.filter(F.when(F.col("kind") == "wildcard", starts == "").otherwise(empty))
    if not bare.isEmpty():
        raise ValueError("a prefix or wildcard must start with a literal character")
    used = [row.kind for row in clauses.select("kind").distinct().collect()]  # six at most
    resolvers = dict.fromkeys(_KINDS[kind] for kind in used or ["term"])
    rows = reduce(DataFrame.unionByName, [resolve(clauses, dictionary) for resolve in resolvers])
    return rows.withColumn("weight", F.col("weight") * boost(F.col("field"), boosts))


_PLACE = [*_CLAUSE, "field", "doc_id"]


def _postings(index: SearchIndex, *columns: str) -> DataFrame:
    return index.postings.select("doc_id", "field", "term", *columns)


def _word_hits(index: SearchIndex, wanted: DataFrame) -> DataFrame:
    """Clauses that any of their terms satisfies."""
    rows = _postings(index, "tf", "length").join(wanted, ["field", "term"])
    part = F.col("weight") * saturation(F.col("tf"), F.col("length"), F.col("mean_length"))
    score = F.when(F.max("constant"), F.max("weight")).otherwise(F.sum(part))
    return rows.groupBy(_PLACE).agg(score.alias("score"))


def _phrase_words(wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words of all phrases, ``(field, term, word, asks)``, and the clauses behind each
    distinct phrase. ``asks`` holds the phrases of which the word is the rarest, with the
    places of their words, rarest first."""
    words = wanted.select("field", "term", "df").distinct().withColumn("word", F.monotonically_increasing_id())
    words = materialize(words, "phrase-words")
    place = F.struct("df", "word", "slot")
    placed = wanted.join(words.drop("df"), ["field", "term"]).groupBy(*_CLAUSE, "field", "weight", "mean_length")
    clauses = placed.agg(F.transform(F.sort_array(F.collect_list(place)), lambda p: p.dropFields("df")).alias("places"))
    phrases = clauses.select("places").distinct().withColumn("phrase", F.monotonically_increasing_id())
    phrases = materialize(phrases, "phrases")
    rarest = F.get("places", F.lit(0))["word"].alias("word")
    asks = phrases.groupBy(rarest).agg(F.collect_list(F.struct("phrase", "places")).alias("asks"))
    asked = materialize(words.drop("df").join(asks, "word", "left"), "phrase-asks")
    return asked, materialize(clauses.join(phrases, "places").drop("places"), "phrase-clauses")


def _phrase_hits(index: SearchIndex, wanted: DataFrame) -> DataFrame:
    """A phrase occurs where all its words agree on where it starts.

    A document is asked for a phrase only if it holds the phrase's rarest word, so common
    words make no rows per clause; and only once, however many clauses ask for it. The first
    pass finds the documents with all words of a phrase, without positions. Only of these
    the second gathers positions: the starts that each word's allow intersect.
    """
    words, clauses = _phrase_words(wanted)
    known = F.col("doc_id").isNotNull()
    held = _postings(index).filter(known).join(words, ["field", "term"]).groupBy("doc_id")
    held = held.agg(F.collect_list("word").alias("held"), F.flatten(F.collect_list("asks")).alias("asks"))
    has_all = lambda ask: F.forall(ask["places"], lambda p: F.array_contains("held", p["word"]))
    whole = F.struct("doc_id", F.filter("asks", has_all).alias("asks"))
    # Listed and filtered as one, so that the words are compared once.
    whole = held.select(F.inline(F.filter(F.array(whole), lambda x: F.size(x["asks"]) > 0)))
    needed = F.array_distinct(F.flatten(F.transform("asks", lambda ask: ask["places"]["word"])))
    rows = _postings(index, "length", "positions").join(words.drop("asks"), ["field", "term"])
    rows = rows.join(whole.withColumn("needed", needed), "doc_id").filter(F.array_contains("needed", F.col("word")))
    entry = F.struct("word", F.struct("length", "positions").alias("posting"))
    per_document = rows.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(entry)).alias("posted"), F.first("asks").alias("asks"))

    def starts(place: Column) -> Column:
        return F.transform(F.try_element_at("posted", place["word"])["positions"], lambda p: p - place["slot"])

    def counted(ask: Column) -> Column:
        first, others = F.get(ask["places"], F.lit(0)), F.slice(ask["places"], F.lit(2), F.size(ask["places"]))
        shared = F.aggregate(others, starts(first), lambda found, place: F.array_intersect(found, starts(place)))
        length = F.try_element_at("posted", first["word"])["length"]
        return F.struct(ask["phrase"].alias("phrase"), F.size(shared).alias("tf"), length.alias("length"))

    found = F.filter(F.transform("asks", counted), lambda x: x["tf"] > 0)
    score = F.col("weight") * saturation(F.col("tf"), F.col("length"), F.col("mean_length"))
    return per_document.select("doc_id", F.inline(found)).join(clauses, "phrase").select(*_PLACE, score.alias("score"))


def _repeated(index: SearchIndex) -> DataFrame:
    """Ids that several records with the same field have."""
    fields = index.postings.filter("ordinal = 0").groupBy("doc_id", "field").agg(F.count(F.lit(1)).alias("records"))
    return fields.filter((F.col("records") > 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def _phrases_found(index: SearchIndex, wanted: DataFrame) -> DataFrame:
    """Phrases of records whose id is their own, and apart from them of ids that repeat."""
    repeated = materialize(_repeated(index), "repeated-ids")
    if repeated.isEmpty():
        return _phrase_hits(index, wanted)
    own, shared = (index.postings.join(repeated, "doc_id", how) for how in ("left_anti", "left_semi"))
    hits = _phrase_hits(replace(index, postings=own), wanted)
    return hits.unionByName(_shared_phrase_hits(replace(index, postings=shared), wanted))


def _shared_phrase_hits(index: SearchIndex, wanted: DataFrame) -> DataFrame:
    """As :func:`_phrase_hits` for ids that repeat: the postings of an id count together, so
    one that lacks a word may still have as many as the phrase has words."""
    words = wanted.select(*_CLAUSE, "field", "term", "slots").distinct()
    distinct = wanted.groupBy(*_CLAUSE, "field").agg(F.count_distinct("term").alias("words"))
    held = _postings(index).join(words, ["field", "term"]).groupBy(_PLACE).agg(F.count(F.lit(1)).alias("held"))
    whole = held.join(distinct, [*_CLAUSE, "field"]).filter(F.col("held") == F.col("words")).select(_PLACE)
    # Per document the clauses to look at: one row that meets all of its postings.
    clause = F.struct(*_CLAUSE, "field")
    asked = whole.groupBy("doc_id").agg(F.collect_set(clause).alias("asked"))
    rows = _postings(index, "length", "positions").join(wanted, ["field", "term"]).join(asked, "doc_id")
    rows = rows.filter(F.array_contains("asked", clause)).drop("asked")
    details = ("weight", "length", "mean_length", "slots")
    per_document = (
        rows.withColumn("starts", F.transform("positions", lambda p: p - F.col("slot")))
        .groupBy(_PLACE)
        .agg(F.collect_list("starts").alias("starts"), *[F.max(c).alias(c) for c in details])
    )
    shared = F.aggregate(
        F.slice("starts", F.lit(2), F.size("starts")), F.get("starts", F.lit(0)), F.array_intersect
    )
    score = F.col("weight") * saturation(F.col("tf"), F.col("length"), F.col("mean_length"))
    counted = per_document.withColumn("tf", F.size(shared)).filter(F.col("tf") > 0)
    return counted.select(*_PLACE, score.alias("score"))


def _wanted(clauses: DataFrame, index: SearchIndex, boosts: dict[str, float] | None) -> DataFrame:
    means = index.fields.select("field", "mean_length")
    return resolve_clauses(clauses, index, boosts).join(means, "field")


def clause_hits(
    clauses: DataFrame, index: SearchIndex, boosts: dict[str, float] | None = None
) -> DataFrame:
    """``(query_id, clause_id, occur, field, doc_id, score)`` of every matching clause.

    Positions, the bulk of the postings, are read only when there are phrases.
    """
    in_phrase = F.col("slot").isNotNull()
    wanted = materialize(_wanted(clauses, index, boosts), "clauses")
    hits = []
    for kind, rows in ((_word_hits, wanted.filter(~in_phrase)), (_phrases_found, wanted.filter(in_phrase))):
        if not rows.isEmpty():
            hits.append(kind(index, rows))
    return reduce(DataFrame.unionByName, hits or [_word_hits(index, wanted)])


# Bits of what matched: the first two, then one for each ``must`` clause of the query.
_SHOULD, _MUST_NOT, _MUST = 0, 1, 2
_BITS = 62  # in one number


def _marked(wanted: DataFrame) -> tuple[DataFrame, list[str]]:
    """Adds the bits of a clause, in as many columns as the query with most ``must`` clauses
    takes, and ``place``: 0 where scores add up over terms, else a number for the clause's field."""
    occur = F.col("occur")
    clause = Window.partitionBy("query_id", "occur").orderBy("clause_id")
    bit = F.when(occur == "must", F.dense_rank().over(clause) - 1 + _MUST)
    bit = bit.when(occur == "should", _SHOULD).when(occur == "must_not", _MUST_NOT)
    once = F.max("constant").over(Window.partitionBy(*_CLAUSE, "field"))
    number = F.dense_rank().over(Window.partitionBy("query_id").orderBy("clause_id", "occur", "field"))
    rows = wanted.withColumns({"bit": bit, "place": F.when(once, number).otherwise(0), "scored": occur != "must_not"})
    rows = materialize(rows, "clauses")
    last = rows.agg(F.max("bit")).first()[0] or 0  # one number
    names = [f"bits{n}" for n in range(last // _BITS + 1)]
    marked = {x: F.expr(f"CASE WHEN bit DIV {_BITS} = {n} THEN shiftleft(1L, bit % {_BITS}) ELSE 0L END") for n, x in enumerate(names)}
    return rows.withColumns(marked), names


def _document_words(index: SearchIndex, wanted: DataFrame, bits: list[str]) -> DataFrame:
    """``(query_id, doc_id, score, bits)`` of the word clauses. The pattern kinds score once
    per clause and field, so these are grouped by place first."""
    rows = _postings(index, "tf", "length").join(wanted, ["field", "term"])
    part = F.when(F.col("scored"), F.col("weight") * saturation(F.col("tf"), F.col("length"), F.col("mean_length")))
    if not wanted.filter("place > 0").isEmpty():
        once = F.max(F.when(F.col("scored"), F.col("weight")))
        score = F.when(F.max("constant"), once).otherwise(F.sum(part))
        rows = rows.groupBy("query_id", "doc_id", "place").agg(score.alias("score"), *[F.bit_or(x).alias(x) for x in bits])
        part = F.col("score")
    return _document_sums(rows, part, bits)


def _document_sums(rows: DataFrame, score: Column, bits: list[str]) -> DataFrame:
    return rows.groupBy("query_id", "doc_id").agg(F.sum(score).alias("score"), *[F.bit_or(x).alias(x) for x in bits])


def _document_phrases(index: SearchIndex, wanted: DataFrame, bits: list[str]) -> DataFrame:
    marks = wanted.select(*_CLAUSE, "scored", *bits).distinct()
    hits = _phrases_found(index, wanted).join(marks, _CLAUSE)
    return _document_sums(hits, F.when(F.col("scored"), F.col("score")), bits)


def search_clauses(
    clauses: DataFrame,
    index: SearchIndex,
    k: int = TOP_K,
    boosts: dict[str, float] | None = None,
) -> DataFrame:
    """``(query_id, doc_id, score, rank)``: documents that match every ``must`` clause,
    no ``must_not`` clause and, without a ``must``, at least one ``should``. ``boosts``
    weigh what a clause scores in a field, for all kinds of clauses.

    A ``must`` clause of terms or a phrase that holds no word demands nothing.
    """
    wordless = F.col("kind").isin("term", "phrase") & (F.size(tokenize(F.coalesce("text", F.lit("")))) == 0)
    demanded = clauses.groupBy("query_id").agg(F.count_if((F.col("occur") == "must") & ~wordless).alias("demanded"))
    wanted, bits = _marked(_wanted(clauses, index, boosts))
    in_phrase = F.col("slot").isNotNull()
    parts = []
    for kind, rows in ((_document_words, wanted.filter(~in_phrase)), (_document_phrases, wanted.filter(in_phrase))):
        if not rows.isEmpty():
            parts.append(kind(index, rows, bits))
    documents = reduce(DataFrame.unionByName, parts or [_document_words(index, wanted, bits)])
    if len(parts) > 1:
        documents = _document_sums(documents, F.col("score"), bits)
    has = lambda bit: F.col(bits[0]).bitwiseAND(1 << bit) != 0
    must = sum((F.bit_count(x) for x in bits), F.lit(0)) - has(_SHOULD).cast("int") - has(_MUST_NOT).cast("int")
    accepted = documents.join(demanded, "query_id").filter(
        (must == F.col("demanded")) & ~has(_MUST_NOT) & ((F.col("demanded") > 0) | has(_SHOULD))
    )
    return top_k(accepted.select("query_id", "doc_id", F.round("score", SCORE_DIGITS).alias("score")), k)
