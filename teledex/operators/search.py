"""Ranked search for a table of queries.

Scores are BM25 summed over query words and fields (Robertson & Zaragoza 2009,
without the constant factor k1 + 1, which does not change the order).

The best ``k`` are found without scoring every document that holds a query word. The
dictionary bounds what a word can add to a score (its weight times its highest share):

1. A query's leading words, those of the highest bounds that make up half of their sum,
   are scored alone. The k-th best sum is a floor: the k-th best score is no lower.
2. Words of the lowest bounds that together stay below the floor can't lift a document
   over it by themselves. All other words are scored; documents without any of them, and
   those that stay below the floor even with the whole bound of the left-out words, go.
3. Only the documents that remain get the shares of the left-out (common) words added.

Postings are bucketed by document, so all of this happens where they lie. What moves is
sums per query and document, few thanks to the floor, and ``k`` rows per query and task.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.analysis import tokenize
from ..functions.regex import strip
from ..sources.jsonl import parsed
from ..storage import materialize
from .index import SearchIndex, saturation, with_idf

# --- Fixed values: they decide the results and must stay as they are. -----------
TOP_K = 10
BOOSTS = {
    "title": 2.0,
    "keywords": 1.7,
    "genres": 2.0,
    "cast": 1.5,
    "creator": 1.2,
    "country": 0.6,
    "network": 0.6,
    "plot": 0.6,
    "num_seasons": 0.5,
    "num_episodes": 0.5,
    "runtime": 0.5,
}
# --------------------------------------------------------------------------------

# Sums of doubles depend on the order of rows; ranking on rounded scores does not.
SCORE_DIGITS = 6
# Bounds and floors are compared with room for that rounding.
ROOM = 1e-5
# Share of a query's summed bounds that its leading words have. Any value gives equal rows.
LEADING = 0.5


def query_terms(queries: DataFrame) -> DataFrame:
    """``(query_id, term, repeats)`` of ``(query_id, text)``; blank queries vanish."""
    words = queries.filter(strip(F.col("text")) != "").select(
        "query_id", F.explode(tokenize(F.col("text"))).alias("term")
    )
    return words.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("repeats"))


def boost(field: Column, boosts: dict[str, float] | None) -> Column:
    """Weight of a field, 1 where none is given."""
    if not boosts:
        return F.lit(1.0)
    pairs = [F.lit(x) for item in boosts.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), field), F.lit(1.0))


def within(index: SearchIndex, fields: list[str] | None) -> SearchIndex:
    """The index of some fields only. Buckets are sorted by field, so that a search in short
    fields skips the pages of the long ones."""
    if fields is None:
        return index
    chosen = F.col("field").isin(fields)
    return replace(index, postings=index.postings.filter(chosen), terms=index.terms.filter(chosen))


def query_weights(
    queries: DataFrame,
    index: SearchIndex,
    fields: list[str] | None = None,
    boosts: dict[str, float] | None = None,
) -> DataFrame:
    """``(query_id, field, term, weight, bound, mean_length)``: each query word in each field
    that contains it. Only as large as the queries, not as the collection."""
    known = with_idf(within(index, fields).terms.join(query_terms(queries), "term"), index.fields)
    weight = F.col("repeats") * F.col("idf") * boost(F.col("field"), boosts)
    return known.select(
        "query_id", "field", "term", weight.alias("weight"),
        (weight * F.col("top_share")).alias("bound"), "mean_length",
    )


def summed_hits(weights: DataFrame, index: SearchIndex) -> DataFrame:
    """``(query_id, doc_id, score)``: unrounded sums over the given words. How the words
    reach the postings is left to the optimizer, which knows the written table's size."""
    hits = index.postings.select("doc_id", "field", "term", "tf", "length").join(weights, ["field", "term"])
    part = F.col("weight") * saturation(F.col("tf"), F.col("length"), F.col("mean_length"))
    return hits.groupBy("query_id", "doc_id").agg(F.sum(part).alias("score"))


def score_documents(
    queries: DataFrame,
    index: SearchIndex,
    fields: list[str] | None = None,
    boosts: dict[str, float] | None = None,
) -> DataFrame:
    """``(query_id, doc_id, score)`` for every document holding a query word."""
    weights = materialize(query_weights(queries, index, fields, boosts), "weights")
    scores = summed_hits(weights, within(index, fields))
    return scores.withColumn("score", F.round("score", SCORE_DIGITS))


def top_k(scores: DataFrame, k: int = TOP_K) -> DataFrame:
    """Best ``k`` per query, ties in document order. Each task keeps its own best
    ``k`` before the shuffle by query."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _floors(sums: DataFrame, k: int) -> DataFrame:
    """``(query_id, floor)``: the k-th best of the sums, for queries with so many."""
    return top_k(sums, k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))


def _ranked_words(weights: DataFrame) -> DataFrame:
    """Words with ``leading`` and ``rest``: the bounds of the word and of all lower ones."""
    order = Window.partitionBy("query_id").orderBy("bound", "field", "term")
    whole = F.sum("bound").over(Window.partitionBy("query_id"))
    lower = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = weights.withColumn("rest", F.sum("bound").over(lower)).withColumn("whole", whole)
    return ranked.withColumn("leading", F.col("rest") > (1 - LEADING) * F.col("whole")).drop("whole")


def candidates(
    queries: DataFrame,
    index: SearchIndex,
    fields: list[str] | None = None,
    boosts: dict[str, float] | None = None,
    k: int = TOP_K,
) -> tuple[DataFrame, DataFrame]:
    """Documents that can be among the best ``k``, ``(query_id, doc_id, score)`` with sums
    that lack the left-out words, and those words ``(query_id, field, term, weight,
    mean_length)``."""
    index = within(index, fields)
    words = materialize(_ranked_words(query_weights(queries, index, None, boosts)), "weights")
    floors = materialize(_floors(summed_hits(words.filter("leading"), index), k), "floors")
    judged = words.join(floors, "query_id", "left")
    judged = judged.withColumn("left_out", F.coalesce(F.col("rest") < F.col("floor") - ROOM, F.lit(False)))
    # Written, as the optimizer takes the size of a join for the product of both sides and
    # would move all postings to meet the words by term.
    judged = materialize(judged, "judged-words")
    scored = materialize(summed_hits(judged.filter("NOT left_out"), index), "sums")
    room = judged.groupBy("query_id").agg(F.coalesce(F.max(F.when(F.col("left_out"), F.col("rest"))), F.lit(0.0)).alias("room"))
    limits = room.join(_floors(scored, k), "query_id", "left")
    near = scored.join(limits, "query_id").filter(
        F.col("floor").isNull() | (F.col("score") + F.col("room") >= F.col("floor") - ROOM)
    )
    out = judged.filter("left_out").select("query_id", "field", "term", "weight", "mean_length")
    return materialize(near.select("query_id", "doc_id", "score"), "candidates"), out


def search(
    queries: DataFrame,
    index: SearchIndex,
    fields: list[str] | None = None,
    boosts: dict[str, float] | None = None,
    k: int = TOP_K,
) -> DataFrame:
    """``(query_id, doc_id, score, rank)``. All fields unboosted by default; pass
    :data:`BOOSTS` for the preset weights; a boost is never negative."""
    index = within(index, fields)
    near, left_out = candidates(queries, index, None, boosts, k)
    # A document's shares of all left-out words, then each query's weights for them.
    words = left_out.groupBy("field", "term").agg(F.first("mean_length").alias("mean_length"))
    words = materialize(words.withColumn("word", F.monotonically_increasing_id()), "word-numbers")
    share = saturation(F.col("tf"), F.col("length"), F.col("mean_length"))
    held = index.postings.select("doc_id", "field", "term", "tf", "length").join(words, ["field", "term"])
    held = held.join(near.select("doc_id").distinct(), "doc_id", "left_semi")
    shares = held.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("word", share.alias("share")))).alias("shares"))
    wanted = left_out.join(words.select("field", "term", "word"), ["field", "term"])
    wanted = wanted.groupBy("query_id").agg(F.collect_list(F.struct("word", "weight")).alias("wanted"))
    full = near.join(wanted, "query_id", "left").join(shares, "doc_id", "left")
    part = lambda total, w: total + w["weight"] * F.coalesce(F.try_element_at("shares", w["word"]), F.lit(0.0))
    more = F.when(F.col("shares").isNotNull() & F.col("wanted").isNotNull(), F.aggregate("wanted", F.lit(0.0), part))
    score = F.round(F.col("score") + F.coalesce(more, F.lit(0.0)), SCORE_DIGITS)
    return top_k(full.select("query_id", "doc_id", score.alias("score")), k)


def _named(hits: DataFrame) -> DataFrame:
    return materialize(
        hits.select("query_id", "rank", F.col("doc_id"), F.col("score").alias("relevance")), "hits"
    )


def hydrate(hits: DataFrame, records: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Hits with the full record. Hits are few, so the records need not move."""
    return _named(hits).join(records.withColumnRenamed(doc_id, "doc_id"), "doc_id")


def hydrate_lines(hits: DataFrame, lines: DataFrame, schema: StructType) -> DataFrame:
    """Hits with their records, from numbered lines of JSON (``sources.jsonl``): only the
    lines of hits are parsed."""
    found = _named(hits)
    wanted = lines.join(found.select("doc_id").distinct(), "doc_id", "left_semi")
    return found.join(parsed(wanted, schema), "doc_id")


def report(hydrated: DataFrame) -> DataFrame:
    """Display columns of hydrated hits; absent values show as ``N/A``."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("N/A"))

    def listed(name: str) -> Column:
        return F.nullif(F.array_join(name, ", "), F.lit(""))

    return hydrated.select(
        "query_id",
        "rank",
        "doc_id",
        F.format_string("%.2f", "relevance").alias("relevance"),
        F.format_string("%s (%s)", shown("title"), shown("year")).alias("heading"),
        shown("certification").alias("certification"),
        shown("language").alias("language"),
        F.coalesce(listed("genres"), F.lit("N/A")).alias("genres"),
        shown("score").alias("user_rating"),
        shown("status").alias("status"),
        shown("type").alias("type"),
        listed("creator").alias("creator"),
        listed("cast").alias("cast"),
        listed("keywords").alias("keywords"),
    )
