"""Temperature mixing: source shares raised to an exponent, realised by whole passes.

A source with share p of the tokens gets the weight p^a / sum of all p^a. The exponent a
is bisected until the weights meet a target: a given entropy, or the largest exponent
range that keeps every source within a repetition limit. The budget gives the largest
source exactly one pass, so no document is left out; smaller sources are passed over
several times. A pass is a permutation of blocks of documents, and of the documents in
each block; the last, partial pass of a source ends where its budget does.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import filled, in_order, spare

BLOCK_TOKENS = 1 << 16
GRID, ROUNDS = 32, 5


def words(text: Column) -> Column:
    """The tokens of a text, counted as runs of other than white space."""
    return F.coalesce(F.regexp_count(filled(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def _at(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """Entropy and largest repetition for each exponent, in one pass over the sources.

    Repetition is relative to the largest source: (p_min / p_max)^(a - 1).
    """
    sums = []
    for i, a in enumerate(exponents):
        power = F.pow("share", F.lit(a))
        sums += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log("share")).alias(f"l{i}")]
    row = sources.agg(*sums, F.min("share").alias("low"), F.max("share").alias("high")).first()
    out = []
    for i, a in enumerate(exponents):
        z, moment = row[f"z{i}"], row[f"l{i}"]
        out.append((math.log(z) - a * moment / z, (row.low / row.high) ** (a - 1)))
    return out


def exponent(sources: DataFrame, entropy: float | None = None, repetition: float | None = None) -> float:
    """The exponent in [0, 1] that meets the target: the entropy (in nats, as near as the
    range allows), or the smallest exponent whose repetition stays within the limit.

    Both fall as the exponent grows, so the range is cut: each of the rounds evaluates a
    grid of exponents in one aggregation over the written table of sources, however many.
    """
    if (entropy is None) == (repetition is None):
        raise ValueError("give a target entropy or a repetition limit")
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        values = _at(sources, grid)
        over = [h > entropy if entropy is not None else r > repetition for h, r in values]
        if not over[0]:
            return low
        last = max(i for i, x in enumerate(over) if x)
        if last == GRID:
            return high
        low, high = grid[last], grid[last + 1]
    return high


def plan(sources: DataFrame, entropy: float | None = None, repetition: float | None = None) -> DataFrame:
    """Per source (group, tokens, share): its weight, passes and tokens of a partial pass."""
    if sources.isEmpty():
        return sources.selectExpr("*", "1D AS weight", "1L AS passes", "0L AS rest")
    a = exponent(sources, entropy, repetition)
    sums = sources.agg(F.sum(F.pow("share", F.lit(a))).alias("z"), F.max("share").alias("high")).first()
    weighted = sources.withColumn("weight", F.pow("share", F.lit(a)) / sums.z)
    # Budget: the largest source passes once, so others pass (share / high)^(a - 1) times.
    times = F.greatest(F.lit(1.0), F.pow(F.col("share") / sums.high, F.lit(a - 1)))
    weighted = weighted.withColumn("times", times).withColumn("passes", F.floor("times").cast("bigint"))
    return weighted.withColumn("rest", F.floor((F.col("times") - F.col("passes")) * F.col("tokens")).cast("bigint")).drop("times")


def mix(
    docs: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    entropy: float | None = None,
    repetition: float | None = 2.0,
    seed: int = 17,
    draws: bool = False,
    id_col: str = "doc_id",
) -> DataFrame:
    """Documents as often as their source's weight asks, with the columns of ``docs``;
    with ``draws`` instead one narrow row per draw: id, source ("=" and its name, or
    "null"), pass from 1, tokens, block, and the turns that order blocks and documents
    within the source's pass.

    Null sources are a source of their own. Null and empty texts count one token, as every
    document does at least, so they pass as others do. Repeated rows are drawn separately.
    An empty table gives an empty result; other columns are kept as they are.
    """
    group, size, order_, block = spare(docs, "group", "size", "shuffled", "block")
    sized = docs.withColumn(group, F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit("null")))
    sized = sized.withColumn(size, F.greatest(words(F.col(f"`{text_col}`")), F.lit(1)))
    # Rows are named by source, id and text hash; equal names are equal rows.
    key = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.lit(seed))
    narrow = sized.select(F.col(group).alias("group"), F.col(f"`{id_col}`").alias("id"), F.col(size).alias("tokens"), key.alias("key"))
    narrow = materialize(narrow, "mix-rows")
    totals = narrow.groupBy("group").agg(F.sum("tokens").alias("tokens"))
    total = narrow.agg(F.sum("tokens").alias("t")).first().t or 1
    sources = materialize(totals.withColumn("share", F.col("tokens") / total), "mix-sources")
    planned = materialize(plan(sources, entropy, repetition), "mix-plan")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("all") / BLOCK_TOKENS))
    known = narrow.join(planned.select("group", "passes", "rest", F.col("tokens").alias("all")), "group")
    # The partial pass: blocks in an order of their own, documents shuffled within each.
    known = known.withColumn("block", F.pmod(F.col("key"), blocks))
    known = known.withColumn("block_order", F.xxhash64("group", "block", F.lit(seed), F.col("passes")))
    known = known.withColumn("doc_order", F.xxhash64("key", F.col("passes")))
    known = materialize(known.select("group", "id", "key", "tokens", "passes", "rest", "block_order", "block", "doc_order"), "mix-known")
    placed = in_order(known, ["group", "block_order", "block", "doc_order", "key"], "mix-order", weight="tokens")
    starts = placed.groupBy("group").agg(F.min("before").alias("start"))
    placed = placed.join(starts, "group").withColumn("place", F.col("before") - F.col("start"))
    # A partial pass takes documents while it stays within its tokens.
    times = F.col("passes") + (F.col("place") + F.col("tokens") <= F.col("rest")).cast("bigint")
    if draws:
        drawn = placed.withColumn("pass", F.explode(F.sequence(F.lit(1), times)))
        turn = F.xxhash64("group", "block", F.lit(seed), F.col("pass") - 1).alias("block_turn")
        names = [F.col("id").alias(id_col), F.col("group").alias("source"), "pass", "tokens", "block"]
        return drawn.select(*names, turn, F.xxhash64("key", F.col("pass") - 1).alias("doc_turn"))
    # Rows of one name are equal and lie next to each other, so all but those at the end of
    # a partial pass are drawn alike; names drawn once need not travel to the texts.
    drawn = placed.withColumn("times", times).groupBy("group", "key")
    drawn = drawn.agg(F.min("times").alias("low"), F.max("times").alias("high"), F.sum("times").alias("all"), F.count("*").alias("rows"))
    drawn = materialize(drawn.filter("high > 1").selectExpr("group", "key", "low", "high", "all - rows * low AS extra"), "mix-times")
    columns = F.struct(*[f"`{c}`" for c in docs.columns]).alias("row")
    texts = sized.select(columns, F.col(group).alias("group"), key.alias("key"))
    alike = texts.join(drawn, ["group", "key"], "left").filter("low IS NULL OR low = high").select("row", F.coalesce("high", F.lit(1)).alias("times"))
    # The others, one name a source at most, are numbered: so many of them come once more.
    # Their names are written first: so few need not move the texts.
    ends = materialize(drawn.filter("low < high"), "mix-ends")
    split = materialize(texts.join(ends, ["group", "key"]), "mix-split")
    numbered = in_order(split, ["group", "key"], "mix-numbers")
    starts = numbered.groupBy("group", "key").agg(F.min("position").alias("start"))
    numbered = numbered.join(starts, ["group", "key"])
    more = (F.col("position") - F.col("start") < F.col("extra")).cast("bigint")
    out = alike.unionByName(numbered.select("row", (F.col("low") + more).alias("times")))
    return out.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
