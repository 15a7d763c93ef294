"""How the words of sources differ, audited exactly within each language.

Term counts work as a count vectoriser with a minimum document frequency and no limit on
its vocabulary, but the vocabulary stays a table: no task and no driver holds it. A task
turns its documents into sparse vectors and adds them up by (lang, source) before anything
moves; one shuffle by (lang, term) adds the tasks' sums, applies the minimum and leaves the
sparse columns of all kept terms.

Pairs of sources are evaluated sparsely. All terms a source lacks share one probability,
so a pair's sum over the whole vocabulary is that of two constants, corrected once per
distinct probability of either source, and once per term that both hold. Only the last
needs the terms, and a task adds its terms' corrections up by pair. All numbers are
integers; shares are computed as decimals, so no count is too large.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize
from .common import filled

MIN_DOCUMENTS = 3
TOP_TERMS = 200
_SCALE = 1_000_000_000
_COUNTED_AT_ONCE = 400_000
_PAIRS_AT_ONCE = 100_000

#: Bytes of terms stay, capitals as small letters; all others end a term.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and characters beyond ASCII; only A-Z become lower case."""
    return text.translate(_LETTERS).split()


def _task_sums(rows: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): sums of the document vectors of a task. A row
    without term stands for each group there is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, Counter] = defaultdict(Counter)
        docs: dict[tuple, Counter] = defaultdict(Counter)
        seen: set[tuple] = set()

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), own in counts.items():
                held = docs[lang, source]
                arrays = [pa.array([x] * len(own), pa.string()) for x in (lang, source)]
                arrays += [pa.array(own.keys(), pa.binary()), pa.array(own.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array([held[x] for x in own], pa.int64())], ["lang", "source", "term", "count", "docs"])
            counts.clear()
            docs.clear()

        for batch in batches:
            for lang, source, text in zip(*[batch[x].to_pylist() for x in ("lang", "source", "text")]):
                group = lang, source
                own = terms(text)
                if group not in seen:
                    seen.add(group)
                    counts[group][b""] = 0
                counts[group].update(own)
                docs[group].update(set(own))
            if sum(map(len, counts.values())) > _COUNTED_AT_ONCE:
                yield from out()
        yield from out()

    return rows.mapInArrow(run, "lang string, source string, term binary, count bigint, docs bigint")


def _share(count: Column, total: Column, distinct: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / (total + distinct)); 1 where there are no terms."""
    scaled = (count + 1).cast("decimal(19,0)") * F.lit(_SCALE).cast("decimal(10,0)")
    whole = (total + distinct).cast("decimal(20,0)")
    return F.when(whole > 0, F.call_function("div", scaled, whole)).otherwise(F.lit(0)) + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _shared_corrections(shares: DataFrame) -> DataFrame:
    """(lang, source, item, value): per ordered pair of sources, summed over terms that
    both hold: what their own probabilities give beyond those of an absent term."""
    held = F.array_sort(F.collect_list(F.struct("source", "p", "absent")))
    columns = shares.groupBy("lang", "term").agg(held.alias("held")).filter(F.size("held") > 1).select("lang", "held")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, int] = defaultdict(int)

        def out() -> Iterator[pa.RecordBatch]:
            if totals:
                keys = [pa.array(x, pa.string()) for x in zip(*totals)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(totals.values(), pa.int64())], ["lang", "source", "item", "value"])
            totals.clear()

        def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
            return (p - q) ** 2 // q

        for batch in batches:
            held = batch["held"]
            sizes = held.value_lengths().to_numpy().astype(np.int64)
            flat = held.flatten()
            langs, lang = np.unique(np.repeat(batch["lang"].to_numpy(zero_copy_only=False), sizes), return_inverse=True)
            coded = flat.field("source").dictionary_encode()
            names, source = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            p, absent = flat.field("p").to_numpy(), flat.field("absent").to_numpy()
            left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(p)) - 1  # entries after it in its term
            for step in range(1, int(sizes.max(initial=0))):
                a = np.flatnonzero(left >= step)
                for i, j in ((a, a + step), (a + step, a)):
                    gain = apart(p[i], p[j]) - apart(p[i], absent[j]) - apart(absent[i], p[j]) + apart(absent[i], absent[j])
                    pair = (lang[i] * len(names) + source[i]) * len(names) + source[j]
                    order = np.argsort(pair, kind="stable")
                    heads = np.flatnonzero(np.diff(pair[order], prepend=-1))
                    for key, value in zip(pair[order][heads].tolist(), np.add.reduceat(gain[order], heads).tolist()):
                        rest, item = divmod(key, len(names))
                        totals[langs[rest // len(names)], names[rest % len(names)], names[item]] += value
                if len(totals) > _PAIRS_AT_ONCE:
                    yield from out()
        yield from out()

    return columns.mapInArrow(run, "lang string, source string, item string, value bigint")


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of a language's sources."""
    own = groups.select("lang", "source", "absent", "distinct")
    others = groups.select("lang", F.col("source").alias("item"), F.col("absent").alias("other"))
    p, absent, other = F.col("p"), F.col("absent"), F.col("other")
    flat = own.join(others, "lang").filter("source <> item")
    flat = flat.select("lang", "source", "item", (F.col("distinct") * _apart(absent, other)).alias("value"))
    # Terms of equal probability in a source count together.
    kinds = shares.groupBy("lang", "source", "absent", "p").agg(F.count("*").alias("n"))
    met = kinds.join(others, "lang").filter("source <> item")
    given = met.select("lang", "source", "item", (F.col("n") * (_apart(p, other) - _apart(absent, other))).alias("value"))
    taken = met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (F.col("n") * (_apart(other, p) - _apart(other, absent))).alias("value"))
    parts = flat.unionByName(given).unionByName(taken).unionByName(_shared_corrections(shares))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit_sources(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
    min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank). Part ``pair``: how far the source's
    words are from those of each other source of its language. Part ``term``: the terms it
    uses more than its language does, the most telling first, ``top_terms`` at most.

    A term counts in a language where at least ``min_documents`` documents hold it. Null
    text, lang and source are empty; every (lang, source) that occurs is a group, without
    any term too. Repeated rows count each. Ties rank by item. An empty table gives an
    empty result; other columns are ignored.
    """
    rows = docs.select(
        filled(F.col(f"`{lang_col}`").cast("string")).alias("lang"),
        filled(F.col(f"`{source_col}`").cast("string")).alias("source"),
        filled(F.col(f"`{text_col}`")).cast("binary").alias("text"),
    )
    sums = _task_sums(rows).repartition("lang", "term").groupBy("lang", "term", "source")
    sums = sums.agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    held = F.collect_list(F.struct("source", "count"))
    columns = sums.groupBy("lang", "term").agg(held.alias("held"), F.sum("docs").alias("docs"), F.sum("count").alias("in_lang"))
    is_term = F.col("term") != F.lit(b"")
    columns = materialize(columns.filter(~is_term | (F.col("docs") >= min_documents)).drop("docs"), "term-columns")
    entries = columns.select("lang", "term", "in_lang", F.inline("held"))
    # Groups: their terms' sum, and the language's sum and number of terms.
    langs = columns.groupBy("lang").agg(F.count_if(is_term).alias("distinct"), F.sum("in_lang").alias("lang_total"))
    groups = entries.groupBy("lang", "source").agg(F.sum("count").alias("total")).join(langs, "lang")
    absent = _share(F.lit(0).cast("long"), F.col("total"), F.col("distinct"))
    groups = materialize(groups.withColumn("absent", absent), "groups")
    shares = entries.filter(is_term).join(groups, ["lang", "source"])
    shares = shares.select(
        "lang", "source", "term", "absent",
        _share(F.col("count"), F.col("total"), F.col("distinct")).alias("p"),
        _share(F.col("in_lang"), F.col("lang_total"), F.col("distinct")).alias("q"),
    )
    shares = materialize(shares, "shares")
    pairs = _pairs(groups, shares).withColumn("part", F.lit("pair"))
    more = shares.filter("p > q").select("lang", "source", F.col("term").cast("string").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    ranked = [
        pairs.select("lang", "source", "part", "item", "value", place),
        more.select("lang", "source", F.lit("term").alias("part"), "item", "value", place).filter(F.col("rank") <= top_terms),
    ]
    return ranked[0].unionByName(ranked[1])
