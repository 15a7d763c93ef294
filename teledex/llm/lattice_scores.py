"""Document scores from a subword lattice.

The pieces of a public vocabulary make a lattice of every word: an arc for each piece
that fits, bytes included, so no text is out of reach. A word's probability is the sum
over all ways to cut it, found by a forward recursion in log space. The vocabulary's own
scores (ranks, read as Zipf weights) weight the arcs at first; expectation maximisation
over the distinct words of the training texts fits them to the corpus.

The words of the training texts are counted whole, per class (language). A word seen
there has a whole-word arc beside its pieces: counts are discounted by a constant and what
that frees goes to the lattice, so the words' probabilities sum to one. Each class
discounts its own counts in the same way, down to all classes together. Uses of a word
within the text add to its weight (a Polya urn), and the text's probability is summed over
the classes, which are known while learning and not while scoring.

Arc weights are as many as pieces, and the most frequent words are a bounded list: both
are broadcast. Counts and lattice values of all other words are joined by the word.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import filled

PIECES = "piece_bpe_32k.model"
#: Passes of expectation maximisation over the distinct words.
ROUNDS = 4
#: The most frequent classes; the others are one more.
CLASSES = 8
#: Weight of the words' probabilities against their uses in the text so far, in words.
URN = 3000.0
#: The broadcast words: at most so many, of so many bytes each.
FREQUENT_WORDS, FREQUENT_BYTES = 1 << 17, 64
#: Weight of the first arc weights against the expected counts, in words.
PRIOR = 100.0
_ZIPF = 10.0
_END_OF_WORD = 0.3
_COUNTED_AT_ONCE = 500_000
_WORDS_AT_ONCE = 20_000
_LN10 = math.log(10)
#: Uses of one word that are added up one by one; more go through the gamma function.
_FEW = 64


@lru_cache(maxsize=2)
def lattice(file: str) -> "Lattice":
    return Lattice(file)


class Lattice:
    """Arcs of words. A word starts with a space; only first arcs hold it."""

    def __init__(self, file: str):
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(file))
        size = model.get_piece_size()
        ranks: dict[bytes, float] = {bytes([b]): float(size) for b in range(256) if not bytes([b]).isspace()}
        ranks[b" "] = float(size)
        for i in range(size):
            if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            if b" " not in piece[1:]:
                ranks[piece] = min(-model.get_score(i), ranks.get(piece, math.inf))
        # Words are lower case: arcs with capitals would only take weight from others.
        self.arcs = [x for x in ranks if x == x.lower()]
        self.lengths = np.array([len(x) for x in self.arcs])
        self.first = np.array([x.startswith(b" ") for x in self.arcs])
        self.start = 1 / (_ZIPF + np.array([ranks[x] for x in self.arcs]))
        # A trie as a table: the next state by state and byte. State 0 is nowhere, 1 the start.
        used = sorted({b for x in self.arcs for b in x})
        self.column = np.zeros(256, np.int32)
        self.column[used] = np.arange(1, len(used) + 1)
        steps: list[dict[int, int]] = [{}, {}]
        ends = {}
        for i, x in enumerate(self.arcs):
            state = 1
            for b in x:
                if b not in steps[state]:
                    steps[state][b] = len(steps)
                    steps.append({})
                state = steps[state][b]
            ends[state] = i
        self.next = np.zeros((len(steps), len(used) + 1), np.int32)
        for state, to in enumerate(steps):
            if to:
                self.next[state, self.column[list(to)]] = list(to.values())
        self.arc_at = np.full(len(steps), -1, np.int32)
        self.arc_at[list(ends)] = list(ends.values())

    def weights(self, expected: np.ndarray | None = None) -> np.ndarray:
        """Log weights of the arcs and, last, of a word's end. First arcs sum to one; so
        do the others with the end. ``expected``: counts to add to the first weights."""
        prior = np.append(self.start, 0.0)
        first = np.append(self.first, False)
        prior[first] /= prior[first].sum()
        prior[~first] *= (1 - _END_OF_WORD) / prior[~first].sum()
        prior[-1] = _END_OF_WORD
        total = prior if expected is None else PRIOR * prior + expected
        return np.log(np.where(first, total / total[first].sum(), total / total[~first].sum()))

    def _laid(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """Arcs that fit as (arc, from, to) by ``from``, places of words' starts and ends,
        and how far into its word each place is. A word of n bytes has n + 2 places."""
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        # One byte a place; a word's last place holds a byte that no arc has.
        column = np.append(self.column[np.frombuffer(b"\n".join([b"", *[b" " + x for x in words], b""])[1:], np.uint8)], 0)
        place = np.arange(len(column) - 1)
        state = np.ones(len(place), np.int32)
        found, ahead = [], 0
        while len(place):
            state = self.next[state, column[place + ahead]]
            ahead += 1
            place, state = place[state > 0], state[state > 0]
            arc = self.arc_at[state]
            found.append((arc[arc >= 0], place[arc >= 0]))
        arc, source = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(source, kind="stable")
        arc, source = arc[order], source[order]
        inside = np.arange(ends[-1] + 1) - np.repeat(starts, sizes + 1)
        return arc, source, source + self.lengths[arc], starts, ends, inside

    @staticmethod
    def _swept(values: np.ndarray, source: np.ndarray, target: np.ndarray, weight: np.ndarray, step: np.ndarray) -> None:
        """Adds up, in log space and step by step, what arcs bring to their targets. Arcs
        come by target within a step."""
        order = np.argsort(step.astype(np.uint16) if step.max(initial=0) < 1 << 16 else step, kind="stable")
        source, target, weight, step = source[order], target[order], weight[order], step[order]
        cuts = np.flatnonzero(np.diff(step)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(step)]):
            own = target[a:b]
            heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            values[own[heads]] = np.logaddexp.reduceat(values[source[a:b]] + weight[a:b], heads)

    def _forward(self, laid: tuple[np.ndarray, ...], weights: np.ndarray) -> np.ndarray:
        arc, source, target, starts, ends, inside = laid
        reach = np.full(ends[-1] + 1, -np.inf)
        reach[starts] = 0.0
        order = np.argsort(target, kind="stable")
        self._swept(reach, source[order], target[order], weights[arc[order]], inside[target[order]])
        return reach

    def log_probability(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        """Natural logarithm of each word's probability, summed over all its cuts."""
        out = [np.zeros(0)]
        for i in range(0, len(words), _WORDS_AT_ONCE):
            laid = self._laid(words[i : i + _WORDS_AT_ONCE])
            out.append(self._forward(laid, weights)[laid[4]] + weights[-1])
        return np.concatenate(out)

    def expected(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        """Expected uses of each arc over all cuts of all words, and how many words end."""
        total = np.zeros(len(weights))
        for i in range(0, len(words), _WORDS_AT_ONCE):
            laid = self._laid(words[i : i + _WORDS_AT_ONCE])
            arc, source, target, _, ends, inside = laid
            reach = self._forward(laid, weights)
            left = np.full(len(reach), -np.inf)
            left[ends] = 0.0
            self._swept(left, target, source, weights[arc], inside.max() - inside[source])
            whole = np.repeat(reach[ends], np.diff(ends, prepend=-1))
            share = np.exp(reach[source] + weights[arc] + left[target] - whole[source])
            total[:-1] += np.bincount(arc, share, len(weights) - 1)
            total[-1] += len(ends)
        return total


def tokens(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space; only A-Z become lower case."""
    return (text or b"").lower().split()


def _word_counts(rows: DataFrame, classes: int) -> DataFrame:
    """(word, counts): every word and how often the training texts of each class hold it.
    The empty word counts the ends of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned: list[Counter] = [Counter() for _ in range(classes)]
        others: set[bytes] = set()

        def out() -> Iterator[pa.RecordBatch]:
            for kind, own in enumerate([*learned, dict.fromkeys(others, 0)]):
                if own:
                    arrays = [pa.array(own.keys(), pa.binary()), pa.array([kind] * len(own), pa.int32()), pa.array(own.values(), pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, ["word", "kind", "count"])
            for own in (*learned, others):
                own.clear()

        for batch in batches:
            for text, kind, held in zip(*[batch[x].to_pylist() for x in ("text", "kind", "held_out")]):
                own = tokens(text)
                if held:
                    others.update(own)
                else:
                    learned[kind].update(own)
                    learned[kind][b""] += 1
            if sum(map(len, learned)) + len(others) > _COUNTED_AT_ONCE:
                yield from out()
        yield from out()

    found = rows.mapInArrow(run, "word binary, kind int, count bigint")
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == i, F.col("count"))), F.lit(0)) for i in range(classes)]
    return found.groupBy("word").agg(F.array(*sums).alias("counts"))


def _fitted(words: DataFrame, file: str, rounds: int) -> np.ndarray:
    """Arc weights after ``rounds`` passes over the distinct training words. A pass brings
    one number an arc to the driver, whatever the corpus."""
    context = words.sparkSession.sparkContext
    weights = lattice(file).weights()
    for _ in range(rounds):
        shared = context.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(shared.value))
            for batch in batches:
                total += lattice(file).expected(batch["word"].to_pylist(), shared.value)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["arc", "uses"])

        sums = words.select("word").mapInArrow(run, "arc bigint, uses double").groupBy("arc").agg(F.sum("uses").alias("uses"))
        expected = np.zeros(len(weights))
        for row in sums.collect():
            expected[row.arc] = row.uses
        weights = lattice(file).weights(expected)
    return weights


def _with_lattice(words: DataFrame, file: str, weights: np.ndarray) -> DataFrame:
    """Words with the natural logarithm of their lattice's probability."""
    shared = words.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = lattice(file).log_probability(batch["word"].to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch["word"], batch["counts"], pa.array(values)], ["word", "counts", "pieces"])

    return words.mapInArrow(run, "word binary, counts array<bigint>, pieces double")


class _Counted(NamedTuple):
    """Sums of one class, or of all: words, distinct words, those met once and twice."""

    words: int
    types: int
    once: int
    twice: int

    def smoothed(self, count: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Log probabilities: discounted counts, and what they free dealt out by ``below``."""
        if not self.words:
            return below
        discount = min(0.9, self.once / (self.once + 2 * self.twice)) if self.once else 0.5
        with np.errstate(divide="ignore"):
            seen = np.log(np.maximum(count - discount, 0) / self.words)
        return np.logaddexp(seen, below + math.log(discount * self.types / self.words))


class Model(NamedTuple):
    """What is known of the training texts as a whole. ``ends``: their number by class."""

    whole: _Counted
    classes: list[_Counted]
    ends: list[int]

    @property
    def tokens(self) -> int:
        return self.whole.words + sum(self.ends)

    @property
    def distinct(self) -> int:
        return self.whole.types + (sum(self.ends) > 0)

    @property
    def end(self) -> float:
        """How likely a text ends after any word."""
        return (sum(self.ends) + 0.5) / (self.tokens + 1)

    def base(self, count) -> np.ndarray:
        return np.log10((count + 1) / (self.tokens + self.distinct + 1))

    def log_probabilities(self, counts: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """A row per word, a column per class."""
        whole = self.whole.smoothed(counts.sum(1), pieces)
        return np.stack([x.smoothed(counts[:, i], whole) for i, x in enumerate(self.classes)], 1)

    def text(self, words: int, parts: np.ndarray) -> float:
        """Log10 probability of a text of so many words; ``parts``: its words' sums by class."""
        prior = np.log((np.array(self.ends) + 0.5) / (sum(self.ends) + 0.5 * len(self.ends)))
        total = np.logaddexp.reduce(prior + parts) - math.lgamma(words + URN) + math.lgamma(URN)
        return float(total + words * math.log1p(-self.end) + math.log(self.end)) / _LN10


def urn(times: np.ndarray, log_probability: np.ndarray) -> np.ndarray:
    """Per word and class the log of p (p + 1) ... (p + times - 1), p = URN * probability."""
    start = log_probability + math.log(URN)
    out = start.copy()
    weight = np.exp(start)
    few = np.flatnonzero((times > 1) & (times <= _FEW))
    if len(few):
        more = times[few] - 1
        ends = np.cumsum(more)
        step = np.arange(ends[-1]) - np.repeat(ends - more, more) + 1
        logs = np.log(step[:, None] + np.repeat(weight[few], more, 0))
        out[few] += np.add.reduceat(logs, ends - more)
    for i in np.flatnonzero(times > _FEW):
        out[i] += [math.lgamma(times[i] + x) - math.lgamma(1 + x) for x in weight[i]]
    return out


def _counts(batch: pa.RecordBatch | pa.Table, classes: int) -> np.ndarray:
    column = batch["counts"]
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, classes)


def _model(words: DataFrame, classes: int) -> Model:
    """One row of sums over the written words."""

    def sums(count: Column, name: str) -> list[Column]:
        own = F.when(F.col("word") != F.lit(b""), count)
        wanted = {"words": F.sum(own), "types": F.count_if(own > 0), "once": F.count_if(own == 1), "twice": F.count_if(own == 2)}
        return [F.coalesce(x, F.lit(0)).alias(f"{name}_{key}") for key, x in wanted.items()]

    columns = sums(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x), "all")
    for i in range(classes):
        columns += sums(F.col("counts")[i], f"c{i}")
        columns.append(F.coalesce(F.sum(F.when(F.col("word") == F.lit(b""), F.col("counts")[i])), F.lit(0)).alias(f"ends{i}"))
    row = words.agg(*columns).first().asDict()
    counted = [_Counted(*[row[f"{name}_{key}"] for key in _Counted._fields]) for name in ("all", *[f"c{i}" for i in range(classes)])]
    return Model(counted[0], counted[1:], [row[f"ends{i}"] for i in range(classes)])


def lattice_scores(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    class_col: str | None = "lang",
    pieces: str = PIECES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens (words and one end), n_known (those
    the training texts hold), train_tokens, base_score and score: log10 probabilities of
    the text under add-one smoothed counts and under this model.

    The model learns from rows where ``held_out`` is false (or null). Null text is empty:
    one end; null classes are one class. Repeated rows count, and are scored, each for
    itself; an id may be null. Without training rows words have their lattice's
    probability alone. An empty table gives an empty result; other columns are ignored.
    """
    kind, kinds = F.lit(0), 1
    if class_col:
        label = F.coalesce(F.col(f"`{class_col}`").cast("string"), F.lit(""))
        common = docs.groupBy(label.alias("kind")).count().orderBy(F.desc("count"), "kind").limit(CLASSES + 1).collect()
        kinds = max(1, len(common))
        kind = F.lit(kinds - 1)
        for i, row in enumerate(common[:CLASSES]):
            kind = F.when(label == row.kind, i).otherwise(kind)
    text = filled(F.col(f"`{text_col}`")).cast("binary").alias("text")
    held = F.coalesce(held_out, F.lit(False)).alias("held_out")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text, kind.cast("int").alias("kind"), held)
    words = materialize(_word_counts(rows, kinds), "words")
    model = _model(words, kinds)
    is_word = F.col("word") != F.lit(b"")
    weights = _fitted(words.filter(is_word & F.exists("counts", lambda x: x > 0)), pieces, rounds)
    valued = materialize(_with_lattice(words.filter(is_word), pieces, weights), "word-values")
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    short = valued.filter(F.octet_length("word") <= FREQUENT_BYTES)
    shared = docs.sparkSession.sparkContext.broadcast(short.orderBy(total.desc(), "word").limit(FREQUENT_WORDS).toArrow())
    cache: dict[str, tuple] = {}

    def by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not cache:
            top = shared.value
            counts = _counts(top, kinds)
            values = model.log_probabilities(counts, top["pieces"].to_numpy())
            cache["top"] = ({x: i for i, x in enumerate(top["word"].to_pylist())}, counts.sum(1), values)
        place, counts, values = cache["top"]
        for batch in batches:
            texts = [Counter(tokens(text)) for text in batch["text"].to_pylist()]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            times = np.fromiter(chain.from_iterable(x.values() for x in texts), np.int64, sizes.sum())
            words = list(chain.from_iterable(texts))
            at = np.fromiter(map(place.get, words, repeat(-1)), np.int64, len(words))
            text = np.repeat(np.arange(len(texts)), sizes)
            known, rare = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
            repeats, own, seen = times[known], text[known], counts[at[known]]

            def summed(values: np.ndarray) -> np.ndarray:
                return np.bincount(own, values, len(texts))

            parts = urn(repeats, values[at[known]])
            parts = np.stack([summed(x) for x in parts.T], 1).ravel() if len(parts) else np.zeros(len(texts) * kinds)
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(text[rare], minlength=len(texts)))]), pa.int32())
            arrays = [
                batch["doc_id"],
                batch["held_out"],
                pa.array(np.bincount(text, times, len(texts)).astype(np.int64) + 1),
                pa.array(summed(repeats * (seen > 0)).astype(np.int64) + (sum(model.ends) > 0)),
                pa.array(summed(repeats * model.base(seen)) + model.base(sum(model.ends))),
                pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * kinds, pa.int32()), pa.array(parts)),
                pa.ListArray.from_arrays(offsets, pa.array([words[i] for i in rare], pa.binary())),
                pa.ListArray.from_arrays(offsets, pa.array(times[rare])),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "parts", "rare", "times"])

    def by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, times = _counts(batch, kinds), batch["times"].to_numpy()
            parts = urn(times, model.log_probabilities(counts, batch["pieces"].to_numpy()))
            own = counts.sum(1)
            arrays = [batch["row"], pa.array(times * (own > 0)), pa.array(times * model.base(own)), *[pa.array(x) for x in np.ascontiguousarray(parts.T)]]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "known", "base", *[f"p{i}" for i in range(kinds)]])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.text(n - 1, np.array(x)) for n, x in zip(batch["n_tokens"].to_pylist(), batch["parts"].to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], [*batch.schema.names[:-1], "score"])

    names = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint"
    schema = f"{names}, base_score double, parts array<double>, rare array<binary>, times array<bigint>"
    scored = rows.select("doc_id", "held_out", "text").mapInArrow(by_text, schema)
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "frequent-words")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    found = rare.join(valued, "word").select("row", "times", "counts", "pieces")
    each = found.mapInArrow(by_word, "row bigint, known bigint, base double, " + ", ".join(f"p{i} double" for i in range(kinds)))
    more = each.groupBy("row").agg(F.sum("known").alias("known"), F.sum("base").alias("base"), F.array(*[F.sum(f"p{i}") for i in range(kinds)]).alias("more"))
    both = scored.join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        F.when(F.col("more").isNull(), F.col("parts")).otherwise(F.zip_with("parts", "more", lambda a, b: a + b)).alias("parts"),
    )
    return both.mapInArrow(whole, f"{names}, train_tokens bigint, base_score double, score double")
