"""Quality classifier: a regularised quadratic discriminant over document statistics.

A document becomes fifteen transformed statistics of its whole text. Per class, Spark
sums counts, first and second moments of the labelled rows in one aggregation; the driver
turns those sums (a fixed 15 x 15) into shrunk covariances and their Cholesky factors,
which every scoring task gets. A score is the logistic of the calibrated difference of
the two class log densities, from Mahalanobis distances by triangular solves.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import spare

FEATURES = [
    "log_bytes", "log_words", "log_word_length", "word_length_spread", "distinct_share", "adjacent_repeats",
    "upper_share", "symbol_share", "digit_share", "letterless_share", "log_line_words", "repeated_lines",
    "log_sentence_words", "repeated_pairs", "common_share",
]

_UPPER = re.compile(r"[A-Z]")
_DIGIT = re.compile(r"[0-9]")
_SYMBOL = re.compile(r"[^\w\s]")
_SENTENCE = re.compile(r"[.!?](?=\s|$)")
#: Score of a log density difference: logistic with this slope a feature.
SLOPE = 1.0 / len(FEATURES)


def _share(part: float, whole: float) -> float:
    return float(np.arcsin(np.sqrt(min(1.0, part / whole)))) if whole else 0.0


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one text; null counts as empty. Shares are taken to
    arcsine square roots and counts to logarithms, which brings them nearer to normal."""
    text = text or ""
    words = text.split()
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    size = len(text)
    lengths = np.fromiter(map(len, words), np.float64, n) if n else np.zeros(1)
    counts = Counter(words)
    repeated_pairs = max(n - 1, 0) - len(set(zip(words, words[1:])))
    return [
        float(np.log1p(len(text.encode("utf-8", "surrogatepass")))),
        float(np.log1p(n)),
        float(np.log1p(lengths.mean())),
        float(np.log1p(lengths.std())),
        _share(len(counts), n),
        _share(sum(map(eq, words, words[1:])), n),
        _share(len(_UPPER.findall(text)), size),
        _share(len(_SYMBOL.findall(text)), size),
        _share(len(_DIGIT.findall(text)), size),
        _share(sum(k for w, k in counts.items() if not any(map(str.isalpha, w))), n),
        float(np.log1p(n / max(len(lines), 1))),
        _share(len(lines) - len(set(lines)), len(lines)),
        float(np.log1p(n / (1 + len(_SENTENCE.findall(text))))),
        _share(repeated_pairs, n - 1),
        _share(max(counts.values(), default=0), n),
    ]


@dataclass(frozen=True)
class Discriminant:
    """Per class: mean, Cholesky factor of the shrunk covariance, and log density constant
    (log prior less half the log determinant), all over features scaled by ``centre`` and
    ``spread``."""

    centre: np.ndarray
    spread: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    constants: tuple[float, float]

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Logistic of the log density difference, between 0 and 1."""
        scaled = (features - self.centre) / self.spread
        density = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants, strict=True):
            white = np.linalg.solve(factor, (scaled - mean).T)
            density.append(constant - 0.5 * (white * white).sum(axis=0))
        return 1.0 / (1.0 + np.exp(np.clip(SLOPE * (density[0] - density[1]), -700, 700)))


def held_out(id_col: str) -> Column:
    """The fifth of all ids whose labels no fit sees."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the statistics of every whole text."""

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(x) for x in texts], dtype=object)

    return docs.select(F.col(f"`{id_col}`"), measured(F.col(f"`{text_col}`")).alias("features"))


def fit(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", shrink: float = 0.3) -> Discriminant:
    """Fits on all labelled rows of ``features`` that aren't held out, by sums over them.

    Each task adds up count, sum and second moment of each class over its rows; Spark adds
    the tasks' sums, and 512 numbers reach the driver. ``shrink`` moves each class
    covariance towards the pooled one, and a hundredth of the identity is added. Null
    labels or ids are left out; of several labels of an id the largest counts. A class
    without labels gets the pooled spread, and scores stay near the prior.
    """
    wanted = labels.filter(F.col("quality").isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max("quality").alias("y"))
    width = len(FEATURES)
    places = np.arange(width + 1)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        moments = np.zeros((2, width + 1, width + 1))
        for batch in batches:
            rows = np.ones((len(batch), width + 1))
            rows[:, 1:] = np.stack(batch["features"].to_numpy()) if len(batch) else np.zeros((0, width))
            good = batch["y"].to_numpy() != 0
            for label, own in ((0, rows[~good]), (1, rows[good])):
                moments[label] += own.T @ own
        for label in (0, 1):
            i, j = np.repeat(places, width + 1), np.tile(places, width + 1)
            yield pd.DataFrame({"label": label, "i": i, "j": j, "v": moments[label].ravel()})

    train = measured.select(id_col, "features").join(wanted, id_col).select("y", "features")
    parts = train.mapInPandas(sums, "label int, i int, j int, v double")
    moments = np.zeros((2, width + 1, width + 1))
    for row in parts.groupBy("label", "i", "j").agg(F.sum("v").alias("v")).collect():
        moments[row.label, row.i, row.j] = row.v
    return solve(moments, shrink)


def solve(moments: np.ndarray, shrink: float) -> Discriminant:
    """The discriminant of two classes' moment matrices (row and column 0: counts, sums)."""
    width = moments.shape[1] - 1
    total = moments.sum(axis=0)
    n = max(total[0, 0], 1.0)
    centre = total[0, 1:] / n
    spread = np.sqrt(np.maximum(np.diag(total)[1:] / n - centre**2, 0)) + 1e-6
    means, covariances, counts = [], [], []
    for m in moments:
        k = m[0, 0]
        mean = (m[0, 1:] / k - centre) / spread if k else np.zeros(width)
        raw = m[1:, 1:] / k if k else np.outer(centre, centre) + np.diag(spread**2)
        shifted = (raw - np.outer(centre, mean * spread) - np.outer(mean * spread, centre) - np.outer(centre, centre)) / np.outer(spread, spread)
        means.append(mean)
        covariances.append(shifted - np.outer(mean, mean))
        counts.append(k)
    prior = (np.array(counts) + 1) / (sum(counts) + 2)
    pooled = prior[0] * covariances[0] + prior[1] * covariances[1]
    factors, constants = [], []
    for k in (0, 1):
        shrunk = (1 - shrink) * covariances[k] + shrink * pooled + 0.01 * np.eye(width)
        factor = np.linalg.cholesky((shrunk + shrunk.T) / 2)
        factors.append(factor)
        constants.append(float(np.log(prior[k]) - np.log(np.diag(factor)).sum()))
    return Discriminant(centre, spread, tuple(means), tuple(factors), tuple(constants))


def score(table: DataFrame, model: Discriminant, column: str, text_col: str | None = None) -> DataFrame:
    """``table`` with a score from 0 to 1 in a new ``column``: of each whole text in
    ``text_col`` (null and empty ones too), or of the statistics in ``features``."""
    shared = table.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype="float64")
        rows = values if text_col is None else [statistics(x) for x in values]
        return pd.Series(shared.value.scores(np.stack([np.asarray(x, dtype=np.float64) for x in rows])))

    return table.withColumn(column, scored(F.col(f"`{text_col or 'features'}`")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with their own columns."""
    column, = spare(docs, "score")
    model = fit(materialize(features(docs, id_col, text_col), "features"), labels, id_col)
    return score(docs, model, column, text_col).filter(F.col(column) >= threshold).drop(column)


def judge_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted (1 from the threshold on).

    Null and empty texts get the score of their (all small) statistics; null ids count as
    held out. Repeated rows are scored alike; an empty table gives an empty result. Other
    columns are never read.
    """
    measured = materialize(features(docs, id_col, text_col), "features")
    scored = score(measured, fit(measured, labels, id_col), "score")
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted")
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", predicted)
