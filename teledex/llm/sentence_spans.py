"""Substring dedup by sliding sentence spans.

Every run of several consecutive sentences is hashed, and with ``words`` also every run of
smaller pieces of some length; the hashes are joined over all documents. The first
occurrence of a span, by document id and place, stays; what any other occurrence covers is
removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import discard, materialize
from .common import bitmap, in_bitmap, row_key, spare

SPAN = 3
#: Words of the longest passage that the query may leave repeated.
WORDS = 50
_WHITE, _STOP, _MARK, _CLAUSE, _ALONE = 1, 2, 4, 8, 16


def _kinds() -> np.ndarray:
    """What each code point is to the cuts."""
    kinds = np.zeros(0x40000, np.uint8)
    # In scripts written without spaces each character counts as a word.
    for a, b in ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFE)):
        kinds[a : b + 1] = _ALONE
    for marks, kind in ((".!?…؟۔।॥։", _STOP), ("。！？｡", _STOP | _MARK), (",;:،؛、，；：–—", _CLAUSE)):
        kinds[[ord(x) for x in marks]] |= kind
    kinds[[c for c in range(0x3001) if chr(c).isspace()]] = _WHITE
    return kinds


_KINDS = _kinds()


def _codes(text: str) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, _KINDS[np.minimum(codes, len(_KINDS) - 1)]


def _distinct(values: np.ndarray) -> np.ndarray:
    """``np.unique``, which is slow on arrays as short as most texts' are."""
    values = np.sort(values)
    fresh = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return values[fresh]


def _ends(codes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where sentences begin and the text ends: behind white space after a sentence's end
    or with a line's end, and behind marks that no white space follows."""
    n = len(codes)
    white = np.zeros(n + 2, bool)
    white[1:-1] = kinds & _WHITE
    edges = np.flatnonzero(white[1:] != white[:-1])
    first, last = edges[::2], edges[1::2]
    lines = np.zeros(n + 1, np.int64)
    np.cumsum(codes == 10, out=lines[1:])
    cut = lines[last] > lines[first]
    cut[first > 0] |= kinds[first[first > 0] - 1] & _STOP > 0
    ends = [[0], last[cut], [n]]
    marks = np.flatnonzero(kinds & _MARK)
    if len(marks):
        marks = marks[marks < n - 1]
        ends.append(marks[kinds[marks + 1] & (_MARK | _WHITE) == 0] + 1)
    return _distinct(np.concatenate(ends).astype(np.int64))


def sentences(text: str | None) -> list[str]:
    """The text cut after sentence ends and lines; the parts, with the white space behind
    them, make up the whole text."""
    ends = _ends(*_codes(text or "")).tolist()
    return [text[a:b] for a, b in zip(ends, ends[1:])]


def _mixed(x: np.ndarray, times: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(times)
    return x ^ (x >> np.uint64(29))


def _breaks(codes: np.ndarray, kinds: np.ndarray, ends: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where pieces of the text begin and the text ends, the words before each place, and
    the words' hashes.

    Pieces are sentences, and parts of those that have more words than a window
    (``words // 6``): of each window of gaps between words without a sentence end, the one
    of least value is a cut, those after clause marks first, else by the hash of the word
    before. So a gap is a cut or not by the words less than a window away, whatever the
    rest of the text is, and no piece is longer than a window.
    """
    window = words // 6
    ink = kinds & _WHITE == 0
    fresh = np.ones(len(codes), bool)
    fresh[1:] = ~ink[:-1]
    alone = kinds & _ALONE > 0
    if alone.any():
        fresh |= alone
        fresh[1:] |= alone[:-1]
    fresh &= ink
    starts = np.flatnonzero(fresh)
    n = len(starts)
    if not n:
        return ends, np.zeros(len(ends), np.int64), np.zeros(0, np.uint64)
    place = np.arange(len(codes)) - starts[np.cumsum(fresh) - 1]
    letters = _mixed((codes + (place.astype(np.uint64) << np.uint64(21))) * np.uint64(0x9E3779B97F4A7C15), 0xBF58476D1CE4E5B9)
    letters[~ink] = 0
    hashes = _mixed(np.add.reduceat(letters, starts), 0x94D049BB133111EB)
    if n > window:
        inked = np.flatnonzero(ink)
        last = inked[np.searchsorted(inked, starts[1:]) - 1]
        gaps = np.zeros(n + 1, np.uint64)
        gaps[1:-1] = hashes[:-1] >> np.uint64(2) | np.uint64(1) | (kinds[last] & _CLAUSE == 0).astype(np.uint64) << np.uint64(62)
        gaps[np.searchsorted(starts, ends)] = 0
        full = n + 2 - window
        least, most = gaps[:full].copy(), np.zeros(n + 1, np.uint64)
        for k in range(1, window):
            np.minimum(least, gaps[k : full + k], out=least)
        for k in range(window):
            np.maximum(most[k : full + k], least, out=most[k : full + k])
        cuts = np.flatnonzero(most == gaps)
        ends = _distinct(np.concatenate([ends, starts[cuts[(cuts > 0) & (cuts < n)]]]))
    return ends, np.searchsorted(starts, ends), hashes


_TIMES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_INVERSES = tuple(pow(times, -1, 1 << 64) for times in _TIMES)


@lru_cache(maxsize=4)
def _powers(times: int, n: int) -> np.ndarray:
    out = np.full(n, times, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _sums(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """128-bit hashes, two numbers each, of runs of words."""
    out, size = np.empty((len(first), 2), np.uint64), max(4096, 1 << len(hashes).bit_length())
    for k, times in enumerate(_TIMES):
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum((_mixed(hashes, times) if k else hashes) * _powers(times, size)[: len(hashes)], out=sums[1:])
        out[:, k] = _mixed((sums[last] - sums[first]) * _powers(_INVERSES[k], size)[first], 0x94D049BB133111EB)
    return out.view(np.int64)


def _hashed(text: str, span: int, words: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The text's spans, each by the places where it begins and ends, and their 128-bit
    hashes in two numbers (white space folded; with ``words`` words alone count)."""
    codes, kinds = _codes(text)
    ends = _ends(codes, kinds)
    if words is None:
        own = [" ".join(text[a:b].split()) for a, b in zip(ends.tolist(), ends.tolist()[1:])]
        digests = b"".join([xxhash.xxh3_128_digest("\n".join(own[i : i + span]).encode("utf-8", "surrogatepass")) for i in range(len(own) - span + 1)])
        return np.stack([ends[:-span], ends[span:]], 1), np.frombuffer(digests, "<i8").reshape(-1, 2)
    bounds, before, hashes = _breaks(codes, kinds, ends, words)
    if not len(hashes):
        return np.zeros((0, 2), np.int64), np.zeros((0, 2), np.int64)
    of = np.searchsorted(bounds, ends)
    of = np.stack([of[:-span], of[span:]], 1) if len(of) > span else np.array([[0, len(bounds) - 1]])
    # Over 50 shared words: cuts less than a window from either end may differ, a span
    # begins within the next window and is up to another one too long.
    to = np.searchsorted(before, before + (words + 3 - 4 * (words // 6)))
    at = np.flatnonzero(to < len(bounds))
    pairs = _distinct(np.concatenate([of[:, 0] << 32 | of[:, 1], at << 32 | to[at]]))
    pairs = np.stack([pairs >> 32, pairs & 0xFFFFFFFF], 1)
    pairs = pairs[before[pairs[:, 0]] < before[pairs[:, 1]]]
    return bounds[pairs], _sums(hashes, before[pairs[:, 0]], before[pairs[:, 1]])


def _spans(docs: DataFrame, span: int, words: int | None, known=None) -> DataFrame:
    """A row per span: half of its hash. With the broadcast bitmap ``known`` only spans in
    it, with the whole hash, the document, and the places where each begins and ends."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            places, hashes = zip(*(_hashed(text or "", span, words) for text in batch["text"]))
            pair = np.concatenate(hashes)
            if known is None:
                yield pd.DataFrame({"b": pair[:, 1]})
                continue
            stay = in_bitmap(pair[:, 1], known.value)
            at, pair = np.concatenate(places)[stay], pair[stay]
            of = batch[["doc_id", "key"]].iloc[np.repeat(np.arange(len(batch)), [len(x) for x in places])[stay]].reset_index(drop=True)
            yield pd.DataFrame({"a": pair[:, 0], "b": pair[:, 1], "doc_id": of["doc_id"], "key": of["key"], "at": at[:, 0], "until": at[:, 1]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInPandas(run, "b bigint" if known is None else f"a bigint, b bigint, doc_id {kind}, key binary, at bigint, until bigint")


def remove_repeats(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text", counts: bool = False, words: int | None = None) -> DataFrame:
    """``docs`` with repeated sentences removed from the text; with ``counts`` also
    n_sentences and n_removed, those that lost words (names that ``docs`` has get an
    underscore in front).

    Spans are runs of ``span`` sentences; texts with fewer, null and empty ones stay as they
    are. With ``words`` (12 or more) they are also the pieces of sentences from each cut on
    that have ``words + 3 - 4 * (words // 6)`` words at least, and whole texts of fewer
    sentences. Then every run of more than ``words`` words that occurs earlier with the
    same line breaks loses words; up to two windows of ``words // 6`` may stay at its start and
    three at its end.

    Repeats within a document count. Rows that repeat id and text are one document: they
    keep the same sentences. Null ids come after all others in the order of first
    occurrences.
    """
    if words is not None and words < 12:
        raise ValueError("words must be 12 or more")
    key, marks, total, gone, cut = spare(docs, "key", "marks", "n_sentences", "n_removed", "cut")
    keyed = docs.withColumn(key, row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")))
    texts = keyed.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(key).alias("key"), F.col(f"`{text_col}`").alias("text"))
    often = _spans(texts, span, words).groupBy("b").count().filter("count > 1").select("b")
    often = materialize(often, "repeated-hashes")
    known = docs.sparkSession.sparkContext.broadcast(bitmap(often, "b"))
    spans = materialize(_spans(texts, span, words, known), "span-places")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "at")
    repeated = spans.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(order).alias("first")).filter("n > 1").drop("n")
    repeated = materialize(repeated, "repeated-spans")
    later = spans.join(repeated, ["a", "b"]).filter((F.col("key") != F.col("first.key")) | (F.col("at") != F.col("first.at")))
    # A document has no more marks than spans.
    found = later.groupBy("key").agg(F.collect_set(F.shiftleft("at", 32) + F.col("until")).alias("marks"))
    found = materialize(found, "span-marks").select(F.col("key").alias(key), F.col("marks").alias(marks))
    discard(often, spans, repeated)

    @F.pandas_udf("text string, total int, gone int")
    def kept(text: pd.Series, marked: pd.Series) -> pd.DataFrame:
        rows = []
        for own, pairs in zip(text, marked):
            ends = _ends(*_codes(own or ""))
            left, lost = own, 0
            if pairs is not None:
                pairs = np.sort(np.asarray(pairs, np.int64))
                first, last = pairs >> 32, np.maximum.accumulate(pairs & 0xFFFFFFFF)
                alone = np.flatnonzero(np.r_[True, first[1:] > last[:-1]])
                first, last = first[alone], last[np.r_[alone[1:] - 1, len(last) - 1]]
                left = "".join([own[a:b] for a, b in zip([0, *last.tolist()], [*first.tolist(), len(own)])])
                edges = np.zeros(len(ends) + 1, np.int64)
                np.add.at(edges, np.searchsorted(ends, first, side="right") - 1, 1)
                np.add.at(edges, np.searchsorted(ends, last), -1)
                lost = int((np.cumsum(edges) > 0).sum())
            rows.append((left, len(ends) - 1, lost))
        return pd.DataFrame(rows, columns=["text", "total", "gone"])

    joined = keyed.join(found, key, "left").withColumn(cut, kept(F.col(f"`{text_col}`"), F.col(marks)))
    columns = [F.col(f"{cut}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        columns += [F.col(f"{cut}.total").alias(total), F.col(f"{cut}.gone").alias(gone)]
    return joined.select(*columns)
