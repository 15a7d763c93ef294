"""Removal of repeated byte strings with suffix arrays over shards.

Every place where a string of LENGTH bytes can start belongs to one anchor: the smallest
hash of a k-gram inside that string. Equal strings have equal anchors, so only places
whose anchor hash occurs again can be repeated, and all strings that could be equal meet
in the shard of their anchor. A shard holds segments (the run of places of an anchor and
the bytes they span), equal ones folded with their count; its suffix array is built by
induced sorting, and permuted common prefixes of LENGTH or more mark repeated places.

Equal strings hold their anchor at the same distance. Places are put in zones of near
distances, all strings of which hold the same core of a segment; zones whose core no other
segment of the anchor has can't be repeated, and stay out of the arrays. In the arrays a
core is three letters that number it: strings of a zone are equal if and only if they are
so with their cores written that way, and some 200 bytes a zone become some 50 letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize
from .common import bitmap, filled, in_bitmap, row_key
from .suffix_arrays import permuted_lcp, suffix_array

LENGTH, GRAM = 200, 32
#: Distances of the anchor in a zone of places.
ZONE = 24
#: Bytes of a shard, and segments of one anchor above which its strings are grouped by
#: their own hash instead, in as many tasks as that takes.
SHARD_BYTES, MANY_SEGMENTS = 2 << 20, 2000

_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 22
#: Bytes of texts whose anchors are found together.
_BLOCK = 1 << 16
#: Letters that number a core.
_DIGITS = 3


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, 1 << 10), _powers(pow(_BASE, -1, 1 << 64), 1 << 10)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if len(_UP) < n:
        size = 1 << n.bit_length()
        _UP, _DOWN = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _UP[:n], _DOWN[:n]


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starting places with one anchor: hash, first place, count."""
    return _anchored(data)[:3]


def _anchored(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starting places with one anchor: hash, first place, count, distance of the
    anchor from the first place."""
    return _anchored_texts([data])[1:]


def _anchored_texts(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """The same for many texts, with the text's number before. Short texts are worked on
    together, long ones in pieces that overlap by a string less one byte."""
    parts: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 5]
    block: list[tuple[int, int, bytes]] = []
    size = 0
    for number, data in enumerate(texts):
        for i in range(0, len(data) - LENGTH + 1, _CHUNK):
            block.append((number, i, data[i : i + _CHUNK + LENGTH - 1]))
            size += len(block[-1][2])
            if size >= _BLOCK:
                parts.append(_anchors(block))
                block, size = [], 0
    if block:
        parts.append(_anchors(block))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _anchors(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    """Runs of pieces: (text's number, place in it, at least LENGTH bytes)."""
    data = b"".join(x for _, _, x in pieces)
    n = len(data)
    up, down = _power_tables(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * down, dtype=np.uint64)])
    grams = (sums[GRAM:] - sums[:-GRAM]) * up[: n - GRAM + 1]
    grams = (grams ^ (grams >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(32)
    # Smallest hash of each window, the leftmost of equal ones: hash above, place below.
    width = LENGTH - GRAM + 1
    packed = (grams & ~np.uint64((1 << 24) - 1)) | np.arange(len(grams), dtype=np.uint64)
    size = -(-len(packed) // width) * width
    grid = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(packed)] = packed
    grid = grid.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    places = n - LENGTH + 1
    least = np.minimum(behind[:places], ahead[width - 1 : width - 1 + places]) & np.uint64((1 << 24) - 1)
    # Runs end with their piece; strings that reach into the next one are none.
    ends = np.cumsum([len(x) for _, _, x in pieces])
    starts = np.concatenate([[0], ends[:-1]])
    fresh = np.concatenate([[True], least[1:] != least[:-1]])
    fresh[starts] = True
    fresh[ends[:-1] - LENGTH + 1] = True
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, places))
    piece = np.searchsorted(starts, first, "right") - 1
    whole = first + LENGTH <= ends[piece]
    first, count, piece = first[whole], count[whole], piece[whole]
    place = least[first].astype(np.int64)
    number, offset = (np.array([x[i] for x in pieces], np.int64) for i in (0, 1))
    return number[piece], grams[place].view(np.int64), first - starts[piece] + offset[piece], count, place - first


def _repeated_anchors(texts: DataFrame) -> DataFrame:
    """(anchor) of every hash that occurs at least twice. Batches count their own first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values, counts = np.unique(_anchored_texts(batch["text"].tolist())[1], return_counts=True)
            yield pd.DataFrame({"anchor": values, "n": counts})

    counted = texts.select("text").mapInPandas(run, "anchor bigint, n bigint")
    return materialize(counted.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"), "anchors")


def _candidates(texts: list[bytes], filter_: np.ndarray):
    """(text's number, anchor, first place, count, distance) of the runs that may be repeated."""
    found = _anchored_texts(texts)
    kept = in_bitmap(found[1], filter_)
    return zip(*(x[kept].tolist() for x in found))


def _segment_name(anchor: int, data: bytes) -> bytes:
    return xxhash.xxh3_128_digest(data, seed=anchor & (1 << 63) - 1)


def _segments(texts: DataFrame, shared) -> DataFrame:
    """Distinct segments: anchor, name, data, at (the anchor's place in them, which follows
    from the data), n (how often). Equal bytes are folded."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[tuple[int, bytes, int], int] = {}
            texts_ = batch["text"].tolist()
            for number, anchor, first, count, at in _candidates(texts_, shared.value):
                own = (anchor, texts_[number][first : first + count + LENGTH - 1], at)
                found[own] = found.get(own, 0) + 1
            names = [_segment_name(a, d) for a, d, _ in found]
            yield pd.DataFrame({"anchor": [a for a, _, _ in found], "name": names, "data": [d for _, d, _ in found], "at": [at for _, _, at in found], "n": list(found.values())})

    rows = texts.select("text").mapInPandas(run, "anchor bigint, name binary, data binary, at int, n bigint")
    return materialize(rows.groupBy("anchor", "name", "data", "at").agg(F.sum("n").alias("n")), "segments")


def _zones(size: int, at: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Zones of a segment's places: number, first and last place, and the core's ends."""
    places = size - LENGTH + 1
    for far in range(0, LENGTH - GRAM + 1, ZONE):
        last = min(far + ZONE - 1, LENGTH - GRAM)
        low, high = max(0, at - last), min(places - 1, at - far)
        if low <= high:
            yield far, low, high, at - far, at - last + LENGTH


def _shared_zones(anchors_: list[int], segments: list[bytes], at: list[int]) -> list[tuple[int, int, int, int, int, int]]:
    """(segment, first place, last place, number of the core, the core's ends) of all zones
    whose core another segment of the same anchor has too, in the order of places."""
    cores: dict[tuple[int, int, bytes], int] = {}
    zones = [[(low, high, a, b, (anchor, far, data[a:b])) for far, low, high, a, b in _zones(len(data), x)] for anchor, data, x in zip(anchors_, segments, at)]
    for own in zones:
        for *_, core in own:
            cores[core] = cores.get(core, 0) + 1
    numbers = {core: i for i, core in enumerate(x for x, n in cores.items() if n > 1)}
    # From the first place on.
    return [(i, low, high, numbers[core], a, b) for i, own in enumerate(zones) for low, high, a, b, core in reversed(own) if core in numbers]


def shared_parts(anchors_: list[int], segments: list[bytes], at: list[int]) -> list[tuple[int, int, int]]:
    """(segment, first place, last place) of all places whose zone has a core that another
    segment of the same anchor has too; neighbouring zones are one part."""
    out: list[tuple[int, int, int]] = []
    for i, low, high, *_ in _shared_zones(anchors_, segments, at):
        if out and out[-1][0] == i and out[-1][2] == low - 1:
            out[-1] = (i, out[-1][1], high)
        else:
            out.append((i, low, high))
    return out


def _neighbours_share(text: np.ndarray) -> np.ndarray:
    """By place, the longest prefix that its suffix shares with any other."""
    sa = suffix_array(text)
    common = permuted_lcp(text, sa)[sa]
    longest = np.empty(len(text), np.int64)
    longest[sa] = np.maximum(common, np.append(common[1:], 0))
    return longest


def _letters(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A text of all parts, 2 added to their bytes, with 1 after each and 0 at the end, and
    where they start."""
    text = np.frombuffer(b"\0".join([*parts, b""]) + b"\0", np.uint8).astype(np.int64) + 2
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.cumsum(sizes + 1) - sizes - 1
    text[starts + sizes] = 1
    text[-1] = 0
    return text, starts


def mark_repeats(segments: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per segment, whether the string at each place of it starts anywhere else in them."""
    text, starts = _letters(segments)
    repeated = _neighbours_share(text) >= length
    return [repeated[a : a + len(x) - length + 1] for a, x in zip(starts, segments)]


def zone_repeats(anchors_: list[int], segments: list[bytes], at: list[int]) -> list[tuple[int, int, np.ndarray]]:
    """(segment, first place, whether the string at each place from there on is repeated) of
    all zones with a shared core; at other places no string is."""
    zones = _shared_zones(anchors_, segments, at)
    if not zones:
        return []
    blank = b"\0" * _DIGITS
    text, starts = _letters([segments[i][low:a] + blank + segments[i][b : high + LENGTH] for i, low, high, _, a, b in zones])
    number = np.array([x[3] for x in zones], np.int64)
    core = starts + np.array([a - low for _, low, _, _, a, _ in zones], np.int64)
    base = 2
    while base**_DIGITS <= len(zones):
        base += 1
    for digit in range(_DIGITS):
        text[core + digit] = 258 + number // base**digit % base
    shared = _neighbours_share(text)
    # A string lacks the bytes of its core and has the letters of it.
    return [(i, low, shared[x : x + high - low + 1] >= LENGTH - (b - a) + _DIGITS) for x, (i, low, high, _, a, b) in zip(starts, zones)]


def _ranges(marks: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]


_RANGES = "name binary, ranges array<struct<low: int, high: int>>"


def _repeated_places(segments: DataFrame) -> DataFrame:
    """(name, ranges of repeated places) of distinct segments."""
    variants = segments.groupBy("anchor").agg(F.count("*").alias("variants"), F.sum(F.octet_length("data")).alias("bytes")).filter("variants > 1")
    variants = materialize(variants, "variants")
    place_count = F.octet_length("data") - (LENGTH - 1)
    # A segment that occurs twice is repeated throughout.
    whole = segments.filter("n > 1").select("name", F.array(F.struct(F.lit(0).alias("low"), place_count.cast("int").alias("high"))).alias("ranges"))
    total = variants.filter(F.col("variants") <= MANY_SEGMENTS).agg(F.sum("bytes").alias("b")).first().b or 0
    shards = int(total // SHARD_BYTES) + 1
    open_ = segments.join(variants, "anchor")

    def sort(group: pd.DataFrame) -> pd.DataFrame:
        data = [bytes(x) for x in group["data"]]
        names, n, found = group["name"].tolist(), group["n"].tolist(), {}
        for i, low, own in zone_repeats(group["anchor"].tolist(), data, group["at"].tolist()):
            if n[i] == 1 and own.any():
                found.setdefault(i, []).extend((a + low, b + low) for a, b in _ranges(own))
        rows = [(names[i], ranges) for i, ranges in found.items() if ranges]
        return pd.DataFrame(rows, columns=["name", "ranges"])

    few = open_.filter(F.col("variants") <= MANY_SEGMENTS).select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "name", "data", "at", "n")
    sorted_ = few.groupBy("shard").applyInPandas(sort, _RANGES)

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for few in range(0, len(batch), 100):  # segments, of some 170 strings at most
                names, found = batch["name"].tolist()[few : few + 100], batch["data"].tolist()[few : few + 100]
                counts = [len(x) - LENGTH + 1 for x in found]
                hashes = [xxhash.xxh3_128_digest(x[i : i + LENGTH]) for x, n in zip(found, counts) for i in range(n)]
                yield pd.DataFrame({"string": hashes, "name": [x for x, n in zip(names, counts) for _ in range(n)], "place": [i for n in counts for i in range(n)]})

    many = open_.filter(F.col("variants") > MANY_SEGMENTS).select("name", "data").mapInPandas(strings, "string binary, name binary, place int")
    # Counted beside each row: strings move once, and none meets another.
    many = many.withColumn("n", F.count("*").over(Window.partitionBy("string"))).filter("n > 1")
    places = many.groupBy("name").agg(F.collect_set(F.struct(F.col("place").alias("low"), (F.col("place") + 1).alias("high"))).alias("ranges"))
    return materialize(whole.unionByName(sorted_).unionByName(places), "repeated-places")


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes left).

    Removed is each byte that lies in a string of LENGTH bytes which also starts anywhere
    else in the documents, this one included; n_spans counts maximal removed runs. Null
    counts as empty, shorter texts stay whole. Repeated rows repeat each other, so they
    lose all they can. Other columns are ignored; an empty table gives an empty result.
    """
    text = filled(F.col(f"`{text_col}`")).cast("binary").alias("text")
    columns = [F.col(f"`{id_col}`").alias("doc_id"), text]
    keyed = docs.select(*columns, row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("key"))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(_repeated_anchors(keyed), "anchor"))
    repeated = _repeated_places(_segments(keyed, shared))

    def occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, keys, places = [], [], []
            known, texts = batch["key"].tolist(), batch["text"].tolist()
            for number, anchor, first, count, _ in _candidates(texts, shared.value):
                names.append(_segment_name(anchor, texts[number][first : first + count + LENGTH - 1]))
                keys.append(known[number])
                places.append(first)
            yield pd.DataFrame({"name": names, "key": keys, "first": places})

    @F.pandas_udf("n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    def cut(text: pd.Series, found: pd.Series) -> pd.DataFrame:
        rows = []
        for data, runs in zip(text, found):
            if runs is None:
                rows.append((len(data), 0, 0, data))
                continue
            edges = np.zeros(len(data) + 1, np.int64)
            for run in runs:
                for r in run["ranges"]:
                    edges[run["first"] + r["low"]] += 1
                    edges[run["first"] + r["high"] + LENGTH - 1] -= 1
            gone = np.cumsum(edges[:-1]) > 0
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            rows.append((len(data), len(data) - len(kept), len(_ranges(gone)), kept))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    runs = keyed.select("key", "text").mapInPandas(occurrences, "name binary, key binary, first int").distinct()
    # A document has no more runs than bytes.
    runs = runs.join(repeated, "name").groupBy("key").agg(F.collect_list(F.struct("first", "ranges")).alias("found"))
    out = keyed.join(materialize(runs, "repeated-runs"), "key", "left")
    return out.withColumn("cut", cut("text", "found")).select("doc_id", "cut.*")
