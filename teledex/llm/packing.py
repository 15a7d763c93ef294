"""Best-fit packing of documents into sequences by bin completion.

The length counts of all pieces (one number per length up to the capacity, whatever the
corpus) go to the driver. There, bins are completed around the largest length left by
branch and bound: undominated fillings are enumerated, best fits first, subtrees whose
waste rules out a better packing are pruned, and the best packing so far, at first
best-fit decreasing, is the incumbent. A filling is used for many bins at once, so a plan
has a bounded number of fillings. Spark then orders all pieces by length and reads each
one's sequence and offset off its place in that order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .common import in_order
from .tokens import encoder

CAPACITY = 2048
Filling = tuple[tuple[int, int], ...]  # (length, how many), largest first
Plan = list[tuple[Filling, int]]  # fillings and how many bins take them


def bins_at_least(counts: np.ndarray) -> int:
    """A lower bound for the number of bins: total length, or lengths over half a bin
    with what can't be put beside them (for every threshold)."""
    capacity = len(counts) - 1
    lengths = np.arange(capacity + 1)
    mass = counts * lengths
    best = -(-int(mass.sum()) // capacity)
    count_to, mass_to = np.cumsum(counts), np.cumsum(mass)
    half = capacity // 2
    total = int(count_to[-1])
    for k in range(0, half + 1):
        alone = total - int(count_to[capacity - k])  # too long for anything from k on
        over_half = int(count_to[capacity - k] - count_to[half])
        beside = over_half * capacity - int(mass_to[capacity - k] - mass_to[half])
        small = int(mass_to[half] - (mass_to[k - 1] if k else 0))
        best = max(best, alone + over_half + max(0, -(-(small - beside) // capacity)))
    return best


def best_fit_decreasing(counts: np.ndarray) -> Plan:
    """Best-fit decreasing on counts: bins with equal contents are kept as one class."""
    capacity = len(counts) - 1
    open_: dict[int, list[tuple[Filling, int]]] = {capacity: [((), 1 << 62)]}
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            room = min(r for r in open_ if r >= length)
            filling, bins = open_[room].pop()
            each = min(room // length, left)
            used = min(bins, left // each)
            grown = (*filling, (length, each))
            open_.setdefault(room - each * length, []).append((grown, used))
            if bins > used:
                open_[room].append((filling, bins - used))
            if not open_[room]:
                del open_[room]
            left -= each * used
    return [(f, n) for classes in open_.values() for f, n in classes if f]


def undominated(counts: np.ndarray, room: int, limit: int) -> list[tuple[int, Filling]]:
    """(waste, filling) for fillings of ``room``, least waste first, largest pieces first.

    A piece that fills the room exactly dominates all others. A filling is dominated, and
    left out, when a further piece fits, or when a larger piece could take one's place or
    two's places.
    """
    sizes = np.flatnonzero(counts[: room + 1])[::-1]
    if not len(sizes):
        return [(room, ())]
    if sizes[0] == room:
        return [(0, ((room, 1),))]
    found: dict[Filling, int] = {}
    largest = [int(x) for x in sizes[:limit]]
    partner = room - sizes
    exact = sizes[(partner > 0) & (partner <= sizes) & (counts[partner] > (partner == sizes))][:limit]
    for a in [int(x) for x in exact] + largest:
        pieces, left = {a: 1}, room - a
        while left:
            fitting = np.flatnonzero(counts[: left + 1])[::-1]
            second = [int(x) for x in fitting if counts[x] > pieces.get(int(x), 0)]
            if not second:
                break
            pick = second[0]
            if pick != left and len(second) > 1:
                # Prefer a pair that fills what is left exactly.
                spare_ = set(second)
                pick = next((x for x in second if left - x in spare_ and (2 * x != left or counts[x] > 1 + pieces.get(x, 0))), pick)
            pieces[pick] = pieces.get(pick, 0) + 1
            left -= pick
        found[tuple(sorted(pieces.items(), reverse=True))] = left
        if len(found) >= 2 * limit:
            break
    ranked = sorted(((w, f) for f, w in found.items()), key=lambda x: (x[0], tuple(-a for a, _ in x[1])))
    kept = [x for x in ranked if not _dominated(counts, x[1], x[0])]
    return (kept or ranked)[:limit]


def _dominated(counts: np.ndarray, filling: Filling, waste: int) -> bool:
    own = dict(filling)

    def free(low: int, high: int) -> bool:
        return any(counts[x] > own.get(x, 0) for x in range(low, min(high, len(counts) - 1) + 1))

    if free(1, waste):
        return True
    lengths = [a for a, k in filling for _ in range(min(k, 2))]
    if any(free(a + 1, a + waste) for a in set(lengths)):
        return True
    return any(free(a + b, a + b + waste) for i, a in enumerate(lengths) for b in lengths[i + 1 :])


def complete_bins(counts: np.ndarray, nodes: int = 6_000, limit: int = 6) -> Plan:
    """Fewest bins found for ``counts[length]`` pieces, by branch and bound. ``nodes``
    bounds the effort; the incumbent is a whole packing at any time."""
    counts = np.asarray(counts, np.int64)
    capacity, total = len(counts) - 1, int((counts * np.arange(len(counts))).sum())
    incumbent = best_fit_decreasing(counts)
    best = sum(n for _, n in incumbent)
    least = bins_at_least(counts)
    if not total or best == least:
        return incumbent
    stack: list[list] = [[counts.copy(), 0, None, 0, None]]  # left, waste, branches, next, chosen
    while stack and nodes and best > least:
        left, waste, branches, at, _ = node = stack[-1]
        allowed = (best - 1) * capacity - total
        if branches is None:
            nodes -= 1
            sizes = np.flatnonzero(left)
            if not len(sizes):
                incumbent = [x[4] for x in stack[:-1]]
                best = sum(n for _, n in incumbent)
                stack.pop()
                continue
            top = int(sizes[-1])
            left[top] -= 1
            branches = [(w, top, f) for w, f in undominated(left, capacity - top, limit)]
            left[top] += 1
            node[2] = branches
        if at >= len(branches) or waste + branches[at][0] > allowed:
            stack.pop()
            continue
        node[3] += 1
        loss, top, filling = branches[at]
        pieces = dict(filling)
        pieces[top] = pieces.get(top, 0) + 1
        bins = min(int(left[x]) // k for x, k in pieces.items())
        if loss:
            bins = min(bins, max(1, (allowed - waste) // loss))
        rest = left.copy()
        for x, k in pieces.items():
            rest[x] -= bins * k
        node[4] = (tuple(sorted(pieces.items(), reverse=True)), bins)
        stack.append([rest, waste + bins * loss, None, 0, None])
    return incumbent


def _runs(plan: Plan, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of places in the order by length: each run's pieces lie ``k`` a bin, at
    ``offset`` on, in bins from ``bin`` on."""
    start = np.cumsum(counts) - counts
    runs, first = [], 0
    for filling, bins in plan:
        offset = 0
        for length, k in filling:
            runs.append((int(start[length]), first, k, offset))
            start[length] += bins * k
            offset += length * k
        first += bins
    return dict(zip(("place", "bin", "k", "offset"), np.array(sorted(runs), np.int64).reshape(-1, 4).T))


def pieces_of(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32. Whole texts are encoded; a
    document longer than the capacity is cut so that only its first piece may be shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = encoder(vocabulary).encode(batch.column("text"))
            ends = np.cumsum(counts)
            rows: list[tuple[int, int, int, int, int]] = []
            for i, (end, count) in enumerate(zip(ends.tolist(), counts.tolist())):
                own = np.append(ids[end - count : end], end_id).astype("<u4")
                cuts = list(range(len(own), 0, -capacity))[::-1]
                at = 0
                for piece, cut in enumerate(cuts):
                    rows.append((i, piece, at, cut - at, zlib.crc32(own[at:cut].tobytes())))
                    at = cut
            i, piece, start, length, crc = (np.array(x, np.int64) for x in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(i)), pa.array(piece.astype(np.int32)), *map(pa.array, (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    columns = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return columns.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    capacity: int = CAPACITY,
    end_id: int = 0,
    nodes: int = 6_000,
) -> DataFrame:
    """One row per piece of a document: doc_id, piece (from 0), start, length, ids_crc32,
    sequence_id, offset.

    Null and empty texts are the end id alone. Repeated rows and null ids are packed like
    others; an empty table gives an empty result; other columns are ignored. Sequences are
    numbered from 0 and gapless; a sequence's pieces follow one another from offset 0.
    """
    pieces = materialize(pieces_of(docs, id_col, text_col, vocabulary, capacity, end_id), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # one row per length at most
        counts[row["length"]] = row["count"]
    runs = pieces.sparkSession.sparkContext.broadcast(_runs(complete_bins(counts, nodes), counts))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = runs.value
        for batch in batches:
            places = batch["position"].to_numpy()
            run = np.searchsorted(known["place"], places, side="right") - 1
            nth = places - known["place"][run]
            k = known["k"][run]
            offset = known["offset"][run] + nth % k * batch["length"].to_numpy()
            yield batch.drop(columns="position").assign(sequence_id=known["bin"][run] + nth // k, offset=offset)

    kind = pieces.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "position"]
    ordered = in_order(pieces, ["length", "doc_id", "piece"], "ordered-pieces").select(*columns)
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return ordered.mapInPandas(place, schema)
