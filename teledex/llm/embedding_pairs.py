"""Embedding near-dedup with a pivot-permutation index.

A vector is described by its nearest reference points (pivots), nearest first. The index
is a table of inverted lists, one for each combination of SHARED pivots among a vector's
first NEAREST; vectors that share at least so many pivots meet in a list. Members of a
list are compared in blocks, by exact cosine; a pair that meets in several lists is given
by the first of them. Equal vectors are one entry.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize
from .components import components

#: Pivots at least, and of these how many describe a vector and how many must be shared. Pivots are
#: picked from a bounded sample of SAMPLE vectors, taken by hash, none within APART of
#: another: several in one dense group would order its members by chance.
PIVOTS, NEAREST, SHARED = 256, 6, 3
SAMPLE, APART = 4096, 0.8
#: Pivots grow with tables of more than so many vectors, up to so many pivots: with more,
#: fewer of the vectors at the threshold share enough of them.
FEW_VECTORS, MOST_PIVOTS = 200_000, 768
#: Members of a list that are compared at once, and blocks of them a task holds.
BLOCK, BLOCKS_AT_ONCE = 128, 32


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` unit vectors of a sample whose cosine with those taken before
    stays below APART."""
    unit = _unit(sample)
    open_ = np.ones(len(unit), bool)
    taken: list[int] = []
    while open_.any() and len(taken) < count:
        i = int(np.argmax(open_))
        taken.append(i)
        open_ &= unit @ unit[i] < APART
        open_[i] = False
    return unit[taken]


def permutation_prefix(vectors: np.ndarray, pivots: np.ndarray, nearest: int = NEAREST) -> np.ndarray:
    """Per vector its nearest pivots by cosine, nearest first, ties by number."""
    return np.argsort(-(_unit(vectors) @ pivots.T), axis=1, kind="stable")[:, :nearest]


def pivots_for(vectors: int, least: int = PIVOTS) -> int:
    """How many pivots a table of so many vectors gets, so that its lists stay about as long
    as at FEW_VECTORS. Lists follow the cube of the pivots (three are shared), but near
    pivots are shared more often than others, hence more than the cube root."""
    return max(least, min(MOST_PIVOTS, round(least * (vectors / FEW_VECTORS) ** 0.4)))


def _names(order: np.ndarray, pivots: int) -> np.ndarray:
    """The number of the list that each row of ascending pivots names."""
    names = np.zeros(len(order), np.int64)
    for j in range(order.shape[1]):
        names = names * pivots + order[:, j]
    return names


def _described(entries: DataFrame, pivots: np.ndarray, nearest: int, shared: int) -> DataFrame:
    """(c, vector, near, lists), written: a vector's nearest pivots in ascending order, and
    its lists, one for each ``shared`` of them."""
    known = entries.sparkSession.sparkContext.broadcast(pivots)
    chosen = list(combinations(range(min(nearest, len(pivots))), shared))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = np.stack(batch["embedding"].to_numpy()).astype(np.float64)
            order = np.sort(permutation_prefix(vectors, known.value, nearest), axis=1).astype(np.int32)
            names = np.stack([_names(order[:, picked], len(known.value)) for picked in chosen], axis=1)
            yield pd.DataFrame({"c": batch["c"], "vector": [v.tobytes() for v in vectors], "near": [o.tobytes() for o in order], "lists": list(names)})

    found = entries.select("c", "embedding").mapInPandas(run, "c bigint, vector binary, near binary, lists array<bigint>")
    return materialize(found, "described-vectors")


def first_shared(a: np.ndarray, b: np.ndarray, shared: int, pivots: int) -> np.ndarray:
    """Per pair of rows of ascending pivots, the list of the first they share (``shared``
    at least): the one of a pair's lists that gives the pair."""
    both = (a[:, :, None] == b[:, None, :]).any(axis=2)
    both &= np.cumsum(both, axis=1) <= shared
    return _names(a[both].reshape(len(a), shared), pivots)


def _rows(members: pa.ListArray, field: str, like: type) -> np.ndarray:
    """A binary field of all members of all blocks, a row a member."""
    flat = members.flatten().field(field)
    return np.frombuffer(b"".join(flat.to_pylist()), like).reshape(len(flat), -1)


def _compared(described: DataFrame, cosine: float, shared: int, pivots: int) -> DataFrame:
    """Linked pairs (a, b), a < b, each once: members of a list are compared block by block,
    and a pair that meets in several lists comes from the first of them."""
    sizes = described.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count("*").alias("size")).filter("size > 1")
    listed = described.select(F.explode("lists").alias("list"), "c", "near", "vector")
    dealt = listed.join(sizes, "list").withColumn("blocks", F.ceil(F.col("size") / BLOCK)).withColumn("block", F.pmod(F.xxhash64("c"), "blocks"))
    # About BLOCK members a block, whatever the list's size.
    blocks = dealt.groupBy("list", "block").agg(F.first("blocks").alias("blocks"), F.collect_list(F.struct("c", "near", "vector")).alias("m"))
    blocks = materialize(blocks, "vector-blocks")

    def linked(lists: np.ndarray, left: pa.ListArray, right: pa.ListArray | None = None) -> pa.RecordBatch:
        """Links between the members of two blocks a row, or within one."""
        sides = []
        for members in (left,) if right is None else (left, right):
            ends = np.concatenate([[0], np.cumsum(members.value_lengths().to_numpy())])
            c = members.flatten().field("c").to_numpy()
            sides.append((ends, c, _rows(members, "near", np.int32), _unit(_rows(members, "vector", np.float64))))
        (at, c1, near1, unit1), (to, c2, near2, unit2) = sides[0], sides[-1]
        found = [(np.zeros(0, np.int64),) * 3]
        for row in range(len(lists)):
            i, j = np.nonzero(unit1[at[row] : at[row + 1]] @ unit2[to[row] : to[row + 1]].T >= cosine)
            if right is None:
                i, j = i[i < j], j[i < j]
            if len(i):
                found.append((np.full(len(i), row), i + at[row], j + to[row]))
        row, i, j = (np.concatenate(x) for x in zip(*found))
        first = first_shared(near1[i], near2[j], shared, pivots) == lists[row]
        a, b = c1[i[first]], c2[j[first]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCKS_AT_ONCE):
                lists, *sides = batch.slice(start, BLOCKS_AT_ONCE).columns
                yield linked(lists.to_numpy(), *sides)

    split = blocks.filter("blocks > 1").select("list", "block", "m")
    pairs = split.toDF("list", "block1", "m1").join(split.toDF("list", "block2", "m2"), "list").filter("block1 < block2").select("list", "m1", "m2")
    inside = blocks.select("list", "m").mapInArrow(run, "a bigint, b bigint")
    return materialize(inside.unionByName(pairs.mapInArrow(run, "a bigint, b bigint")), "vector-links")


def near_vectors(
    table: DataFrame, cosine: float = 0.95, pivots: int = PIVOTS, nearest: int = NEAREST, shared: int = SHARED, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Pairs found in the index link if their cosine in double precision reaches the
    threshold (``pivots`` are at least so many, more for large tables); n_links counts other vectors, copies included. Vectors that are null, zero
    or empty, or hold null or non-finite components, link with nothing, and vectors of
    unlike lengths don't meet. Repeated rows are vectors of their own. A null id names no
    component that has another. Other columns are ignored; empty tables give empty results.
    """
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)
    rows = table.select(F.col(f"`{id_col}`").alias("vec_id"), F.when(sound, vector).alias("embedding"))
    sums = rows.filter("embedding IS NOT NULL").groupBy("embedding").agg(F.count("*").alias("size"), F.min("vec_id").alias("first"))
    entries = materialize(sums.withColumn("c", F.monotonically_increasing_id()), "vectors")
    links = None
    for row in entries.groupBy(F.size("embedding").alias("width")).count().collect():  # one row a vector length
        own = entries.filter(F.size("embedding") == row.width)
        sample = own.orderBy(F.xxhash64("embedding"), "c").limit(SAMPLE).collect()
        points = spread_pivots(np.array([r.embedding for r in sample], np.float64), pivots_for(row["count"], pivots))
        common = min(shared, nearest, len(points))
        found = _compared(_described(own, points, nearest, common), cosine, common, len(points))
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = entries.select(F.col("c").alias("a"), F.col("c").alias("b")).limit(0)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    beside = both.join(entries.select(F.col("c").alias("b"), "size"), "b").groupBy("a").agg(F.sum("size").alias("beside"))
    known = entries.join(components(links), F.col("c") == F.col("node"), "left").withColumn("root", F.coalesce("root", "c"))
    least = known.groupBy("root").agg(F.min("first").alias("least"))
    known = known.join(least, "root").join(beside, F.col("c") == F.col("a"), "left")
    known = known.select("embedding", "least", (F.col("size") - 1 + F.coalesce("beside", F.lit(0))).alias("n_links"))
    out = rows.join(materialize(known, "vector-groups"), "embedding", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
