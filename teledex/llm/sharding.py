"""Sharding along a Hilbert curve over quantised metadata.

Each dimension is cut at its own quantiles, the cells become a point of a grid, and rows
are sorted by the point's index on the Hilbert curve. Shards are runs of that order, so a
shard spans a small range of every dimension and readers can skip it by its statistics.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import broadcast_checked, materialize
from .common import filled, in_order, spare

BITS = 5


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Curve indexes of grid points (rows of coordinates below 2 ** bits), by undoing the
    rotations of each level on the coordinates and reading the Gray code across them."""
    x = np.array(cells, np.uint64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for d in range(dims):
            flip = (x[d] & bit) != 0
            swap = (x[0] ^ x[d]) & low
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] = np.where(flip, x[d], x[d] ^ swap)
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    fix = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        fix ^= np.where((x[-1] & np.uint64(1 << level)) != 0, np.uint64((1 << level) - 1), np.uint64(0))
    x ^= fix
    index = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            index = (index << np.uint64(1)) | ((x[d] >> np.uint64(level)) & np.uint64(1))
    return index.astype(np.int64)


def ranked(table: DataFrame, names: list[str]) -> DataFrame:
    """``table`` (read again for each text dimension) with text in the columns ``names``
    replaced by its place among the column's different values. Null stays null."""
    for name in names:
        if isinstance(table.schema[name].dataType, (T.StringType, T.BinaryType)):
            value, = spare(table, "value")
            different = table.select(F.col(f"`{name}`").cast("binary").alias(value)).filter(F.col(value).isNotNull()).distinct()
            ranks = in_order(materialize(different, "dimension-values"), [value], "dimension-ranks")
            ranks = broadcast_checked(materialize(ranks.select(F.col(value), "position"), "dimension-places"))
            rank, = spare(table, "rank")
            ranks = ranks.withColumnRenamed("position", rank)
            table = table.join(ranks, F.col(f"`{name}`").cast("binary") == F.col(value), "left").drop(value)
            table = table.drop(name).withColumnRenamed(rank, name)
    return table


def ordinal(df: DataFrame, name: str) -> Column:
    """A numeric dimension (text: see ``ranked``) as a number that keeps its order. Null
    comes before all values."""
    return F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(float("-inf")))


def on_curve(table: DataFrame, dimensions: list[str], bits: int = BITS) -> DataFrame:
    """``table`` with its rows' ``curve`` index. The cuts are quantiles over all rows; only
    they (2 ** bits - 1 numbers a dimension) reach the driver."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    values = [ordinal(table, d) for d in dimensions]
    cuts_of = [F.percentile_approx(F.when(v > float("-inf"), v), shares, 10_000).alias(f"d{i}") for i, v in enumerate(values)]
    row = table.agg(*cuts_of).first()
    cuts = [np.unique(np.array(row[f"d{i}"] or [], np.float64)) for i in range(len(dimensions))]

    @F.pandas_udf("bigint")
    def index(point: pd.DataFrame) -> pd.Series:
        cells = [np.searchsorted(c, point.iloc[:, i].to_numpy(np.float64), side="right") for i, c in enumerate(cuts)]
        return pd.Series(hilbert_index(np.stack(cells, axis=1), bits))

    return table.withColumn("curve", index(F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)])))


def assign_shards(
    docs: DataFrame, shards: int = 24, dimensions: tuple[str, ...] = ("source", "lang", "size"), law: str = "rows", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null).

    Runs of the curve's order are cut at equal row counts (``rows``: counts at most one
    apart) or at equal bytes (``bytes``: a shard may pass its mark by one row). ``size``,
    the UTF-8 bytes of the text and 8, can be a dimension. Null text counts as empty, null
    dimensions come first, equal points are ordered by id, checksum and size; repeated rows
    get slots of their own. Fewer rows than shards leave some empty.
    """
    text = F.col(f"`{text_col}`")
    own = [F.col(f"`{id_col}`").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint").alias("size")]
    own += [F.crc32(filled(text).cast("binary")).alias("text_crc32")]
    own += [F.col(f"`{d}`").alias(f"dim_{d}") for d in dimensions if d != "size"]
    names = [d if d == "size" else f"dim_{d}" for d in dimensions]
    narrow = ranked(materialize(docs.select(*own), "shard-rows"), names)
    curved = on_curve(narrow, names)
    curved = materialize(curved.select("doc_id", "size", "text_crc32", "curve"), "shard-points")
    placed = in_order(curved, ["curve", "doc_id", "text_crc32", "size"], "shard-order", weight="size")
    totals = placed.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()
    rows, total = max(totals.rows, 1), max(totals.bytes or 0, 1)
    if law == "rows":
        placed = placed.withColumn("shard", F.expr(f"CAST((position * {shards}L) div {rows}L AS INT)"))
        slot = F.col("position") - F.expr(f"(shard * {rows}L + {shards - 1}L) div {shards}L")
    elif law == "bytes":
        placed = placed.withColumn("shard", F.expr(f"CAST(CAST(before AS DECIMAL(38,0)) * {shards} div {total} AS INT)"))
        starts = placed.groupBy("shard").agg(F.min("position").alias("start"))  # one row a shard
        placed = placed.join(F.broadcast(starts), "shard")
        slot = F.col("position") - F.col("start")
    else:
        raise ValueError("law is rows or bytes")
    return placed.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", slot.cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int, dimensions: list[str]) -> None:
    """Whole rows as Parquet, a folder a shard, in the curve's order, runs of equal rows."""
    rows = docs.select(F.struct("*").alias("row"), *[F.col(f"`{d}`").alias(f"dim_{d}") for d in dimensions])
    names = [f"dim_{d}" for d in dimensions]
    curved = on_curve(ranked(rows, names), names).select("row", "curve")
    placed = in_order(materialize(curved, "curved"), ["curve"], "curve-order")
    count, (shard,) = max(placed.count(), 1), spare(docs, "shard")
    placed = placed.select("row.*", F.expr(f"CAST((position * {shards}L) div {count}L AS INT)").alias(shard))
    placed.write.partitionBy(shard).parquet(path)
