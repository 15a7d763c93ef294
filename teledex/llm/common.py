"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialize


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hands texts to Python workers in small batches, where the session sets no size:
    a worker's memory follows the batch, and texts can be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) == 10_000:
        spark.conf.set(name, rows)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spare(df: DataFrame, *wanted: str) -> list[str]:
    """Column names close to the wanted ones that ``df`` doesn't have (in any case)."""
    taken, names = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def filled(text: Column) -> Column:
    """Null text counts as empty."""
    return F.coalesce(text, F.lit(""))


def content_hash(text: Column) -> Column:
    """128 bits of a text's content."""
    return F.unhex(F.md5(text))


def row_key(id_col: Column, text: Column) -> Column:
    """128 bits naming a document by its id (null allowed) and text. Rows that repeat both
    are one document to the operators that use it."""
    return F.unhex(F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(" "), filled(text))))


#: Bits of a bitmap: 16 a value within these bounds.
BITMAP_BITS = (1 << 20, 1 << 29)
#: Bits that a task packs into one value.
BLOCK_BITS = 1 << 16


def bitmap(values: DataFrame, column: str) -> np.ndarray:
    """A filter with a bit for each value of a written table's bigint column (one of the
    hashed low bits). Its size is bounded; a fuller one finds values that aren't there
    more often, and misses none. Tasks pack blocks of bits, so the driver only lays blocks
    of some kilobytes side by side: 64 MB at most, fetched by one job. (An iterator over
    partitions would run a job for each, one after the other.)"""
    wanted = 1 << max(1, 16 * values.count()).bit_length()
    bits = min(max(wanted, BITMAP_BITS[0]), BITMAP_BITS[1])
    place = F.col(column).bitwiseAND(F.lit(bits - 1))
    in_block = F.collect_set(place.bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int")).alias("places")
    blocks = values.groupBy(F.shiftright(place, BLOCK_BITS.bit_length() - 1).alias("block")).agg(in_block)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for places in batch["places"]:
                own = np.zeros(BLOCK_BITS, np.uint8)
                own[places.values.to_numpy()] = 1
                packed.append(np.packbits(own, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch["block"], pa.array(packed, pa.binary())], ["block", "bits"])

    out = np.zeros(bits // 32, np.uint32)
    size = BLOCK_BITS // 32
    for row in blocks.mapInArrow(pack, "block bigint, bits binary").collect():
        out[row.block * size : (row.block + 1) * size] = np.frombuffer(row.bits, np.uint32)
    return out


def in_bitmap(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    place = values & np.int64(len(known) * 32 - 1)
    return (known[place >> 5] >> (place & 31).astype(np.uint32)) & 1 == 1


def rows_in_bitmap(table: DataFrame, value: Column, known: np.ndarray) -> DataFrame:
    """Rows whose bigint value may be among those of a bitmap; nothing is moved."""
    shared = table.sparkSession.sparkContext.broadcast(known)
    name, = spare(table, "tested")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(batch[name].to_numpy(), shared.value)))

    tested = table.withColumn(name, value)
    return tested.mapInArrow(run, tested.schema).drop(name)


def let_go(spark: SparkSession) -> None:
    """Has the driver collect its garbage: the shuffle files of a job stay on the executors'
    disks until its plan is found unreachable, which a driver with little to do finds late."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def in_order(table: DataFrame, keys: list[str], name: str, weight: str | None = None) -> DataFrame:
    """``table`` (cheap to read: it is read twice) with its rows' places in the order of
    ``keys``: ``position`` from 0 and, with ``weight``, ``before``: the weight of all
    earlier rows.

    Rows are dealt by ranges of the keys and a row number, so equal keys can be split over
    tasks; each task numbers its own sorted rows. The result is written, and only the rows
    and weight of each task (one line a partition) go through the driver.
    """
    spark = table.sparkSession
    tie, = spare(table, "tie")
    dealt = table.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys, tie)
    dealt = dealt.sortWithinPartitions(*keys, tie).drop(tie).withColumn("part", F.spark_partition_id())
    if weight is None:
        placed = dealt.withColumn("position", F.monotonically_increasing_id() - F.shiftleft(F.col("part").cast("long"), 33))
    else:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rows = total = 0
            for batch in batches:
                sums = batch[weight].cumsum()
                yield batch.assign(position=range(rows, rows + len(batch)), before=total + sums - batch[weight])
                rows += len(batch)
                total += int(batch[weight].sum())

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
        placed = dealt.mapInPandas(run, f"{fields}, position bigint, before bigint")
    written = materialize(placed, name)
    sums = [F.count("*").alias("rows")] + ([F.sum(weight).alias("weight")] if weight else [])
    rows_before = weight_before = 0
    starts = []
    for part in sorted(written.groupBy("part").agg(*sums).collect(), key=lambda p: p.part):
        starts.append((part.part, rows_before, weight_before))
        rows_before += part.rows
        weight_before += (part.weight or 0) if weight else 0
    starts = spark.createDataFrame(starts, "part int, rows_before bigint, weight_before bigint")
    out = written.join(F.broadcast(starts), "part").withColumn("position", F.col("position") + F.col("rows_before"))
    if weight:
        out = out.withColumn("before", F.col("before") + F.col("weight_before"))
    return out.drop("part", "rows_before", "weight_before")
