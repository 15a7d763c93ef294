"""JSON Lines tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.regex import strip
from ..storage import materialize, running_sum


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Declared schema, blank lines skipped, a malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> int:
    """Distributed write with nulls kept; returns the row count, taken during the write.

    ``files`` asks for that many output files; by default every task writes its own.
    """
    rows = Observation()
    observed = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    if files is not None:
        observed = observed.repartition(files)
    observed.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return rows.get["rows"]


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, value)``: lines with their 0-based number, in (file, offset) order. Blank
    lines are counted and left out.

    The lines are written once with the block and the row number of the scan that read
    them; counts, offsets and every later use come from that table, so neither another
    split of the input nor new files can change a number or lose a line. Places become
    global numbers by a running sum over the blocks, dealt out by ranges.
    """
    block = ["path", "block"]
    placed = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )
    placed = materialize(placed, "lines")
    blocks = placed.groupBy(block).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    starts = running_sum(blocks, block, "n", "offset")
    return placed.join(starts, block).filter(strip(F.col("value")) != "").select(
        (F.col("seq") - F.col("first") + F.col("offset")).alias("doc_id"), "value"
    )


def parsed(lines: DataFrame, schema: StructType) -> DataFrame:
    """Records of ``(doc_id, value)`` lines; a malformed line fails the job."""
    record = F.from_json("value", schema, {"mode": "FAILFAST"})
    return lines.select("doc_id", record.alias("r")).select("doc_id", "r.*")


def read_numbered_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Records with their line number as ``doc_id``."""
    return parsed(numbered_lines(spark, path), schema)
