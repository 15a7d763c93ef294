"""Where intermediate tables go: a folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Most rows of a narrow table (numbers and short strings, commonly under 100 bytes a
# row) that are broadcast.
BROADCAST_ROWS = 500_000

SHARED_FOLDER_CONF = "spark.checkpoint.dir"


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Where none is set, a local master gets a temporary
    one; a cluster must name its own."""
    folder = spark.conf.get(SHARED_FOLDER_CONF, None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {SHARED_FOLDER_CONF} to a folder all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="teledex-")
    return _local_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder, so runs never meet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: cuts lineage, survives lost executors, and gives the
    optimizer the table's real size for its join choices."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``materialize`` wrote, once nothing reads them any more."""
    for table in tables:
        remove(table.sparkSession, table.written_to)


def remove(spark: SparkSession, folder: str) -> None:
    """Removes a folder of any file system Spark knows; nothing happens if it is missing."""
    path, system = _file_system(spark, folder)
    system.delete(path, True)


def running_sum(table: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``table``, written, with the sum of ``value`` over all rows before each, in the order
    of ``keys`` (distinct), as ``name``.

    Rows are dealt out by ranges of the keys and each task sums its own range; only the
    tasks' totals, one number each, go through the driver.
    """
    dealt = table.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    dealt = materialize(dealt, "ranges")
    order = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    shifts, total = [], 0
    for part in sorted(dealt.groupBy("_part").agg(F.sum(value).alias("own")).collect()):
        shifts.append((part["_part"], total))
        total += part.own
    shifts = dealt.sparkSession.createDataFrame(shifts, "_part int, _shift bigint")
    summed = dealt.withColumn(name, F.coalesce(F.sum(value).over(order), F.lit(0)))
    shifted = summed.join(F.broadcast(shifts), "_part")  # a row per task
    moved = (F.col(name) + F.col("_shift")).alias(name)
    return materialize(shifted.select(*table.columns, moved), "running-sums")


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if it is missing."""
    where, system = _file_system(spark, path)
    return [x.getPath().getName() for x in system.listStatus(where)] if system.exists(where) else []


def mark(spark: SparkSession, folder: str) -> None:
    """Marks a folder as complete; see :func:`marked`."""
    where, system = _file_system(spark, f"{folder}/_COMPLETE")
    system.create(where, True).close()


def marked(spark: SparkSession, folder: str) -> bool:
    where, system = _file_system(spark, f"{folder}/_COMPLETE")
    return system.exists(where)


def broadcast_checked(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, marked for broadcast when it has at most ``max_rows`` rows; else
    the join is left to the optimizer."""
    return F.broadcast(table) if table.count() <= max_rows else table


def spread(scan: DataFrame, key: str) -> DataFrame:
    """For CPU-bound work on a scan of fewer partitions than there are cores (a small
    table, or files that cannot be split): repartition by key. Larger scans, where a
    shuffle would cost, are returned as they are.

    ``scan`` must be a plain scan: for one, counting partitions only lists files.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan
