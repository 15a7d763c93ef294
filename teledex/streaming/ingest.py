"""HTML pages -> records as they arrive: the batch extraction on a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.html_records import extract_html_records
from ..sources.text import html_rows
from ..storage import new_path, remove

FILES_PER_BATCH = 500


def stream_html_files(
    spark: SparkSession, folder: str, glob: str = "*.html", files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """``(path, html)`` stream of a folder, at most ``files_per_batch`` files a batch."""
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return html_rows(files)


def ingest(
    pages: DataFrame,
    output: str,
    checkpoint: str | None = None,
    keep: list[str] | None = None,
    output_format: str = "parquet",
) -> StreamingQuery:
    """Start extracting a page stream into ``output`` until its present input is done.

    The same ``checkpoint`` continues where it stopped. Without one the run starts over:
    the previous output is removed first, with the sink's own log, which would otherwise
    take the new run's batches for done. Each page is read, parsed and written by one task; no state is kept.
    """
    if checkpoint is None:
        remove(pages.sparkSession, output)
        checkpoint = new_path(pages.sparkSession, "ingest-checkpoint")
    writer = extract_html_records(pages, keep=keep).writeStream.format(output_format)
    if output_format == "json":
        writer = writer.option("ignoreNullFields", "false")
    return (
        writer.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", output)
        .trigger(availableNow=True)
        .start()
    )
