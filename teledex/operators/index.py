"""Full-text index as tables.

``postings``  one row per (document, field, term): count, positions, field length
``terms``     dictionary: per (field, term) its documents and its highest share of a score
``fields``    documents and mean length per field

Documents are dealt into buckets once, before they are analyzed; a document's postings are
computed inside its own row and stay in its bucket, sorted by (field, term). So no term,
however common, gathers in one task, and searches, which group by document, never move
postings. The dictionary is sorted by (field, term) as a whole.

An index folder holds versions, each complete on its own; the last complete one counts.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions.analysis import term_groups, tokenize
from ..storage import listed, mark, marked, new_path, remove

# --- Fixed values: they decide the results and must stay as they are. -----------
FIELDS = [
    "title", "year", "certification", "genres", "keywords",
    "cast", "creator", "language", "status", "type", "score",
    "country", "network", "plot", "num_seasons", "num_episodes", "runtime",
]
EXACT_FIELDS = ["year", "status", "num_seasons", "num_episodes"]
K1, B = 1.2, 0.75
# --------------------------------------------------------------------------------

# Bytes of text in a bucket, by default: what a task sorts when indexing, and scores per
# query when searching, then doesn't grow with the collection.
BUCKET_BYTES = 8_000_000
MAX_BUCKETS = 100_000  # Spark's own limit, unless it is set higher


def _searchable_text(records: DataFrame, name: str) -> Column:
    """Field as one string; null when it counts as absent (0, blank, empty list)."""
    kind = records.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, ArrayType):
        text = F.array_join(value, " ")
    elif isinstance(kind, StringType):
        text = value
    else:
        text = F.when(value != 0, value.cast("string"))
    return F.nullif(text, F.lit(""))


def search_fields(records: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, field, value)`` for every field a record has."""
    present = [name for name in FIELDS if name in records.columns]
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("field"), _searchable_text(records, name).alias("value"))
            for name in present
        ]
    )
    kept = F.filter(entries, lambda e: e["value"].isNotNull())
    return records.select(F.col(doc_id).alias("doc_id"), F.inline(kept))


def field_tokens(field: Column, value: Column) -> Column:
    """Exact fields are one token as written; the others are analyzed."""
    return F.when(field.isin(EXACT_FIELDS), F.array(value)).otherwise(tokenize(value))


def build_postings(fields: DataFrame) -> DataFrame:
    """Postings of ``(doc_id, field, value)`` rows. ``ordinal`` is 0 on exactly one
    posting of each document's field, so field totals need no distinct."""
    tokens = fields.select(
        "doc_id", "field", field_tokens(F.col("field"), F.col("value")).alias("tokens")
    )
    groups = tokens.select(
        "doc_id",
        "field",
        F.size("tokens").alias("length"),
        F.posexplode(term_groups(F.col("tokens"))).alias("ordinal", "entry"),
    )
    return groups.select(
        "doc_id",
        "field",
        "entry.term",
        F.size("entry.positions").alias("tf"),
        "length",
        "ordinal",
        "entry.positions",
    )


def field_stats(postings: DataFrame) -> DataFrame:
    """``(field, docs, mean_length)``."""
    return (
        postings.filter(F.col("ordinal") == 0)
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("docs"), F.avg("length").alias("mean_length"))
    )


def saturation(tf: Column, length: Column, mean_length: Column) -> Column:
    """What a posting adds to a score per unit of its term's weight: below 1."""
    return tf / (tf + K1 * (1 - B + B * length / mean_length))


def term_stats(postings: DataFrame, fields: DataFrame) -> DataFrame:
    """``(field, term, df, top_share)``; counted map-side first, so common terms are cheap.
    ``top_share`` bounds what the term adds to any document's score."""
    share = saturation(F.col("tf"), F.col("length"), F.col("mean_length"))
    known = postings.join(F.broadcast(fields.select("field", "mean_length")), "field")  # a row per field
    return known.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"), F.max(share).alias("top_share"))


def with_idf(terms: DataFrame, fields: DataFrame) -> DataFrame:
    """Add ``docs``, ``mean_length`` and ``idf = ln(1 + (N - n + 0.5) / (n + 0.5))``."""
    n, total = F.col("df"), F.col("docs")
    return terms.join(fields, "field").withColumn("idf", F.log(1 + (total - n + 0.5) / (n + 0.5)))


@dataclass(frozen=True)
class SearchIndex:
    postings: DataFrame
    terms: DataFrame
    fields: DataFrame


def _table_name(folder: str) -> str:
    return f"teledex_postings_{hashlib.md5(folder.encode()).hexdigest()}"


def bucket_count(fields: DataFrame) -> int:
    """Buckets for ``(doc_id, field, value)`` rows: the session's shuffle partitions, more where
    buckets would exceed ``BUCKET_BYTES``."""
    spark = fields.sparkSession
    total = fields.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(-(-total // BUCKET_BYTES), MAX_BUCKETS))


def write_index(fields: DataFrame, path: str, buckets: int | None = None) -> SearchIndex:
    """Build from ``(doc_id, field, value)`` rows as a new version under ``path``.

    ``buckets`` (by default as many as the text needs, see :func:`bucket_count`) is how many
    tasks a search has: a bucket's postings should suit one task. The fields of a document
    should come from one row, so that dealing them out moves each text once. The version
    before the new one stays for those who still read it; older ones are removed.
    """
    spark = fields.sparkSession
    buckets = buckets or bucket_count(fields)
    older = _versions(spark, path)
    number = 1 + int(older[-1].split("-")[0]) if older else 1
    folder = f"{path.rstrip('/')}/{number:08d}-{buckets}"
    postings = build_postings(fields.repartition(buckets, "doc_id"))
    writer = postings.write.format("parquet").bucketBy(buckets, "doc_id").sortBy("field", "term")
    writer.option("path", f"{folder}/postings").saveAsTable(_table_name(folder))
    postings = spark.table(_table_name(folder))
    field_stats(postings).write.parquet(f"{folder}/fields")
    stats = term_stats(postings, spark.read.parquet(f"{folder}/fields"))
    ordered = stats.repartitionByRange("field", "term").sortWithinPartitions("field", "term")
    ordered.write.parquet(f"{folder}/terms")
    mark(spark, folder)
    for name in older[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(f'{path.rstrip('/')}/{name}')}")
        remove(spark, f"{path.rstrip('/')}/{name}")
    return read_index(spark, path)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete versions under a path, oldest first."""
    return sorted(name for name in listed(spark, path) if marked(spark, f"{path.rstrip('/')}/{name}"))


def read_index(spark: SparkSession, path: str) -> SearchIndex:
    """The last complete version. Its bucketed postings are made known to the session's
    catalog, which is how Spark learns of buckets."""
    versions = _versions(spark, path)
    if not versions:
        raise ValueError(f"no index under {path}")
    folder = f"{path.rstrip('/')}/{versions[-1]}"
    name, buckets = _table_name(folder), versions[-1].split("-")[1]
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{folder}/postings").schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (doc_id) "
            f"SORTED BY (field, term) INTO {buckets} BUCKETS LOCATION '{folder}/postings'"
        )
    return SearchIndex(spark.table(name), *[spark.read.parquet(f"{folder}/{x}") for x in ("terms", "fields")])


def index_records(
    records: DataFrame, doc_id: str = "doc_id", path: str | None = None, buckets: int | None = None
) -> SearchIndex:
    """Index records; without ``path`` into a new folder of the shared one."""
    path = path or new_path(records.sparkSession, "index")
    buckets = buckets or bucket_count(search_fields(records, doc_id))
    # Dealt before the fields are listed: each record moves once, as it is.
    return write_index(search_fields(records.repartition(buckets, doc_id), doc_id), path, buckets)
