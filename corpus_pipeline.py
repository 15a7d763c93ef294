"""A training corpus in stages: quality, exact dedup, near dedup, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from teledex.llm.common import read
from teledex.llm.exact_dedup import exact_dedup
from teledex.llm.mixing import mix
from teledex.llm.ngram_join import near_dedup
from teledex.llm.packing import pack
from teledex.llm.quality import keep_good
from teledex.storage import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier doesn't reject."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: word 5-shingles, similarity 0.8."""
    return near_dedup(docs, words=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources up to twice."""
    return mix(docs, repetition=2.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixing), ("packing", packing)]

#: Learned scores, similarity components and bin completion are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
