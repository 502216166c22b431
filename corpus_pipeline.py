"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all documents that the
one before kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderspark.llm import decontam, line_dedup, packing, quality, simhash
from larderspark.llm.common import read, spare
from larderspark.session import cut_lineage


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def line_dedup_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go; so do documents of which nothing is left."""
    removed = spare(docs, "removed_lines")
    left = line_dedup.dedup_lines(docs, removed=removed).filter((F.col(removed) == 0) | (F.length(F.trim("text")) > 0))
    if "n_chars" in docs.columns:
        changed = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near-duplicates stays."""
    return simhash.keep_one(docs, repeats=False)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontam.drop_leaking(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document stands in the training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_dedup_texts),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: SQL can express neither the classifier nor the fingerprints and token ids; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
