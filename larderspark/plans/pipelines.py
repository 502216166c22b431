"""Whole jobs: read, transform, write, report paths."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderspark.operators import product_docs, ranking, reports, reviews
from larderspark.sources import writers

SAMPLE_REVIEWS = 1000
SAMPLE_PRODUCTS = 250


def write_review_outputs(raw: DataFrame, out: str, mode: str = "overwrite") -> dict[str, str | None]:
    """Clean reviews, build product documents and the report, write all of them.

    The cleaned table is written first and read back, so documents and report
    are column-pruned scans of it. A failed Parquet write of the cleaned table
    is a warning: the CSV is then read back instead.
    """
    spark = raw.sparkSession
    paths: dict[str, str | None] = {
        "cleaned_reviews": f"{out}/reviews_cleaned.parquet",
        "cleaned_reviews_csv": f"{out}/reviews_cleaned.csv",
        "product_documents": f"{out}/product_documents.parquet",
        "quality_report": f"{out}/quality_report.json",
        "sample_reviews": f"{out}/reviews_cleaned_sample.parquet",
        "sample_products": f"{out}/product_documents_sample.parquet",
    }
    cleaned = reviews.clean_reviews(raw)
    try:
        cleaned.write.mode(mode).parquet(paths["cleaned_reviews"])
        table = spark.read.parquet(paths["cleaned_reviews"])
    except PySparkException as error:
        print(f"warning: cleaned parquet not written: {error}")
        paths["cleaned_reviews"] = None
        table = cleaned
    writers.write_csv(table, paths["cleaned_reviews_csv"], mode)
    product_docs.product_documents(table).write.mode(mode).parquet(paths["product_documents"])
    documents = spark.read.parquet(paths["product_documents"])
    ranking.head(table, ["Id"], SAMPLE_REVIEWS).write.mode(mode).parquet(paths["sample_reviews"])
    ranking.head(documents, [F.desc("review_count"), "ProductId"], SAMPLE_PRODUCTS).write.mode(
        mode).parquet(paths["sample_products"])
    reports.quality_report(raw, table).coalesce(1).write.mode(mode).json(paths["quality_report"])
    return paths


def _read_artefact(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".csv"):
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return spark.read.json(path) if path.endswith(".json") else spark.read.parquet(path)


def artefact_list(spark: SparkSession, paths: Mapping[str, str | None]) -> DataFrame:
    """Which artefacts exist, and how many rows each of them has."""
    frames = []
    for name, path in paths.items():
        try:
            found = None if path is None else _read_artefact(spark, path)
        except AnalysisException:
            found = None
        if found is None:
            rows = spark.createDataFrame([(None,)], "rows bigint")
        else:
            rows = found.agg(F.count(F.lit(1)).alias("rows"))
        frames.append(rows.select(
            F.lit(name).alias("artefact"), F.lit(found is not None).alias("exists"), "rows"))
    return reduce(DataFrame.unionByName, frames)
