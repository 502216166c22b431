"""Quality gate of the exported catalogue."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from larderspark.functions import text
from larderspark.session import cut_lineage

# check name -> message when it fails
FAILURES = {
    "products_empty": "products_master is empty",
    "documents_empty": "product_search_documents is empty",
    "products_duplicates": "products_master contains duplicate product_id values",
    "documents_duplicates": "product_search_documents contains duplicate product_id values",
    "blank_names": "products_master contains blank product_name values",
    "blank_texts": "product_search_documents contains blank search_text values",
}


# table -> (column that must not be blank, name of the count of blanks)
BLANKS = {"products": ("product_name", "blank_product_names"), "documents": ("search_text", "blank_search_text")}


def totals(prefix: str) -> list[Column]:
    """Rows and blanks: plain sums, so they can be observed while the rows are written."""
    blank, name = BLANKS[prefix]
    return [F.count(F.lit(1)).alias(f"{prefix}_rows"), F.count_if(text.strip(F.col(blank)) == "").alias(name)]


def unique_ids(prefix: str) -> Column:
    return F.count_distinct("product_id").alias(f"{prefix}_unique_ids")


def quality_gate(products: DataFrame, documents: DataFrame) -> DataFrame:
    """One row: counts, distinct ids, blanks, failures and the status."""
    def counts(df: DataFrame, prefix: str) -> DataFrame:
        return df.agg(*totals(prefix), unique_ids(prefix))

    row = counts(products, "products").unionByName(counts(documents, "documents"), allowMissingColumns=True)
    return verdict(row.agg(*[F.max(c).alias(c) for c in row.columns]))


def store_observed(df: DataFrame, prefix: str) -> tuple[DataFrame, dict[str, int]]:
    """``df`` as a stored table, and its counts, taken as it is written; only the distinct ids read it again."""
    seen = Observation(f"{prefix}-counts")
    stored = cut_lineage(df.observe(seen, *totals(prefix)), prefix)
    return stored, {**seen.get, f"{prefix}_unique_ids": stored.agg(unique_ids(prefix)).first()[0]}


def verdict(row: DataFrame) -> DataFrame:
    """Counts with the failed checks and the status."""
    failed: dict[str, Column] = {
        "products_empty": F.col("products_rows") == 0,
        "documents_empty": F.col("documents_rows") == 0,
        "products_duplicates": F.col("products_unique_ids") != F.col("products_rows"),
        "documents_duplicates": F.col("documents_unique_ids") != F.col("documents_rows"),
        "blank_names": F.col("blank_product_names") > 0,
        "blank_texts": F.col("blank_search_text") > 0,
    }
    messages = F.concat_ws("; ", *[F.when(failed[k], F.lit(FAILURES[k])) for k in FAILURES])
    return row.withColumn("failures", messages).withColumn(
        "status", F.when(F.col("failures") == "", F.lit("passed")).otherwise(F.lit("failed"))
    )


def assert_quality(products: DataFrame, documents: DataFrame) -> dict[str, object]:
    """The report as a dict; raises with the report when the gate fails."""
    return passed(quality_gate(products, documents).first().asDict())


def passed(report: dict[str, object]) -> dict[str, object]:
    if report["status"] == "failed":
        raise RuntimeError(json.dumps(report, indent=2))
    return report
