"""One search document per product, from reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderspark.functions import numeric, text
from larderspark.operators.ranking import merge_top_k

SUMMARIES = 6
TEXTS = 8
TEXT_CHARS = 280
NO_LABEL = "No short label available"


def review_samples(cleaned: DataFrame) -> DataFrame:
    """At most 6 summaries and 8 shortened texts per product, best rated first.

    Each review becomes up to two narrow rows (kind, value). The ranked filter
    keeps 8 per product and kind in every partition before the shuffle and
    merges them per slice of partitions, so a product with a third of all
    reviews sends a few rows per slice, not its texts.
    """
    kinds = F.array(
        F.struct(F.lit("s").alias("kind"), F.col("Summary").alias("value")),
        F.struct(F.lit("t").alias("kind"), F.substring("Text", 1, TEXT_CHARS).alias("value")),
    )
    rows = cleaned.select(
        "ProductId", "HelpfulnessDenominator", "HelpfulnessNumerator", "Score", "text_length", "Id",
        F.explode_outer(F.filter(kinds, lambda k: k["value"] != "")).alias("sample"),
    ).select("*", "sample.kind", "sample.value").drop("sample")
    best = [
        F.desc_nulls_first("HelpfulnessDenominator"),
        F.desc_nulls_first("HelpfulnessNumerator"),
        F.desc_nulls_first("Score"),
        F.desc_nulls_first("text_length"),
        "Id",
    ]
    kept = merge_top_k(rows, ["ProductId", "kind"], best, TEXTS)

    def values(kind: str, limit: int):
        item = F.when(
            (F.col("kind") == kind) & (F.col("rank") <= limit), F.struct("rank", "value")
        )
        return F.transform(F.array_sort(F.collect_list(item)), lambda x: x["value"])

    return kept.groupBy("ProductId").agg(
        values("s", SUMMARIES).alias("summary_samples"),
        values("t", TEXTS).alias("text_samples"),
    )


def product_documents(cleaned: DataFrame) -> DataFrame:
    """Counts, averages, samples and the search text of every product."""
    totals = cleaned.groupBy("ProductId").agg(
        F.count(F.lit(1)).cast("int").alias("review_count"),
        numeric.round_even(F.avg("Score"), 2).cast("float").alias("average_score"),
        numeric.round_even(
            F.avg(numeric.exact_ratio(F.col("HelpfulnessNumerator"), F.col("HelpfulnessDenominator"))).cast("double"), 3
        ).cast("float").alias("average_helpfulness_ratio"),
        F.min("review_timestamp").alias("first_review_at"),
        F.max("review_timestamp").alias("last_review_at"),
    )
    joined = totals.join(review_samples(cleaned), "ProductId", "left").withColumns(
        {
            "summary_samples": F.coalesce("summary_samples", F.array().cast("array<string>")),
            "text_samples": F.coalesce("text_samples", F.array().cast("array<string>")),
        }
    )
    label = F.try_element_at("summary_samples", F.lit(1))
    search_text = F.concat(
        F.lit("ProductId: "), F.col("ProductId"),
        F.lit(". Label hint: "), F.coalesce(label, F.lit(NO_LABEL)),
        F.lit(". Average score: "), F.col("average_score").cast("string"),
        F.lit(". Review count: "), F.col("review_count").cast("string"),
        F.lit(". Summary evidence: "), F.array_join("summary_samples", " | "),
        F.lit(". Review evidence: "), F.array_join("text_samples", " "),
    )
    return joined.select(
        "ProductId", label.alias("label_hint"), "review_count", "average_score",
        "average_helpfulness_ratio", "first_review_at", "last_review_at",
        "summary_samples", "text_samples", search_text.alias("search_text"),
    )


BASIC_CHARS = 2000
BASIC_EXCERPTS = 5
BASIC_REVIEWS = 3


def product_documents_basic(cleaned: DataFrame) -> DataFrame:
    """Older document: all titles then three reviews, cut to 2000 characters.

    Only the first 2000 characters survive and each title takes at least the
    three characters of its separator, so no more than 668 titles can show:
    ranking to that bound per product is exact and keeps groups small.
    """
    titles_bound = -(-BASIC_CHARS // 3) + 1
    totals = cleaned.groupBy("ProductId").agg(
        numeric.round_even(F.avg("Score"), 2).alias("note_moyenne"),
        F.count("Score").alias("nb_avis"),
        numeric.round_even(F.avg("HelpfulnessNumerator"), 2).alias("helpfulness_moy"),
    )
    def first(value: Column, n: int, name: str) -> DataFrame:
        rows = merge_top_k(cleaned.select("ProductId", "Id", value.alias("value")), ["ProductId"], ["Id"], n)
        ordered = F.array_sort(F.collect_list(F.struct("rank", "value")))
        return rows.groupBy("ProductId").agg(F.transform(ordered, lambda x: x["value"]).alias(name))

    # two narrow passes: whole texts travel only for the few excerpts
    titles = first(F.substring("Summary", 1, BASIC_CHARS), titles_bound, "titles")
    excerpts = first(F.col("Text"), BASIC_EXCERPTS, "extraits_utiles")
    evidence = F.concat(
        F.array_join("titles", " | "), F.lit(" . "),
        F.array_join(F.slice("extraits_utiles", 1, BASIC_REVIEWS), " "),
    )
    return totals.join(titles, "ProductId").join(excerpts, "ProductId").select(
        F.col("ProductId").alias("product_id"), "note_moyenne", "nb_avis", "helpfulness_moy",
        text.truncate(evidence, BASIC_CHARS).alias("texte_recherche"), "extraits_utiles",
    )


def top_products(documents: DataFrame, n: int) -> DataFrame:
    return documents.orderBy(F.desc("review_count"), "ProductId").limit(n)
