"""Display facts of a search result, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderspark.functions import numeric, text
from larderspark.functions.binding import let

# Defaults and the ordered keyword rules of the categories. Words
# match anywhere, also inside longer words; the first rule that matches wins.
DEFAULT_DESCRIPTION = "Produit reconstruit a partir d'avis clients agreges."
DEFAULT_CATEGORY = "Produits"
CATEGORY_RULES = (
    ("Farines", ("flour", "farine", "meal", "baking mix", "mix")),
    ("Chocolats", ("chocolate", "chocolat", "cocoa", "cacao")),
    ("Cafe", ("coffee", "cafe", "espresso", "latte")),
    ("The et infusions", ("tea", "the", "chai", "herbal", "infusion")),
    ("Biscuits et snacks", ("cookie", "cracker", "snack", "bar", "pretzel", "chip", "biscuit")),
    ("Croquettes", ("dog", "cat", "pet food", "treat", "puppy", "kitten")),
    ("Boissons", ("drink", "juice", "beverage", "smoothie", "soda")),
    ("Gateaux et desserts", ("cake", "brownie", "dessert", "pudding", "muffin")),
    ("Epices et sauces", ("spice", "seasoning", "sauce", "marinade", "dressing")),
    ("Cereales et grains", ("cereal", "oat", "granola", "grain", "rice")),
)
SNIPPET_CHARS = 140
SNIPPETS = 2


def title(label: Column, product_id: Column) -> Column:
    return F.coalesce(text.blank_to_null(label), product_id)


def category(title_: Column, summaries: Column, texts: Column, label: Column) -> Column:
    words = F.concat(
        F.array(title_), text.text_list(summaries), text.text_list(texts),
        F.array(F.coalesce(label, F.lit(""))))
    haystack = F.lower(F.array_join(F.filter(words, lambda w: w != ""), " "))

    def rules(h: Column) -> Column:
        chosen = F.lit(DEFAULT_CATEGORY)
        for name, keywords in reversed(CATEGORY_RULES):
            chosen = F.when(text.contains_any(h, keywords), F.lit(name)).otherwise(chosen)
        return chosen

    return let(haystack, rules)


def description(title_: Column, summaries: Column, texts: Column, label: Column) -> Column:
    """First shortened sample that says more than the title, else the label."""
    candidates = F.transform(
        F.concat(text.text_list(texts), text.text_list(summaries)), lambda c: text.clip_text(c))
    first = let(text.strip(F.lower(title_)), lambda known: F.get(
        F.filter(candidates, lambda c: (c != "") & (F.lower(c) != known)), F.lit(0)))
    labelled = F.concat(text.blank_to_null(text.strip(label)), F.lit("."))
    return F.coalesce(first, labelled, F.lit(DEFAULT_DESCRIPTION))


def snippets(title_: Column, description_: Column, summaries: Column, texts: Column,
             limit: int = SNIPPETS) -> Column:
    """Distinct shortened samples that repeat neither title nor description."""
    candidates = text.distinct_texts(F.concat(text.text_list(summaries), text.text_list(texts)))

    def plain(c: Column) -> Column:
        return F.btrim(F.lower(c), F.lit(" ."))

    known = F.array(F.lit(""), text.strip(F.lower(title_)), plain(description_))
    return let(known, lambda ks: F.slice(
        F.filter(
            F.transform(candidates, lambda c: text.clip_text(c, SNIPPET_CHARS)),
            lambda c: ~F.array_contains(ks, plain(c))), 1, limit))


def result_columns(results: DataFrame) -> DataFrame:
    """Ranked rows to result records.

    Needs query_id, rank, product_id, score, label_hint, review_count,
    average_score, summary_samples, text_samples, semantic_similarity and
    fallback_relevance. Apply it to the top rows only.
    """
    samples = (F.col("summary_samples"), F.col("text_samples"))
    titled = results.withColumn("title", title(F.col("label_hint"), F.col("product_id")))
    described = titled.withColumn(
        "description", description(F.col("title"), *samples, F.col("label_hint")))
    similarity = F.col("semantic_similarity")
    return described.select(
        "query_id", "rank", "product_id", "title", "score",
        F.coalesce("average_score", F.lit(0.0)).alias("avg_rating"),
        F.coalesce("review_count", F.lit(0)).alias("nb_reviews"),
        "description",
        snippets(F.col("title"), F.col("description"), *samples).alias("snippets"),
        category(F.col("title"), *samples, F.col("label_hint")).alias("category"),
        numeric.bounded_cosine(similarity).alias("semantic_similarity"),
        numeric.angle_degrees(similarity).alias("vector_angle_degrees"),
        F.coalesce(numeric.angle_relevance(similarity), F.col("fallback_relevance"))
        .alias("relevance_percent"),
    )


def facet_filter(results: DataFrame, categories: list[str]) -> DataFrame:
    return results.filter(F.col("category").isin(*categories)) if categories else results


def facet_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
