"""Hybrid ranking of keyword and vector candidates, and the search entry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larderspark.functions import numeric, text, vectors
from larderspark.operators import enrich, lexical
from larderspark.operators.blocks import small
from larderspark.operators.ranking import top_k
from larderspark.operators.vector import DIGITS, vector_ranking
from larderspark.session import cut_lineage

Ranker = Callable[[DataFrame, DataFrame, int], DataFrame]
MAX_TOP_K = 10
WARNING = "Semantic search temporarily unavailable; lexical fallback used."
KEYWORD, HYBRID, FALLBACK = "keyword_only", "semantic_hybrid", "lexical_fallback"


@dataclass(frozen=True)
class Weights:
    """How the parts of a hybrid score are weighed."""

    semantic: float = 0.65
    lexical: float = 0.35
    phrase: float = 0.08
    rating: float = 0.02
    reviews: float = 0.03
    pool: int = 20


def _details(products: DataFrame, hits: DataFrame, rows: int) -> DataFrame:
    """The product columns of the hits; products stay in place while hits are few."""
    wanted = hits.select("product_id").distinct()
    return products.join(small(wanted, rows), "product_id", "left_semi")


def _best_score(c: str) -> Column:
    return F.max(c).over(Window.partitionBy("query_id"))


def keyword_rows(ranked: DataFrame, products: DataFrame, rows: int) -> DataFrame:
    """Keyword hits with the columns that ``result_columns`` needs."""
    meta = _details(products, ranked, rows).select(
        "product_id", "label_hint", "summary_samples", "text_samples")
    scored = ranked.withColumn("score", F.col("lexical_score")).withColumn(
        "fallback_relevance", numeric.score_relevance(F.col("score"), _best_score("score")))
    return scored.join(meta, "product_id", "left").select(
        "query_id", "rank", "product_id", "score", "label_hint", "review_count", "average_score",
        "summary_samples", "text_samples", F.lit(None).cast("double").alias("semantic_similarity"),
        "fallback_relevance")


def keyword_search(products: DataFrame, queries: DataFrame, k: int, rows: int | None = None,
                   word_ranker: Ranker = lexical.lexical_ranking) -> DataFrame:
    """Keyword result records of every query."""
    rows = queries.count() * k if rows is None else rows
    ranked = cut_lineage(word_ranker(products, queries, k))
    return enrich.result_columns(keyword_rows(ranked, products, rows))


def hybrid_rows(
    products: DataFrame, points: DataFrame, queries: DataFrame, lexical_hits: DataFrame,
    semantic_hits: DataFrame, n_queries: int, weights: Weights = Weights(),
) -> DataFrame:
    """Scored candidates: the union of both pools with missing cosines filled in.

    ``queries`` has query_id, query, vector and top_k. Everything after the
    two rankings works on at most ``2 * pool`` rows per query.
    """
    rows = n_queries * 2 * weights.pool
    lexical_side = lexical_hits.select("query_id", "product_id", "lexical_score")
    semantic_side = semantic_hits.select("query_id", "product_id", "cosine")
    candidates = cut_lineage(
        semantic_side.join(lexical_side, ["query_id", "product_id"], "full_outer"))
    asked = queries.select("query_id", F.lower(text.strip(F.col("query"))).alias("phrase"),
                           F.col("vector").cast("array<double>").alias("vector"), "top_k")

    meta = _details(products, candidates, rows)
    # ids find the vectors where they are; the query vectors meet only those few
    missing = candidates.filter(F.col("cosine").isNull()).select("query_id", "product_id")
    found = points.select("product_id", "embedding").join(small(missing, rows), "product_id")
    backfill = found.join(asked.select("query_id", "vector"), "query_id").select(
        "query_id", "product_id",
        numeric.round_even(vectors.cosine(F.col("embedding"), F.col("vector")), DIGITS)
        .alias("filled"))
    joined = (
        candidates.join(backfill, ["query_id", "product_id"], "left")
        .join(meta, "product_id", "left")
        .join(asked.drop("vector"), "query_id")
        .withColumn("similarity", F.coalesce("cosine", "filled"))
    )
    zero = F.lit(0.0)

    def share(c: str) -> Column:
        best = _best_score(c)
        return F.when(F.coalesce(best, zero) != 0, F.coalesce(F.col(c), zero) / best).otherwise(zero)

    title_lower = F.coalesce(F.nullif("label_lower", F.lit("")), F.lower("product_id"))
    in_words = title_lower.contains(F.col("phrase")) | F.coalesce(
        F.col("text_lower"), F.lit("")).contains(F.col("phrase"))
    rating = F.coalesce(F.col("average_score"), zero)
    reviews = F.coalesce(F.col("review_count"), F.lit(0))
    score = (
        F.lit(weights.semantic) * share("similarity")
        + F.lit(weights.lexical) * share("lexical_score")
        + F.when((F.col("phrase") != "") & in_words, F.lit(weights.phrase)).otherwise(zero)
        + F.least(rating / 5.0, F.lit(1.0)) * weights.rating
        + F.least(F.log1p(reviews) / 5.0, F.lit(1.0)) * weights.reviews
    )
    scored = joined.withColumn("score", numeric.round_even(score, 6)).withColumns(
        {"review_count": reviews, "average_score": rating})
    order = [F.desc("score"), F.desc("review_count"), F.desc("average_score"), F.asc("product_id")]
    best = top_k(scored, ["query_id"], order, F.col("top_k"), bound=MAX_TOP_K)
    return best.withColumn(
        "fallback_relevance", numeric.score_relevance(F.col("score"), _best_score("score"))
    ).select(
        "query_id", "rank", "product_id", "score", "label_hint", "review_count", "average_score",
        "summary_samples", "text_samples", F.col("similarity").alias("semantic_similarity"),
        "fallback_relevance")


def with_strategy(queries: DataFrame, default_k: int = MAX_TOP_K) -> DataFrame:
    """Queries with their strategy, warning and checked parameters.

    Keyword mode is taken as asked. A semantic query without a usable vector
    falls back to keywords, with a warning.
    """
    def optional(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in queries.columns else F.lit(None).cast(kind)

    k, floor, mode = optional("top_k", "int"), optional("min_score", "double"), optional("mode", "string")
    checked_k = F.when(k.isNull() | k.between(1, MAX_TOP_K), F.coalesce(k, F.lit(default_k))).otherwise(
        F.raise_error(F.lit(f"top_k must be in 1..{MAX_TOP_K}")).cast("int"))
    checked_floor = F.when(floor.isNull() | floor.between(-1, 1), floor).otherwise(
        F.raise_error(F.lit("min_score must be in -1..1")).cast("double"))
    checked_mode = F.when(mode.isNull() | mode.isin("semantic", "keyword"), F.coalesce(mode, F.lit("semantic"))
                          ).otherwise(F.raise_error(F.lit("mode must be semantic or keyword")))
    vector = optional("vector", "array<double>")
    has_vector = F.coalesce(F.size(vector) > 0, F.lit(False)) & (text.strip(F.col("query")) != "")
    strategy = F.when(checked_mode == "keyword", F.lit(KEYWORD)).when(
        has_vector, F.lit(HYBRID)).otherwise(F.lit(FALLBACK))
    return queries.select(
        "query_id", "query", vector.alias("vector"), checked_k.alias("top_k"),
        checked_floor.alias("min_score"), strategy.alias("strategy"),
    ).withColumn("warning", F.when(F.col("strategy") == FALLBACK, F.lit(WARNING)))


def ranked_rows(products: DataFrame, queries: DataFrame, points: DataFrame | None = None,
                weights: Weights = Weights(), ranker: Ranker = vector_ranking,
                word_ranker: Ranker = lexical.lexical_ranking) -> tuple[DataFrame, DataFrame]:
    """(strategies, ranked rows) of a query table under one row contract.

    ``ranker`` finds the vector candidates: exact, or ``lsh.ann_ranking`` when
    ``points`` carry signatures. ``word_ranker`` finds the keyword candidates.
    """
    plan = cut_lineage(with_strategy(queries))
    n, most = plan.agg(F.count(F.lit(1)), F.max("top_k")).first()
    weights = replace(weights, pool=max(weights.pool, most or 0))  # a pool below top_k would lose results
    lexical_hits = cut_lineage(word_ranker(products, plan, weights.pool))
    keyword_only = plan.filter(F.col("strategy") != HYBRID).select("query_id", "top_k")
    by_words = lexical_hits.join(small(keyword_only, n), "query_id").filter(
        F.col("rank") <= F.col("top_k")).drop("top_k")
    rows = keyword_rows(by_words, products, n * weights.pool)
    if points is not None:
        semantic = plan.filter(F.col("strategy") == HYBRID)
        semantic_hits = ranker(points, semantic, weights.pool)
        words = lexical_hits.join(semantic.select("query_id"), "query_id", "left_semi")
        rows = rows.unionByName(
            hybrid_rows(products, points, semantic, words, semantic_hits, n, weights))
    return plan.drop("vector"), rows


def search(products: DataFrame, queries: DataFrame, points: DataFrame | None = None,
           weights: Weights = Weights(), all_indexed: bool = False,
           ranker: Ranker = vector_ranking, word_ranker: Ranker = lexical.lexical_ranking) -> DataFrame:
    """Result records of every query, with the strategy that was used.

    ``products`` from ``search_ready``; ``queries``: query_id, query and
    optionally vector, mode, top_k, min_score; ``points``: product_id,
    embedding, review_count, average_score. Only products with a vector are
    searched. Set ``all_indexed`` when both come from one table of documents
    with their vectors: it saves the join of two large tables.
    """
    if points is None:
        queries = queries.drop("vector")
    elif not all_indexed:
        products = lexical.indexed_products(products, points)
    plan, rows = ranked_rows(products, queries, points, weights, ranker, word_ranker)
    return enrich.result_columns(rows).join(
        plan.select("query_id", "strategy", "warning"), "query_id")


def search_summary(plan: DataFrame, results: DataFrame, total_indexed: int) -> DataFrame:
    """One row per query, also for those without results."""
    counts = results.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_results"))
    return plan.select("query_id", "strategy", "warning").join(counts, "query_id", "left").select(
        "query_id", "strategy", "warning", F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.lit(total_indexed).cast("bigint").alias("total_indexed"))
