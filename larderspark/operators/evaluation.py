"""Ranking quality: relevance, precision, success, reciprocal rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderspark.functions import numeric
from larderspark.operators.blocks import small

FALLBACK = "lexical_fallback"


def group_match(words: Column, groups: Column) -> Column:
    """Every group has a term that the text contains; no groups never match."""
    hit = F.forall(groups, lambda g: F.exists(g, lambda t: words.contains(F.lower(t))))
    return F.coalesce((F.size(groups) > 0) & hit, F.lit(False))


def judge(results: DataFrame, benchmark: DataFrame, documents: DataFrame, rows: int) -> DataFrame:
    """Results with ``relevant``, by the term groups of their query.

    ``results``: query_id, rank, product_id, title; ``benchmark``: query_id,
    top_k, positive_groups; ``documents``: product_id, label_hint, text_lower.
    ``rows`` is the number of results, for the choice of join.
    """
    wanted = results.select("product_id").distinct()
    texts = documents.join(small(wanted, rows), "product_id", "left_semi").select(
        "product_id",
        F.lower(F.concat_ws(" ", F.coalesce("label_hint", F.lit("")), "text_lower")).alias("_text"))
    joined = results.join(texts, "product_id", "left").join(
        benchmark.select("query_id", "positive_groups"), "query_id", "left")
    words = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("_text", F.lit(""))))
    return joined.withColumn("relevant", group_match(words, F.col("positive_groups"))).drop(
        "_text", "positive_groups")


def judge_by_pairs(results: DataFrame, relevant: DataFrame) -> DataFrame:
    """Results with ``relevant``, by judged (query_id, product_id) pairs."""
    marked = relevant.select("query_id", "product_id", F.lit(True).alias("relevant"))
    return results.join(marked, ["query_id", "product_id"], "left").withColumn(
        "relevant", F.coalesce("relevant", F.lit(False)))


def metrics(judged: DataFrame, benchmark: DataFrame) -> DataFrame:
    """P@k, success@k and reciprocal rank per query; no results count as 0.

    Precision divides by k, not by the results returned. Without a ``top_k``
    k is the number of results.
    """
    wanted = benchmark.select("query_id", F.col("top_k").alias("_k") if "top_k" in benchmark.columns
                              else F.lit(None).cast("int").alias("_k"))
    joined = wanted.join(judged.select("query_id", "rank", "relevant"), "query_id", "left")
    counted = joined.filter(
        F.col("rank").isNull() | F.col("_k").isNull() | (F.col("rank") <= F.col("_k")))
    hit = F.col("relevant")
    totals = counted.groupBy("query_id").agg(
        F.max("_k").alias("_k"), F.count("rank").alias("_n"),
        F.count_if(hit).alias("_hits"), F.min(F.when(hit, F.col("rank"))).alias("_first"))
    # a top_k below the best rank still keeps its query
    full = wanted.select("query_id", F.col("_k").alias("_asked")).join(totals, "query_id", "left")
    k = F.coalesce("_asked", F.greatest("_n", F.lit(1)), F.lit(1)).cast("int")
    hits = F.coalesce("_hits", F.lit(0))
    return full.select(
        "query_id", k.alias("top_k"),
        numeric.round_even(hits / k, 4).alias("precision_at_k"),
        F.when(hits > 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("success_at_k"),
        F.coalesce(numeric.round_even(F.lit(1.0) / F.col("_first"), 4), F.lit(0.0)).alias("mrr"))


def summarize(per_query: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Means over queries, by system if asked; zeros when there are none."""
    def mean(c: str) -> Column:
        return F.coalesce(numeric.round_even(F.avg(c), 4), F.lit(0.0))

    time = F.avg("search_time_ms") if "search_time_ms" in per_query.columns else F.lit(None).cast("double")
    return per_query.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("queries_total"), mean("precision_at_k").alias("avg_precision_at_k"),
        mean("success_at_k").alias("success_rate_at_k"), mean("mrr").alias("mrr"),
        numeric.round_even(time, 2).alias("avg_search_time_ms"))


def strategy_counts(per_query: DataFrame) -> DataFrame:
    return per_query.groupBy(F.coalesce("strategy", F.lit("unknown")).alias("strategy")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("strategy") == FALLBACK).alias("fallback_runs"))


def compare(systems: dict[str, DataFrame]) -> DataFrame:
    """The summaries of several systems side by side (per-query metrics in)."""
    tagged = None
    for name, per_query in systems.items():
        part = per_query.withColumn("system", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part, allowMissingColumns=True)
    return summarize(tagged, ["system"])
