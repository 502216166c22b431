"""Top-k, pages, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    k: int | Column,
    rank: str = "rank",
    bound: int | None = None,
) -> DataFrame:
    """The first ``k`` rows per key, with their rank.

    A constant ``k`` is pruned per input partition before the shuffle. ``k`` may
    differ per key (a column); then ``bound`` is the largest value it takes.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(window))
    if isinstance(k, int):
        return ranked.filter(F.col(rank) <= k)
    if bound is not None:
        ranked = ranked.filter(F.col(rank) <= bound)
    return ranked.filter(F.col(rank) <= k)


PARTITIONS_PER_SLICE = 1024


def merge_top_k(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int) -> DataFrame:
    """``top_k`` of rows that are already cut to ``k`` per key and partition.

    A scan of very many partitions still sends ``k`` rows per key from each of
    them. They are merged per slice of partitions first, so the last task of a
    key sees ``k`` rows per slice.
    """
    part = F.floor(F.spark_partition_id() / PARTITIONS_PER_SLICE)
    merged = top_k(df.withColumn("_slice", part), [*keys, "_slice"], order, k, "_rank")
    return top_k(merged.drop("_slice", "_rank"), keys, order, k)


def page(df: DataFrame, keys: Sequence[str], order: Sequence[Column], number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1) of the rows of each key in the given order."""
    last = number * size
    return top_k(df, keys, order, last).filter(F.col("rank") > last - size)


# Result orders a user can ask for; the id makes each of them total.
SORT_MODES: dict[str, tuple[str, ...]] = {
    "relevance": ("score", "nb_reviews", "avg_rating"),
    "rating": ("avg_rating", "nb_reviews", "score"),
    "reviews": ("nb_reviews", "avg_rating", "score"),
}


def sort_order(mode: str, id_column: str = "product_id") -> list[Column]:
    return [F.desc(c) for c in SORT_MODES[mode]] + [F.asc(id_column)]


def head(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows of a total order (each partition sends at most ``n``)."""
    return df.orderBy(*order).limit(n)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows by hash order of the key: repeatable and independent of layout."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(key))), F.col(key)).limit(n)
