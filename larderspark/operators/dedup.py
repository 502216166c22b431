"""Keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key under a total order.

    ``row_number() = 1`` lets Spark keep one row per key in every input
    partition before the shuffle, so copies of a hot key do not travel.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def keep_first_by_digest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``keep_first`` for long keys: rows are sorted and dealt by a 256-bit digest, not by whole texts."""
    digest = F.sha2(F.to_json(F.struct(*keys)), 256)
    return keep_first(df.withColumn("_digest", digest), ["_digest"], order).drop("_digest")
