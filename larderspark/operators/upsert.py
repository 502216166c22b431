"""Idempotent upserts as joins on the primary key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderspark.operators.dedup import keep_first


def last_wins(source: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One source row per key; ``order`` puts the winner first."""
    return keep_first(source, keys, order)


def upsert(base: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace base rows of the same key; new keys are inserted.

    With nothing but key columns there is nothing to update and base rows stay.
    ``source`` has one row per key (see ``last_wins``). Spark broadcasts a
    small source by its known size, so the base is not shuffled for a small
    delta; a large one becomes a sort-merge join.
    """
    if set(source.columns) <= set(keys):
        return base.unionByName(source.join(base.select(*keys), list(keys), "left_anti"))
    kept = base.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source.select(*base.columns))


def upsert_partial(
    base: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    refresh: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Existing rows take only the ``update`` columns; new rows take everything.

    ``refresh`` gives columns that are set on every inserted or updated row,
    such as a time stamp. ``source`` has one row per key. For a small source
    the base is read once without a shuffle, and once more for its keys only.
    """
    refresh, keys = dict(refresh or {}), list(keys)
    new = source.withColumn("_in_source", F.lit(True)).alias("s")
    joined = base.alias("b").join(new, keys, "left")
    touched = F.col("s._in_source").isNotNull()

    def updated(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c in refresh:
            return F.when(touched, refresh[c]).otherwise(F.col(f"b.{c}")).alias(c)
        if c in update and c in source.columns:
            return F.when(touched, F.col(f"s.{c}")).otherwise(F.col(f"b.{c}")).alias(c)
        return F.col(f"b.{c}")

    def inserted(c: str) -> Column:
        if c in refresh:
            return refresh[c].alias(c)
        if c in source.columns:
            return F.col(c)
        return F.lit(None).cast(base.schema[c].dataType).alias(c)

    added = source.join(base.select(*keys), keys, "left_anti")
    return joined.select(*[updated(c) for c in base.columns]).unionByName(
        added.select(*[inserted(c) for c in base.columns]))
