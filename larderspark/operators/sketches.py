"""Stored sketches per group and day, merged for any range of days.

Exact quantiles and distinct counts need all rows again for every range.
Sketches are made once per day, are of bounded size, and merge: quantiles
(KLL) and sets (theta, which also intersect) of any range come from one small
row per group and day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of the quantile sketches: their rank error is below RANK_ERROR (with high probability).
KLL_SIZE, RANK_ERROR = 400, 0.02
#: Logarithm of the entries of the set sketches: exact up to them, relative error below SET_ERROR beyond.
THETA_LOG, SET_ERROR = 12, 0.06


def daily(df: DataFrame, keys: Sequence[str], day: Column, value: Column, ids: Mapping[str, Column]) -> DataFrame:
    """(keys, day, rows, quantiles, one set per entry of ``ids``): store this table.

    Sketches are built map-side and merged, so a hot group sends one sketch per
    task. Null values are in no sketch, but count as rows.
    """
    return df.groupBy(*keys, day.alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_bigint(value.cast("long"), KLL_SIZE).alias("quantiles"),
        *[F.theta_sketch_agg(c, THETA_LOG).alias(name) for name, c in ids.items()])


def merged(table: DataFrame, keys: Sequence[str], ids: Sequence[str], low: str | None = None, high: str | None = None) -> DataFrame:
    """The sketches of all days from ``low`` to ``high`` (inclusive; unset: open), merged per group."""
    chosen = table
    if low is not None:
        chosen = chosen.filter(F.col("day") >= F.lit(low).cast("date"))
    if high is not None:
        chosen = chosen.filter(F.col("day") <= F.lit(high).cast("date"))
    return chosen.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.kll_merge_agg_bigint("quantiles", KLL_SIZE).alias("quantiles"),
        *[F.theta_union_agg(name, THETA_LOG).alias(name) for name in ids])


def quantile(share: float, sketch: str = "quantiles") -> Column:
    return F.kll_sketch_get_quantile_bigint(F.col(sketch), F.lit(share))


def distinct(name: str) -> Column:
    return F.theta_sketch_estimate(F.col(name))


def common(left: str, right: str) -> Column:
    """About how many members two sets share."""
    return F.theta_sketch_estimate(F.theta_intersection(F.col(left), F.col(right)))
