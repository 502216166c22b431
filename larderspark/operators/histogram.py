"""Counts by value, and quantiles read from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, value: Column, name: str, count: str = "n") -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias(count))


def bins(df: DataFrame, value: str, low: float, high: float, n: int) -> DataFrame:
    """Rows per equal-width bin; 0 and ``n + 1`` hold what lies outside."""
    bucket = F.width_bucket(F.col(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(n))
    return value_counts(df, bucket, "bin")


def nearest_quantiles(
    df: DataFrame, value: str, quantiles: Mapping[str, float], median: str | None = None
) -> DataFrame:
    """Nearest-rank quantiles: the value at index ``floor(q * (n - 1) + 0.5)``.

    Rows are first counted by value, so only the histogram (one row per
    distinct integer value) is ordered, never the data. ``median`` names an
    extra column with the mean of the two middle values.
    """
    counts = value_counts(df.filter(F.col(value).isNotNull()), F.col(value), "v")
    # one row per distinct value: small by construction
    upto = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = counts.withColumn("c", F.sum("n").over(upto)).withColumn("t", F.sum("n").over(whole))

    def at(index: Column) -> Column:
        return F.min(F.when(F.col("c") > index, F.col("v")))

    last = F.col("t") - 1
    picks = [at(F.floor(F.lit(q) * last + 0.5)).alias(name) for name, q in quantiles.items()]
    if median is not None:
        middle = (at(F.floor(last / 2)) + at(F.ceil(last / 2))) / 2
        picks.append(middle.alias(median))
    return ranked.agg(*picks)


def group_sizes(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
