"""Facet counts from bitmaps: any combination of facet values without reading the rows again.

Every row has a number, and every facet value a bitmap per bucket of numbers.
Values are combined by AND of their bitmaps, bucket by bucket.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmaps(rows: DataFrame, facets: Mapping[str, str]) -> DataFrame:
    """(facet, value, bucket, bits): store this table. ``facets``: facet name to column; null is a value of its own.

    Rows are numbered where they lie, so a bucket's rows are neighbours and
    its bitmaps dense. Bits are set map-side: a value that a third of all
    rows have is one bitmap of 4 KB per bucket.
    """
    number = F.monotonically_increasing_id()
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("facet"), F.col(c).cast("string").alias("value")) for name, c in facets.items()])).alias("f")
    return (
        rows.withColumn("_row", number).select("_row", pairs)
        .groupBy("f.facet", "f.value", F.bitmap_bucket_number("_row").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_row")).alias("bits"))
    )


def counts(table: DataFrame, facet: str) -> DataFrame:
    """(value, n) of one facet."""
    return table.filter(F.col("facet") == facet).groupBy("value").agg(F.sum(F.bitmap_count("bits")).alias("n"))


def pair_counts(table: DataFrame, left: str, right: str) -> DataFrame:
    """(left value, right value, n) of every pair that some row has.

    Bitmaps meet per bucket: the work is buckets times pairs of values, whatever the number of rows.
    """
    side = lambda facet, name: table.filter(F.col("facet") == facet).select(
        "bucket", F.col("value").alias(name), F.col("bits").alias(f"{name}_bits"))
    met = side(left, "left").join(side(right, "right"), "bucket")
    both = met.select("bucket", "left", "right", F.explode(F.array("left_bits", "right_bits")).alias("bits"))
    shared = both.groupBy("bucket", "left", "right").agg(F.bitmap_and_agg("bits").alias("bits"))
    return shared.groupBy("left", "right").agg(F.sum(F.bitmap_count("bits")).alias("n")).filter("n > 0").select(
        F.col("left").alias(left), F.col("right").alias(right), "n")


def filtered_counts(table: DataFrame, chosen: Mapping[str, list[str]], facet: str) -> DataFrame:
    """(value, n) of ``facet`` among the rows that have one of the chosen values of every facet of ``chosen``."""
    kept = None
    for name, values in chosen.items():
        any_of = table.filter((F.col("facet") == name) & F.col("value").isin(values)).groupBy("bucket").agg(
            F.bitmap_or_agg("bits").alias("bits"))
        if kept is not None:
            any_of = kept.join(any_of.withColumnRenamed("bits", "more"), "bucket").select(
                "bucket", F.explode(F.array("bits", "more")).alias("bits")).groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"))
        kept = any_of
    wanted = table.filter(F.col("facet") == facet).select("bucket", "value", F.col("bits").alias("own"))
    met = wanted.join(kept, "bucket").select("bucket", "value", F.explode(F.array("own", "bits")).alias("bits"))
    return met.groupBy("bucket", "value").agg(F.bitmap_and_agg("bits").alias("bits")).groupBy("value").agg(
        F.sum(F.bitmap_count("bits")).alias("n")).filter("n > 0")
