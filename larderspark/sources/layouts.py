"""Stored layouts that spare joins a shuffle and lookups a read."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larderspark.session import scratch_path


def write_bucketed(df: DataFrame, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """``df`` as a table bucketed and sorted by ``key``; read back.

    Tables with the same buckets of the same key type join without a shuffle,
    as often as they are joined. A bucket is one task of such a join.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.option("path", path or scratch_path(spark, name)).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def write_lookup(df: DataFrame, path: str, keys: Sequence[str], distinct: int = 1_000_000, mode: str = "overwrite") -> None:
    """Parquet in ranges of ``keys``, with a Bloom filter of every key column in each row group.

    Ranges serve lookups of neighbours, Bloom filters those of ids that are
    not there. ``distinct``: keys of a row group, about.
    """
    writer = df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode)
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{key}", str(distinct))
    writer.parquet(path)


def lookup(spark: SparkSession, path: str, key: str, values: Sequence) -> DataFrame:
    """The rows of some keys; row groups that cannot have them are not read."""
    wanted: Column = F.col(key).isin(list(values)) if len(values) != 1 else F.col(key) == F.lit(values[0])
    return spark.read.parquet(path).filter(wanted)
