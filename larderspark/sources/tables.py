"""Keyed Parquet tables in hash buckets: a change rewrites only the buckets of its keys.

A bucket is a partition of the table by the hash of the key. The changed
buckets are overwritten by Spark's dynamic partition overwrite, all other
files stay as they are. Every bucket is either old or new, and applying a
change again gives the same table, so a job that died is run again. One
writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderspark.operators.upsert import upsert
from larderspark.session import cut_lineage

BUCKET = "key_bucket"
#: Buckets of a new table. One is what a task rewrites: take more for a table above some tens of gigabytes.
BUCKETS = 64


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _properties(spark: SparkSession, path: str) -> dict | None:
    try:
        row = spark.read.schema("value string").text(f"{path}/_table").first()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None
    return json.loads(row.value)


def _write_properties(spark: SparkSession, path: str, keys: Sequence[str], buckets: int, schema: T.StructType) -> None:
    value = json.dumps({"keys": list(keys), "buckets": buckets, "schema": schema.json()})
    spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_table")


def _write(df: DataFrame, path: str, mode: str) -> None:
    """``dynamic``: written beside the table, moved in when all of it is there, so ``df`` may read the buckets it replaces."""
    writer = df.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(BUCKET).parquet(path)


def _folder(spark: SparkSession, path: str) -> tuple:
    """(file system, its path) of a folder."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context._jsc.hadoopConfiguration()), at


def create(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Write ``df`` (one row per key) as a whole new table; one that is there is replaced."""
    there = _folder(df.sparkSession, path)
    source = cut_lineage(df, "table") if there[0].exists(there[1]) else df  # it may come from the table that it replaces
    _write(source.withColumn(BUCKET, bucket_of(keys, buckets)), path, "static")
    _write_properties(source.sparkSession, path, keys, buckets, source.schema)


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, None if there is none."""
    known = _properties(spark, path)
    return None if known is None else _stored(spark, path, known).drop(BUCKET)


def _stored(spark: SparkSession, path: str, known: dict) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(known["schema"]))
    # files without a column that came later read as null
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)


def changed_buckets(source: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """At most as many numbers as the table has buckets."""
    return sorted(r.b for r in source.select(bucket_of(keys, buckets).alias("b")).distinct().collect())


Merge = Callable[[DataFrame, DataFrame], DataFrame]


def apply(source: DataFrame, path: str, keys: Sequence[str], merge: Merge | None = None, buckets: int = BUCKETS) -> None:
    """Merge ``source`` (one row per key) into the table; a table that is not there yet is created from it.

    ``merge(stored, source)`` gives the new rows of the changed buckets; unset,
    source rows replace or join the stored ones (``upsert``). Columns that the
    table did not have yet are added, those that the source lacks are null in new rows.
    """
    spark = source.sparkSession
    known = _properties(spark, path)
    if known is None:
        create(source, path, keys, buckets)
        return
    schema = T.StructType.fromJson(json.loads(known["schema"]))
    fresh = [f for f in source.schema.fields if f.name not in schema.names]
    if fresh:
        schema = T.StructType([*schema.fields, *fresh])
        _write_properties(spark, path, keys, known["buckets"], schema)
        known = {**known, "schema": schema.json()}
    held = cut_lineage(source.select(*[  # stored: computed once, and its size is known to the joins
        (F.col(f.name) if f.name in source.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
        if f.name in source.columns or merge is None]), "changes")
    number = bucket_of(keys, known["buckets"])
    touched = changed_buckets(held, keys, known["buckets"])
    stored = _stored(spark, path, known).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = (merge or (lambda old, new: upsert(old, new, list(keys))))(stored, held)
    _write(merged.select(*schema.names).withColumn(BUCKET, number), path, "dynamic")


def delete(spark: SparkSession, path: str, gone: DataFrame) -> None:
    """Remove the rows whose keys are in ``gone`` (the key columns)."""
    known = _properties(spark, path)
    if known is None:
        return
    keys, buckets = known["keys"], known["buckets"]
    schema = T.StructType.fromJson(json.loads(known["schema"]))
    held = cut_lineage(gone.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in keys]).distinct(), "gone")
    touched = changed_buckets(held, keys, buckets)
    left = _stored(spark, path, known).filter(F.col(BUCKET).isin(touched)).join(held, keys, "left_anti")
    full = {r[BUCKET] for r in left.select(BUCKET).distinct().collect()}  # of the keys alone
    _write(left, path, "dynamic")
    # a bucket without a row is not written, so its folder goes
    for number in set(touched) - full:
        system, at = _folder(spark, f"{path}/{BUCKET}={number}")
        system.delete(at, True)
