"""Readers. Every one returns a lazy DataFrame; nothing is inferred by a scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderspark import schemas
from larderspark.functions import text


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Review CSV, columns taken by header name; quoted fields may span lines.

    Other orders and further columns are fine. A field that is not of its
    type becomes null. Files whose headers differ from each other are an error,
    and so is a missing column. One task reads a file: bring many.
    """
    return _reviews(spark, path, schemas.REVIEWS)


def _reviews(spark: SparkSession, path: str, wanted: T.StructType) -> DataFrame:
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
    names = reader.csv(path).columns
    require_columns(names, wanted.names)
    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = reader.option("enforceSchema", False).schema(texts).csv(path)
    return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted])


def read_reviews_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """The older column subset; a field that does not parse becomes null."""
    return _reviews(spark, path, T.StructType([f for f in schemas.REVIEWS if f.name != "ProfileName"]))


def read_nutrition(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One nutrition CSV as text columns; a missing file is an error.

    Columns are taken by header name, so other columns and orders are fine.
    """
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(f"{directory.rstrip('/')}/{name}.csv")
        .select(*schemas.NUTRITION_FILES[name])
    )


def tsv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a tab-separated dump, from its first line only."""
    first = spark.read.text(path).limit(1).collect()
    return first[0].value.split("\t") if first else []


def read_catalog_dump(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated dump, all columns text; extra fields of ragged lines are dropped.

    The whole file is read. A row limit belongs after cleaning, not before it.
    """
    names = tsv_header(spark, path)
    require_columns(names, schemas.CATALOG_REQUIRED)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)  # a file with its columns in another order is an error
        .option("sep", "\t")
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def require_columns(names: Iterable[str], required: Iterable[str]) -> None:
    missing = sorted(set(required) - set(names))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")


def column_or(df: DataFrame, name: str, default: Column | None = None) -> Column:
    """A column if the input has it, else the default (null text)."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(None).cast("string") if default is None else default


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed product payloads, one JSON document per line, kept as text.

    ``barcode`` is the one that was asked for, if the file is named after it
    (``123.json``), else null.
    """
    asked = F.regexp_extract("_metadata.file_name", r"^([0-9]+)\.", 1)
    return spark.read.text(path).select(
        F.col("value").alias("payload"), F.when(asked != "", asked).alias("barcode"))


def barcode_list(values: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Distinct, sorted barcodes of comma-joined values and of a line file.

    Both inputs have one text column ``value``. Lines that start with ``#`` or
    are blank are skipped and, unlike values, are not split at commas.
    """
    codes = values.select(F.explode(F.split("value", ",")).alias("barcode"))
    if lines is not None:
        kept = lines.filter(~F.col("value").startswith("#"))
        codes = codes.unionByName(kept.select(F.col("value").alias("barcode")))
    return (
        codes.select(text.strip(F.col("barcode")).alias("barcode"))
        .filter(F.col("barcode") != "")
        .distinct()
        .sort("barcode")
    )


def read_barcode_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_benchmark(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark query set: a JSON array of query, top_k and term groups."""
    return spark.read.schema(schemas.BENCHMARK_QUERIES).option("multiLine", True).json(path)


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet if it is there, else an empty frame of the fixed schema."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def read_table(
    spark: SparkSession, name: str, columns: Iterable[str] = ("*",), limit: int = 0, order: Iterable[str] = ()
) -> DataFrame:
    """Columns of a catalogue table, with the optional ``LIMIT`` of the embed job, by the columns of ``order``."""
    df = spark.read.table(name).select(*columns)
    if limit <= 0:
        return df
    if not order:
        raise ValueError("a limit needs an order")
    return df.orderBy(*order).limit(limit)


def read_database(
    spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, parts: int,
    **properties: str,
) -> DataFrame:
    """A JDBC table read in parallel over ranges of a numeric key."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=lower,
                 upperBound=upper, numPartitions=parts, **properties)
        .load()
    )
