"""Data quality and exploration reports, in long form where they are nested."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderspark.functions import text
from larderspark.operators.histogram import group_sizes, nearest_quantiles, value_counts

SHORT_CHARS = 80
LONG_CHARS = 1500


def score_distribution(cleaned: DataFrame) -> DataFrame:
    return value_counts(cleaned, F.col("Score"), "Score").orderBy("Score")


def year_distribution(cleaned: DataFrame) -> DataFrame:
    return value_counts(cleaned, F.year("review_timestamp"), "year").orderBy("year")


def text_length_quantiles(cleaned: DataFrame) -> DataFrame:
    return nearest_quantiles(cleaned, "text_length", {"p50": 0.5, "p90": 0.9, "p99": 0.99})


def reviews_per_product(cleaned: DataFrame) -> DataFrame:
    """Median (interpolated, cut to int), p90 and p95 (nearest), max of group sizes."""
    sizes = group_sizes(cleaned, ["ProductId"])
    row = nearest_quantiles(sizes, "n", {"p90": 0.9, "p95": 0.95, "max": 1.0}, median="median")
    return stack_rows(row, ["median", "p90", "p95", "max"])


def stack_rows(row: DataFrame, names: Sequence[str], name: str = "metric", value: str = "value") -> DataFrame:
    """A one-row frame as (metric, value) rows."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias(name), F.col(n).cast("bigint").alias(value)) for n in names]
    )
    return row.select(F.inline(pairs))


def review_checks() -> dict[str, Column]:
    """Counts of one pass over cleaned reviews. The first four should be 0."""
    blank_summary, blank_text = F.col("Summary") == "", F.col("Text") == ""
    return {
        "missing_product_id": F.count_if(F.col("ProductId") == ""),
        "missing_summary_and_text": F.count_if(blank_summary & blank_text),
        "score_out_of_range": F.count_if(~F.col("Score").between(1, 5)),
        "helpfulness_invalid": F.count_if(
            F.col("HelpfulnessNumerator") > F.col("HelpfulnessDenominator")
        ),
        "zero_helpfulness_denominator": F.count_if(F.col("HelpfulnessDenominator") == 0),
        "short_reviews_under_80_chars": F.count_if(F.col("text_length") < SHORT_CHARS),
        "long_reviews_over_1500_chars": F.count_if(F.col("text_length") > LONG_CHARS),
    }


def overview_metrics(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Raw, cleaned and removed rows, distinct products and users, in long form."""
    none = F.lit(None).cast("bigint")
    counts = cleaned.agg(
        none.alias("raw_rows"),
        F.count(F.lit(1)).alias("cleaned_rows"),
        F.count_distinct("ProductId").alias("unique_products"),
        F.count_distinct("UserId").alias("unique_users"),
    )
    raw_rows = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    names = ["raw_rows", "cleaned_rows", "unique_products", "unique_users"]
    row = counts.unionByName(raw_rows, allowMissingColumns=True).agg(
        *[F.max(n).alias(n) for n in names]
    ).withColumn("rows_removed", F.col("raw_rows") - F.col("cleaned_rows"))
    return stack_rows(row, [*names, "rows_removed"])


def quality_report(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """The whole report as (section, metric, value) rows.

    Pass a materialised ``cleaned`` frame: each section is one narrow scan.
    """
    checks = review_checks()

    def section(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(
            F.lit(name).alias("section"), F.col("metric").cast("string").alias("metric"),
            F.col("value").cast("bigint").alias("value"),
        )

    def counted(rows: DataFrame, key: str) -> DataFrame:
        return rows.select(F.col(key).cast("string").alias("metric"), F.col("n").alias("value"))

    quantiles = text_length_quantiles(cleaned)
    parts = [
        section("overview", overview_metrics(raw, cleaned)),
        section("checks", stack_rows(cleaned.agg(*[c.alias(n) for n, c in checks.items()]), list(checks))),
        section("score_distribution",
                counted(value_counts(cleaned, F.col("Score").cast("int"), "Score"), "Score")),
        section("reviews_per_product", reviews_per_product(cleaned)),
        section("text_length_quantiles", stack_rows(quantiles, ["p50", "p90", "p99"])),
        section("year_distribution",
                counted(value_counts(cleaned, F.year("review_timestamp"), "year"), "year")),
    ]
    return reduce(DataFrame.unionByName, parts)


def completeness(df: DataFrame, columns: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Percent of rows with a value per column, one decimal, half up.

    A column in ``required`` counts blanks as values (only null is missing).
    """

    def share(c: str) -> Column:
        present = F.col(c) if c in required else text.blank_to_null(F.col(c))
        percent = F.lit(100).cast("decimal(20,0)") * F.count(present) / F.count(F.lit(1))
        return F.round(percent, 1).cast("double").alias(f"{c}_pct")

    return df.agg(F.count(F.lit(1)).alias("total"), *[share(c) for c in columns])


def grade_distribution(df: DataFrame, column: str = "nutriscore", missing: str = "inconnu") -> DataFrame:
    grade = F.coalesce(text.blank_to_null(F.col(column)), F.lit(missing))
    return value_counts(df, grade, "grade").orderBy("grade")


def text_stats(df: DataFrame, column: str, over: int = 512) -> DataFrame:
    """Count, min, mean, median, max of text length; rows above the cut-off."""
    lengths = df.select(F.char_length(column).cast("bigint").alias("n_chars"))
    return lengths.agg(
        F.count(F.lit(1)).alias("total"),
        F.min("n_chars").alias("min_chars"),
        F.round(F.avg("n_chars"), 0).alias("avg_chars"),
        # a value->count map bounded by the range of text lengths
        F.percentile("n_chars", 0.5).alias("median_chars"),
        F.max("n_chars").alias("max_chars"),
        F.count_if(F.col("n_chars") > over).alias("above_512"),
    )


def top_values(df: DataFrame, value: Column, name: str, n: int = 15) -> DataFrame:
    """Most frequent non-blank values, name as the tie-break."""
    present = df.select(value.alias(name)).filter(F.col(name) != "")
    return value_counts(present, F.col(name), name).orderBy(F.desc("n"), name).limit(n)


def top_brands(df: DataFrame, n: int = 15) -> DataFrame:
    return top_values(df, F.col("brand"), "brand", n)


def top_first_category(df: DataFrame, n: int = 15) -> DataFrame:
    """First listed category; rows without categories do not count."""
    listed = df.filter(F.col("categories") != "")
    first = F.split_part("categories", F.lit(","), F.lit(1))
    return value_counts(listed, first, "category").orderBy(F.desc("n"), "category").limit(n)


def rows_by_source(master: DataFrame) -> DataFrame:
    return value_counts(master, F.col("source_dataset"), "source_dataset").orderBy(
        F.desc("n"), "source_dataset"
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Exact rows per table (answered from file footers for Parquet)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def schema_listing(df: DataFrame) -> DataFrame:
    """Column name, type, nullability and position of a table."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable, i + 1) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, data_type string, is_nullable boolean, ordinal_position int"
    )


def catalog_report(tables: Mapping[str, DataFrame], catalog: DataFrame, columns: Sequence[str],
                   required: Sequence[str] = ()) -> DataFrame:
    """Row counts and completeness together, as (section, metric, value) rows."""
    counts = table_counts(tables).select(
        F.lit("row_counts").alias("section"), F.col("table_name").alias("metric"),
        F.col("row_count").cast("double").alias("value"),
    )
    names = [f"{c}_pct" for c in columns]
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
    shares = completeness(catalog, columns, required).select(
        F.lit("completeness").alias("section"), F.inline(pairs)
    )
    return counts.unionByName(shares)
