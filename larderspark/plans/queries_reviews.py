"""Registered queries on reviews and product documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderspark.functions import numeric, text
from larderspark.operators import product_docs, ranking, reports, reviews, sketches
from larderspark.operators.dedup import keep_first
from larderspark.operators.histogram import bins
from larderspark.plans import fixtures, pipelines
from larderspark.session import cut_lineage, scratch_path
from larderspark.sources import readers, writers

JOIN = " || "


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.view(spark, sf, "fx_reviews")


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.clean_reviews(raw(spark, sf))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents read the cleaned table twice, so it is stored first."""
    used = ("Id", "ProductId", "HelpfulnessNumerator", "HelpfulnessDenominator", "Score",
            "Summary", "Text", "review_timestamp", "text_length")
    return product_docs.product_documents(cut_lineage(cleaned(spark, sf).select(*used), "cleaned"))


def flat(df: DataFrame) -> DataFrame:
    """Text arrays joined to one text, so any engine can compare them."""
    arrays = [f.name for f in df.schema if f.dataType.simpleString() == "array<string>"]
    return df.withColumns({c: F.array_join(c, JOIN) for c in arrays})


def scan_reviews(spark, sf):
    path = scratch_path(spark, "reviews-csv")
    writers.write_csv(raw(spark, sf), path)
    return readers.read_reviews(spark, path).withColumns(
        {c: F.coalesce(c, F.lit("")) for c in ("Summary", "Text")}
    )


def scan_reviews_by_name(spark, sf):
    """Columns in another order, with a further one, by header name; the older subset of columns."""
    rows = raw(spark, sf)
    path = scratch_path(spark, "reviews-csv")
    writers.write_csv(rows.select(*rows.columns[::-1], F.lit("x").alias("More")), path)
    return readers.read_reviews_tolerant(spark, path).withColumns(
        {c: F.coalesce(c, F.lit("")) for c in ("Summary", "Text")}
    )


def artefact_names(spark, sf):
    pages = fixtures.table(spark, sf, "pages")
    return pages.select("page_id", text.slug(F.col("url")).alias("slug"), text.suffix(F.col("url")).alias("suffix"))


def normalize_text(spark, sf):
    pages = fixtures.table(spark, sf, "pages")
    return pages.select("page_id", text.normalize_text(F.col("html")).alias("html"))


def clean_text(spark, sf):
    """Every turn, beside the one after it (null after the last turn)."""
    rows = fixtures.table(spark, sf, "conversations")
    later = rows.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("later"))
    return rows.join(later, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", text.clean_text(F.col("text")).alias("text"), text.clean_text(F.col("later")).alias("later"))


def safe_cast(spark, sf):
    value = F.get_json_object("props", "$.k")
    dirty = (
        F.when(F.col("event_id") % 5 == 0, F.concat(value, F.lit(".0")))
        .when(F.col("event_id") % 7 == 0, F.concat(value, F.lit("x")))
        .otherwise(value)
    )
    rows = fixtures.table(spark, sf, "events").select("event_id", dirty.alias("raw"))
    return rows.select(
        "event_id", numeric.to_long(F.col("raw")).alias("as_long"),
        numeric.to_double(F.col("raw")).alias("as_double"),
    )


def review_enrich(spark, sf):
    return reviews.enrich_reviews(raw(spark, sf)).select(
        "Id", "review_timestamp", numeric.round_even(F.col("helpfulness_ratio").cast("double"), 4)
        .alias("helpfulness_ratio"), "summary_length", "text_length", "review_text",
    )


def clean_reviews(spark, sf):
    return cleaned(spark, sf).select(
        "Id", "ProductId", "UserId", "ProfileName", "HelpfulnessNumerator",
        "HelpfulnessDenominator", "Score", "Time", "Summary", "Text", "review_timestamp",
        "text_length",
    )


def clean_reviews_basic(spark, sf):
    return reviews.clean_reviews_basic(raw(spark, sf))


def keep_first_by_key(spark, sf):
    return keep_first(fixtures.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
        ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"])


def product_documents(spark, sf):
    return flat(documents(spark, sf))


def product_documents_basic(spark, sf):
    kept = cut_lineage(reviews.clean_reviews_basic(raw(spark, sf)), "cleaned")
    return flat(product_docs.product_documents_basic(kept))


SKETCHED = {"products": "ProductId", "users": "UserId"}


def sketch_table(spark, sf):
    """Per source and day: rows, sketch of text lengths, sets of products and users. Stored."""
    rows = cleaned(spark, sf)
    return cut_lineage(sketches.daily(
        rows, ["ProfileName"], F.to_date("review_timestamp"), F.col("text_length"), {n: F.col(c) for n, c in SKETCHED.items()}))


def sketch_ranges(spark, sf):
    """Per source and range of days: rows, and whether the merged sketches keep their bounds against exact figures.

    ``shared_kept``: products that the range has in common with all days.
    """
    table, rows = sketch_table(spark, sf), cut_lineage(cleaned(spark, sf).select(
        "ProfileName", F.to_date("review_timestamp").alias("day"), "text_length", *SKETCHED.values()))
    whole = sketches.merged(table, ["ProfileName"], list(SKETCHED)).select("ProfileName", F.col("products").alias("all_products"))
    out = None
    for name, low, high in (("all", None, None), ("early", None, "2011-04-30"), ("late", "2011-05-01", None)):
        part = sketches.merged(table, ["ProfileName"], list(SKETCHED), low, high).join(whole, "ProfileName")
        asked = part.select("ProfileName", "rows", *[sketches.quantile(q).alias(f"q{i}") for i, q in enumerate((0.1, 0.5, 0.9))],
                            *[sketches.distinct(n).alias(n) for n in SKETCHED], sketches.common("products", "all_products").alias("shared"))
        chosen = rows.filter(F.col("day") >= F.lit(low).cast("date")) if low else rows
        chosen = chosen.filter(F.col("day") <= F.lit(high).cast("date")) if high else chosen
        ranked = chosen.join(asked, "ProfileName").groupBy("ProfileName").agg(
            *[F.any_value(c).alias(c) for c in asked.columns[1:]],
            *[F.avg((F.col("text_length") <= F.col(f"q{i}")).cast("double")).alias(f"upto{i}") for i in range(3)],
            *[F.avg((F.col("text_length") < F.col(f"q{i}")).cast("double")).alias(f"below{i}") for i in range(3)],
            *[F.count_distinct(c).alias(f"exact_{n}") for n, c in SKETCHED.items()])
        error = sketches.RANK_ERROR
        quantiles = [(F.col(f"upto{i}") >= q - error) & (F.col(f"below{i}") <= q + error) for i, q in enumerate((0.1, 0.5, 0.9))]
        near = lambda n, exact: F.abs(F.col(n) - F.col(exact)) <= sketches.SET_ERROR * F.col(exact)
        checked = ranked.select(
            F.lit(name).alias("days"), "ProfileName", "rows", (quantiles[0] & quantiles[1] & quantiles[2]).alias("quantiles_kept"),
            (near("products", "exact_products") & near("users", "exact_users")).alias("sets_kept"),
            near("shared", "exact_products").alias("shared_kept"))
        out = checked if out is None else out.unionByName(checked)
    return out


def quality_report(spark, sf):
    narrow = cut_lineage(
        cleaned(spark, sf).select(
            "ProductId", "UserId", "Score", "HelpfulnessNumerator", "HelpfulnessDenominator",
            "review_timestamp", "text_length",
            (F.col("Summary") != "").cast("string").alias("Summary"),
            F.substring("Text", 1, 1).alias("Text"),
        ).withColumn("Summary", F.when(F.col("Summary") == "true", F.lit("x")).otherwise(F.lit("")))
    )
    return reports.quality_report(raw(spark, sf), narrow)


def top_products(spark, sf):
    return product_docs.top_products(documents(spark, sf), 25).select(
        "ProductId", "review_count", "average_score")


def head_sample(spark, sf):
    return ranking.head(documents(spark, sf), [F.desc("review_count"), "ProductId"], 250).select(
        "ProductId", F.substring("search_text", 1, 200).alias("search_text_preview"))


def seeded_sample(spark, sf):
    return ranking.seeded_sample(documents(spark, sf), "ProductId", 500, 42).select("ProductId")


def length_histogram(spark, sf):
    return bins(cleaned(spark, sf), "text_length", 0, 20000, 50)


def schema_listing(spark, sf):
    """Schema rows of the cleaned reviews with the values present in each column."""
    df = cleaned(spark, sf)
    listing = reports.schema_listing(df)
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = reports.stack_rows(filled, df.columns, "column_name", "non_null")
    return listing.join(long, "column_name").drop("is_nullable")


def pipeline_outputs(spark, sf):
    path = scratch_path(spark, "outputs")
    paths = pipelines.write_review_outputs(raw(spark, sf), path)
    return pipelines.artefact_list(spark, paths)


def empty_source(spark, sf):
    """Search documents with an index that is not there: both become one frame."""
    from larderspark import schemas

    missing = readers.read_optional(spark, scratch_path(spark, "absent"), schemas.SEARCH_DOCUMENTS)
    present = documents(spark, sf).select(
        "ProductId", "label_hint", F.col("review_count").cast("bigint").alias("review_count"),
        F.col("average_score").cast("double").alias("average_score"), "search_text")
    both = present.withColumn("part", F.lit("present")).unionByName(
        missing.withColumn("part", F.lit("missing")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("review_count").alias("reviews"))


QUERIES = {
    "scan_reviews": scan_reviews,
    "scan_reviews_by_name": scan_reviews_by_name,
    "artefact_names": artefact_names,
    "normalize_text": normalize_text,
    "clean_text": clean_text,
    "safe_cast": safe_cast,
    "review_enrich": review_enrich,
    "clean_reviews": clean_reviews,
    "clean_reviews_basic": clean_reviews_basic,
    "keep_first_by_key": keep_first_by_key,
    "product_documents": product_documents,
    "product_documents_basic": product_documents_basic,
    "score_distribution": lambda s, d: reports.score_distribution(cleaned(s, d)),
    "year_distribution": lambda s, d: reports.year_distribution(cleaned(s, d)),
    "reviews_per_product": lambda s, d: reports.reviews_per_product(cleaned(s, d)),
    "sketch_ranges": sketch_ranges,
    "text_length_quantiles": lambda s, d: reports.text_length_quantiles(cleaned(s, d)),
    "overview_metrics": lambda s, d: reports.overview_metrics(raw(s, d), cleaned(s, d)),
    "quality_report": quality_report,
    "length_histogram": length_histogram,
    "schema_listing": schema_listing,
    "top_products": top_products,
    "head_sample": head_sample,
    "seeded_sample": seeded_sample,
    "pipeline_outputs": pipeline_outputs,
    "empty_source": empty_source,
}
