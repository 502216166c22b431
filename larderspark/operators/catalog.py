"""Catalogue products from a dump or from landed payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderspark import schemas
from larderspark.functions import numeric, text
from larderspark.functions.payload import strict_json
from larderspark.operators.dedup import keep_first
from larderspark.sources.readers import column_or, require_columns

BASE_URL = "https://world.openfoodfacts.org"
GRADES = ("a", "b", "c", "d", "e")
MIN_NAME = 3


def valid_code(c: Column) -> Column:
    """Exactly 8 or 13 ASCII digits."""
    return c.rlike(r"^(\d{8}|\d{13})\z")


def nutriment_map(df: DataFrame) -> Column:
    """The parsable nutriments of the columns present, as name to number."""
    names = [c for c in schemas.NUTRIMENTS if c in df.columns]
    if not names:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    values = F.array(*[numeric.numeric_text(F.col(f"`{c}`")) for c in names])
    pairs = F.map_from_arrays(F.array(*[F.lit(c) for c in names]), values)
    return F.map_filter(pairs, lambda k, v: v.isNotNull())


def useful(df: DataFrame) -> Column:
    """Categories, ingredients or a lower-case grade are given."""
    grade = column_or(df, "nutriscore_grade")
    filled = [column_or(df, c) != "" for c in ("categories", "ingredients_text")]
    return F.coalesce(filled[0], F.lit(False)) | F.coalesce(filled[1], F.lit(False)) | F.coalesce(
        grade.rlike(r"^[abcde]\z"), F.lit(False))


def clean_catalog(raw: DataFrame, limit: int = 0) -> DataFrame:
    """Valid, useful, distinct products with cleaned fields.

    ``limit`` (0 = all) takes the first codes in order, after all filters.
    """
    require_columns(raw.columns, schemas.CATALOG_REQUIRED)
    present = [c for c in (*schemas.CATALOG_REQUIRED, *schemas.CATALOG_OPTIONAL) if c in raw.columns]
    stripped = raw.withColumns({c: text.strip(F.col(c)) for c in present})
    kept = stripped.filter(
        (F.col("code") != "")
        & (F.col("product_name") != "")
        & valid_code(F.col("code"))
        & (F.char_length("product_name") >= MIN_NAME)
        & useful(stripped)
    )
    columns = [*present, *[c for c in schemas.NUTRIMENTS if c in raw.columns]]
    order = [F.asc_nulls_last(f"`{c}`") for c in columns if c != "code"]
    first = keep_first(kept.select(*[f"`{c}`" for c in columns]), ["code"], order)
    if limit > 0:
        first = first.orderBy("code").limit(limit)
    grade = F.lower(F.coalesce(column_or(first, "nutriscore_grade"), F.lit("")))
    url = F.coalesce(text.blank_to_null(column_or(first, "url")),
                     F.concat(F.lit(f"{BASE_URL}/product/"), F.col("code")))
    shaped = first.select(
        "code",
        text.clean_product_name(F.col("product_name")).alias("product_name"),
        text.clean_field(column_or(first, "brands")).alias("brand"),
        text.clean_field(column_or(first, "categories")).alias("categories"),
        F.coalesce(column_or(first, "ingredients_text"), F.lit("")).alias("ingredients_text"),
        text.clean_field(column_or(first, "allergens")).alias("allergens"),
        F.when(grade.isin(*GRADES), grade).otherwise(F.lit("")).alias("nutriscore"),
        nutriment_map(first).alias("nutriments"),
        F.to_json(nutriment_map(first)).alias("nutriments_json"),
        url.alias("source_url"),
    ).filter((F.col("product_name") != "") & ~F.lower("product_name").isin(*text.JUNK_WORDS))
    return shaped.withColumn("raw_payload", raw_payload()).select(*schemas.CATALOG_COLUMNS)


def raw_payload() -> Column:
    """The cleaned fields and the flattened nutriments as one JSON object."""
    fields = F.to_json(
        F.struct("code", "product_name", F.col("brand").alias("brands"), "categories",
                 F.col("nutriscore").alias("nutriscore_grade"))
    )
    numbers = F.to_json("nutriments")
    joined = F.concat(F.regexp_replace(fields, r"\}\z", ","), F.regexp_replace(numbers, r"^\{", ""))
    return F.when(F.size("nutriments") > 0, joined).otherwise(fields)


NAME_KEYS = ("product_name", "product_name_en", "product_name_fr",
             "generic_name", "generic_name_en", "generic_name_fr")
INGREDIENT_KEYS = ("ingredients_text", "ingredients_text_en", "ingredients_text_fr")


def best_text(product: Column, *keys: str) -> Column:
    """First non-blank JSON string among the keys; other JSON types do not count."""
    def candidate(key: str) -> Column:
        value = F.try_variant_get(product, f"$.{key}", "variant")
        as_text = text.collapse(F.try_variant_get(product, f"$.{key}", "string"))
        return text.blank_to_null(F.when(F.schema_of_variant(value) == "STRING", as_text))

    return F.coalesce(*[candidate(k) for k in keys], F.lit(""))


def normalize_payloads(payloads: DataFrame, barcode: Column | None = None) -> DataFrame:
    """Landed payloads (text column ``payload``) to catalogue rows.

    Payloads that are not JSON, or without a code or a name, are rejected.
    ``nutriments_json`` is the whole nutriments object, ``{}`` where there is
    none; ``nutriments`` has its numbers.
    """
    parsed = payloads.withColumn("_doc", strict_json(F.col("payload")))
    doc, product = F.col("_doc"), F.try_variant_get(F.col("_doc"), "$.product", "variant")
    code = F.coalesce(
        text.blank_to_null(F.try_variant_get(doc, "$.code", "string")),
        text.blank_to_null(F.try_variant_get(doc, "$.product.code", "string")),
        F.lit(None).cast("string") if barcode is None else barcode,
    )
    given = F.try_variant_get(product, "$.nutriments", "variant")
    nutriments = F.try_variant_get(product, "$.nutriments", "map<string,variant>")
    numbers = F.map_filter(
        F.transform_values(nutriments, lambda k, v: F.try_variant_get(v, "$", "double")),
        lambda k, v: v.isNotNull(),
    )
    rows = parsed.select(
        text.strip(code).alias("code"),
        best_text(product, *NAME_KEYS).alias("product_name"),
        best_text(product, "brands").alias("brand"),
        best_text(product, "categories").alias("categories"),
        best_text(product, *INGREDIENT_KEYS).alias("ingredients_text"),
        best_text(product, "allergens").alias("allergens"),
        best_text(product, "nutriscore_grade", "nutriscore_score").alias("nutriscore"),
        F.coalesce(numbers, F.map_from_arrays(
            F.array().cast("array<string>"), F.array().cast("array<double>"))).alias("nutriments"),
        F.when(F.schema_of_variant(given).startswith("OBJECT"), F.to_json(given)).otherwise("{}").alias("nutriments_json"),
        F.concat(F.lit(f"{BASE_URL}/product/"), text.strip(code)).alias("source_url"),
        F.col("payload").alias("raw_payload"),
    )
    return rows.filter((F.col("code") != "") & (F.col("product_name") != ""))
