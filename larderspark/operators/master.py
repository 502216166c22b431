"""The master catalogue and its search documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderspark.functions import numeric, text
from larderspark.operators import nutrition
from larderspark.operators.catalog import GRADES

COLUMNS = (
    "product_id", "barcode", "product_name", "brand", "categories", "ingredients_text",
    "allergens", "nutrition_summary", "nutriscore", "source_dataset", "payload",
)
SUMMARY_KEYS = ("energy-kcal_100g", "proteins_100g", "fat_100g", "sugars_100g", "salt_100g")
INGREDIENT_CHARS = 400
# Columns an existing master row takes from each source.
CATALOG_UPDATES = tuple(c for c in COLUMNS if c not in ("product_id", "source_dataset"))
NUTRITION_UPDATES = ("product_name", "categories", "nutrition_summary", "payload")


def trim_spaces(c: Column) -> Column:
    return F.btrim(c, F.lit(" "))


def eligible(name: Column) -> Column:
    return F.char_length(trim_spaces(name)) > 1


def nutrition_summary(nutriments: Column) -> Column:
    """Five nutriment values as text, missing ones skipped."""
    return F.concat_ws(
        " ", *[numeric.plain_number(F.try_element_at(nutriments, F.lit(k))) for k in SUMMARY_KEYS]
    )


def from_catalog(catalog: DataFrame) -> DataFrame:
    return catalog.filter(eligible(F.col("product_name"))).select(
        F.concat(F.lit("off:"), "code").alias("product_id"),
        F.col("code").alias("barcode"), "product_name", "brand", "categories",
        "ingredients_text", "allergens",
        nutrition_summary(F.col("nutriments")).alias("nutrition_summary"),
        "nutriscore", F.lit("openfoodfacts").alias("source_dataset"),
        F.col("raw_payload").alias("payload"),
    )


def from_nutrition(foods: DataFrame, facts: DataFrame) -> DataFrame:
    """Foods with their category and a labelled text of three nutrients."""
    none = F.lit(None).cast("string")
    fdc = F.col("fdc_id").cast("string")
    payload = F.to_json(
        F.struct("fdc_id", "description", F.col("food_category").alias("category")),
        {"ignoreNullFields": "false"},
    )
    return (
        foods.filter(eligible(F.col("description")))
        .join(nutrition.main_nutrients(facts), "fdc_id", "left")
        .select(
            F.concat(F.lit("usda:"), fdc).alias("product_id"), fdc.alias("barcode"),
            text.initcap_words(F.col("description")).alias("product_name"),
            F.lit("USDA Foundation Foods").alias("brand"),
            F.col("food_category").alias("categories"),
            none.alias("ingredients_text"), none.alias("allergens"),
            nutrition.nutrition_text().alias("nutrition_summary"),
            none.alias("nutriscore"), F.lit("usda").alias("source_dataset"),
            payload.alias("payload"),
        )
    )


def products_master(catalog: DataFrame, foods: DataFrame, facts: DataFrame) -> DataFrame:
    return from_catalog(catalog).unionByName(from_nutrition(foods, facts))


def search_text() -> Column:
    """Words only: name, brand, categories, ingredients, allergens, grade."""
    def words(c: Column) -> Column:
        return text.blank_to_null(trim_spaces(c))

    grade = F.when(F.col("nutriscore").isin(*GRADES),
                   F.concat(F.lit("Nutri-Score "), F.upper("nutriscore")))
    ingredients = text.blank_to_null(
        F.substring(trim_spaces(F.col("ingredients_text")), 1, INGREDIENT_CHARS))
    return trim_spaces(F.concat_ws(
        " ", words(F.col("product_name")), words(F.col("brand")), words(F.col("categories")),
        ingredients, words(F.col("allergens")), grade))


def search_documents(master: DataFrame) -> DataFrame:
    return master.filter(eligible(F.col("product_name"))).select(
        F.col("product_id").alias("source_product_id"), "source_dataset",
        search_text().alias("search_text"), "payload",
    )
