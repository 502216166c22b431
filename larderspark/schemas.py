"""Declared schemas of inputs and fixed-shape results."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, F, D, B = (
    T.StringType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.BooleanType(),
)
TEXTS = T.ArrayType(S)
VECTOR = T.ArrayType(F)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Id is a long: a review table of cluster size has more rows than an int counts.
REVIEWS = struct(
    Id=L, ProductId=S, UserId=S, ProfileName=S, HelpfulnessNumerator=I,
    HelpfulnessDenominator=I, Score=F, Time=I, Summary=S, Text=S,
)

SEARCH_DOCUMENTS = struct(
    ProductId=S, label_hint=S, review_count=L, average_score=D, search_text=S
)

BENCHMARK_QUERIES = struct(
    query=S, top_k=I, positive_groups=T.ArrayType(TEXTS)
)

# Nutrition files: columns as they come, all read as text and cast afterwards.
NUTRITION_FILES = {
    "food_category": ("id", "code", "description"),
    "food": ("fdc_id", "data_type", "description", "food_category_id", "publication_date"),
    "foundation_food": ("fdc_id", "NDB_number", "footnote"),
    "nutrient": ("id", "name", "nutrient_nbr", "unit_name", "rank"),
    "food_nutrient": (
        "id", "fdc_id", "nutrient_id", "amount", "data_points", "min", "max", "median",
    ),
    "measure_unit": ("id", "name"),
    "food_portion": (
        "id", "fdc_id", "measure_unit_id", "amount", "gram_weight", "portion_description",
        "modifier",
    ),
}

# Nutriment columns of the catalogue dump.
NUTRIMENTS = (
    "energy-kcal_100g", "energy_100g", "fat_100g", "saturated-fat_100g",
    "carbohydrates_100g", "sugars_100g", "fiber_100g", "proteins_100g", "salt_100g",
    "sodium_100g",
)
CATALOG_REQUIRED = ("code", "product_name")
CATALOG_OPTIONAL = (
    "brands", "categories", "ingredients_text", "allergens", "nutriscore_grade", "url",
)

CATALOG_COLUMNS = (
    "code", "product_name", "brand", "categories", "ingredients_text", "allergens",
    "nutriscore", "nutriments", "nutriments_json", "source_url", "raw_payload",
)

RUN_LEDGER = struct(
    run_id=S, source=S, status=S, row_count=L, notes=S, event_at=T.TimestampType()
)
