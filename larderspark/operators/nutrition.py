"""Nutrition tables: typed, filtered, first per key, dimensions attached."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderspark.functions import numeric, text
from larderspark.operators.dedup import keep_first

AMOUNT_MAX = 1_000_000
GRAMS_MAX = 10_000
ENERGY, PROTEIN, FAT = 1008, 1003, 1004


@dataclass(frozen=True)
class Table:
    """Target table: key, columns by kind as (target, source) names."""

    source: str
    key: str
    longs: tuple[tuple[str, str], ...] = ()
    doubles: tuple[tuple[str, str], ...] = ()
    texts: tuple[tuple[str, str], ...] = ()
    not_null: tuple[str, ...] = ()
    not_blank: tuple[str, ...] = ()
    order: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in (*self.longs, *self.doubles, *self.texts)]


def _same(*names: str) -> tuple[tuple[str, str], ...]:
    return tuple((n, n) for n in names)


TABLES: Mapping[str, Table] = {
    "categories": Table("food_category", "id", _same("id"), (), _same("code", "description"),
                        ("id",), ("description",)),
    "foods": Table("food", "fdc_id", _same("fdc_id", "food_category_id"), (),
                   _same("data_type", "description", "publication_date"),
                   ("fdc_id",), ("description",)),
    "foundation": Table("foundation_food", "fdc_id", _same("fdc_id"), (),
                        (("ndb_number", "NDB_number"), ("footnote", "footnote")), ("fdc_id",)),
    "nutrients": Table("nutrient", "id", _same("id", "rank"), (),
                       _same("name", "nutrient_nbr", "unit_name"), ("id",), ("name",)),
    "food_nutrients": Table(
        "food_nutrient", "id", _same("id", "fdc_id", "nutrient_id", "data_points"),
        (("amount", "amount"), ("min_value", "min"), ("max_value", "max"), ("median_value", "median")),
        (), ("id", "fdc_id", "nutrient_id")),
    "units": Table("measure_unit", "id", _same("id"), (), _same("name"), ("id",), ("name",)),
    "portions": Table("food_portion", "id", _same("id", "fdc_id", "measure_unit_id"),
                      _same("amount", "gram_weight"), _same("portion_description", "modifier"),
                      ("id", "fdc_id")),
}


def import_table(raw: DataFrame, spec: Table, condition: Column | None = None) -> DataFrame:
    """Cast, clean, filter and keep the first row per key.

    File order means nothing in Spark: among equal keys the row that sorts
    first over all columns is kept.
    """
    typed = raw.select(
        *[numeric.to_long(F.col(src)).alias(name) for name, src in spec.longs],
        *[numeric.to_double(F.col(src)).alias(name) for name, src in spec.doubles],
        *[text.clean_text(F.col(src)).alias(name) for name, src in spec.texts],
    )
    for c in spec.not_null:
        typed = typed.filter(F.col(c).isNotNull())
    for c in spec.not_blank:
        typed = typed.filter(F.col(c) != "")
    if condition is not None:
        typed = typed.filter(condition)
    order = [c for c in spec.columns if c != spec.key]
    return keep_first(typed, [spec.key], order or [spec.key])


def categories(raw: DataFrame) -> DataFrame:
    return import_table(raw, TABLES["categories"])


def foundation(raw: DataFrame) -> DataFrame:
    return import_table(raw, TABLES["foundation"])


def nutrients(raw: DataFrame) -> DataFrame:
    return import_table(raw, TABLES["nutrients"])


def units(raw: DataFrame) -> DataFrame:
    return import_table(raw, TABLES["units"])


def with_name(df: DataFrame, dim: DataFrame, key: str, dim_value: str, name: str) -> DataFrame:
    """Left join of a dimension's name. Spark broadcasts it while it is small."""
    looked_up = dim.select(F.col("id").alias(key), F.col(dim_value).alias(name))
    return df.join(looked_up, key, "left")


def foods(raw: DataFrame, category_dim: DataFrame) -> DataFrame:
    return with_name(import_table(raw, TABLES["foods"]), category_dim, "food_category_id",
                     "description", "food_category")


def food_nutrients(raw: DataFrame, amount_max: float = AMOUNT_MAX) -> DataFrame:
    in_range = F.col("amount").between(0, amount_max)
    return import_table(raw, TABLES["food_nutrients"], in_range)


def portions(raw: DataFrame, unit_dim: DataFrame, grams_max: float = GRAMS_MAX) -> DataFrame:
    weighed = (F.col("gram_weight") > 0) & (F.col("gram_weight") <= grams_max)
    return with_name(import_table(raw, TABLES["portions"], weighed), unit_dim,
                     "measure_unit_id", "name", "measure_unit")


def import_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All seven tables from their raw files (keys are the file names)."""
    category_dim, unit_dim = categories(raw["food_category"]), units(raw["measure_unit"])
    return {
        "categories": category_dim,
        "foods": foods(raw["food"], category_dim),
        "foundation": foundation(raw["foundation_food"]),
        "nutrients": nutrients(raw["nutrient"]),
        "food_nutrients": food_nutrients(raw["food_nutrient"]),
        "units": unit_dim,
        "portions": portions(raw["food_portion"], unit_dim),
    }


def main_nutrients(facts: DataFrame) -> DataFrame:
    """Energy, protein and fat per food in one pass instead of three joins.

    A food with several rows for one nutrient takes the one with the least id.
    """
    def amount(nutrient: int, name: str) -> Column:
        hit = F.col("nutrient_id") == nutrient
        return F.min_by(F.when(hit, F.col("amount")), F.when(hit, F.col("id"))).alias(name)

    return (
        facts.filter(F.col("nutrient_id").isin(ENERGY, PROTEIN, FAT))
        .groupBy("fdc_id")
        .agg(amount(ENERGY, "energy"), amount(PROTEIN, "protein"), amount(FAT, "fat"))
    )


def nutrition_text() -> Column:
    """Labelled amounts joined by bars; missing amounts are skipped."""
    def part(label: str, name: str, unit: str) -> Column:
        return F.concat(F.lit(f"{label}: "), numeric.plain_number(F.col(name)), F.lit(f" {unit}"))

    return F.concat_ws(" | ", part("Energy", "energy", "kcal"), part("Protein", "protein", "g"),
                       part("Fat", "fat", "g"))


def relevance_examples(raw: DataFrame) -> DataFrame:
    """Graded query-product judgements with a known label."""
    spec = Table("examples", "example_id",
                 _same("example_id", "query_id", "small_version", "large_version"), (),
                 _same("query", "product_id", "product_locale", "esci_label", "split"),
                 ("example_id", "query_id"), ("query", "product_id"))
    return import_table(raw, spec, F.col("esci_label").isin(*RELEVANCE_LABELS))


# Accepted spellings of the four judgement grades.
RELEVANCE_LABELS = ("E", "S", "C", "I", "Exact", "Substitute", "Complement", "Irrelevant")
EXACT_LABELS = ("E", "Exact")


def relevant_pairs(examples: DataFrame) -> DataFrame:
    """Query-product pairs judged exact, as relevance judgements."""
    return examples.filter(F.col("esci_label").isin(*EXACT_LABELS)).select("query_id", "product_id").distinct()
