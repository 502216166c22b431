"""Registered queries on the catalogue, nutrition tables and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderspark.functions import payload, text
from larderspark.operators import catalog, ledger, master, nutrition, quality, reports
from larderspark.operators.upsert import upsert, upsert_partial
from larderspark.plans import catalog_jobs, fixtures
from larderspark.session import cut_lineage, scratch_path
from larderspark.sources import readers, tables, writers
from larderspark.streaming import jobs

AMOUNT_MAX = 90_000
REPORT_COLUMNS = ("product_name", "brand", "categories", "ingredients_text", "allergens", "nutriscore")


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.clean_catalog(fixtures.catalog_dump(spark, sf))


def categories(spark, sf):
    return nutrition.categories(fixtures.view(spark, sf, "fx_categories"))


def foods(spark, sf):
    return nutrition.foods(fixtures.view(spark, sf, "fx_foods"), categories(spark, sf))


def units(spark, sf):
    return nutrition.units(fixtures.view(spark, sf, "fx_units"))


def facts(spark, sf):
    return nutrition.food_nutrients(fixtures.view(spark, sf, "fx_nutrients"), AMOUNT_MAX)


def portions(spark, sf):
    return nutrition.portions(fixtures.view(spark, sf, "fx_portions"), units(spark, sf))


def master_rows(spark, sf):
    return master.products_master(cleaned(spark, sf), foods(spark, sf), facts(spark, sf))


def search_documents(spark, sf):
    return master.search_documents(master_rows(spark, sf))


def examples(spark, sf):
    return nutrition.relevance_examples(fixtures.view(spark, sf, "fx_examples"))


def scan_tsv_dump(spark, sf):
    path = scratch_path(spark, "dump-tsv")
    (fixtures.catalog_dump(spark, sf).drop("p_partkey").write.option("header", True)
     .option("sep", "\t").option("escape", '"').option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    dump = readers.read_catalog_dump(spark, path)
    return dump.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c.replace("-", "_")) for c in dump.columns])


def scan_nutrition(spark, sf):
    """A nutrition file with its columns in another order, read back by name."""
    foods = fixtures.view(spark, sf, "fx_foods")
    path = scratch_path(spark, "nutrition")
    writers.write_csv(foods.select(*foods.columns[::-1], F.lit("x").alias("more")), f"{path}/food.csv")
    return readers.read_nutrition(spark, path, "food")


def normalize_payload(spark, sf):
    source = fixtures.catalog_dump(spark, sf)
    product = F.struct(
        "product_name", F.concat(F.lit("generic "), "code").alias("generic_name_fr"),
        F.struct(F.lit(1).alias("x")).alias("product_name_en"), "brands", "categories",
        F.col("ingredients_text").alias("ingredients_text_en"),
        F.lit(3).alias("nutriscore_score"),
        F.struct(F.col("energy-kcal_100g").try_cast("int").alias("energy-kcal_100g")).alias("nutriments"),
    )
    text_rows = source.select(F.concat(
        F.to_json(F.struct(F.when(F.col("p_partkey") % 13 != 0, F.col("code")).alias("code"),
                           product.alias("product"))),
        F.when(F.col("p_partkey") % 37 == 0, F.lit("broken")).otherwise(F.lit(""))).alias("value"))
    path = scratch_path(spark, "payloads")
    text_rows.write.text(path)
    rows = catalog.normalize_payloads(readers.read_payloads(spark, path))
    return rows.select(
        "code", "product_name", "brand", "categories", "ingredients_text", "allergens", "nutriscore",
        F.try_element_at("nutriments", F.lit("energy-kcal_100g")).alias("energy"), "source_url")


def barcode_list(spark, sf):
    rows = fixtures.view(spark, sf, "fx_catalog")
    values = rows.select(F.concat_ws(",", "code", F.concat(F.lit(" "), "code"), F.lit("")).alias("value"))
    lines = rows.select(
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("# "), "product_name"))
        .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit(" "), "product_name", F.lit(", b ")))
        .otherwise(F.lit("")).alias("value"))
    path = scratch_path(spark, "barcodes")
    lines.write.text(path)
    return readers.barcode_list(values, readers.read_barcode_file(spark, path))


def valid_codes(spark, sf):
    return fixtures.view(spark, sf, "fx_catalog").filter(catalog.valid_code(F.col("code"))).select(
        "p_partkey", "code")


def clean_catalog_field(spark, sf):
    rows = fixtures.view(spark, sf, "fx_catalog")
    return rows.select("p_partkey", *[
        text.clean_field(F.col(c)).alias(c) for c in ("brands", "categories", "allergens")])


def nutriment_map(spark, sf):
    dump = fixtures.catalog_dump(spark, sf)
    return dump.select("p_partkey", F.explode(catalog.nutriment_map(dump)).alias("nutriment", "amount"))


def catalog_clean(spark, sf):
    rows = cleaned(spark, sf)
    payload_energy = F.get_json_object("raw_payload", "$['energy-kcal_100g']").cast("double")
    return rows.select(
        "code", "product_name", "brand", "categories", "ingredients_text", "allergens", "nutriscore",
        F.try_element_at("nutriments", F.lit("proteins_100g")).alias("proteins"), "source_url",
        F.get_json_object("raw_payload", "$.brands").alias("payload_brand"),
        payload_energy.alias("payload_energy"))


def nutrition_summary(spark, sf):
    return cleaned(spark, sf).select("code", master.nutrition_summary(F.col("nutriments")).alias("summary"))


def initcap_words(spark, sf):
    rows = fixtures.view(spark, sf, "fx_foods")
    return rows.select("fdc_id", text.initcap_words(F.col("description")).alias("name"))


def food_nutrition(spark, sf):
    rows = foods(spark, sf).join(nutrition.main_nutrients(facts(spark, sf)), "fdc_id", "left")
    return rows.select("fdc_id", "food_category", nutrition.nutrition_text().alias("summary"))


def products_master(spark, sf):
    return master_rows(spark, sf).drop("payload")


def catalog_search_text(spark, sf):
    return search_documents(spark, sf).drop("payload")


def part_delta(base):
    return base.select(
        (F.col("p_partkey") * 2).alias("p_partkey"), "p_name", "p_brand", "p_type", "p_size",
        (F.col("p_retailprice") + 1).alias("p_retailprice"))


def upsert_merge(spark, sf):
    base = fixtures.table(spark, sf, "part")
    return upsert(base, part_delta(base), ["p_partkey"])


def upsert_table(spark, sf):
    """The same into a stored table of hash buckets."""
    base, path = fixtures.table(spark, sf, "part"), scratch_path(spark, "parts")
    tables.create(base, path, ["p_partkey"])
    tables.apply(part_delta(base), path, ["p_partkey"])
    return tables.read(spark, path)


def upsert_stream(spark, sf):
    """The same, the changes arriving as files of a stream."""
    base, path = fixtures.table(spark, sf, "part"), scratch_path(spark, "parts")
    tables.create(base, path, ["p_partkey"])
    delta = part_delta(base)
    for part in (0, 1):
        delta.filter(F.pmod(F.xxhash64("p_partkey"), F.lit(2)) == part).write.mode("append").parquet(f"{path}-changes")
    changes = jobs.read_stream(spark, f"{path}-changes", delta.schema, jobs.files_of_batch(spark, f"{path}-changes", delta.schema))
    jobs.upsert_stream(changes, path, ["p_partkey"], ["p_name"], f"{path}-progress").awaitTermination()
    return tables.read(spark, path)


def customer_delta(base):
    return base.select(
        (F.col("c_custkey") * 2).alias("c_custkey"), F.concat("c_name", F.lit(" new")).alias("c_name"),
        F.col("c_nationkey"), (F.col("c_acctbal") + 1).alias("c_acctbal"), "c_mktsegment")


def partial(base, delta):
    return upsert_partial(base, delta, ["c_custkey"], ["c_acctbal"], {"c_mktsegment": F.lit("TOUCHED")})


def upsert_part(spark, sf):
    base = fixtures.table(spark, sf, "customer")
    return partial(base, customer_delta(base))


def upsert_partial_table(spark, sf):
    base, path = fixtures.table(spark, sf, "customer"), scratch_path(spark, "customers")
    tables.create(base, path, ["c_custkey"])
    tables.apply(customer_delta(base), path, ["c_custkey"], partial)
    return tables.read(spark, path)


def master_incremental(spark, sf):
    """The master after changes of both sources, brought up to date by their keys.

    The tables start with some rows missing, some different, and some too
    many; the changes lead to the rows that ``products_master`` is made of.
    """
    house = scratch_path(spark, "house")
    last = {"catalog": (cut_lineage(cleaned(spark, sf)), "code"), "foods": (cut_lineage(foods(spark, sf)), "fdc_id"),
            "food_nutrients": (cut_lineage(facts(spark, sf)), "id")}
    changed = {}
    for name, (rows, key) in last.items():
        turn = F.pmod(F.xxhash64(F.lit(name), F.col(key).cast("string")), F.lit(20))
        column = {"catalog": "product_name", "foods": "description", "food_nutrients": "amount"}[name]
        other = F.lit(7.0) if column == "amount" else F.concat(F.lit("was "), column)
        extra = rows.filter(turn == 2).withColumn(
            key, F.concat(F.lit("9"), key) if name == "catalog" else F.col(key) + 10_000_000_000)
        first = rows.filter(turn != 0).withColumn(column, F.when(turn == 1, other).otherwise(F.col(column)))
        tables.create(first.unionByName(extra), f"{house}/{name}", [key])
        changed[name] = (cut_lineage(rows.filter(turn < 2)), cut_lineage(extra))
    catalog_jobs.rebuild_master(spark, house)
    for name, (rows, extra) in changed.items():
        tables.apply(rows, f"{house}/{name}", [last[name][1]])
        tables.delete(spark, f"{house}/{name}", extra.select(last[name][1]))
    keys = {name: rows.unionByName(extra) for name, (rows, extra) in changed.items()}
    catalog_jobs.refresh_master(spark, house, keys["catalog"], keys["foods"], keys["food_nutrients"])
    return tables.read(spark, f"{house}/master").drop("payload", "updated_at")


def scan_benchmark(spark, sf):
    """Query sets as JSON files, each an array of queries."""
    words = F.split("query", " ")
    at = lambda odd: F.filter(words, lambda w, i: (i % 2 == odd) & (w != ""))
    asked = fixtures.view(spark, sf, "fx_queries").select(
        F.pmod(F.xxhash64("query_id"), F.lit(1 << 20)).alias("part"),
        F.struct("query", "top_k", F.array(at(0), at(1)).alias("positive_groups")).alias("q"))
    path = scratch_path(spark, "query-sets")
    asked.groupBy("part").agg(F.to_json(F.collect_list("q")).alias("value")).write.partitionBy("part").text(path)
    found = readers.read_benchmark(spark, f"{path}/part=*")
    return found.select("query", "top_k", *[
        F.array_join(F.get("positive_groups", F.lit(n)), " ").alias(f"group_{n}") for n in (0, 1)])


def export_catalog(spark, sf):
    path = scratch_path(spark, "export")
    rows = cut_lineage(master_rows(spark, sf))
    catalog_jobs.export_catalog(rows, master.search_documents(rows), path)
    products = spark.read.parquet(f"{path}/products_master.parquet")
    documents = spark.read.parquet(f"{path}/product_search_documents.parquet")
    return products.join(documents.select("product_id", "search_text"), "product_id").select(
        "product_id", "barcode", "product_name", "source_dataset", "search_text",
        F.get_json_object("payload_json", "$.category").alias("payload_category"))


def quality_gate(spark, sf):
    rows = cut_lineage(master_rows(spark, sf))
    products, documents = catalog_jobs.export_frames(rows, master.search_documents(rows))
    return quality.quality_gate(products, documents)


def run_ledger(spark, sf):
    events = fixtures.table(spark, sf, "events")
    status = F.when(F.col("event_type") == "error", F.lit(ledger.FAILED)).when(
        F.col("event_type") == "click", F.lit(ledger.RUNNING)).otherwise(F.lit(ledger.SUCCEEDED))
    rows = events.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        F.lit("events").alias("source"), status.alias("status"),
        F.get_json_object("props", "$.k").cast("bigint").alias("row_count"),
        F.col("props").alias("notes"), F.col("ts").alias("event_at"), "event_id")
    return ledger.latest_runs(rows, "event_id")


def table_counts(spark, sf):
    return reports.table_counts({t: fixtures.table(spark, sf, t) for t in fixtures.TABLES})


def catalog_report(spark, sf):
    rows = cut_lineage(cleaned(spark, sf))
    merged = cut_lineage(master.products_master(rows, foods(spark, sf), facts(spark, sf)))
    tables = {
        "catalog": rows, "products_master": merged,
        "product_search_documents": master.search_documents(merged), "foods": foods(spark, sf),
        "relevance_examples": examples(spark, sf),
    }
    return reports.catalog_report(tables, rows, REPORT_COLUMNS, ("product_name",))


def extract_json(spark, sf):
    events = fixtures.table(spark, sf, "events")
    shown = (
        F.when(F.col("event_id") % 3 == 0, F.col("props"))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit("Answer:\n"), "props", F.lit("\nend")))
        .otherwise(F.concat(F.lit("{ no json "), F.col("event_type")))
    )
    found = payload.extract_json(shown)
    return events.select("event_id", F.try_variant_get(found, "$.k", "bigint").alias("k"))


QUERIES = {
    "scan_nutrition": scan_nutrition,
    "scan_tsv_dump": scan_tsv_dump,
    "normalize_payload": normalize_payload,
    "barcode_list": barcode_list,
    "valid_codes": valid_codes,
    "clean_catalog_field": clean_catalog_field,
    "nutriment_map": nutriment_map,
    "catalog_clean": catalog_clean,
    "nutrition_summary": nutrition_summary,
    "initcap_words": initcap_words,
    "dim_categories": categories,
    "dim_foods": foods,
    "dim_foundation": lambda s, d: nutrition.foundation(
        fixtures.view(s, d, "fx_foods").select(
            "fdc_id", F.col("food_category_id").alias("NDB_number"), F.col("data_type").alias("footnote"))),
    "dim_nutrients": lambda s, d: nutrition.nutrients(fixtures.view(s, d, "fx_nutrient_names")),
    "dim_units": units,
    "fact_nutrients": facts,
    "fact_portions": portions,
    "relevance_examples": examples,
    "food_nutrition": food_nutrition,
    "products_master": products_master,
    "catalog_search_text": catalog_search_text,
    "upsert_merge": upsert_merge,
    "upsert_partial": upsert_part,
    "upsert_table": upsert_table,
    "upsert_stream": upsert_stream,
    "upsert_partial_table": upsert_partial_table,
    "master_incremental": master_incremental,
    "scan_benchmark": scan_benchmark,
    "export_catalog": export_catalog,
    "quality_gate": quality_gate,
    "run_ledger": run_ledger,
    "completeness": lambda s, d: reports.completeness(cleaned(s, d), REPORT_COLUMNS, ("product_name",)),
    "grade_distribution": lambda s, d: reports.grade_distribution(cleaned(s, d)),
    "search_text_stats": lambda s, d: reports.text_stats(search_documents(s, d), "search_text"),
    "rows_by_source": lambda s, d: reports.rows_by_source(master_rows(s, d)),
    "table_counts": table_counts,
    "top_brands": lambda s, d: reports.top_brands(cleaned(s, d)),
    "top_first_category": lambda s, d: reports.top_first_category(cleaned(s, d)),
    "catalog_report": catalog_report,
    "extract_json": extract_json,
}
