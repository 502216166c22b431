"""Catalogue jobs: nutrition import, master rebuild, export behind the gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderspark import schemas
from larderspark.operators import catalog, ledger, master, nutrition, quality
from larderspark.operators.upsert import last_wins, upsert_partial
from larderspark.session import cut_lineage
from larderspark.sources import readers, tables, writers


def load(df: DataFrame, path: str, keys: list[str]) -> int:
    """Upsert into a keyed table; the row count of the source is returned.

    The source is stored first: it is computed once and its size is known.
    Only the buckets of its keys are rewritten.
    """
    source = cut_lineage(df)
    tables.apply(source, path, keys)
    return source.count()


def import_nutrition(spark: SparkSession, directory: str, warehouse: str) -> int:
    """All seven nutrition files into their tables, logged in the run ledger."""
    def job() -> int:
        raw = {name: readers.read_nutrition(spark, directory, name) for name in schemas.NUTRITION_FILES}
        return sum(
            load(df, f"{warehouse}/{name}", [nutrition.TABLES[name].key])
            for name, df in nutrition.import_all(raw).items()
        )

    return ledger.run_logged(spark, f"{warehouse}/runs", "nutrition", job, {"directory": directory})


def import_catalog(spark: SparkSession, dump: str, warehouse: str, limit: int = 0) -> int:
    """Catalogue dump into its table, logged; rebuild the master as a next step."""
    def job() -> int:
        cleaned = catalog.clean_catalog(readers.read_catalog_dump(spark, dump), limit)
        return load(cleaned, f"{warehouse}/catalog", ["code"])

    return ledger.run_logged(spark, f"{warehouse}/runs", "catalog_dump", job, {"path": dump, "limit": limit})


def import_payloads(spark: SparkSession, landed: str, warehouse: str) -> int:
    """Landed payloads into the catalogue table; of equal codes one row wins.

    A payload without a code takes the barcode its file is named after.
    """
    def job() -> int:
        rows = catalog.normalize_payloads(readers.read_payloads(spark, landed), F.col("barcode"))
        return load(last_wins(rows, ["code"], ["raw_payload"]), f"{warehouse}/catalog", ["code"])

    return ledger.run_logged(spark, f"{warehouse}/runs", "catalog_payloads", job, {"path": landed})


def import_examples(spark: SparkSession, path: str, warehouse: str) -> int:
    """Relevance judgements into their table, logged."""
    def job() -> int:
        return load(nutrition.relevance_examples(spark.read.parquet(path)),
                    f"{warehouse}/examples", ["example_id"])

    return ledger.run_logged(spark, f"{warehouse}/runs", "relevance_examples", job, {"path": path})


def rebuild_master(spark: SparkSession, warehouse: str) -> None:
    """Both sources into ``master``, then the search documents of all of it.

    Rows of an existing master keep their other columns and get a new time.
    """
    sources = [tables.read(spark, f"{warehouse}/{t}") for t in ("catalog", "foods", "food_nutrients")]
    now, path = F.current_timestamp(), f"{warehouse}/master"
    catalog_rows, foods, facts = sources
    updates = ((master.from_catalog(catalog_rows), master.CATALOG_UPDATES),
               (master.from_nutrition(foods, facts), master.NUTRITION_UPDATES))
    for rows, update in updates:  # the id prefixes keep the sources apart, so each rule meets only its rows
        tables.apply(rows.withColumn("updated_at", now), path, ["product_id"], lambda old, new: upsert_partial(
            old, new, ["product_id"], update, {"updated_at": F.current_timestamp()}))
    documents = master.search_documents(tables.read(spark, path)).withColumn("updated_at", now)
    load(documents, f"{warehouse}/search_documents", ["source_product_id"])


def refresh_master(spark: SparkSession, warehouse: str, codes: DataFrame | None = None,
                   fdc_ids: DataFrame | None = None, nutrients: DataFrame | None = None) -> int:
    """Bring ``master`` and its search documents up to date with changed source rows only.

    ``codes`` (code): catalogue rows that were inserted, updated or deleted;
    ``fdc_ids`` (fdc_id): foods; ``nutrients`` (fdc_id): foods with a changed
    nutrient row. Their products are computed again from the sources; those
    that no longer exist or qualify are retracted. Returns the products looked
    at. The result is that of ``master.products_master`` on the whole sources.
    """
    def keys(df: DataFrame | None, name: str, kind: str) -> DataFrame:
        return spark.createDataFrame([], f"{name} {kind}") if df is None else df.select(F.col(name).cast(kind).alias(name))

    code = cut_lineage(keys(codes, "code", "string").distinct(), "codes")
    fdc = cut_lineage(keys(fdc_ids, "fdc_id", "long").unionByName(keys(nutrients, "fdc_id", "long")).distinct(), "foods")
    catalog_rows, foods, facts = (tables.read(spark, f"{warehouse}/{t}") for t in ("catalog", "foods", "food_nutrients"))
    fresh = cut_lineage(master.products_master(
        catalog_rows.join(code, "code", "left_semi"), foods.join(fdc, "fdc_id", "left_semi"),
        facts.join(fdc, "fdc_id", "left_semi")), "fresh")
    touched = cut_lineage(
        code.select(F.concat(F.lit("off:"), "code").alias("product_id"))
        .unionByName(fdc.select(F.concat(F.lit("usda:"), F.col("fdc_id").cast("string")).alias("product_id"))), "touched")
    path, documents = f"{warehouse}/master", f"{warehouse}/search_documents"
    tables.apply(fresh.withColumn("updated_at", F.current_timestamp()), path, ["product_id"])
    tables.delete(spark, path, touched.join(fresh.select("product_id"), "product_id", "left_anti"))
    shown = cut_lineage(master.search_documents(fresh).withColumn("updated_at", F.current_timestamp()), "documents")
    tables.apply(shown, documents, ["source_product_id"])
    tables.delete(spark, documents, touched.select(F.col("product_id").alias("source_product_id")).join(
        shown.select("source_product_id"), "source_product_id", "left_anti"))
    return touched.count()


def export_frames(products: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The export shape: payload as JSON text, times as text, ids as product_id."""
    def shape(df: DataFrame, rename: dict[str, str]) -> DataFrame:
        out = df.withColumnsRenamed({**rename, "payload": "payload_json"})
        if "updated_at" in out.columns:
            out = out.withColumn("updated_at", F.col("updated_at").cast("string"))
        return out

    return shape(products, {}), shape(documents, {"source_product_id": "product_id"})


def export_catalog(products: DataFrame, documents: DataFrame, out: str) -> dict[str, object]:
    """Gate, then both tables sorted by id, then the report as JSON.

    Both frames are computed once, into stored tables, and counted on the way;
    the gate reads ids only, and the sorted files are written from them.
    """
    spark = products.sparkSession
    products, documents = export_frames(products, documents)
    (products, seen), (documents, more) = (
        quality.store_observed(df, prefix) for df, prefix in ((products, "products"), (documents, "documents")))
    counts = {**seen, **more}
    row = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))
    report = quality.passed(quality.verdict(row).first().asDict())
    writers.write_sorted(products, f"{out}/products_master.parquet", ["product_id"])
    writers.write_sorted(documents, f"{out}/product_search_documents.parquet", ["product_id"])
    spark.createDataFrame([report]).coalesce(1).write.mode("overwrite").json(
        f"{out}/quality_report.json")
    return report
