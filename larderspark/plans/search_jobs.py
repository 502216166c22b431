"""Search jobs: embed, index and evaluate, each reading and writing tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderspark.operators import embedding, enrich, evaluation, hybrid, vector
from larderspark.session import cut_lineage
from larderspark.sources import readers, tables


def embed_table(documents: DataFrame, out: str, key: str, text_column: str, model: str,
                max_chars: int = embedding.DOCUMENT_CHARS, resume: bool = True,
                make_encoder: Callable[[], embedding.Encoder] | None = None) -> dict[str, object]:
    """Embed what ``out`` does not hold yet, append it, return the manifest.

    Only new files are written; a failed run leaves the old ones as they are.
    Without ``resume`` the table is written anew.
    """
    spark = documents.sparkSession
    schema = T.StructType([documents.schema[key], T.StructField("embedding", T.ArrayType(T.FloatType()))])
    todo = documents
    if resume:
        todo = embedding.remaining(documents, readers.read_optional(spark, out, schema), key)
    done = cut_lineage(embedding.embed_documents(todo, key, text_column, max_chars, make_encoder))
    good = done.filter(F.col("embedding").isNotNull()).select(*schema.names)
    good.write.mode("append" if resume else "overwrite").parquet(out)
    manifest = embedding.manifest(done, key, model, documents.count()).first().asDict()
    return {**manifest, "products_embedded": spark.read.parquet(out).count(), "output_path": out}


def index_vectors(embedded: DataFrame, path: str, id_column: str, recreate: bool = False) -> int:
    """Points into a keyed vector table: new from scratch, or upserted by id. Returns the points written."""
    points = cut_lineage(vector.vector_table(embedded, id_column))
    if recreate:
        tables.create(points, path, ["point_id"])
    else:
        tables.apply(points, path, ["point_id"])
    return points.count()


def evaluate(products: DataFrame, benchmark: DataFrame, points: DataFrame | None = None,
             all_indexed: bool = False) -> DataFrame:
    """P@k, success@k and reciprocal rank per benchmark query, with the strategy.

    ``benchmark``: query_id, query, top_k, positive_groups and, for the
    semantic system, vector. Without ``points`` the keyword system is run.
    """
    asked = cut_lineage(benchmark)
    if points is not None and not all_indexed:
        products = hybrid.lexical.indexed_products(products, points)
    plan, rows = hybrid.ranked_rows(products, asked.drop("vector") if points is None else asked, points)
    titled = rows.withColumn("title", enrich.title(F.col("label_hint"), F.col("product_id")))
    judged = evaluation.judge(
        titled.select("query_id", "rank", "product_id", "title"), asked, products,
        asked.count() * hybrid.MAX_TOP_K)
    strategy = F.lit(hybrid.KEYWORD) if points is None else F.col("strategy")
    return evaluation.metrics(judged, asked).join(
        plan.select("query_id", strategy.alias("strategy")), "query_id")


def write_evaluation(systems: dict[str, DataFrame], out: str) -> DataFrame:
    """Per-query metrics of each system and their comparison, as JSON."""
    stored = {}
    for name, metrics in systems.items():
        metrics.write.mode("overwrite").json(f"{out}/{name}")
        stored[name] = metrics.sparkSession.read.schema(metrics.schema).json(f"{out}/{name}")
    report = evaluation.compare(stored)
    report.coalesce(1).write.mode("overwrite").json(f"{out}/comparison")
    return report
