"""Views that shape the given tables like the inputs of a product search.

Each view is one SELECT that Spark and DuckDB both understand, so the
registered query and its SQL check start from the same rows. All of them read
their whole table; dirty rows are made by arithmetic on the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixture name -> (source tables, SELECT)
VIEWS: dict[str, str] = {
    "fx_reviews": """
        SELECT doc_id AS Id,
               concat('P', lpad(CAST(n_chars % 997 AS STRING), 4, '0')) AS ProductId,
               lang AS UserId, source AS ProfileName,
               CAST(CASE WHEN n_chars % 37 = 0 THEN n_chars % 10 + 1
                         ELSE n_chars % (n_chars % 10 + 1) END AS INT) AS HelpfulnessNumerator,
               CAST(n_chars % 10 AS INT) AS HelpfulnessDenominator,
               CAST(CASE WHEN n_chars % 41 = 0 THEN 0 ELSE 1 + n_chars % 5 END AS FLOAT) AS Score,
               CAST(1300000000 + n_chars * 3600 AS INT) AS Time,
               CASE WHEN n_chars % 13 = 0 THEN '' ELSE substring(text, 1, 40) END AS Summary,
               text AS Text
        FROM documents""",
    "fx_queries": """
        SELECT item_id AS query_id, lower(text) AS query, 5 AS top_k FROM benchmark""",
    "fx_examples": """
        SELECT doc_id AS example_id,
               concat(' query  ', CAST(doc_id % 40 AS STRING), ' ') AS query,
               doc_id % 40 AS query_id,
               concat('P', lpad(CAST(doc_id * 7 % 997 AS STRING), 4, '0')) AS product_id,
               'us' AS product_locale,
               CASE WHEN quality = 1 AND toxic = 0 THEN 'E' WHEN quality = 1 THEN 'Substitute'
                    WHEN toxic = 0 THEN 'C' ELSE 'X' END AS esci_label,
               CASE WHEN doc_id % 4 = 0 THEN 'test' ELSE 'train' END AS split,
               quality AS small_version, 1 AS large_version
        FROM labels""",
    "fx_catalog": """
        SELECT p_partkey,
               CASE WHEN k % 11 = 0 THEN concat('X', lpad(CAST(k AS STRING), 12, '0'))
                    WHEN k % 5 = 0 THEN lpad(CAST(k AS STRING), 8, '0')
                    ELSE lpad(CAST(k AS STRING), 13, '0') END AS code,
               CASE WHEN k % 23 = 0 THEN ' ' WHEN k % 29 = 0 THEN 'unknown'
                    WHEN k % 31 = 0 THEN concat(p_name, ' ;  x') ELSE p_name END AS product_name,
               concat('en:', p_brand, '; ') AS brands,
               CASE WHEN k % 7 = 0 THEN ''
                    ELSE concat('en:', lower(p_type), ',, fr:', p_name) END AS categories,
               CASE WHEN k % 3 = 0 THEN concat(p_name, ' powder') ELSE '' END AS ingredients_text,
               CASE WHEN k % 17 = 0 THEN ' N/A ' WHEN k % 2 = 0 THEN 'en:milk;en:soy'
                    ELSE '' END AS allergens,
               substring('abcdefghij', p_size % 10 + 1, 1) AS nutriscore_grade,
               CASE WHEN k % 6 = 0 THEN concat('http://shop.example/', CAST(k AS STRING))
                    ELSE '' END AS url,
               CASE WHEN p_size % 4 = 0 THEN 'nan'
                    ELSE CAST(p_size AS STRING) END AS energy_kcal,
               CASE WHEN p_size % 3 = 0 THEN 'traces'
                    ELSE CAST(p_retailprice AS STRING) END AS proteins
        FROM (SELECT *, CASE WHEN p_partkey % 19 = 0 THEN p_partkey + 1
                             ELSE p_partkey END AS k FROM part) AS parts""",
    "fx_foods": """
        SELECT CAST(p_partkey AS STRING) AS fdc_id, ' foundation  food ' AS data_type,
               upper(concat(p_name, CASE WHEN p_size % 2 = 0 THEN ', raw (' ELSE '  ' END, p_type,
                            CASE WHEN p_size % 2 = 0 THEN ')' ELSE ' ' END)) AS description,
               CASE WHEN p_size % 9 = 0 THEN 'none' WHEN p_size % 2 = 0
                    THEN concat(CAST(p_size AS STRING), '.0')
                    ELSE CAST(p_size AS STRING) END AS food_category_id,
               '2024-04-18' AS publication_date
        FROM part""",
    "fx_categories": """
        SELECT CAST(n_nationkey AS STRING) AS id, CAST(n_regionkey AS STRING) AS code,
               concat(' ', n_name, '  x ') AS description FROM nation""",
    "fx_units": """
        SELECT CAST(n_nationkey AS STRING) AS id,
               CASE WHEN n_nationkey % 8 = 7 THEN ' ' ELSE n_name END AS name FROM nation""",
    "fx_nutrient_names": """
        SELECT CAST(s_suppkey AS STRING) AS id, s_name AS name,
               CAST(s_nationkey AS STRING) AS nutrient_nbr, 'G' AS unit_name,
               CASE WHEN s_suppkey % 3 = 0 THEN 'n/a' ELSE CAST(s_suppkey * 10 AS STRING) END AS rank
        FROM supplier""",
    "fx_nutrients": """
        SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS id,
               CAST(l_partkey AS STRING) AS fdc_id,
               CASE WHEN l_linenumber = 1 THEN '1008' WHEN l_linenumber = 2 THEN '1003'
                    WHEN l_linenumber = 3 THEN '1004'
                    ELSE CAST(2000 + l_linenumber AS STRING) END AS nutrient_id,
               CAST(l_extendedprice AS STRING) AS amount,
               CAST(l_suppkey AS STRING) AS data_points, CAST(l_tax AS STRING) AS min,
               CAST(l_quantity AS STRING) AS max,
               CASE WHEN l_discount = 0 THEN '' ELSE CAST(l_discount AS STRING) END AS median
        FROM lineitem""",
    "fx_portions": """
        SELECT CAST(l_orderkey * 10 + l_linenumber AS STRING) AS id,
               CAST(l_partkey AS STRING) AS fdc_id,
               CAST(l_suppkey % 30 AS STRING) AS measure_unit_id,
               CAST(l_quantity AS STRING) AS amount,
               CAST(l_quantity - 5 AS STRING) AS gram_weight,
               concat(' ', l_returnflag, '  cup') AS portion_description,
               l_linestatus AS modifier
        FROM lineitem""",
}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view over the tables of ``sf_dir``."""
    query = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"FROM {t}" in query}
    for t, df in used.items():
        query = query.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(query, **used)


def catalog_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue view under the column names of the dump."""
    return (
        view(spark, sf_dir, "fx_catalog")
        .withColumnRenamed("energy_kcal", "energy-kcal_100g")
        .withColumnRenamed("proteins", "proteins_100g")
    )
