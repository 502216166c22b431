"""SQL checks of the catalogue queries."""

from __future__ import annotations

from larderspark.plans.fixtures import TABLES
from larderspark.plans.sqltext import CLASS, SPACES, collapse, with_views


def field(c: str) -> str:
    value = f"regexp_replace(trim({c}, {SPACES}), '\\b[a-z]{{2}}:', '', 'g')"
    value = f"regexp_replace(replace({value}, ';', ','), ',{CLASS}*,', ',', 'g')"
    value = f"trim(regexp_replace({value}, '{CLASS}+', ' ', 'g'), ' ,')"
    return f"CASE WHEN lower({value}) IN ('unknown', 'n/a', '-') THEN '' ELSE {value} END"


def number(c: str) -> str:
    return (f"CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({c} AS VARCHAR) END")


CATALOG = f"""
cat_kept AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY code ORDER BY product_name, brands, categories,
             ingredients_text, allergens, nutriscore_grade, url, energy_kcal, proteins) AS rn
    FROM (SELECT code, trim(product_name) AS product_name, trim(brands) AS brands,
                 trim(categories) AS categories, trim(ingredients_text) AS ingredients_text,
                 trim(allergens) AS allergens, nutriscore_grade, url, energy_kcal, proteins
          FROM fx_catalog)
    WHERE product_name <> '' AND regexp_full_match(code, '[0-9]{{8}}|[0-9]{{13}}')
      AND length(product_name) >= 3
      AND (categories <> '' OR ingredients_text <> '' OR nutriscore_grade IN ('a','b','c','d','e')))
  WHERE rn = 1),
catalog AS (
  SELECT code, {collapse("replace(product_name, ';', ' ')")} AS product_name,
         {field('brands')} AS brand, {field('categories')} AS categories, ingredients_text,
         {field('allergens')} AS allergens,
         CASE WHEN nutriscore_grade IN ('a','b','c','d','e') THEN nutriscore_grade ELSE '' END AS nutriscore,
         TRY_CAST(nullif(energy_kcal, 'nan') AS DOUBLE) AS energy, TRY_CAST(proteins AS DOUBLE) AS protein,
         coalesce(nullif(url, ''), concat('https://world.openfoodfacts.org/product/', code)) AS source_url
  FROM cat_kept
  WHERE lower({collapse("replace(product_name, ';', ' ')")}) NOT IN ('', 'unknown', 'n/a', '-'))"""

CATEGORIES = f"""
cats AS (SELECT CAST(id AS BIGINT) AS id, code, {collapse('description')} AS description FROM fx_categories)"""
FOODS = CATEGORIES + f""",
foods AS (
  SELECT CAST(fdc_id AS BIGINT) AS fdc_id, {collapse('data_type')} AS data_type,
         {collapse('f.description')} AS description,
         CAST(TRY_CAST(food_category_id AS DOUBLE) AS BIGINT) AS food_category_id,
         publication_date, c.description AS food_category
  FROM fx_foods f LEFT JOIN cats c ON c.id = CAST(TRY_CAST(food_category_id AS DOUBLE) AS BIGINT))"""
FACTS = """
facts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY fdc_id, nutrient_id, data_points,
              amount, min_value, max_value, median_value NULLS FIRST) AS rn
    FROM (SELECT CAST(id AS BIGINT) AS id, CAST(fdc_id AS BIGINT) AS fdc_id,
                 CAST(nutrient_id AS BIGINT) AS nutrient_id, CAST(data_points AS BIGINT) AS data_points,
                 CAST(amount AS DOUBLE) AS amount, CAST(min AS DOUBLE) AS min_value,
                 CAST(max AS DOUBLE) AS max_value, TRY_CAST(median AS DOUBLE) AS median_value
          FROM fx_nutrients)
    WHERE amount BETWEEN 0 AND 90000)
  WHERE rn = 1)"""
UNITS = """
units AS (SELECT CAST(id AS BIGINT) AS id, name FROM fx_units WHERE trim(name) <> '')"""
MAIN = f"""
main AS (
  SELECT fdc_id, min_by(amount, id) FILTER (WHERE nutrient_id = 1008) AS energy,
         min_by(amount, id) FILTER (WHERE nutrient_id = 1003) AS protein,
         min_by(amount, id) FILTER (WHERE nutrient_id = 1004) AS fat
  FROM facts WHERE nutrient_id IN (1003, 1004, 1008) GROUP BY fdc_id),
food_texts AS (
  SELECT f.*, concat_ws(' | ', 'Energy: ' || {number('energy')} || ' kcal',
                        'Protein: ' || {number('protein')} || ' g', 'Fat: ' || {number('fat')} || ' g') AS summary
  FROM foods f LEFT JOIN main USING (fdc_id))"""
INITCAP = """array_to_string(list_transform(
  regexp_extract_all(lower({c}), '([a-z0-9]+|[^a-z0-9]+)'),
  lambda x: concat(upper(x[1:1]), x[2:])), '')"""
MASTER = f"""
master AS (
  SELECT concat('off:', code) AS product_id, code AS barcode, product_name, brand, categories,
         ingredients_text, allergens,
         concat_ws(' ', {number('energy')}, {number('protein')}) AS nutrition_summary,
         nutriscore, 'openfoodfacts' AS source_dataset, NULL AS payload_category
  FROM catalog WHERE length(trim(product_name)) > 1
  UNION ALL
  SELECT concat('usda:', fdc_id), CAST(fdc_id AS VARCHAR), {INITCAP.format(c='description')},
         'USDA Foundation Foods', food_category, NULL, NULL, summary, NULL, 'usda', food_category
  FROM food_texts WHERE length(trim(description)) > 1),
search_docs AS (
  SELECT product_id AS source_product_id, source_dataset,
         trim(concat_ws(' ', nullif(trim(product_name), ''), nullif(trim(brand), ''),
              nullif(trim(categories), ''), nullif(left(trim(ingredients_text), 400), ''),
              nullif(trim(allergens), ''),
              CASE WHEN nutriscore IN ('a','b','c','d','e')
                   THEN concat('Nutri-Score ', upper(nutriscore)) END)) AS search_text
  FROM master WHERE length(trim(product_name)) > 1)"""
EXAMPLES = f"""
examples AS (
  SELECT example_id, query_id, CAST(small_version AS BIGINT) AS small_version,
         CAST(large_version AS BIGINT) AS large_version, {collapse('query')} AS query, product_id,
         product_locale, esci_label, split
  FROM fx_examples
  WHERE esci_label IN ('E','S','C','I','Exact','Substitute','Complement','Irrelevant'))"""

_MASTER_VIEWS = ["fx_catalog", "fx_categories", "fx_foods", "fx_nutrients"]
_MASTER_CTES = (CATALOG, FOODS, FACTS, MAIN, MASTER)


def share(c: str, value: str | None = None) -> str:
    return (f"round(CAST(100 AS DECIMAL(20,6)) * count({value or f'nullif({c}, {chr(39) * 2})'})"
            f" / count(*), 1)")


COMPLETE = (
    "SELECT count(*) AS total, " + share("product_name", "product_name") + " AS product_name_pct, "
    + ", ".join(f"{share(c)} AS {c}_pct"
                for c in ("brand", "categories", "ingredients_text", "allergens", "nutriscore"))
    + " FROM catalog")


def catalog(body: str) -> str:
    return with_views(["fx_catalog"], CATALOG, body=body)


def whole(body: str) -> str:
    return with_views(_MASTER_VIEWS, *_MASTER_CTES, body=body)


UPSERTED = """
        SELECT * FROM part WHERE p_partkey NOT IN (SELECT p_partkey * 2 FROM part) UNION ALL
        SELECT p_partkey * 2, p_name, p_brand, p_type, p_size, p_retailprice + 1 FROM part"""
UPSERTED_PARTS = """
        SELECT coalesce(b.c_custkey, s.k) AS c_custkey, coalesce(b.c_name, concat(s.c_name, ' new')) AS c_name,
               coalesce(b.c_nationkey, s.c_nationkey) AS c_nationkey,
               CASE WHEN s.k IS NULL THEN b.c_acctbal ELSE s.c_acctbal + 1 END AS c_acctbal,
               CASE WHEN s.k IS NULL THEN b.c_mktsegment ELSE 'TOUCHED' END AS c_mktsegment
        FROM customer b FULL JOIN (SELECT *, c_custkey * 2 AS k FROM customer) s ON b.c_custkey = s.k"""

ORACLES = {
    "scan_tsv_dump": with_views(["fx_catalog"], body="""
        SELECT code, product_name, brands, categories, ingredients_text, allergens, nutriscore_grade,
               url, energy_kcal AS energy_kcal_100g, proteins AS proteins_100g FROM fx_catalog"""),
    "normalize_payload": with_views(["fx_catalog"], body=f"""
        SELECT code, CASE WHEN trim(product_name) = '' THEN concat('generic ', code)
                          ELSE {collapse('product_name')} END AS product_name,
               {collapse('brands')} AS brand, {collapse('categories')} AS categories,
               {collapse('ingredients_text')} AS ingredients_text, '' AS allergens, '' AS nutriscore,
               TRY_CAST(nullif(energy_kcal, 'nan') AS DOUBLE) AS energy,
               concat('https://world.openfoodfacts.org/product/', code) AS source_url
        FROM fx_catalog WHERE p_partkey % 13 <> 0 AND p_partkey % 37 <> 0"""),
    "barcode_list": with_views(["fx_catalog"], body="""
        SELECT DISTINCT barcode FROM (
          SELECT code AS barcode FROM fx_catalog UNION ALL
          SELECT trim(concat(' ', product_name, ', b ')) FROM fx_catalog WHERE p_partkey % 3 = 1)
        WHERE barcode <> ''"""),
    "valid_codes": with_views(["fx_catalog"], body="""
        SELECT p_partkey, code FROM fx_catalog WHERE regexp_full_match(code, '[0-9]{8}|[0-9]{13}')"""),
    "clean_catalog_field": with_views(["fx_catalog"], body=f"""
        SELECT p_partkey, {field('brands')} AS brands, {field('categories')} AS categories,
               {field('allergens')} AS allergens FROM fx_catalog"""),
    "nutriment_map": with_views(["fx_catalog"], body="""
        SELECT p_partkey, 'energy-kcal_100g' AS nutriment, CAST(energy_kcal AS DOUBLE) AS amount
        FROM fx_catalog WHERE energy_kcal <> 'nan' UNION ALL
        SELECT p_partkey, 'proteins_100g', CAST(proteins AS DOUBLE) FROM fx_catalog
        WHERE proteins <> 'traces'"""),
    "catalog_clean": catalog("""
        SELECT code, product_name, brand, categories, ingredients_text, allergens, nutriscore,
               protein AS proteins, source_url, brand AS payload_brand, energy AS payload_energy
        FROM catalog"""),
    "nutrition_summary": catalog(
        f"SELECT code, concat_ws(' ', {number('energy')}, {number('protein')}) AS summary FROM catalog"),
    "initcap_words": with_views(["fx_foods"], body=f"""
        SELECT fdc_id, {INITCAP.format(c='description')} AS name FROM fx_foods"""),
    "dim_categories": with_views(["fx_categories"], CATEGORIES, body="SELECT * FROM cats"),
    "scan_nutrition": with_views(["fx_foods"], body="SELECT * FROM fx_foods"),
    "dim_foods": with_views(["fx_categories", "fx_foods"], FOODS, body="SELECT * FROM foods"),
    "dim_foundation": with_views(["fx_foods"], body=f"""
        SELECT CAST(fdc_id AS BIGINT) AS fdc_id, food_category_id AS ndb_number,
               {collapse('data_type')} AS footnote FROM fx_foods"""),
    "dim_nutrients": with_views(["fx_nutrient_names"], body="""
        SELECT CAST(id AS BIGINT) AS id, TRY_CAST(rank AS BIGINT) AS rank, name, nutrient_nbr, unit_name
        FROM fx_nutrient_names"""),
    "dim_units": with_views(["fx_units"], UNITS, body="SELECT * FROM units"),
    "fact_nutrients": with_views(["fx_nutrients"], FACTS, body="SELECT * FROM facts"),
    "fact_portions": with_views(["fx_units", "fx_portions"], UNITS, body=f"""
        SELECT p.id, fdc_id, measure_unit_id, amount, gram_weight, portion_description, modifier,
               name AS measure_unit
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY fdc_id, measure_unit_id, amount,
                        gram_weight, portion_description, modifier) AS rn
              FROM (SELECT CAST(id AS BIGINT) AS id, CAST(fdc_id AS BIGINT) AS fdc_id,
                           CAST(measure_unit_id AS BIGINT) AS measure_unit_id,
                           CAST(amount AS DOUBLE) AS amount, CAST(gram_weight AS DOUBLE) AS gram_weight,
                           {collapse('portion_description')} AS portion_description, modifier
                    FROM fx_portions)
              WHERE gram_weight > 0 AND gram_weight <= 10000) p
        LEFT JOIN units u ON u.id = p.measure_unit_id WHERE rn = 1"""),
    "relevance_examples": with_views(["fx_examples"], EXAMPLES, body="SELECT * FROM examples"),
    "food_nutrition": with_views(["fx_categories", "fx_foods", "fx_nutrients"], FOODS, FACTS, MAIN,
                                 body="SELECT fdc_id, food_category, summary FROM food_texts"),
    "products_master": whole("SELECT * EXCLUDE (payload_category) FROM master"),
    "catalog_search_text": whole("SELECT * FROM search_docs"),
    "upsert_merge": UPSERTED,
    "upsert_table": UPSERTED,
    "upsert_stream": UPSERTED,
    "upsert_partial": UPSERTED_PARTS,
    "upsert_partial_table": UPSERTED_PARTS,
    "master_incremental": whole("SELECT * EXCLUDE (payload_category) FROM master"),
    "scan_benchmark": with_views(["fx_queries"], body="""
        SELECT query, top_k,
               array_to_string(list_filter(terms, lambda t, i: i % 2 = 1 AND t <> ''), ' ') AS group_0,
               array_to_string(list_filter(terms, lambda t, i: i % 2 = 0 AND t <> ''), ' ') AS group_1
        FROM (SELECT *, string_split(query, ' ') AS terms FROM fx_queries)"""),
    "export_catalog": whole("""
        SELECT product_id, barcode, product_name, m.source_dataset, search_text, payload_category
        FROM master m JOIN search_docs s ON s.source_product_id = m.product_id"""),
    "quality_gate": whole("""
        SELECT (SELECT count(*) FROM master) AS products_rows,
               (SELECT count(DISTINCT product_id) FROM master) AS products_unique_ids,
               (SELECT count(*) FROM master WHERE trim(product_name) = '') AS blank_product_names,
               (SELECT count(*) FROM search_docs) AS documents_rows,
               (SELECT count(DISTINCT source_product_id) FROM search_docs) AS documents_unique_ids,
               (SELECT count(*) FROM search_docs WHERE trim(search_text) = '') AS blank_search_text,
               '' AS failures, 'passed' AS status"""),
    "run_ledger": """
        SELECT run_id, source, status, row_count, notes, started_at,
               CASE WHEN status <> 'running' THEN ts END AS finished_at
        FROM (SELECT concat('run-', user_id) AS run_id, 'events' AS source,
                     CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'running'
                          ELSE 'succeeded' END AS status,
                     CAST(props->>'$.k' AS BIGINT) AS row_count, props AS notes, ts,
                     min(ts) OVER (PARTITION BY user_id) AS started_at,
                     row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
              FROM events) WHERE rn = 1""",
    "completeness": catalog(COMPLETE),
    "grade_distribution": catalog(
        "SELECT coalesce(nullif(nutriscore, ''), 'inconnu') AS grade, count(*) AS n FROM catalog GROUP BY ALL"),
    "search_text_stats": whole("""
        SELECT count(*) AS total, min(length(search_text)) AS min_chars,
               round(avg(length(search_text)), 0) AS avg_chars,
               quantile_cont(length(search_text), 0.5) AS median_chars,
               max(length(search_text)) AS max_chars,
               count(*) FILTER (WHERE length(search_text) > 512) AS above_512 FROM search_docs"""),
    "rows_by_source": whole("SELECT source_dataset, count(*) AS n FROM master GROUP BY ALL"),
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES),
    "top_brands": catalog("""SELECT brand, count(*) AS n FROM catalog WHERE brand <> ''
                             GROUP BY brand ORDER BY n DESC, brand LIMIT 15"""),
    "top_first_category": catalog("""
        SELECT split_part(categories, ',', 1) AS category, count(*) AS n FROM catalog
        WHERE categories <> '' GROUP BY ALL ORDER BY n DESC, category LIMIT 15"""),
    "catalog_report": with_views([*_MASTER_VIEWS, "fx_examples"], *_MASTER_CTES, EXAMPLES,
                                 f"complete AS ({COMPLETE})", body="""
        SELECT 'row_counts' AS section, 'catalog' AS metric, CAST(count(*) AS DOUBLE) AS value FROM catalog
        UNION ALL SELECT 'row_counts', 'products_master', count(*) FROM master
        UNION ALL SELECT 'row_counts', 'product_search_documents', count(*) FROM search_docs
        UNION ALL SELECT 'row_counts', 'foods', count(*) FROM foods
        UNION ALL SELECT 'row_counts', 'relevance_examples', count(*) FROM examples
        UNION ALL SELECT 'completeness',
          unnest(['product_name_pct', 'brand_pct', 'categories_pct', 'ingredients_text_pct',
                  'allergens_pct', 'nutriscore_pct']),
          unnest([product_name_pct, brand_pct, categories_pct, ingredients_text_pct, allergens_pct,
                  nutriscore_pct]) FROM complete"""),
    "extract_json": """SELECT event_id, CASE WHEN event_id % 3 < 2
                       THEN CAST(props->>'$.k' AS BIGINT) END AS k FROM events""",
}
