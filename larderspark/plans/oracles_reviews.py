"""SQL checks of the review queries."""

from __future__ import annotations

from larderspark.plans.sqltext import SPACES, collapse, normalize, with_views

CLEAN = f"""
normalized AS (
  SELECT Id, {normalize('ProductId')} AS ProductId, {normalize('UserId')} AS UserId,
         {normalize('ProfileName')} AS ProfileName, HelpfulnessNumerator, HelpfulnessDenominator,
         Score, Time, {normalize('Summary')} AS Summary, {normalize('Text')} AS Text
  FROM fx_reviews),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY ProductId, UserId, Score, Time, Summary, Text
                               ORDER BY Id) AS rn
  FROM normalized
  WHERE ProductId <> '' AND (Summary <> '' OR Text <> '') AND Score BETWEEN 1 AND 5
    AND HelpfulnessNumerator <= HelpfulnessDenominator),
cleaned AS (
  SELECT * EXCLUDE (rn), CAST(to_timestamp(Time) AT TIME ZONE 'UTC' AS TIMESTAMP) AS review_timestamp,
         CAST(length(Text) AS INT) AS text_length,
         CASE WHEN HelpfulnessDenominator > 0
              THEN CAST(HelpfulnessNumerator AS DOUBLE) / HelpfulnessDenominator END AS ratio
  FROM numbered WHERE rn = 1)"""

DOCS = CLEAN + """,
ranked AS (
  SELECT *, row_number() OVER best AS rn,
         sum(CASE WHEN Summary <> '' THEN 1 ELSE 0 END) OVER best AS s_rank,
         sum(CASE WHEN Text <> '' THEN 1 ELSE 0 END) OVER best AS t_rank
  FROM cleaned
  WINDOW best AS (PARTITION BY ProductId ORDER BY HelpfulnessDenominator DESC,
                  HelpfulnessNumerator DESC, Score DESC, text_length DESC, Id
                  ROWS UNBOUNDED PRECEDING)),
grouped AS (
  SELECT ProductId, CAST(count(*) AS INT) AS review_count,
         CAST(round_even(CAST(avg(Score) AS DOUBLE), 2) AS FLOAT) AS average_score,
         CAST(round_even(avg(ratio), 3) AS FLOAT) AS average_helpfulness_ratio,
         min(review_timestamp) AS first_review_at, max(review_timestamp) AS last_review_at,
         coalesce(list(Summary ORDER BY rn) FILTER (WHERE Summary <> '' AND s_rank <= 6), []) AS ss,
         coalesce(list(substring(Text, 1, 280) ORDER BY rn)
                  FILTER (WHERE Text <> '' AND t_rank <= 8), []) AS ts
  FROM ranked GROUP BY ProductId),
docs AS (
  SELECT *, ss[1] AS label_hint,
         concat('ProductId: ', ProductId, '. Label hint: ',
                coalesce(ss[1], 'No short label available'),
                '. Average score: ', CAST(average_score AS VARCHAR),
                '. Review count: ', CAST(review_count AS VARCHAR),
                '. Summary evidence: ', coalesce(array_to_string(ss, ' | '), ''),
                '. Review evidence: ', coalesce(array_to_string(ts, ' '), '')) AS search_text
  FROM grouped)"""

BASIC = f"""
basic AS (
  SELECT Id, ProductId, UserId, HelpfulnessNumerator, HelpfulnessDenominator, Score, Time,
         coalesce(trim(Summary, {SPACES}), '') AS Summary, trim(Text, {SPACES}) AS Text
  FROM fx_reviews WHERE ProductId IS NOT NULL AND Text IS NOT NULL AND Score BETWEEN 1 AND 5),
basic_kept AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ProductId, Text ORDER BY Id) AS rn FROM basic)
  WHERE rn = 1)"""

QUANTILE = "list_extract(list_sort(list({v})), CAST(floor({q} * (count(*) - 1) + 0.5) AS BIGINT) + 1)"


def nearest(value: str, q: float) -> str:
    return f"CAST({QUANTILE.format(v=value, q=q)} AS BIGINT)"


def reviews(body: str, extra: str = "") -> str:
    return with_views(["fx_reviews"], CLEAN, extra, body=body)


SIZES = "sizes AS (SELECT ProductId, count(*) AS n FROM cleaned GROUP BY ProductId)"
PER_PRODUCT = f"""
SELECT unnest(['median', 'p90', 'p95', 'max']) AS metric,
       unnest([CAST(floor(quantile_cont(n, 0.5)) AS BIGINT), {nearest('n', 0.9)},
               {nearest('n', 0.95)}, CAST(max(n) AS BIGINT)]) AS value FROM sizes"""
OVERVIEW = """
SELECT unnest(['raw_rows', 'cleaned_rows', 'rows_removed', 'unique_products', 'unique_users']) AS metric,
       unnest([r, n, r - n, p, u]) AS value
FROM (SELECT count(*) AS n, count(DISTINCT ProductId) AS p, count(DISTINCT UserId) AS u,
             (SELECT count(*) FROM fx_reviews) AS r FROM cleaned)"""
TEXT_QUANTILES = (
    f"SELECT {nearest('text_length', 0.5)} AS p50, {nearest('text_length', 0.9)} AS p90, "
    f"{nearest('text_length', 0.99)} AS p99 FROM cleaned"
)

REPORT = f"""
SELECT 'overview' AS section, metric, value FROM ({OVERVIEW})
UNION ALL
SELECT 'checks', unnest(['missing_product_id', 'missing_summary_and_text', 'score_out_of_range',
  'helpfulness_invalid', 'zero_helpfulness_denominator', 'short_reviews_under_80_chars',
  'long_reviews_over_1500_chars']),
  unnest([count(*) FILTER (WHERE ProductId = ''), count(*) FILTER (WHERE Summary = '' AND Text = ''),
  count(*) FILTER (WHERE NOT Score BETWEEN 1 AND 5),
  count(*) FILTER (WHERE HelpfulnessNumerator > HelpfulnessDenominator),
  count(*) FILTER (WHERE HelpfulnessDenominator = 0), count(*) FILTER (WHERE text_length < 80),
  count(*) FILTER (WHERE text_length > 1500)]) FROM cleaned
UNION ALL
SELECT 'score_distribution', CAST(CAST(Score AS INT) AS VARCHAR), count(*) FROM cleaned GROUP BY Score
UNION ALL
SELECT 'reviews_per_product', metric, value FROM ({PER_PRODUCT})
UNION ALL
SELECT 'text_length_quantiles', unnest(['p50', 'p90', 'p99']), unnest([p50, p90, p99])
FROM ({TEXT_QUANTILES})
UNION ALL
SELECT 'year_distribution', CAST(year(review_timestamp) AS VARCHAR), count(*)
FROM cleaned GROUP BY ALL"""

COLUMN_TYPES = {
    "Id": "bigint", "ProductId": "string", "UserId": "string", "ProfileName": "string",
    "HelpfulnessNumerator": "int", "HelpfulnessDenominator": "int", "Score": "float", "Time": "int",
    "Summary": "string", "Text": "string", "review_timestamp": "timestamp_ntz",
    "helpfulness_ratio": "float", "summary_length": "int", "text_length": "int",
    "review_text": "string",
}
LISTING = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{kind}' AS data_type, {i + 1} AS ordinal_position, "
    + ("count(ratio)" if c == "helpfulness_ratio" else "count(*)") + " AS non_null FROM cleaned"
    for i, (c, kind) in enumerate(COLUMN_TYPES.items()))

ORACLES = {
    "schema_listing": reviews(LISTING),
    "seeded_sample": reviews("""
        SELECT ProductId FROM (SELECT DISTINCT ProductId FROM cleaned)
        ORDER BY md5(concat('42:', ProductId)), ProductId LIMIT 500"""),
    "pipeline_outputs": with_views(["fx_reviews"], CLEAN, SIZES, f"report AS ({REPORT})", body="""
        SELECT artefact, true AS exists, rows FROM (
          SELECT 'cleaned_reviews' AS artefact, count(*) AS rows FROM cleaned UNION ALL
          SELECT 'cleaned_reviews_csv', count(*) FROM cleaned UNION ALL
          SELECT 'sample_reviews', least(1000, count(*)) FROM cleaned UNION ALL
          SELECT 'product_documents', count(*) FROM sizes UNION ALL
          SELECT 'sample_products', least(250, count(*)) FROM sizes UNION ALL
          SELECT 'quality_report', count(*) FROM report)"""),
    "scan_reviews": with_views(["fx_reviews"], body="SELECT * FROM fx_reviews"),
    "scan_reviews_by_name": with_views(["fx_reviews"], body="SELECT * EXCLUDE (ProfileName) FROM fx_reviews"),
    "artefact_names": """
        SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '_') AS slug,
               translate(url, ':-.', '___') AS suffix FROM pages""",
    "normalize_text": f"SELECT page_id, {normalize('html')} AS html FROM pages",
    "clean_text": f"""SELECT c.conv_id, c.turn, {collapse('c.text')} AS text, {collapse('n.text')} AS later
                      FROM conversations c LEFT JOIN conversations n ON c.conv_id = n.conv_id AND n.turn = c.turn + 1""",
    "safe_cast": """
        SELECT event_id, CAST(trunc(TRY_CAST(v AS DOUBLE)) AS BIGINT) AS as_long,
               TRY_CAST(v AS DOUBLE) AS as_double
        FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN concat(k, '.0')
                                    WHEN event_id % 7 = 0 THEN concat(k, 'x') ELSE k END AS v
              FROM (SELECT event_id, props->>'$.k' AS k FROM events))""",
    "review_enrich": with_views(["fx_reviews"], body="""
        SELECT Id, CAST(to_timestamp(Time) AT TIME ZONE 'UTC' AS TIMESTAMP) AS review_timestamp,
               round_even(CAST(CAST(CASE WHEN HelpfulnessDenominator > 0
                   THEN CAST(HelpfulnessNumerator AS DOUBLE) / HelpfulnessDenominator END AS FLOAT)
                   AS DOUBLE), 4) AS helpfulness_ratio,
               CAST(length(Summary) AS INT) AS summary_length, CAST(length(Text) AS INT) AS text_length,
               CASE WHEN Summary <> '' THEN concat(Summary, '. ', Text) ELSE Text END AS review_text
        FROM fx_reviews"""),
    "clean_reviews": reviews("SELECT * EXCLUDE (ratio) FROM cleaned"),
    "clean_reviews_basic": with_views(["fx_reviews"], BASIC, body="SELECT * FROM basic_kept"),
    "keep_first_by_key": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn
          FROM lineitem) WHERE rn = 1""",
    "product_documents": with_views(["fx_reviews"], DOCS, body="""
        SELECT ProductId, label_hint, review_count, average_score, average_helpfulness_ratio,
               first_review_at, last_review_at, array_to_string(ss, ' || ') AS summary_samples,
               array_to_string(ts, ' || ') AS text_samples, search_text FROM docs"""),
    "product_documents_basic": with_views(["fx_reviews"], BASIC, body="""
        SELECT ProductId AS product_id, round_even(CAST(avg(Score) AS DOUBLE), 2) AS note_moyenne,
               count(Score) AS nb_avis, round_even(avg(HelpfulnessNumerator), 2) AS helpfulness_moy,
               substring(concat(array_to_string(list(Summary ORDER BY Id), ' | '), ' . ',
                    array_to_string(list(Text ORDER BY Id)[1:3], ' ')), 1, 2000) AS texte_recherche,
               array_to_string(list(Text ORDER BY Id)[1:5], ' || ') AS extraits_utiles
        FROM basic_kept GROUP BY ProductId"""),
    "score_distribution": reviews('SELECT Score, count(*) AS n FROM cleaned GROUP BY Score'),
    "year_distribution": reviews(
        "SELECT CAST(year(review_timestamp) AS INT) AS year, count(*) AS n FROM cleaned GROUP BY ALL"),
    "reviews_per_product": reviews(PER_PRODUCT, SIZES),
    "sketch_ranges": reviews(" UNION ALL ".join(f"""
        SELECT '{name}' AS days, ProfileName, count(*) AS rows, true AS quantiles_kept, true AS sets_kept, true AS shared_kept
        FROM cleaned WHERE {days} GROUP BY ProfileName""" for name, days in (
            ("all", "true"), ("early", "CAST(review_timestamp AS DATE) <= DATE '2011-04-30'"),
            ("late", "CAST(review_timestamp AS DATE) >= DATE '2011-05-01'")))),
    "text_length_quantiles": reviews(
        "SELECT CAST(p50 AS INT) AS p50, CAST(p90 AS INT) AS p90, CAST(p99 AS INT) AS p99 "
        f"FROM ({TEXT_QUANTILES})"),
    "overview_metrics": reviews(OVERVIEW),
    "quality_report": reviews(REPORT, SIZES),
    "length_histogram": reviews("""
        SELECT CASE WHEN text_length >= 20000 THEN 51
                    ELSE CAST(floor(text_length / 400.0) AS BIGINT) + 1 END AS bin, count(*) AS n
        FROM cleaned GROUP BY ALL"""),
    "top_products": with_views(["fx_reviews"], CLEAN, body="""
        SELECT ProductId, CAST(count(*) AS INT) AS review_count,
               CAST(round_even(CAST(avg(Score) AS DOUBLE), 2) AS FLOAT) AS average_score
        FROM cleaned GROUP BY ProductId ORDER BY count(*) DESC, ProductId LIMIT 25"""),
    "head_sample": with_views(["fx_reviews"], DOCS, body="""
        SELECT ProductId, substring(search_text, 1, 200) AS search_text_preview
        FROM docs ORDER BY review_count DESC, ProductId LIMIT 250"""),
    "empty_source": with_views(["fx_reviews"], CLEAN, body="""
        SELECT 'present' AS part, count(DISTINCT ProductId) AS n, CAST(count(*) AS BIGINT) AS reviews
        FROM cleaned"""),
}
