"""SQL checks of the search queries."""

from __future__ import annotations

from larderspark.operators.enrich import CATEGORY_RULES
from larderspark.operators.summaries import PROMPT, RECOMMENDATION, SUMMARY
from larderspark.plans.oracles_catalog import _MASTER_CTES, _MASTER_VIEWS, EXAMPLES
from larderspark.plans.oracles_reviews import BASIC, DOCS
from larderspark.plans.sqltext import CLASS, SPACES, collapse, with_views

PRODUCTS = DOCS + """,
products AS (
  SELECT ProductId AS product_id, label_hint, CAST(review_count AS BIGINT) AS review_count,
         CAST(average_score AS DOUBLE) AS average_score, lower(search_text) AS text_lower,
         lower(coalesce(label_hint, '')) AS label_lower, ss, ts, search_text,
         coalesce(nullif(label_hint, ''), ProductId) AS title
  FROM docs)"""


def occurrences(body: str, needle: str) -> str:
    return f"((length({body}) - length(replace({body}, {needle}, ''))) / length({needle}))"


SCORE = (
    f"3 * {occurrences('text_lower', 'phrase')} + 5 * {occurrences('label_lower', 'phrase')} + "
    f"list_sum(list_transform(terms, lambda t: {occurrences('text_lower', 't')} + "
    f"2 * {occurrences('label_lower', 't')}))"
)
ASKED = f"""
asked AS (SELECT *, string_split_regex(phrase, '{CLASS}+') AS terms
          FROM (SELECT query_id, trim(query, {SPACES}) AS phrase, top_k FROM fx_queries)
          WHERE phrase <> '')"""


def ranking(k: int) -> str:
    return f"""
lex_scores AS (SELECT query_id, product_id, review_count, average_score, {SCORE} AS lexical_score
               FROM asked, products),
lex AS (SELECT * FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY lexical_score DESC, review_count DESC,
                    average_score DESC, product_id) AS INT) AS rank
          FROM lex_scores WHERE lexical_score > 0) WHERE rank <= {k})"""


RECORDS = """
records AS (
  SELECT query_id, rank, product_id, title, lexical_score AS score, lex.average_score AS avg_rating,
         lex.review_count AS nb_reviews,
         CAST(greatest(8, least(99, round_even(100 * lexical_score / max(lexical_score)
              OVER (PARTITION BY query_id), 0))) AS INT) AS relevance_percent
  FROM lex JOIN products USING (product_id))"""


def hashed(c: str) -> str:
    words = f"list_filter(string_split({collapse(f'lower({c})')}, ' '), lambda w: w <> '')"
    return (f"list_transform({words}, lambda w: CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 64)")


def unit(source: str, key: str, c: str, name: str) -> str:
    return f"""
{name}_buckets AS (SELECT {key}, {hashed(c)} AS b FROM {source}),
{name}_counts AS (SELECT {key}, list_transform(range(0, 64), lambda d:
                    CAST(len(list_filter(b, lambda x: x = d)) AS DOUBLE)) AS v FROM {name}_buckets),
{name} AS (SELECT {key}, list_transform(v, lambda x: CAST(x / sqrt(list_sum(list_transform(v, lambda y: y * y)))
                    AS FLOAT)) AS e FROM {name}_counts)"""


HYBRID = f"""
{unit('(SELECT product_id, substring(search_text, 1, 1200) AS t FROM products)', 'product_id', 't', 'pvec').strip()},
{unit("(SELECT query_id, substring(phrase, 1, 512) AS t FROM asked)", 'query_id', 't', 'qvec').strip()},
cosines AS (SELECT query_id, product_id,
                   round_even(list_cosine_similarity(CAST(q.e AS DOUBLE[]), CAST(p.e AS DOUBLE[])), 12) AS cosine
            FROM qvec q, pvec p),
sem AS (SELECT * FROM (
          SELECT c.*, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, review_count DESC,
                 average_score DESC, product_id) AS rn
          FROM cosines c JOIN products USING (product_id)) WHERE rn <= 20),
pool AS (SELECT query_id, product_id, cosine, lexical_score
         FROM (SELECT query_id, product_id FROM sem UNION SELECT query_id, product_id FROM lex)
         JOIN cosines USING (query_id, product_id) LEFT JOIN lex USING (query_id, product_id)),
mixed AS (
  SELECT query_id, product_id, p.title, p.review_count, p.average_score, cosine,
         round_even(0.65::DOUBLE * cosine / max(cosine) OVER q
           + 0.35::DOUBLE * coalesce(CAST(pool.lexical_score AS DOUBLE), 0)
             / coalesce(nullif(CAST(max(pool.lexical_score) OVER q AS DOUBLE), 0), 1)
           + CASE WHEN contains(coalesce(nullif(label_lower, ''), lower(p.product_id)), phrase)
                    OR contains(text_lower, phrase) THEN 0.08::DOUBLE ELSE 0 END
           + least(p.average_score / 5.0::DOUBLE, 1.0) * 0.02::DOUBLE
           + least(ln(1 + p.review_count) / 5.0::DOUBLE, 1.0) * 0.03::DOUBLE, 6) AS score
  FROM pool JOIN products p USING (product_id) JOIN asked USING (query_id)
  WINDOW q AS (PARTITION BY query_id)),
best AS (SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, review_count DESC,
            average_score DESC, product_id) AS INT) AS rank FROM mixed) WHERE rank <= 5)"""


def angle(c: str) -> str:
    return f"round_even(degrees(acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, {c})))), 2)"


def angle_percent(c: str) -> str:
    return (f"CAST(greatest(0, least(100, round_even(100 * (1 - acos(greatest(-1.0::DOUBLE, "
            f"least(1.0::DOUBLE, {c}))) / (pi() / 2)), 0))) AS INT)")


def search(body: str, *more: str, k: int = 5) -> str:
    return with_views(["fx_reviews", "fx_queries"], PRODUCTS, ASKED, ranking(k), *more, body=body)


CENTROIDS = """
cells AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
centroids AS (SELECT label, list(x ORDER BY pos) AS vector
              FROM (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x FROM cells GROUP BY label, pos)
              GROUP BY label),
paired AS (SELECT vec_id, e.label, c.label AS query_id,
                  round_even(list_cosine_similarity(CAST(embedding AS DOUBLE[]), c.vector), 12) AS cosine
           FROM embeddings e, centroids c),
nearest AS (SELECT * FROM (
  SELECT query_id, CAST(vec_id AS VARCHAR) AS product_id, label, cosine,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, CAST(vec_id AS VARCHAR)) AS INT) AS rank
  FROM paired) WHERE rank <= 10)"""


def clip(c: str, limit: int) -> str:
    value = f"trim(regexp_replace({c}, '{CLASS}+', ' ', 'g'), ' .|')"
    return (f"CASE WHEN length({value}) <= {limit} THEN {value} ELSE concat(trim(regexp_replace("
            f"substring({value}, 1, {limit}), ' [^ ]*$', ''), ' ,;:-'), '...') END")


def clean_list(c: str) -> str:
    return f"list_filter(list_transform({c}, lambda x: trim(x, {SPACES})), lambda x: x <> '')"


RULES = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(h, '{w}')" for w in words) + f" THEN '{name}'"
    for name, words in CATEGORY_RULES) + " ELSE 'Produits' END"
SHOWN = f"""
described AS (
  SELECT *, {clean_list('ss')} AS s_list, {clean_list('ts')} AS t_list FROM products),
haystacks AS (
  SELECT product_id, {RULES} AS category FROM (
    SELECT product_id, lower(array_to_string(list_filter(list_concat([title], s_list, t_list,
           [coalesce(label_hint, '')]), lambda w: w <> ''), ' ')) AS h FROM described)),
clipped AS (
  SELECT product_id, title, label_hint, s_list, t_list,
         list_transform(list_concat(t_list, s_list), lambda x: {clip('x', 180)}) AS long_clips,
         list_concat(s_list, t_list) AS all_texts FROM described),
descriptions AS (
  SELECT product_id, title, all_texts,
         coalesce(list_filter(long_clips, lambda x: x <> '' AND lower(x) <> trim(lower(title), {SPACES}))[1],
                  concat(nullif(trim(label_hint), ''), '.'),
                  'Produit reconstruit a partir d''avis clients agreges.') AS description
  FROM clipped),
keyed AS (
  SELECT product_id, title, description, unnest(all_texts) AS t, generate_subscripts(all_texts, 1) AS pos
  FROM descriptions),
firsts AS (
  SELECT product_id, title, description, {clip('t', 140)} AS snippet, pos,
         row_number() OVER (PARTITION BY product_id, lower({collapse('t')}) ORDER BY pos) AS nth FROM keyed),
snippets AS (
  SELECT product_id, array_to_string(list(snippet ORDER BY pos)[1:2], ' || ') AS snippets FROM firsts
  WHERE nth = 1 AND trim(lower(snippet), ' .') NOT IN ('', trim(lower(title), {SPACES}),
        trim(lower(description), ' .')) GROUP BY product_id)"""


def shown(body: str) -> str:
    return with_views(["fx_reviews"], PRODUCTS, SHOWN, body=body)


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_S, _R = SUMMARY.split("%s"), RECOMMENDATION.split("%s")
JUDGED = """
judged AS (
  SELECT query_id, rank, product_id,
         CAST(len(list_filter(terms, lambda t, i: i % 2 = 1 AND t <> '' AND contains(words, t))) > 0
              AND len(list_filter(terms, lambda t, i: i % 2 = 0 AND t <> '' AND contains(words, t))) > 0 AS INT) AS relevant
  FROM (SELECT r.query_id, r.rank, r.product_id, string_split(query, ' ') AS terms,
               lower(concat_ws(' ', r.title, coalesce(p.label_hint, ''), text_lower)) AS words
        FROM {results} r JOIN products p USING (product_id) JOIN fx_queries USING (query_id))),
measured AS (
  SELECT query_id, 5 AS top_k, round_even(coalesce(sum(relevant), 0) / 5.0::DOUBLE, 4) AS precision_at_k,
         CASE WHEN max(relevant) = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS success_at_k,
         coalesce(round_even(1.0::DOUBLE / min(rank) FILTER (WHERE relevant = 1), 4), 0.0::DOUBLE) AS mrr
  FROM fx_queries LEFT JOIN judged USING (query_id) GROUP BY query_id)"""
KEYWORD_JUDGED = RECORDS + "," + JUDGED.format(results="records")
MEANS = """count(*) AS queries_total, round_even(avg(precision_at_k), 4) AS avg_precision_at_k,
           round_even(avg(success_at_k), 4) AS success_rate_at_k, round_even(avg(mrr), 4) AS mrr"""
STRATEGY = """CASE WHEN query_id % 3 = 0 THEN 'keyword_only' WHEN query_id % 5 = 0 THEN 'lexical_fallback'
                   ELSE 'semantic_hybrid' END"""
POINT_ID = """
  SELECT {key}, concat(h[1:8], '-', h[9:12], '-5', h[14:16], '-',
         substr('89ab', CAST(('0x' || h[17:17]) AS INT) % 4 + 1, 1), h[18:20], '-', h[21:32]) AS point_id
  FROM (SELECT {key}, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({name})) AS h FROM {source})"""

MIXED_RECORDS = f"""
mixed_records AS (
  SELECT r.query_id, rank, r.product_id, title, CAST(score AS DOUBLE) AS score, avg_rating, nb_reviews,
         CAST(NULL AS DOUBLE) AS vector_angle_degrees, relevance_percent,
         {STRATEGY.replace('query_id', 'r.query_id')} AS strategy
  FROM records r WHERE {STRATEGY.replace('query_id', 'r.query_id')} <> 'semantic_hybrid'
  UNION ALL
  SELECT query_id, rank, product_id, title, score, average_score, review_count, {angle('cosine')},
         {angle_percent('cosine')}, 'semantic_hybrid' FROM best WHERE {STRATEGY} = 'semantic_hybrid')"""


def json_list(c: str) -> str:
    return f"CAST(to_json({c}[1:4]) AS VARCHAR)"


_P = PROMPT.split("%s")
_PROMPT_PARTS = ("title", "product_id", "format('{:.2f}', round_even(average_score, 2))", "review_count",
                 json_list("s_list"), json_list("t_list"), "title", "product_id")
PROMPT_SQL = "concat(" + ", ".join(
    f"{sql_text(words)}, {part}" for words, part in zip(_P, _PROMPT_PARTS)) + f", {sql_text(_P[-1])})"

HYBRID_ROWS = search(f"""
        SELECT query_id, rank, product_id, title, score, average_score AS avg_rating,
               review_count AS nb_reviews, round_even(cosine, 6) AS semantic_similarity,
               {angle('cosine')} AS vector_angle_degrees, {angle_percent('cosine')} AS relevance_percent,
               'semantic_hybrid' AS strategy FROM best""", HYBRID, k=20)
EMBEDDED = with_views(
    [], unit("(SELECT doc_id, substring(text, 1, 1200) AS t FROM documents)", "doc_id", "t", "vec"), body="""
        SELECT doc_id, CAST(pos - 1 AS INT) AS pos, round_even(CAST(x AS DOUBLE), 5) AS x
        FROM (SELECT doc_id, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM vec) WHERE x > 0""")

ORACLES = {
    "search_results": with_views(
        ["fx_reviews", "fx_queries"], PRODUCTS, ASKED, ranking(20), HYBRID,
        RECORDS.replace("FROM lex ", "FROM (SELECT * FROM lex WHERE rank <= 5) lex "),
        MIXED_RECORDS, SHOWN, body="""
        SELECT m.*, d.description, coalesce(s.snippets, '') AS snippets, category,
               CASE WHEN strategy = 'lexical_fallback' THEN
                 'Semantic search temporarily unavailable; lexical fallback used.' END AS warning
        FROM mixed_records m JOIN descriptions d USING (product_id) JOIN haystacks USING (product_id)
        LEFT JOIN snippets s USING (product_id)"""),
    "summary_prompt": with_views(["fx_reviews"], PRODUCTS, SHOWN, body=f"""
        SELECT product_id, {PROMPT_SQL} AS prompt FROM described"""),
    "lexical_score": search("""
        SELECT query_id, product_id, CAST(lexical_score AS DOUBLE) AS lexical_score, rank FROM lex""", k=10),
    "lexical_indexed": search("""
        SELECT query_id, product_id, CAST(lexical_score AS DOUBLE) AS lexical_score, rank FROM lex""", k=10),
    "lexical_rare": with_views(
        [], f"""
        asked AS (SELECT doc_id AS query_id, regexp_extract(lower(text), '[a-z]{{12,}}', 0) AS phrase FROM documents
                  WHERE doc_id % 100 = 0),
        scores AS (SELECT query_id, CAST(doc_id AS VARCHAR) AS product_id,
                          4 * {occurrences('lower(text)', 'phrase')} AS lexical_score
                   FROM asked JOIN documents ON phrase <> '' AND contains(lower(text), phrase))""", body=f"""
        SELECT query_id, product_id, CAST(lexical_score AS DOUBLE) AS lexical_score, rank FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY lexical_score DESC, product_id) AS INT) AS rank
          FROM scores) WHERE rank <= 5"""),
    "lexical_regex": with_views(
        ["fx_reviews", "fx_queries"], PRODUCTS, """
        asked AS (SELECT query_id, list_transform(list_filter(string_split(query, ' '),
                         lambda w: regexp_full_match(w, '[a-z]{4,}'))[1:2], lambda w: concat(w[1:4], '[a-z]*')) AS terms
                  FROM fx_queries),
        patterns AS (SELECT query_id, unnest(terms) AS p, 1 AS in_text, 2 AS in_label FROM asked
                     UNION ALL SELECT query_id, array_to_string(terms, ' '), 3, 5 FROM asked WHERE len(terms) > 0),
        scores AS (SELECT query_id, product_id, any_value(review_count) AS review_count, any_value(average_score) AS average_score,
                          sum(in_text * len(regexp_extract_all(text_lower, p)) + in_label * len(regexp_extract_all(label_lower, p)))
                          AS lexical_score
                   FROM patterns, products GROUP BY query_id, product_id)""", body="""
        SELECT query_id, product_id, CAST(lexical_score AS DOUBLE) AS lexical_score, rank FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY lexical_score DESC, review_count DESC,
                    average_score DESC, product_id) AS INT) AS rank FROM scores WHERE lexical_score > 0) WHERE rank <= 10"""),
    "catalog_keyword_search": with_views(
        _MASTER_VIEWS, *_MASTER_CTES,
        """asked AS (SELECT query_id, phrase, string_split(phrase, ' ') AS terms FROM (
             SELECT s_suppkey AS query_id, concat('brand#', s_nationkey % 25 + 1, ' ',
                    CASE WHEN s_suppkey % 2 = 0 THEN 'ring' ELSE 'powder' END) AS phrase FROM supplier)),
           products AS (SELECT source_product_id AS product_id, lower(search_text) AS text_lower,
                               '' AS label_lower, 0 AS review_count, 0 AS average_score FROM search_docs)""",
        ranking(5),
        body="SELECT query_id, product_id, CAST(lexical_score AS DOUBLE) AS lexical_score, rank FROM lex"),
    "keyword_search": search("SELECT * REPLACE (CAST(score AS DOUBLE) AS score) FROM records", RECORDS),
    "sorted_page": search("""
        SELECT * FROM (
          SELECT query_id, product_id, CAST(score AS DOUBLE) AS score, avg_rating, nb_reviews,
                 CAST(row_number() OVER (PARTITION BY query_id ORDER BY avg_rating DESC, nb_reviews DESC,
                      score DESC, product_id) AS INT) AS rank FROM records)
        WHERE rank BETWEEN 3 AND 4""", RECORDS),
    "vector_search": with_views([], CENTROIDS, body="""
        SELECT query_id, product_id, round_even(cosine, 6) AS cosine, rank FROM nearest WHERE cosine >= 0.1"""),
    "vector_search_pruned": with_views([], CENTROIDS, body="""
        SELECT query_id, product_id, round_even(cosine, 6) AS cosine, rank FROM nearest WHERE cosine >= 0.1"""),
    "document_search_pruned": with_views(
        [], unit("(SELECT doc_id, substring(text, 1, 1200) AS t FROM documents)", "doc_id", "t", "vec"), """
        known AS (SELECT doc_id, CAST(e AS DOUBLE[]) AS e FROM vec WHERE len(list_filter(e, lambda x: x > 0)) > 0),
        pairs AS (SELECT a.doc_id AS query_id, round_even(list_cosine_similarity(a.e, b.e), 12) AS cosine, b.doc_id
                  FROM known a, known b WHERE a.doc_id % 100 = 0)""", body="""
        SELECT query_id, rank, round_even(cosine, 6) AS cosine FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC) AS INT) AS rank FROM pairs)
        WHERE rank <= 10"""),
    "vector_search_fallback": with_views([], CENTROIDS, body="""
        SELECT query_id, product_id, round_even(cosine, 6) AS cosine, rank, 'exact' AS strategy
        FROM nearest WHERE cosine >= 0.1"""),
    "ivf_recall": f"""
        SELECT count(*) AS queries, true AS recall_kept, true AS share_kept FROM documents
        WHERE doc_id % 100 = 0 AND len({hashed('substring(text, 1, 1200)')}) > 0""",
    "vector_search_dirty": with_views([], CENTROIDS, body="""
        SELECT query_id, product_id, cosine, rank FROM (
          SELECT query_id, CAST(vec_id AS VARCHAR) AS product_id, round_even(cosine, 6) AS cosine,
                 CAST(row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, CAST(vec_id AS VARCHAR)) AS INT) AS rank
          FROM paired WHERE vec_id % 7 > 3) WHERE rank <= 10"""),
    "cosine_pairs": with_views([], CENTROIDS, body="""
        SELECT vec_id, label, round_even(cosine, 6) AS cosine FROM paired WHERE label = query_id"""),
    "angle_metrics": with_views([], CENTROIDS, body=f"""
        SELECT vec_id, c AS similarity, {angle('c')} AS angle, {angle_percent('c')} AS relevance
        FROM (SELECT vec_id, round_even(cosine, 6) AS c FROM paired WHERE label = query_id)"""),
    "vector_index_build": f"""
        SELECT point_id, CAST(vec_id AS VARCHAR) AS product_id, CAST(len(embedding) AS INT) AS dimension,
               round_even(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 5)
               AS norm, label
        FROM embeddings JOIN ({POINT_ID.format(key='vec_id', name='CAST(vec_id AS VARCHAR)', source='embeddings')})
        USING (vec_id)""",
    "vector_index_basic": with_views(["fx_reviews"], BASIC, body="""
        SELECT row_number() OVER (ORDER BY ProductId) - 1 AS point_id, ProductId AS product_id,
               64 AS dimension, CAST(least(500, length(concat(
                 array_to_string(list(Summary ORDER BY Id), ' | '), ' . ',
                 array_to_string(list(Text ORDER BY Id)[1:3], ' ')))) AS INT) AS payload_chars
        FROM basic_kept GROUP BY ProductId"""),
    "stable_point_id": POINT_ID.format(
        key="p_partkey", name="concat(p_name, '-', p_partkey)", source="part"),
    "embed_input": "SELECT doc_id, substring(text, 1, 1200) AS input FROM documents",
    "embed_documents": EMBEDDED,
    "embed_stream": EMBEDDED,
    "embed_queries": with_views(
        [], unit(f"(SELECT item_id, substring(trim(text, {SPACES}), 1, 512) AS t FROM benchmark)",
                 "item_id", "t", "vec"), body="""
        SELECT item_id AS query_id, CAST(pos - 1 AS INT) AS pos, round_even(CAST(x AS DOUBLE), 5) AS x
        FROM (SELECT item_id, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM vec) WHERE x > 0"""),
    "join_embeddings": """SELECT doc_id, lang, CAST(len(embedding) AS INT) AS dimension
                          FROM documents JOIN embeddings ON doc_id = vec_id""",
    "join_colocated": """SELECT doc_id, lang, CAST(len(embedding) AS INT) AS dimension
                         FROM documents JOIN embeddings ON doc_id = vec_id""",
    "point_lookup": """SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (
                       SELECT doc_id FROM documents WHERE doc_id % 100 = 0 ORDER BY doc_id LIMIT 200)""",
    "embed_resume": with_views(
        [], unit("(SELECT doc_id, substring(text, 1, 1200) AS t FROM documents)", "doc_id", "t", "vec"), body="""
        SELECT vec_id AS doc_id, round_even(CAST(embedding[1] AS DOUBLE), 5) AS x FROM embeddings UNION ALL
        SELECT doc_id, round_even(CAST(e[1] AS DOUBLE), 5) FROM vec
        WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)"""),
    "embed_manifest": """
        SELECT count(*) AS products_total, count(*) FILTER (WHERE NOT contains(text, '@')) AS products_embedded,
               count(*) FILTER (WHERE contains(text, '@')) AS errors, 2 AS vector_size, 'length' AS model,
               (SELECT coalesce(array_to_string(list_sort(list(concat(doc_id, ': mail address in text'))), ' || '), '')
                FROM (SELECT doc_id FROM documents WHERE contains(text, '@') ORDER BY doc_id LIMIT 5)) AS error_samples
        FROM documents""",
    "indexed_products": """SELECT CAST(doc_id AS VARCHAR) AS product_id, lang FROM documents
                           WHERE doc_id IN (SELECT vec_id FROM embeddings)""",
    "hybrid_search": HYBRID_ROWS,
    "hybrid_pruned": HYBRID_ROWS,
    "catalog_hybrid_search": with_views(
        _MASTER_VIEWS, *_MASTER_CTES,
        """asked AS (SELECT query_id, phrase, string_split(phrase, ' ') AS terms FROM (
             SELECT n_nationkey AS query_id, CASE WHEN n_nationkey % 2 = 0 THEN concat('usda:', n_nationkey)
                    ELSE concat('brand#', n_nationkey % 5 + 1, ' powder') END AS phrase FROM nation)),
           products AS (SELECT source_product_id AS product_id, search_text, lower(search_text) AS text_lower,
                               '' AS label_lower, 0::BIGINT AS review_count, 0::DOUBLE AS average_score,
                               source_product_id AS title FROM search_docs)""",
        ranking(20),
        HYBRID.replace("cosine / max(cosine) OVER q", "coalesce(cosine / nullif(max(cosine) OVER q, 0), 0)"), body="""
        SELECT query_id, rank, product_id, title, score, round_even(cosine, 6) AS semantic_similarity FROM best"""),
    "hybrid_small_pool": search(
        "SELECT query_id, rank, product_id, score FROM best", HYBRID.replace("rn <= 20", "rn <= 5"), k=5),
    "search_strategy": search(f"""
        SELECT query_id, {STRATEGY} AS strategy,
               CASE WHEN {STRATEGY} = 'lexical_fallback' THEN
                 'Semantic search temporarily unavailable; lexical fallback used.' END AS warning,
               CAST(CASE WHEN {STRATEGY} = 'semantic_hybrid' THEN 5
                    ELSE (SELECT count(*) FROM lex WHERE lex.query_id = f.query_id) END AS BIGINT) AS n_results,
               (SELECT count(*) FROM products) AS total_indexed FROM fx_queries f"""),
    "derive_category": shown("SELECT product_id, category FROM haystacks"),
    "derive_description": shown("SELECT product_id, description FROM descriptions"),
    "derive_snippets": shown("""SELECT product_id, coalesce(snippets, '') AS snippets
                                FROM products LEFT JOIN snippets USING (product_id)"""),
    "clip_text": f"SELECT doc_id, {clip('text', 180)} AS clip_180, {clip('text', 140)} AS clip_140 FROM documents",
    "facet_filter": shown("""SELECT product_id, category FROM haystacks
                             WHERE category IN ('Farines', 'The et infusions')"""),
    "facet_pairs": shown("""
        SELECT category, CAST(CAST(floor(average_score) AS INT) AS VARCHAR) AS stars, count(*) AS n
        FROM haystacks JOIN products USING (product_id) GROUP BY ALL"""),
    "facet_within": shown("""
        SELECT category, count(*) AS n FROM haystacks JOIN products USING (product_id)
        WHERE floor(average_score) IN (3, 4) GROUP BY category"""),
    "facet_counts": shown("SELECT category, count(*) AS n FROM haystacks GROUP BY category"),
    "extractive_summary": with_views(["fx_reviews", "fx_examples"], PRODUCTS, SHOWN, f"""
        parts AS (
          SELECT product_id, title, review_count, average_score,
                 (SELECT list(c ORDER BY pos) FROM (
                    SELECT c, min(pos) AS pos FROM (SELECT {clip('t', 140)} AS c, pos
                      FROM keyed k WHERE k.product_id = products.product_id) GROUP BY c)) AS sn
          FROM products)""", body=f"""
        SELECT a.product_id, coalesce(title, a.product_id) AS product_label,
               CASE WHEN title IS NULL THEN 'No product document is available yet for this identifier.'
                    ELSE concat(title, {sql_text(_S[1])}, review_count, {sql_text(_S[2])},
                         format('{{:.1f}}', round_even(average_score, 1)), {sql_text(_S[3])}) END AS summary,
               coalesce(array_to_string(sn[1:3], ' || '), '') AS pros,
               coalesce(array_to_string(sn[4:5], ' || '), '') AS cons,
               CASE WHEN title IS NULL THEN 'insufficient-data'
                    ELSE concat({sql_text(_R[0])}, title, {sql_text(_R[1])}, a.product_id, {sql_text(_R[2])})
                    END AS recommendation,
               'customer-reviews' AS source_basis
        FROM (SELECT DISTINCT product_id FROM fx_examples) a LEFT JOIN parts USING (product_id)"""),
    "eval_relevance": search("SELECT * FROM judged", KEYWORD_JUDGED),
    "eval_metrics": search("SELECT * FROM measured", KEYWORD_JUDGED),
    "eval_summary": search(f"SELECT {MEANS} FROM measured", KEYWORD_JUDGED),
    "eval_strategies": with_views(["fx_queries"], body=f"""
        SELECT {STRATEGY} AS strategy, count(*) AS n,
               count(*) FILTER (WHERE {STRATEGY} = 'lexical_fallback') AS fallback_runs
        FROM fx_queries GROUP BY ALL"""),
    "eval_compare": search(
        f"SELECT 'keyword' AS system, {MEANS} FROM measured UNION ALL "
        f"SELECT 'semantic', {MEANS} FROM h_measured",
        HYBRID, RECORDS.replace("FROM lex ", "FROM (SELECT * FROM lex WHERE rank <= 5) lex "),
        JUDGED.format(results="records"),
        JUDGED.format(results="best").replace("judged", "h_judged").replace("measured", "h_measured"),
        k=20),
    "eval_graded": with_views(
        ["fx_reviews", "fx_queries", "fx_examples"], PRODUCTS, ASKED, ranking(5), EXAMPLES, body="""
        SELECT query_id, 5 AS top_k, round_even(count(*) FILTER (WHERE hit) / 5.0::DOUBLE, 4) AS precision_at_k,
               CASE WHEN count(*) FILTER (WHERE hit) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS success_at_k,
               coalesce(round_even(1.0::DOUBLE / min(rank) FILTER (WHERE hit), 4), 0.0::DOUBLE) AS mrr
        FROM (SELECT f.query_id, rank, EXISTS (SELECT 1 FROM examples x WHERE x.query_id = l.query_id
                AND x.product_id = l.product_id AND esci_label IN ('E', 'Exact')) AS hit
              FROM fx_queries f LEFT JOIN lex l USING (query_id)) GROUP BY query_id"""),
    "eval_judgements": with_views([], CENTROIDS, body="""
        SELECT query_id, 10 AS top_k, round_even(count(*) FILTER (WHERE label = query_id) / 10.0::DOUBLE, 4)
               AS precision_at_k,
               CASE WHEN count(*) FILTER (WHERE label = query_id) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
               AS success_at_k,
               coalesce(round_even(1.0::DOUBLE / min(rank) FILTER (WHERE label = query_id), 4), 0.0::DOUBLE) AS mrr
        FROM nearest GROUP BY query_id"""),
}
