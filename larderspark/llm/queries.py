"""Registered queries of the training-data operators, and their SQL where SQL can express them.

Each query applies its operator, with production parameters, to the whole
table. Those without SQL are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larderspark.llm import (
    conversation_trie, decontam, embed_dedup, language, line_dedup, packing, periodic_runs, quality, secrets, simhash,
    substring_dedup, toxicity, url_filter,
)
from larderspark.llm.common import read, stored_in_batches


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "removed_lines", "text")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(read(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_pages(read(spark, sf_dir, "pages"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.group_vectors(read(spark, sf_dir, "embeddings"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_documents(read(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_repeats(read(spark, sf_dir, "documents"))
    return stored_in_batches(periodic_runs.digests(periodic_runs.find_runs(docs)), "runs")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(substring_dedup.remove_repeats(read(spark, sf_dir, "documents")))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(read(spark, sf_dir, "conversations"), rebuilt=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_secret_scan, op3_packing, op4_decontamination, op5_language_id,
        op6_quality, op7_toxicity, op8_url_filter, op9_embedding_dedup, op10_simhash_dedup,
        op11_periodic_runs, op12_substring_dedup, op13_conversation_trie,
    )
}

#: crc32 of a decimal id, bit by bit
CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({0}::VARCHAR, ''),
  lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda crc, b: xor(xor(crc, b) >> 1, 3988292384::BIGINT * (xor(crc, b) & 1))), 4294967295::BIGINT)"""

ORACLES: dict[str, str] = {
    # all pairs of equal lines, joined along diagonals to common runs
    "op1_line_dedup": rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents),
w AS (SELECT doc_id, i, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l),
pairs AS (
  SELECT b.doc_id, b.i, b.n, a.doc_id AS other, b.i - a.i AS shift
  FROM w a JOIN w b ON a.line = b.line AND (a.doc_id < b.doc_id OR a.doc_id = b.doc_id AND a.i < b.i)),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, other, shift ORDER BY i) AS island FROM pairs),
runs AS (SELECT *, sum(n) OVER (PARTITION BY doc_id, other, shift, island) AS words FROM islands),
gone AS (SELECT DISTINCT doc_id, i FROM runs WHERE words >= {line_dedup.LEAST_WORDS})
SELECT d.doc_id, coalesce(g.n, 0) AS removed_lines, CASE WHEN g.n IS NULL THEN d.text ELSE coalesce(k.t, '') END AS text
FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)
LEFT JOIN (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS t FROM l ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
) k USING (doc_id)
""",
    # all equal words of all alignments, counted in windows
    "op4_decontamination": rf"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
  FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
bw AS (SELECT item_id, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM b),
runs AS (
  SELECT doc_id, item_id, count(*) OVER (
    PARTITION BY doc_id, item_id, p - q ORDER BY q RANGE BETWEEN CURRENT ROW AND {decontam.WINDOW - 1} FOLLOWING) AS n
  FROM dw JOIN bw USING (word))
SELECT doc_id, item_id, max(n) AS equal_words FROM runs GROUP BY doc_id, item_id HAVING max(n) >= {decontam.EQUAL}
""",
    # all pairs of vectors with equal labels
    "op9_embedding_dedup": rf"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
near AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {embed_dedup.THRESHOLD}),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, r.c AS component_id, e.vec_id = r.c AS kept FROM embeddings e
JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON e.vec_id = r.a
LEFT JOIN (SELECT a, count(*) AS n FROM near GROUP BY a) k ON e.vec_id = k.a
""",
    # all pairs of equal words in a document, joined to stretches
    "op11_periodic_runs": rf"""
WITH d AS (
  SELECT doc_id, {CRC32.format("doc_id")} AS h,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
m AS (SELECT *, len(w) AS n, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a FROM d),
v AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
    w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1]) ELSE w END AS w FROM m),
p AS (SELECT doc_id, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM v),
pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM p x JOIN p y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i
  WHERE 4 * (y.i - x.i) <= x.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches
  WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
  FROM runs GROUP BY doc_id),
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS turn FROM runs)
  WHERE turn = 1),
gone AS (
  SELECT DISTINCT p.doc_id, p.i FROM p JOIN runs r ON p.doc_id = r.doc_id AND p.i >= r.start + r.period AND p.i < r.start + r.length),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM p ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(l.runs, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed l USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)
""",
    # all windows and their least documents
    "op12_substring_dedup": rf"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {substring_dedup.WINDOW - 1}], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {substring_dedup.WINDOW - 2})) AS i FROM d)),
least AS (SELECT words, min(doc_id) AS first FROM windows GROUP BY words),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {substring_dedup.WINDOW})) AS i
  FROM windows JOIN least USING (words) WHERE first < doc_id),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM p ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(g.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id) LEFT JOIN kept k USING (doc_id)
""",
    # all prefixes, joined with those they continue
    "op13_conversation_trie": f"""
WITH own AS (
  SELECT conv_id, {CRC32.format("conv_id")} % 6 AS h, conv_id - conv_id % 100 AS donor,
    list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
convs AS (
  SELECT c.conv_id, list_concat(coalesce(d.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM own c LEFT JOIN own d ON d.conv_id = c.donor),
members AS (
  SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM convs),
paths AS (SELECT conv_id, depth, len(turns) = depth AS ends, turns[1:depth] AS path FROM members),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ends
  FROM paths GROUP BY path, depth),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce((n.n_convs - 1) * length(n.path[-1].text), 0) AS saved
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]),
children AS (
  SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM linked WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked l LEFT JOIN children c USING (conv_id, depth)),
above AS (
  SELECT path[1:d] AS path, d AS depth, n_children, saved FROM (
    SELECT path, n_children, saved, unnest(range(depth + 1)) AS d FROM counted)),
sums AS (
  SELECT path, depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM above GROUP BY path, depth)
SELECT c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, sha256(c.ends) AS ends_sha256
FROM counted c JOIN sums s ON c.path = s.path AND c.depth = s.depth
""",
}
