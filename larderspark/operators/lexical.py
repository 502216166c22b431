"""Keyword ranking: weighted literal counts of the query and its words."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from larderspark.functions import text
from larderspark.operators.blocks import BLOCK_BYTES, bounded_blocks
from larderspark.operators.ranking import merge_top_k
from larderspark.session import cut_lineage

# Weight of a match of the whole query and of one of its words,
# in the search text and in the label.
PHRASE_TEXT, PHRASE_LABEL, WORD_TEXT, WORD_LABEL = 3.0, 5.0, 1.0, 2.0

# A block of queries is bounded by what a task holds for it: patterns and rows.
LEXICAL_BLOCK_BYTES = 4 * BLOCK_BYTES
ROW_BYTES = 160
SPARE_ROWS = 16


@dataclass(frozen=True)
class Columns:
    """Where the search columns are found in a document table."""

    product_id: str = "ProductId"
    label: str | None = "label_hint"
    text: str = "search_text"
    reviews: str | None = "review_count"
    rating: str | None = "average_score"
    summaries: str | None = "summary_samples"
    texts: str | None = "text_samples"


# Documents of the master catalogue have a text and nothing else to rank by.
CATALOG_COLUMNS = Columns("source_product_id", None, "search_text", None, None, None, None)


def search_ready(docs: DataFrame, columns: Columns = Columns()) -> DataFrame:
    """Documents under fixed names, with lower-case text and label."""
    def optional(name: str | None, kind: str) -> Column:
        return F.lit(None).cast(kind) if name is None else F.col(name).cast(kind)

    label = optional(columns.label, "string")
    return docs.select(
        F.col(columns.product_id).cast("string").alias("product_id"),
        label.alias("label_hint"),
        F.coalesce(optional(columns.reviews, "bigint"), F.lit(0)).alias("review_count"),
        F.coalesce(optional(columns.rating, "double"), F.lit(0.0)).alias("average_score"),
        optional(columns.summaries, "array<string>").alias("summary_samples"),
        optional(columns.texts, "array<string>").alias("text_samples"),
        F.lower(F.coalesce(F.col(columns.text), F.lit(""))).alias("text_lower"),
        F.lower(F.coalesce(label, F.lit(""))).alias("label_lower"),
    )


def indexed_products(products: DataFrame, indexed: DataFrame | None, key: str = "product_id") -> DataFrame:
    """Only products that have a vector; all of them when the index is empty."""
    if indexed is None or indexed.isEmpty():
        return products
    return products.join(indexed.select(key), key, "left_semi")


def query_terms(queries: DataFrame) -> DataFrame:
    """query_id, phrase (lower, stripped) and its words; blank queries drop out."""
    phrase = F.lower(text.strip(F.col("query")))
    return (
        queries.select("query_id", phrase.alias("phrase"))
        .filter(F.col("phrase") != "")
        .withColumn("terms", F.split(text.collapse(F.col("phrase")), " "))
    )


def lexical_score(body: Column, label: Column, phrase: Column, terms: Column) -> Column:
    """The score of one query on one document, as a column expression."""
    count = text.literal_count
    words = F.aggregate(
        terms, F.lit(0.0),
        lambda acc, t: acc + count(body, t) * WORD_TEXT + count(label, t) * WORD_LABEL)
    return count(body, phrase) * PHRASE_TEXT + count(label, phrase) * PHRASE_LABEL + words


ORDER = (F.desc, "lexical_score"), (F.desc, "review_count"), (F.desc, "average_score"), (F.asc, "product_id")


def ranking_order() -> list[Column]:
    return [direction(c) for direction, c in ORDER]


def _plan(rows) -> list[tuple]:
    """(query ids, phrase, terms) per distinct phrase: equal queries score once."""
    plan: dict[str, tuple] = {}
    for row in rows:
        plan.setdefault(row.phrase, ([], row.phrase, list(row.terms)))[0].append(row.query_id)
    return list(plan.values())


def _uses(plan: list[tuple]) -> dict[str, list[tuple]]:
    """Every phrase and word, with (query, weight in text, weight in label)."""
    uses: dict[str, dict[int, list[float]]] = {}
    for q, (_, phrase, terms) in enumerate(plan):
        weights = [(phrase, PHRASE_TEXT, PHRASE_LABEL)] + [(t, WORD_TEXT, WORD_LABEL) for t in terms]
        for pattern, in_text, in_label in weights:
            entry = uses.setdefault(pattern, {}).setdefault(q, [0.0, 0.0])
            entry[0] += in_text
            entry[1] += in_label
    return {p: [(q, *w) for q, w in by_query.items()] for p, by_query in uses.items()}


def _literal_counter(patterns: list[str]) -> Callable[[str], dict[int, int]]:
    """Non-overlapping occurrences per pattern, leftmost first, in one walk."""
    try:
        import ahocorasick
    except ImportError:  # one walk per pattern
        return lambda value: {n: value.count(p) for n, p in enumerate(patterns) if p in value}

    automaton = ahocorasick.Automaton()
    for n, pattern in enumerate(patterns):
        automaton.add_word(pattern, (n, len(pattern)))
    automaton.make_automaton()

    def count(value: str) -> dict[int, int]:
        free_from: dict[int, int] = {}
        counts: dict[int, int] = {}
        for end, (n, length) in automaton.iter(value):
            if end - length >= free_from.get(n, -1):
                free_from[n] = end
                counts[n] = counts.get(n, 0) + 1
        return counts

    return count


def _regex_counter(patterns: list[str]) -> Callable[[str], dict[int, int]]:
    """Matches per pattern; an invalid pattern is an error."""
    compiled = [re.compile(p) for p in patterns]

    def count(value: str) -> dict[int, int]:
        found = ((n, sum(1 for _ in p.finditer(value))) for n, p in enumerate(compiled))
        return {n: times for n, times in found if times}

    return count


def _scores(count: Callable[[str], dict[int, int]], uses: list, body: str, label: str) -> dict[int, float]:
    """Score per query: counts first, then each pattern's weights once."""
    scores: dict[int, float] = {}
    for side, value in ((1, body), (2, label)):
        for n, times in count(value).items():
            for use in uses[n]:
                scores[use[0]] = scores.get(use[0], 0.0) + times * use[side]
    return scores


def _best(rows: list[tuple], k: int) -> list[tuple]:
    rows.sort(key=lambda r: (-r[0], -r[1], -r[2], r[3]))
    return rows[:k]


def _scan(plan, k: int, schema: pa.Schema, regex: bool):
    """mapInArrow function: the best ``k`` documents per query of one partition.

    Each text is read once whatever the number of queries, and only the
    current best rows per query are held.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = plan.value
        if not queries:
            return
        patterns = _uses(queries)
        uses = list(patterns.values())
        count = (_regex_counter if regex else _literal_counter)(list(patterns))
        best: dict[int, list[tuple]] = {}
        least: dict[int, float] = {}  # k-th score so far: lower ones cannot get in
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in
                       ("product_id", "text_lower", "label_lower", "review_count", "average_score"))
            for product, body, label, reviews, rating in zip(*columns):
                for q, score in _scores(count, uses, body, label).items():
                    if score < least.get(q, 0.0):
                        continue
                    rows = best.setdefault(q, [])
                    rows.append((score, reviews, rating, product))
                    if len(rows) >= 2 * k + SPARE_ROWS:
                        best[q] = _best(rows, k)
                        least[q] = best[q][-1][0]
        out = [(query_id, *row) for q, rows in best.items()
               for row in _best(rows, k) for query_id in queries[q][0]]
        if out:
            query_id, score, reviews, rating, product = zip(*out)
            arrays = [query_id, product, score, reviews, rating]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, type=f.type) for a, f in zip(arrays, schema)], schema=schema)

    return run


def lexical_ranking(
    products: DataFrame, queries: DataFrame, k: int, regex: bool = False,
    block_bytes: int = LEXICAL_BLOCK_BYTES,
) -> DataFrame:
    """The best ``k`` products per query: score, reviews, rating, then id.

    ``products`` comes from ``search_ready``; ``queries`` has ``query_id`` and
    ``query``. Documents are not shuffled: every partition sends at most ``k``
    rows per query. Literal matching walks each text once for all queries;
    ``regex=True`` has to try every query on every text.
    """
    terms = query_terms(queries)
    held = (2 * k + SPARE_ROWS) * ROW_BYTES
    size = F.octet_length("phrase") + F.octet_length(F.array_join("terms", " ")) + 64 + held
    blocks = bounded_blocks(terms, "query_id", size, block_bytes)
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("product_id", T.StringType()), T.StructField("lexical_score", T.DoubleType()),
        T.StructField("review_count", T.LongType()), T.StructField("average_score", T.DoubleType()),
    ])
    results = [_rank_block(products, block, k, schema, regex) for block in blocks]
    if len(results) > 1:  # one pass per block; each is stored before the next
        results = [cut_lineage(r) for r in results]
    ranked = results[0]
    for other in results[1:]:
        ranked = ranked.unionByName(other)
    return ranked


def _rank_block(products: DataFrame, block: DataFrame, k: int, schema: T.StructType, regex: bool) -> DataFrame:
    spark = products.sparkSession
    plan = spark.sparkContext.broadcast(_plan(block.collect()))  # size checked
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])
    narrow = products.select("product_id", "text_lower", "label_lower", "review_count", "average_score")
    found = narrow.mapInArrow(_scan(plan, k, arrow, regex), schema)
    return merge_top_k(found, ["query_id"], ranking_order(), k)
