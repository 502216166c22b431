"""Registered queries on search, vectors, enrichment and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderspark.functions import ids, numeric, text, vectors
from larderspark.operators import (
    embedding, enrich, evaluation, facets, hybrid, ivf, lexical, lexical_index, lsh, nutrition, product_docs, pruned, ranking, reviews,
    summaries, vector,
)
from larderspark.plans import fixtures, queries_catalog, queries_reviews
from larderspark.plans.queries_reviews import flat
from larderspark.schemas import VECTOR, L, struct
from larderspark.session import cut_lineage, scratch_path
from larderspark.sources import layouts
from larderspark.streaming import jobs

K = 5


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Product documents, stored once: search reads them more than once."""
    return cut_lineage(queries_reviews.documents(spark, sf))


def queries(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.view(spark, sf, "fx_queries")


def benchmark(spark: SparkSession, sf: str) -> DataFrame:
    """Two term groups per query: all its words at odd places, and all at even ones."""
    words = F.split("query", " ")
    at = lambda odd: F.filter(words, lambda w, i: (i % 2 == odd) & (w != ""))
    groups = F.array(at(0), at(1))
    return queries(spark, sf).select("query_id", "query", "top_k", groups.alias("positive_groups"))


def with_vectors(docs: DataFrame) -> DataFrame:
    """Documents and their vectors by the built-in encoder, as one stored table."""
    value = embedding.document_input(F.col("search_text"))
    return cut_lineage(embedding.embed_native(
        docs, "ProductId", value, keep=[c for c in docs.columns if c != "ProductId"]))


def points(table: DataFrame) -> DataFrame:
    return table.select(
        F.col("ProductId").alias("product_id"), "embedding", "review_count",
        F.col("average_score").cast("double").alias("average_score"))


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.table(spark, sf, "embeddings")
    return rows.select(F.col("vec_id").cast("string").alias("product_id"), "vec_id", "embedding", "label")


def centroid_queries(spark: SparkSession, sf: str) -> DataFrame:
    """The mean vector of every label as query vectors."""
    return vector.centroids(embeddings(spark, sf), "label").withColumnRenamed("label", "query_id")


def ann_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector whose id is divisible by 100, and the mean vector of every label as query -1 - label."""
    rows = embeddings(spark, sf).filter("vec_id % 100 = 0").select(
        F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("vector"))
    centres = centroid_queries(spark, sf).select(
        (-1 - F.col("query_id")).cast("long").alias("query_id"), F.col("vector").cast("array<double>").alias("vector"))
    return rows.unionByName(centres)


def six(c: str):
    return numeric.round_even(F.col(c), 6).alias(c)


# --- keyword search -------------------------------------------------------

def lexical_score(spark, sf):
    products = lexical.search_ready(queries_reviews.documents(spark, sf))
    return lexical.lexical_ranking(products, queries(spark, sf), 10).select(
        "query_id", "product_id", "lexical_score", "rank")


def stored_lists(spark, products):
    path = scratch_path(spark, "lexical-index")
    lexical_index.write_index(products, path)
    return lexical_index.read_index(spark, path)


def lexical_indexed(spark, sf):
    """The ranking of ``lexical_score`` from an inverted index."""
    products = lexical.search_ready(queries_reviews.documents(spark, sf))
    return lexical_index.indexed_ranking(stored_lists(spark, products), queries(spark, sf), 10).select(
        "query_id", "product_id", "lexical_score", "rank")


def lexical_rare(spark, sf):
    """Whole documents, asked for the first long word of every document whose id is divisible by 100.

    Most documents have none of these words and are not read.
    """
    docs = fixtures.table(spark, sf, "documents").select("doc_id", "text")
    products = lexical.search_ready(docs, lexical.Columns("doc_id", None, "text", None, None, None, None))
    word = F.regexp_extract(F.lower("text"), "[a-z]{12,}", 0)
    asked = docs.filter("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), word.alias("query"))
    return lexical_index.indexed_ranking(stored_lists(spark, products), cut_lineage(asked), K).select(
        "query_id", "product_id", "lexical_score", "rank")


def lexical_regex(spark, sf):
    """Patterns in place of literals: the queries' words as stems with any ending."""
    products = lexical.search_ready(queries_reviews.documents(spark, sf))
    words = F.slice(F.filter(F.split("query", " "), lambda w: w.rlike("^[a-z]{4,}$")), 1, 2)
    asked = queries(spark, sf).select("query_id", F.array_join(
        F.transform(words, lambda w: F.concat(F.substring(w, 1, 4), F.lit("[a-z]*"))), " ").alias("query"))
    return lexical.lexical_ranking(products, asked, 10, regex=True).select(
        "query_id", "product_id", "lexical_score", "rank")


def catalog_keyword_search(spark, sf):
    """The same ranking on the search documents of the master catalogue."""
    docs = queries_catalog.search_documents(spark, sf)
    products = lexical.search_ready(docs, lexical.CATALOG_COLUMNS)
    asked = fixtures.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("query_id"),
        F.concat(F.lit("brand#"), (F.col("s_nationkey") % 25 + 1).cast("string"),
                 F.lit(" "), F.when(F.col("s_suppkey") % 2 == 0, F.lit("ring")).otherwise(F.lit("powder")))
        .alias("query"))
    return lexical.lexical_ranking(products, asked, K).select(
        "query_id", "product_id", "lexical_score", "rank")


def keyword_records(spark, sf):
    docs = documents(spark, sf)
    return hybrid.keyword_search(lexical.search_ready(docs), queries(spark, sf), K)


def keyword_search(spark, sf):
    return keyword_records(spark, sf).select(
        "query_id", "rank", "product_id", "title", "score", "avg_rating", "nb_reviews",
        "relevance_percent")


def sorted_page(spark, sf):
    rows = keyword_records(spark, sf).select(
        "query_id", "product_id", "score", "avg_rating", "nb_reviews")
    return ranking.page(rows, ["query_id"], ranking.sort_order("rating"), 2, 2)


# --- vectors --------------------------------------------------------------

def vector_search(spark, sf):
    asked = centroid_queries(spark, sf).withColumn("min_score", F.lit(0.1))
    return vector.vector_ranking(embeddings(spark, sf), asked, 10).select(
        "query_id", "product_id", six("cosine"), "rank")


def vector_search_dirty(spark, sf):
    """Vectors with NaN, null and infinite components and zero vectors among the others."""
    def at_third(value):
        return F.transform("embedding", lambda x, i: F.when(i == 3, F.lit(value).cast("float")).otherwise(x))

    dirty = (
        F.when(F.col("vec_id") % 7 == 0, at_third(float("nan"))).when(F.col("vec_id") % 7 == 1, at_third(None))
        .when(F.col("vec_id") % 7 == 2, at_third(float("inf")))
        .when(F.col("vec_id") % 7 == 3, F.transform("embedding", lambda x: F.lit(0).cast("float")))
        .otherwise(F.col("embedding")))
    return vector.vector_ranking(
        embeddings(spark, sf).withColumn("embedding", dirty), centroid_queries(spark, sf), 10
    ).select("query_id", "product_id", six("cosine"), "rank")


def ann_index(spark, sf):
    """Vectors with norm and signatures, stored like an index."""
    rows = embeddings(spark, sf).withColumn("norm", vectors.norm(F.col("embedding")))
    return cut_lineage(lsh.with_codes(rows, "embedding"))


def ann_search(spark, sf):
    return lsh.ann_ranking(ann_index(spark, sf), cut_lineage(ann_queries(spark, sf)), 10).select(
        "query_id", "product_id", six("cosine"), "rank")


def ann_recall(spark, sf):
    asked = cut_lineage(ann_queries(spark, sf))
    exact = vector.vector_ranking(embeddings(spark, sf), asked, 10)
    return lsh.recall(lsh.ann_ranking(ann_index(spark, sf), asked, 10), exact)


def document_points(spark, sf):
    """Hashed vectors of all documents: unlike the given embeddings they have real neighbours."""
    docs = embedding.embed_documents(fixtures.table(spark, sf, "documents"), "doc_id", "text")
    return cut_lineage(docs.select(
        F.col("doc_id").cast("string").alias("product_id"), "doc_id", "embedding",
        F.lit(0).cast("long").alias("review_count"), F.lit(0.0).alias("average_score")))


def document_queries(stored):
    """Every document whose id is divisible by 100."""
    return cut_lineage(stored.filter("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), F.col("embedding").alias("vector")))


def stored_index(spark, stored):
    path = scratch_path(spark, "ivf")
    ivf.write_index(stored, path)
    return ivf.read_index(spark, path)


def ivf_search(spark, sf):
    stored = document_points(spark, sf)
    return ivf.ivf_ranking(stored_index(spark, stored), document_queries(stored), 10).select(
        "query_id", "product_id", six("cosine"), "rank")


def ivf_recall(spark, sf):
    """Queries, and whether recall@10 and the share of exactly scored pairs keep their bounds.

    A result counts if its cosine reaches the exact tenth one: copies of a
    document tie, and any of them is as good.
    """
    stored = document_points(spark, sf)
    asked = document_queries(stored)
    usable = ivf.usable(stored).count()
    short = min(ivf.SHORT, max(20, usable // 10))
    model, points_ = stored_index(spark, stored)
    blocks = ivf.short_lists(model, points_, asked, short)
    lists = sum(rows.count() for _, _, rows in blocks)
    found = ivf.rank_lists(model, blocks, 10)
    exact = cut_lineage(vector.vector_ranking(stored, asked, 10))
    tenth = exact.groupBy("query_id").agg(F.min("cosine").alias("least"), F.count("*").alias("relevant"))
    good = found.join(tenth, "query_id").filter("cosine >= least").groupBy("query_id").agg(F.count("*").alias("good"))
    hits = tenth.join(good, "query_id", "left").agg(
        F.count("*").alias("queries"), F.sum("relevant").alias("relevant"), F.sum(F.coalesce("good", F.lit(0))).alias("good"))
    return hits.select(
        "queries", (F.col("good") >= 0.9 * F.col("relevant")).alias("recall_kept"),
        (F.lit(lists) <= 0.1 * usable * F.col("queries")).alias("share_kept"))


def stored_cells(spark, stored):
    path = scratch_path(spark, "cells")
    pruned.write_cells(stored, path)
    return pruned.read_cells(spark, path)


def vector_search_pruned(spark, sf):
    """The rows of ``vector_search``, by cells with pivots and radii."""
    asked = centroid_queries(spark, sf).withColumn("min_score", F.lit(0.1))
    rows, _ = pruned.pruned_ranking(stored_cells(spark, embeddings(spark, sf)), cut_lineage(asked), 10)
    return rows.select("query_id", "product_id", six("cosine"), "rank")


def document_search_pruned(spark, sf):
    """Best cosines of documents whose id is divisible by 100, among all documents, by cells."""
    stored = document_points(spark, sf)
    rows, _ = pruned.pruned_ranking(stored_cells(spark, stored), document_queries(stored), 10)
    return rows.select("query_id", "rank", six("cosine"))


def vector_search_fallback(spark, sf):
    """Asked of an index that is not there: the exact search answers."""
    asked = centroid_queries(spark, sf).withColumn("min_score", F.lit(0.1))
    rows, strategy = ivf.search_or_exact(spark, scratch_path(spark, "no-index"), embeddings(spark, sf), asked, 10)
    return rows.select("query_id", "product_id", six("cosine"), "rank").withColumn("strategy", F.lit(strategy))


def with_centroid(spark, sf):
    rows = embeddings(spark, sf).join(vector.centroids(embeddings(spark, sf), "label"), "label")
    return vector.cosine_pairs(rows, "embedding", "vector")


def cosine_pairs(spark, sf):
    return with_centroid(spark, sf).select("vec_id", "label", six("cosine"))


def angle_metrics(spark, sf):
    rows = with_centroid(spark, sf).select("vec_id", six("cosine"))
    return rows.select(
        "vec_id", numeric.bounded_cosine(F.col("cosine")).alias("similarity"),
        numeric.angle_degrees(F.col("cosine")).alias("angle"),
        numeric.angle_relevance(F.col("cosine")).alias("relevance"))


def vector_index_build(spark, sf):
    path = scratch_path(spark, "vectors")
    vector.vector_table(embeddings(spark, sf), "vec_id").write.parquet(path)
    return vector.load_points(spark, path).select(
        "point_id", "product_id", F.size("embedding").alias("dimension"),
        numeric.round_even(F.col("norm"), 5).alias("norm"),
        F.get_json_object("payload", "$.label").cast("int").alias("label"))


def vector_index_basic(spark, sf):
    """Older index form of the older documents, with hashed vectors."""
    docs = product_docs.product_documents_basic(
        cut_lineage(reviews.clean_reviews_basic(queries_reviews.raw(spark, sf)), "cleaned"))
    embedded = embedding.embed_native(
        docs, "product_id", F.col("texte_recherche"), 64,
        keep=["note_moyenne", "nb_avis", "texte_recherche", "extraits_utiles"])
    return vector.vector_table_basic(embedded, 64).select(
        "point_id", "product_id", F.size("embedding").alias("dimension"),
        F.char_length(F.get_json_object("payload", "$.texte_recherche")).alias("payload_chars"))


def stable_point_id(spark, sf):
    return fixtures.table(spark, sf, "part").select(
        "p_partkey", ids.stable_point_id(F.concat("p_name", F.lit("-"), "p_partkey")).alias("point_id"))


# --- embeddings -----------------------------------------------------------

def embed_input(spark, sf):
    rows = fixtures.table(spark, sf, "documents")
    return rows.select("doc_id", embedding.document_input(F.col("text")).alias("input"))


def nonzero(df, key):
    # the outer form: the inner one would compute the vector again to test its size
    return df.select(key, F.posexplode_outer("embedding").alias("pos", "x")).filter("x > 0").select(
        key, "pos", numeric.round_even(F.col("x").cast("double"), 5).alias("x"))


def embed_documents(spark, sf):
    return nonzero(embedding.embed_documents(
        fixtures.table(spark, sf, "documents"), "doc_id", "text"), "doc_id")


def embed_stream(spark, sf):
    """Documents arriving as files, some of them twice: every one is embedded once."""
    docs = fixtures.table(spark, sf, "documents").select("doc_id", "text")
    path = scratch_path(spark, "arriving")
    docs.write.parquet(path)
    docs.filter("doc_id % 10 = 3").write.mode("append").parquet(path)
    stream = jobs.read_stream(spark, path, docs.schema, jobs.files_of_batch(spark, path, docs.schema))
    jobs.embed_stream(stream, "doc_id", "text", f"{path}-vectors", f"{path}-progress").awaitTermination()
    return nonzero(jobs.read_embedded(spark, f"{path}-vectors", struct(doc_id=L, embedding=VECTOR)), "doc_id")


def embed_queries(spark, sf):
    asked = fixtures.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return nonzero(embedding.embed_queries(asked).withColumnRenamed("vector", "embedding"), "query_id")


def done_vectors(spark, sf):
    return embeddings(spark, sf).select(F.col("vec_id").alias("doc_id"), "embedding")


def join_embeddings(spark, sf):
    docs = fixtures.table(spark, sf, "documents").select("doc_id", "lang")
    return embedding.join_embeddings(docs, done_vectors(spark, sf), "doc_id").select(
        "doc_id", "lang", F.size("embedding").alias("dimension"))


#: Buckets of the stored tables that are joined in place.
JOIN_BUCKETS = 16


def join_colocated(spark, sf):
    """``join_embeddings`` of tables that lie in the same buckets: no row moves."""
    docs = layouts.write_bucketed(fixtures.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", JOIN_BUCKETS)
    vectors_ = layouts.write_bucketed(done_vectors(spark, sf), "doc_id", JOIN_BUCKETS)
    return embedding.join_embeddings(docs.hint("merge"), vectors_, "doc_id").select(
        "doc_id", "lang", F.size("embedding").alias("dimension"))


def point_lookup(spark, sf):
    """Documents by id: every hundredth, and as many ids that are not there."""
    docs = fixtures.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    path = scratch_path(spark, "by-id")
    layouts.write_lookup(docs, path, ["doc_id"])
    asked = docs.filter("doc_id % 100 = 0").select("doc_id")
    ids_ = [r.doc_id for r in asked.orderBy("doc_id").limit(200).collect()]
    return layouts.lookup(spark, path, "doc_id", ids_ + [-1 - i for i in ids_])


def embed_resume(spark, sf):
    docs = fixtures.table(spark, sf, "documents")
    rows = embedding.resume(docs, done_vectors(spark, sf), "doc_id", "text")
    return rows.select("doc_id", numeric.round_even(
        F.get("embedding", F.lit(0)).cast("double"), 5).alias("x"))


def _length_encoder():
    """A stand-in encoder: refuses texts with a mail sign."""
    def encode(texts):
        if any("@" in t for t in texts):
            raise ValueError("mail address in text")
        return [[float(len(t)), float(t.count(" "))] for t in texts]

    return encode


def embed_manifest(spark, sf):
    docs = fixtures.table(spark, sf, "documents")
    embedded = embedding.embed_documents(docs, "doc_id", "text", 0, _length_encoder)
    return flat(embedding.manifest(embedded, "doc_id", "length"))


def indexed_products(spark, sf):
    docs = fixtures.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("product_id"), "lang")
    return lexical.indexed_products(docs, embeddings(spark, sf))


# --- hybrid search --------------------------------------------------------

def search_inputs(spark, sf, mixed: bool, docs=None):
    """Products, queries with vectors, points; products and points are one table."""
    table = with_vectors(queries_reviews.documents(spark, sf) if docs is None else docs)
    asked = embedding.embed_queries(queries(spark, sf))
    if mixed:  # keyword mode and queries whose embedding failed
        asked = asked.withColumn(
            "mode", F.when(F.col("query_id") % 3 == 0, F.lit("keyword")).otherwise(F.lit("semantic"))
        ).withColumn("vector", F.when(F.col("query_id") % 5 != 0, F.col("vector")))
    return lexical.search_ready(table), asked, points(table)


def hybrid_search(spark, sf):
    products, asked, stored = search_inputs(spark, sf, False)
    rows = hybrid.search(products, asked, stored, all_indexed=True)
    return rows.select(
        "query_id", "rank", "product_id", "title", "score", "avg_rating", "nb_reviews",
        six("semantic_similarity"), "vector_angle_degrees", "relevance_percent", "strategy")


def catalog_hybrid_search(spark, sf):
    """Hybrid search of the master catalogue, whose products have no label: their ids are their titles.

    Every nation asks for an id, or for a brand and a word.
    """
    docs = queries_catalog.search_documents(spark, sf)
    table = cut_lineage(embedding.embed_native(
        docs, "source_product_id", embedding.document_input(F.col("search_text")), keep=["search_text"]))
    key = F.col("n_nationkey")
    asked = embedding.embed_queries(fixtures.table(spark, sf, "nation").select(
        key.alias("query_id"), F.lit(5).alias("top_k"),
        F.when(key % 2 == 0, F.concat(F.lit("usda:"), key.cast("string"))).otherwise(
            F.concat(F.lit("brand#"), (key % 5 + 1).cast("string"), F.lit(" powder"))).alias("query")))
    stored = table.select(
        F.col("source_product_id").alias("product_id"), "embedding", F.lit(0).cast("long").alias("review_count"),
        F.lit(0.0).alias("average_score"))
    rows = hybrid.search(lexical.search_ready(table, lexical.CATALOG_COLUMNS), asked, stored, all_indexed=True)
    return rows.select("query_id", "rank", "product_id", "title", "score", six("semantic_similarity"))


def hybrid_small_pool(spark, sf):
    """A pool below the number of rows asked for is raised to it."""
    products, asked, stored = search_inputs(spark, sf, False)
    rows = hybrid.search(products, asked, stored, hybrid.Weights(pool=2), all_indexed=True)
    return rows.select("query_id", "rank", "product_id", "score")


def search_results(spark, sf):
    products, asked, stored = search_inputs(spark, sf, True)
    return flat(hybrid.search(products, asked, stored, all_indexed=True)).drop("semantic_similarity")


def search_strategy(spark, sf):
    products, asked, stored = search_inputs(spark, sf, True)
    plan, rows = hybrid.ranked_rows(products, asked, stored)
    return hybrid.search_summary(plan, rows, stored.count())


# --- enrichment -----------------------------------------------------------

def display(spark, sf):
    docs = lexical.search_ready(queries_reviews.documents(spark, sf))
    return docs.withColumn("title", enrich.title(F.col("label_hint"), F.col("product_id")))


def samples():
    return F.col("summary_samples"), F.col("text_samples")


def derive_category(spark, sf):
    return display(spark, sf).select(
        "product_id", enrich.category(F.col("title"), *samples(), F.col("label_hint")).alias("category"))


def described(spark, sf):
    return display(spark, sf).withColumn(
        "description", enrich.description(F.col("title"), *samples(), F.col("label_hint")))


def derive_description(spark, sf):
    return described(spark, sf).select("product_id", "description")


def derive_snippets(spark, sf):
    return described(spark, sf).select("product_id", F.array_join(
        enrich.snippets(F.col("title"), F.col("description"), *samples()), " || ").alias("snippets"))


def clip_text(spark, sf):
    rows = fixtures.table(spark, sf, "documents")
    return rows.select("doc_id", text.clip_text(F.col("text")).alias("clip_180"),
                       text.clip_text(F.col("text"), 140).alias("clip_140"))


def facet_filter(spark, sf):
    return enrich.facet_filter(derive_category(spark, sf), ["Farines", "The et infusions"])


def facet_counts(spark, sf):
    return enrich.facet_counts(derive_category(spark, sf))


def facet_bitmaps(spark, sf):
    """Bitmaps of category and whole stars of every product."""
    rows = display(spark, sf).select(
        enrich.category(F.col("title"), *samples(), F.col("label_hint")).alias("category"),
        F.floor("average_score").cast("int").alias("stars"))
    return cut_lineage(facets.bitmaps(rows, {"category": "category", "stars": "stars"}))


def facet_pairs(spark, sf):
    return facets.pair_counts(facet_bitmaps(spark, sf), "category", "stars")


def facet_within(spark, sf):
    """Categories among the products of three or four stars."""
    return facets.filtered_counts(facet_bitmaps(spark, sf), {"stars": ["3", "4"]}, "category").withColumnRenamed("value", "category")


def extractive_summary(spark, sf):
    asked = fixtures.view(spark, sf, "fx_examples").select("product_id")
    return flat(summaries.summarize_requested(queries_reviews.documents(spark, sf), asked))


def summary_prompt(spark, sf):
    return summaries.summary_prompts(queries_reviews.documents(spark, sf))


# --- evaluation -----------------------------------------------------------

def judged_keyword(spark, sf, docs=None, word_ranker=lexical.lexical_ranking):
    products = lexical.search_ready(documents(spark, sf) if docs is None else docs)
    asked = benchmark(spark, sf)
    rows = hybrid.keyword_search(products, asked, K, word_ranker=word_ranker)
    n = asked.count() * K
    return evaluation.judge(rows.select("query_id", "rank", "product_id", "title"), asked, products, n), asked


def eval_relevance(spark, sf):
    judged, _ = judged_keyword(spark, sf)
    return judged.select("query_id", "rank", "product_id", F.col("relevant").cast("int").alias("relevant"))


def keyword_metrics(spark, sf, docs=None, word_ranker=lexical.lexical_ranking):
    return evaluation.metrics(*judged_keyword(spark, sf, docs, word_ranker))


def eval_summary(spark, sf):
    return evaluation.summarize(keyword_metrics(spark, sf)).drop("avg_search_time_ms")


def hybrid_metrics(spark, sf, docs=None, word_ranker=lexical.lexical_ranking):
    products, asked, stored = search_inputs(spark, sf, False, docs)
    plan, rows = hybrid.ranked_rows(products, asked, stored, word_ranker=word_ranker)
    groups = benchmark(spark, sf)
    titled = rows.withColumn("title", enrich.title(F.col("label_hint"), F.col("product_id")))
    judged = evaluation.judge(titled.select("query_id", "rank", "product_id", "title"), groups, products,
                              groups.count() * K)
    return evaluation.metrics(judged, groups).join(plan.select("query_id", "strategy"), "query_id")


def eval_compare(spark, sf):
    """Both systems over the same documents; their words are ranked once, to the larger of both depths."""
    docs = documents(spark, sf)
    pool = hybrid.Weights().pool
    ranked = cut_lineage(lexical.lexical_ranking(lexical.search_ready(docs), queries(spark, sf), pool))

    def cut(_products, _queries, k):
        if k > pool:
            raise ValueError("the stored ranking is not deep enough")
        return ranked.filter(F.col("rank") <= k)

    return evaluation.compare({
        "keyword": keyword_metrics(spark, sf, docs, cut), "semantic": hybrid_metrics(spark, sf, docs, cut),
    }).drop("avg_search_time_ms")


def hybrid_pruned(spark, sf):
    """The rows of ``hybrid_search``: words and vectors only from blocks whose bounds can still reach the result."""
    products, asked, stored = search_inputs(spark, sf, False)
    lists, cells = stored_lists(spark, products), stored_cells(spark, stored)
    rows = hybrid.search(
        products, asked, stored, all_indexed=True,
        ranker=lambda _, q, k: pruned.pruned_ranking(cells, q, k)[0],
        word_ranker=lambda _, q, k: lexical_index.bounded_ranking(lists, q, k)[0])
    return rows.select(
        "query_id", "rank", "product_id", "title", "score", "avg_rating", "nb_reviews",
        six("semantic_similarity"), "vector_angle_degrees", "relevance_percent", "strategy")


def eval_strategies(spark, sf):
    asked = embedding.embed_queries(queries(spark, sf)).withColumn(
        "mode", F.when(F.col("query_id") % 3 == 0, F.lit("keyword")).otherwise(F.lit("semantic"))
    ).withColumn("vector", F.when(F.col("query_id") % 5 != 0, F.col("vector")))
    return evaluation.strategy_counts(hybrid.with_strategy(asked))


def eval_judgements(spark, sf):
    """Vector results judged by label equality, as with imported judgements."""
    asked = cut_lineage(centroid_queries(spark, sf))
    found = vector.vector_ranking(embeddings(spark, sf), asked, 10)
    pairs = embeddings(spark, sf).select(F.col("label").alias("query_id"), "product_id")
    judged = evaluation.judge_by_pairs(found, pairs)
    return evaluation.metrics(judged, asked.select("query_id", F.lit(10).alias("top_k")))


def eval_graded(spark, sf):
    """Keyword results judged by the imported exact judgements."""
    products = lexical.search_ready(documents(spark, sf))
    asked = queries(spark, sf)
    found = lexical.lexical_ranking(products, asked, K)
    pairs = nutrition.relevant_pairs(queries_catalog.examples(spark, sf))
    return evaluation.metrics(evaluation.judge_by_pairs(found, pairs), asked)


QUERIES = {
    "eval_graded": eval_graded,
    "lexical_score": lexical_score,
    "lexical_indexed": lexical_indexed,
    "lexical_rare": lexical_rare,
    "lexical_regex": lexical_regex,
    "catalog_keyword_search": catalog_keyword_search,
    "keyword_search": keyword_search,
    "sorted_page": sorted_page,
    "vector_search": vector_search,
    "vector_search_dirty": vector_search_dirty,
    "hybrid_small_pool": hybrid_small_pool,
    "ann_search": ann_search,
    "ann_recall": ann_recall,
    "ivf_search": ivf_search,
    "ivf_recall": ivf_recall,
    "vector_search_pruned": vector_search_pruned,
    "document_search_pruned": document_search_pruned,
    "vector_search_fallback": vector_search_fallback,
    "cosine_pairs": cosine_pairs,
    "angle_metrics": angle_metrics,
    "vector_index_build": vector_index_build,
    "vector_index_basic": vector_index_basic,
    "stable_point_id": stable_point_id,
    "embed_input": embed_input,
    "embed_documents": embed_documents,
    "embed_queries": embed_queries,
    "embed_stream": embed_stream,
    "join_embeddings": join_embeddings,
    "join_colocated": join_colocated,
    "point_lookup": point_lookup,
    "embed_resume": embed_resume,
    "embed_manifest": embed_manifest,
    "indexed_products": indexed_products,
    "hybrid_search": hybrid_search,
    "hybrid_pruned": hybrid_pruned,
    "catalog_hybrid_search": catalog_hybrid_search,
    "search_results": search_results,
    "search_strategy": search_strategy,
    "derive_category": derive_category,
    "derive_description": derive_description,
    "derive_snippets": derive_snippets,
    "clip_text": clip_text,
    "facet_filter": facet_filter,
    "facet_counts": facet_counts,
    "facet_pairs": facet_pairs,
    "facet_within": facet_within,
    "extractive_summary": extractive_summary,
    "summary_prompt": summary_prompt,
    "eval_relevance": eval_relevance,
    "eval_metrics": keyword_metrics,
    "eval_summary": eval_summary,
    "eval_strategies": eval_strategies,
    "eval_compare": eval_compare,
    "eval_judgements": eval_judgements,
}
