import math
import random
import re
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larderspark.plans import queries_search, search_jobs
from larderspark.sources import tables
from larderspark.operators import blocks, embedding, enrich, evaluation, hybrid, lexical, lsh, ranking, summaries, vector

WORDS = ["tea", "the", "other", "green", "c++", "a.b", "aa", "aaa", "bar", "é"]


def documents(spark, n=200, seed=1):
    rng = random.Random(seed)
    rows = [(f"p{i:03d}", " ".join(rng.choices(WORDS, k=2)) if i % 5 else None, rng.choice([1, 2]),
             float(rng.choice([3, 4])), " ".join(rng.choices(WORDS, k=12))) for i in range(n)]
    return rows, spark.createDataFrame(
        rows, "ProductId string, label_hint string, review_count int, average_score double, search_text string"
    ).withColumns({c: F.array().cast("array<string>") for c in ("summary_samples", "text_samples")})


def count(text, needle):
    return text.count(needle)


def brute_force(rows, query, k):
    phrase = query.strip().lower()
    scored = []
    for product, label, reviews, rating, text in rows:
        text, label = text.lower(), (label or "").lower()
        score = 3 * count(text, phrase) + 5 * count(label, phrase)
        score += sum(count(text, t) + 2 * count(label, t) for t in phrase.split())
        if phrase and score > 0:
            scored.append((-score, -reviews, -rating, product))
    return [(r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]


QUERIES = [(1, "tea"), (2, "the tea"), (3, "  Green   TEA "), (4, "c++"), (5, "."), (6, " "), (7, "aa aa"),
           (8, "zzz"), (9, "tea"), (10, "aaa"), (11, "É")]


@pytest.mark.parametrize("block_bytes", [10**9, 20000])
def test_lexical_against_brute_force(spark, block_bytes):
    rows, df = documents(spark)
    queries = spark.createDataFrame(QUERIES, "query_id int, query string").repartition(3)
    got = lexical.lexical_ranking(lexical.search_ready(df.repartition(5)), queries, 7, block_bytes=block_bytes)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.product_id, r.lexical_score))
    for query_id, query in QUERIES:
        assert sorted(found.get(query_id, [])) == brute_force(rows, query, 7), query


def test_expression_and_scan_agree(spark):
    _, df = documents(spark, 40)
    products = lexical.search_ready(df)
    queries = spark.createDataFrame(QUERIES, "query_id int, query string")
    terms = [r for r in lexical.query_terms(queries).collect()]
    scan = {(r.query_id, r.product_id): r.lexical_score
            for r in lexical.lexical_ranking(products, queries, 1000).collect()}
    for t in terms:
        expression = lexical.lexical_score(F.col("text_lower"), F.col("label_lower"), F.lit(t.phrase),
                                           F.array(*[F.lit(x) for x in t.terms]))
        for r in products.select("product_id", expression.alias("s")).collect():
            assert scan.get((t.query_id, r.product_id), 0.0) == r.s


def test_regex_mode(spark):
    rows, df = documents(spark, 40)
    products = lexical.search_ready(df)
    dot = spark.createDataFrame([(1, "a.b")], "query_id int, query string")
    got = {r.product_id: r.lexical_score for r in lexical.lexical_ranking(products, dot, 100, regex=True).collect()}
    for product, label, _, _, body in rows:
        times = 4 * len(re.findall("a.b", body.lower())) + 7 * len(re.findall("a.b", (label or "").lower()))
        assert got.get(product, 0) == times
    with pytest.raises(Exception, match="multiple repeat"):
        lexical.lexical_ranking(
            products, spark.createDataFrame([(1, "c++++")], "query_id int, query string"), 5, regex=True).collect()


def test_no_queries_or_documents(spark):
    _, df = documents(spark, 5)
    products = lexical.search_ready(df)
    none = spark.createDataFrame([], "query_id int, query string")
    assert lexical.lexical_ranking(products, none, 5).count() == 0
    some = spark.createDataFrame([(1, "tea")], "query_id int, query string")
    assert lexical.lexical_ranking(products.limit(0), some, 5).count() == 0


def test_blocks_are_bounded(spark):
    df = spark.range(1000).withColumn("size", F.lit(10))
    parts = blocks.bounded_blocks(df, "id", F.col("size"), 1000)
    assert len(parts) > 10 and max(p.count() for p in parts) <= 100
    assert sum(p.count() for p in parts) == 1000
    with pytest.raises(ValueError, match="one row"):
        blocks.bounded_blocks(df, "id", F.col("size"), 5)


def test_rows_of_one_key_above_the_bound_are_an_error(spark):
    df = spark.range(200).select(F.lit(1).alias("id"), F.lit(10).alias("size"))
    with pytest.raises(ValueError, match="one id"):
        blocks.bounded_blocks(df, "id", F.col("size"), 1000)


def test_vectors_that_are_not_finite_lose_nothing(spark):
    good = [(f"p{i}", [1.0, i / 10]) for i in range(20)]
    bad = [(f"x{i}", [float("nan"), 1.0]) for i in range(3)] + [("y", [None, 1.0]), ("z", [float("inf"), 1.0]), ("o", [0.0, 0.0])]
    points = spark.createDataFrame(good + bad, "product_id string, embedding array<float>").coalesce(1)
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [float("nan"), 1.0])], "query_id int, vector array<float>")
    got = vector.vector_ranking(points, queries, 3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.product_id) for r in got] == [(1, "p0"), (1, "p1"), (1, "p2")]
    assert lsh.with_codes(points, "embedding").count() == 20


def test_pool_below_top_k_loses_nothing(spark):
    _, df, _, points, _, queries = hybrid_inputs(spark)
    products = lexical.search_ready(df)
    for mode in ("semantic", "keyword"):
        asked = queries.withColumn("mode", F.lit(mode))
        small = hybrid.search(products, asked, points, hybrid.Weights(pool=3), all_indexed=True)
        large = hybrid.search(products, asked, points, hybrid.Weights(pool=10), all_indexed=True)
        columns = ["query_id", "rank", "product_id", "score"]
        assert sorted(small.select(columns).collect()) == sorted(large.select(columns).collect())


def test_scratch_space_must_be_shared(monkeypatch):
    from larderspark import session

    class Remote:
        class sparkContext:
            master = "spark://host"
            getCheckpointDir = staticmethod(lambda: None)
            getConf = staticmethod(dict)

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Remote)


def vectors_and_queries(spark, n=300, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    data = rng.standard_normal((n, dim)).astype(np.float32)
    data[10] = data[20] = data[30]  # equal vectors: ties
    data[40] = 0
    rows = [(f"p{i:03d}", [float(x) for x in v], int(i % 3), float(i % 2)) for i, v in enumerate(data)]
    rows += [("none", None, 0, 0.0), ("empty", [], 0, 0.0)]
    points = spark.createDataFrame(
        rows, "product_id string, embedding array<float>, review_count bigint, average_score double")
    asked = [(0, [float(x) for x in data[30]], None), (1, [float(x) for x in -data[7]], 0.2),
             (2, [0.0] * dim, None), (3, [1.0] * dim, 0.999)]
    queries = spark.createDataFrame(asked, "query_id int, vector array<float>, min_score double")
    return data, points, asked, queries


def exact(data, asked, k):
    out = {}
    for query_id, q, floor in asked:
        q = np.array(q)
        if not q.any():
            continue
        scored = []
        for i, v in enumerate(data.astype(np.float64)):
            if v.any():
                c = round(float(v @ q / np.linalg.norm(v) / np.linalg.norm(q)), 12)
                if floor is None or c >= floor:
                    scored.append((-c, -(i % 3), -float(i % 2), f"p{i:03d}"))
        out[query_id] = [s[3] for s in sorted(scored)[:k]]
    return {q: v for q, v in out.items() if v}


@pytest.mark.parametrize("block_bytes", [10**9, 2300])
def test_vector_ranking_against_brute_force(spark, block_bytes):
    data, points, asked, queries = vectors_and_queries(spark)
    got = {}
    for r in vector.vector_ranking(points.repartition(6), queries, 10, block_bytes).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.product_id)
    assert got == exact(data, asked, 10)
    assert got[0][:3] == ["p020", "p010", "p030"]


def test_vector_dimensions_must_agree(spark):
    _, points, _, _ = vectors_and_queries(spark, 50)
    short = spark.createDataFrame([(1, [1.0, 2.0])], "query_id int, vector array<float>")
    with pytest.raises(Exception, match="different dimensions"):
        vector.vector_ranking(points, short, 3).collect()
    odd = points.select("product_id", "embedding").filter("size(embedding) > 0").unionByName(
        spark.createDataFrame([("x", [1.0])], "product_id string, embedding array<float>"))
    with pytest.raises(Exception, match="dimensions"):
        vector.vector_table(odd, "product_id").collect()
    with pytest.raises(ValueError, match="missing required column"):
        vector.vector_table(odd, "other")


def test_approximate_search_is_exact_on_what_it_finds(spark):
    data, points, asked, queries = vectors_and_queries(spark, 400)
    index = lsh.with_codes(points, "embedding")
    found = lsh.ann_ranking(index, queries, 5)
    blocked = lsh.ann_ranking(index, queries, 5, block_bytes=5000)
    assert sorted(map(tuple, blocked.collect())) == sorted(map(tuple, found.collect()))
    best = vector.vector_ranking(points, queries, 400).select("query_id", "product_id", F.col("cosine").alias("c"))
    joined = found.join(best, ["query_id", "product_id"]).collect()
    assert len(joined) == found.count() and all(r.cosine == r.c for r in joined)
    assert found.groupBy("query_id", "product_id").count().filter("count > 1").count() == 0
    share = lsh.recall(found, vector.vector_ranking(points, queries, 5)).agg(F.avg("recall")).first()[0]
    assert share > 0.8


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_recall_of_the_registered_query(spark, size):
    """Every row with an id divisible by 100 is asked, and nine tenths of its true neighbours are found."""
    sf = Path("/root/testdata") / size
    if not sf.exists():
        pytest.skip("test tables are not here")
    found = queries_search.ann_recall(spark, str(sf)).collect()
    ids = {r.vec_id for r in spark.read.parquet(f"{sf}/embeddings.parquet").filter("vec_id % 100 = 0").collect()}
    assert {r.query_id for r in found if r.query_id >= 0} == ids and len(found) > len(ids)
    for part in (lambda q: q >= 0, lambda q: q < 0):
        rows = [r for r in found if part(r.query_id)]
        assert all(r.relevant == 10 for r in rows)
        assert sum(r.recall for r in rows) / len(rows) >= 0.9


def test_approximate_search_with_one_full_signature(spark):
    """A third of all points share one vector: none is lost, none is doubled."""
    rows = [(f"h{i:04d}", [1.0, 1.0, 1.0, 1.0]) for i in range(1000)] + [
        (f"p{i:04d}", [float(x) for x in np.random.default_rng(i).standard_normal(4)]) for i in range(2000)]
    points = spark.createDataFrame(rows, "product_id string, embedding array<float>")
    queries = spark.createDataFrame([(1, [1.0, 1.0, 1.0, 1.0])], "query_id int, vector array<float>")
    got = lsh.ann_ranking(lsh.with_codes(points, "embedding"), queries, 900).collect()
    assert [r.product_id for r in sorted(got, key=lambda r: r["rank"])] == [f"h{i:04d}" for i in range(900)]


def test_sequential_ids(spark):
    df = spark.range(1000).select(F.format_string("k%04d", "id").alias("key")).repartition(7)
    got = sorted((r.key, r.point_id) for r in vector.sequential_ids(df, "key").collect())
    assert got == [(f"k{i:04d}", i) for i in range(1000)]


def failing_encoder():
    def encode(texts):
        if any(t == "bad" for t in texts):
            raise RuntimeError("refused")
        return [[float(len(t)), 1.0] for t in texts]

    return encode


def test_encoder_failures_are_kept_apart(spark):
    df = spark.createDataFrame([(i, "bad" if i % 4 == 0 else "x" * i) for i in range(40)], "id int, t string")
    done = embedding.embed_documents(df, "id", "t", 5, failing_encoder)
    rows = {r.id: r for r in done.collect()}
    assert rows[4].embedding is None and rows[4].error == "refused" and rows[9].embedding == [5.0, 1.0]
    row = embedding.manifest(done, "id", "m").first()
    assert (row.products_total, row.errors, row.vector_size) == (40, 10, 2)
    assert row.error_samples == sorted(f"{i}: refused" for i in (0, 4, 8, 12, 16))
    assert embedding.join_embeddings(df, done, "id").count() == 30


def test_resume_embeds_only_what_is_missing(spark, collect):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "id int, t string")
    old = spark.createDataFrame([(1, [9.0, 9.0])], "id int, embedding array<float>")
    got = dict(collect(embedding.resume(df, old, "id", "t", make_encoder=failing_encoder)))
    assert got[1] == [9.0, 9.0] and got[2] == [6.0, 1.0] and len(got) == 6


def test_hashed_vectors(spark):
    df = spark.createDataFrame([(1, "Tea tea  green"), (2, "  "), (3, None)], "id int, t string")
    got = {r.id: r.embedding for r in embedding.embed_documents(df, "id", "t").collect()}
    assert sorted(x for x in got[1] if x) == pytest.approx([1 / math.sqrt(5), 2 / math.sqrt(5)])
    assert not any(got[2]) and not any(got[3]) and len(got[2]) == 64
    asked = spark.createDataFrame([(1, "tea"), (2, " ")], "query_id int, query string")
    vectors = {r.query_id: r.vector for r in embedding.embed_queries(asked).collect()}
    assert vectors[2] is None and sum(vectors[1]) == 1.0


def hybrid_inputs(spark):
    rows, df = documents(spark, 60, 5)
    rng = np.random.default_rng(9)
    vecs = {r[0]: rng.standard_normal(6) for r in rows}
    points = spark.createDataFrame(
        [(p, [float(x) for x in v], 1, 3.0) for p, v in vecs.items()],
        "product_id string, embedding array<float>, review_count bigint, average_score double")
    asked = [(i, q, [float(x) for x in rng.standard_normal(6)], 10) for i, (_, q) in enumerate(QUERIES[:5])]
    queries = spark.createDataFrame(asked, "query_id int, query string, vector array<float>, top_k int")
    return rows, df, vecs, points, asked, queries


def hybrid_brute(rows, vecs, query, vector_, k, weights):
    info = {r[0]: r for r in rows}
    q = np.array(vector_, dtype=np.float32).astype(np.float64)

    def cosine(p):
        v = np.array(vecs[p], dtype=np.float32).astype(np.float64)
        return round(float(v @ q / np.linalg.norm(v) / np.linalg.norm(q)), 12)

    semantic = {p: cosine(p) for p in sorted(vecs, key=lambda p: (-cosine(p), p))[:20]}
    lexical_ = {p: s for _, p, s in brute_force(rows, query, 20)}
    sem = {p: cosine(p) for p in {*semantic, *lexical_}}
    top_s, top_l = max(sem.values()), max(lexical_.values(), default=0)
    phrase, out = query.strip().lower(), []
    for p in sem:
        _, label, reviews, rating, text = info[p]
        hit = phrase in (label or p).lower() or phrase in text.lower()
        score = (weights.semantic * sem[p] / top_s + (weights.lexical * lexical_.get(p, 0) / top_l if top_l else 0)
                 + (0.08 if hit else 0) + min(rating / 5, 1) * 0.02 + min(math.log1p(reviews) / 5, 1) * 0.03)
        out.append((-round(score, 6), -reviews, -rating, p))
    return [x[3] for x in sorted(out)[:k]]


@pytest.mark.parametrize("weights", [hybrid.Weights(), hybrid.Weights(semantic=1.0, lexical=0.0)])
def test_hybrid_against_brute_force(spark, weights):
    rows, df, vecs, points, asked, queries = hybrid_inputs(spark)
    result = hybrid.search(lexical.search_ready(df), queries, points, weights)
    got = {}
    for r in result.orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.product_id)
        assert r.strategy == "semantic_hybrid" and r.warning is None and r.relevance_percent is not None
    for query_id, query, vector_, k in asked:
        assert got[query_id] == hybrid_brute(rows, vecs, query, vector_, k, weights)


def test_hybrid_with_signatures(spark):
    """All signature tables wide open: the approximate ranker finds everything."""
    _, df, _, points, _, queries = hybrid_inputs(spark)
    products = lexical.search_ready(df)
    wide = lambda p, q, k: lsh.ann_ranking(p, q, k, tables=40, bits=1)
    index = lsh.with_codes(points, "embedding", 40, 1)
    columns = ["query_id", "rank", "product_id", "score"]
    got = hybrid.search(products, queries, index, ranker=wide).select(*columns)
    assert sorted(got.collect()) == sorted(hybrid.search(products, queries, points).select(*columns).collect())


def test_keyword_only_with_points(spark):
    _, df, _, points, _, queries = hybrid_inputs(spark)
    products = lexical.search_ready(df)
    rows = hybrid.search(products, queries.withColumn("mode", F.lit("keyword")), points, all_indexed=True).collect()
    assert rows and {r.strategy for r in rows} == {"keyword_only"}
    plain = hybrid.search(products, queries.drop("vector")).collect()
    assert len(plain) == len(rows) and {r.strategy for r in plain} == {"lexical_fallback"}


def test_counter_without_automaton(monkeypatch):
    import sys

    patterns = ["aa", "tea", "é", "c++"]
    with_automaton = lexical._literal_counter(patterns)
    monkeypatch.setitem(sys.modules, "ahocorasick", None)
    plain = lexical._literal_counter(patterns)
    for value in ("", "aaaa tea", "té c++++ teatea", "a a"):
        assert with_automaton(value) == plain(value)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab ", min_size=1, max_size=4), min_size=1, max_size=6, unique=True),
       st.text("ab ", max_size=60))
def test_counter_equals_plain_counting(patterns, value):
    counts = lexical._literal_counter(patterns)(value)
    assert counts == {n: value.count(p) for n, p in enumerate(patterns) if p in value}


def test_merge_in_slices_equals_one_top_k(spark, monkeypatch):
    monkeypatch.setattr(ranking, "PARTITIONS_PER_SLICE", 2)
    df = spark.range(0, 3000, 1, 9).select((F.col("id") % 4).alias("q"), (F.col("id") * 7919 % 997).alias("s"), "id")
    order = [F.desc("s"), F.asc("id")]
    merged = ranking.merge_top_k(df, ["q"], order, 10)
    assert sorted(merged.collect()) == sorted(ranking.top_k(df, ["q"], order, 10).collect())


def test_embed_index_evaluate_jobs(spark, tmp_path, collect):
    _, df = documents(spark, 30)
    out, index = str(tmp_path / "vectors"), str(tmp_path / "index")
    first = search_jobs.embed_table(df.limit(10), out, "ProductId", "search_text", "hashed")
    again = search_jobs.embed_table(df, out, "ProductId", "search_text", "hashed")
    assert (first["products_embedded"], again["products_embedded"], again["errors"]) == (10, 30, 0)
    assert again["products_total"] == 30 and again["vector_size"] == 64
    table = df.join(spark.read.parquet(out), "ProductId")
    stored = table.select("ProductId", "embedding", "review_count")
    assert search_jobs.index_vectors(stored.limit(5), index, "ProductId") == 5
    assert search_jobs.index_vectors(stored, index, "ProductId") == 30
    assert tables.read(spark, index).count() == 30
    search_jobs.index_vectors(stored.limit(7), index, "ProductId", recreate=True)
    assert tables.read(spark, index).count() == 7

    asked = spark.createDataFrame(
        [(1, "green tea", 3, [["tea"], ["green"]]), (2, "zzz", 3, [["zzz"]])],
        "query_id int, query string, top_k int, positive_groups array<array<string>>")
    with_vectors = asked.join(embedding.embed_queries(asked.select("query_id", "query")).drop("query"), "query_id")
    points = table.select(F.col("ProductId").alias("product_id"), "embedding", "review_count", "average_score")
    products = lexical.search_ready(df)
    systems = {"keyword": search_jobs.evaluate(products, asked),
               "semantic": search_jobs.evaluate(products, with_vectors, points, all_indexed=True)}
    report = {r.system: r for r in search_jobs.write_evaluation(systems, str(tmp_path / "report")).collect()}
    assert report["keyword"].queries_total == 2 and report["keyword"].success_rate_at_k == 0.5
    assert report["semantic"].success_rate_at_k == 0.5
    got = {r.query_id: r for r in spark.read.json(str(tmp_path / "report" / "semantic")).collect()}
    assert got[1].strategy == "semantic_hybrid" and got[2].mrr == 0.0


def test_strategies(spark):
    _, df, _, points, _, queries = hybrid_inputs(spark)
    mixed = queries.withColumn("mode", F.when(F.col("query_id") == 0, F.lit("keyword"))).withColumn(
        "vector", F.when(F.col("query_id") != 1, F.col("vector"))).withColumn(
        "query", F.when(F.col("query_id") == 2, F.lit(" ")).otherwise(F.col("query")))
    products = lexical.search_ready(df)
    plan, rows = hybrid.ranked_rows(products, mixed, points)
    got = {r.query_id: r for r in hybrid.search_summary(plan, rows, 60).collect()}
    assert [got[i].strategy for i in range(4)] == [
        "keyword_only", "lexical_fallback", "lexical_fallback", "semantic_hybrid"]
    assert got[1].warning and got[0].warning is None and got[2].n_results == 0 and got[3].n_results == 10
    with pytest.raises(Exception, match="top_k must be"):
        hybrid.search(products, queries.withColumn("top_k", F.lit(11)), points).collect()
    with pytest.raises(Exception, match="mode must be"):
        hybrid.search(products, queries.withColumn("mode", F.lit("x")), points).collect()


def test_only_indexed_products(spark, collect):
    _, df = documents(spark, 5)
    products = lexical.search_ready(df).select("product_id")
    index = spark.createDataFrame([("p001",), ("zzz",)], "product_id string")
    assert collect(lexical.indexed_products(products, index)) == [("p001",)]
    assert lexical.indexed_products(products, index.limit(0)).count() == 5


def display(spark, label, summaries_, texts):
    df = spark.createDataFrame([(label, summaries_, texts)], "l string, s array<string>, t array<string>")
    df = df.withColumn("title", enrich.title(F.col("l"), F.lit("P1")))
    df = df.withColumn("d", enrich.description(F.col("title"), F.col("s"), F.col("t"), F.col("l")))
    return df.select("title", "d", enrich.snippets(F.col("title"), F.col("d"), F.col("s"), F.col("t")).alias("sn"),
                     enrich.category(F.col("title"), F.col("s"), F.col("t"), F.col("l")).alias("c")).first()


def test_display_facts(spark):
    row = display(spark, "Good tea", ["Good tea", "good  TEA", "So fine"], ["Good tea.", "I like it. "])
    assert (row.title, row.d, row.sn, row.c) == ("Good tea", "I like it", ["So fine"], "The et infusions")
    row = display(spark, "x", ["x"], None)
    assert (row.d, row.sn, row.c) == ("x.", [], "Produits")
    row = display(spark, None, None, None)
    assert (row.title, row.d, row.sn) == ("P1", enrich.DEFAULT_DESCRIPTION, [])
    assert display(spark, "another cake mix", [], []).c == "Farines"
    assert display(spark, "Other thing", [], []).c == "The et infusions"


def test_summaries(spark):
    docs = spark.createDataFrame(
        [("P1", "Tea", 3, 4.25, ["a", "b", "a ."], ["c", "d", "e", "f"]), ("P2", None, None, None, None, None)],
        "ProductId string, label_hint string, review_count int, average_score double, "
        "summary_samples array<string>, text_samples array<string>")
    asked = spark.createDataFrame([("P1",), ("P2",), ("P9",), ("P9",)], "product_id string")
    got = {r.product_id: r for r in summaries.summarize_requested(docs, asked).collect()}
    assert got["P1"].pros == ["a", "b", "c"] and got["P1"].cons == ["d", "e"]
    assert "3 avis agreges, avec une note moyenne de 4.2/5" in got["P1"].summary
    assert got["P2"].product_label == "P2" and "de 0.0/5" in got["P2"].summary and got["P2"].pros == []
    assert got["P9"].recommendation == "insufficient-data" and len(got) == 3
    answers = spark.createDataFrame(
        [("P1", "Tea", 'Voila {"summary": " ok ", "pros": ["a", " ", "b", "c", "d"], "cons": []} fin'),
         ("P2", "P2", "rien")], "product_id string, product_label string, answer string")
    parsed = summaries.parse_answers(answers).collect()
    assert len(parsed) == 1 and parsed[0].summary == "ok" and parsed[0].pros == ["a", "b", "c"]
    assert parsed[0].recommendation == "Produit correspondant : Tea (P1)."


def test_metrics(spark):
    benchmark = spark.createDataFrame([(1, 3), (2, 3), (3, 3)], "query_id int, top_k int")
    judged = spark.createDataFrame(
        [(1, 1, False), (1, 2, True), (2, 1, False), (2, 4, True)], "query_id int, rank int, relevant boolean")
    got = {r.query_id: (r.precision_at_k, r.success_at_k, r.mrr) for r in evaluation.metrics(judged, benchmark).collect()}
    assert got == {1: (0.3333, 1.0, 0.5), 2: (0.0, 0.0, 0.0), 3: (0.0, 0.0, 0.0)}
    unbounded = evaluation.metrics(judged, benchmark.select("query_id")).orderBy("query_id").collect()
    assert [(r.top_k, r.precision_at_k) for r in unbounded] == [(2, 0.5), (2, 0.5), (1, 0.0)]
    summary = evaluation.summarize(evaluation.metrics(judged, benchmark)).first()
    assert (summary.queries_total, summary.avg_precision_at_k, summary.mrr) == (3, 0.1111, 0.1667)
    nothing = evaluation.summarize(evaluation.metrics(judged, benchmark.limit(0))).first()
    assert (nothing.queries_total, nothing.mrr, nothing.avg_search_time_ms) == (0, 0.0, None)


def test_term_groups(spark):
    df = spark.createDataFrame(
        [("dark Chocolate sugar-free", [["cocoa", "CHOCOLATE"], ["low sugar", "sugar-free"]]), ("dark", [["x"]]),
         ("dark", []), ("dark", None)], "w string, g array<array<string>>")
    got = [r.r for r in df.select(evaluation.group_match(F.lower("w"), F.col("g")).alias("r")).collect()]
    assert got == [True, False, False, False]
