"""What the models learn from: bounded, per kind, one row per id, whatever the table holds besides."""

import random
import string

from pyspark.sql import functions as F

from larderspark.llm import common, language, quality, secrets, toxicity, url_filter


def test_samples_are_bounded_and_hot_keys_count_once(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    sample = common.bounded_sample(rows, 500, "k").collect()
    assert 200 < len(sample) < 800 and len({r.k for r in sample}) == len(sample)
    assert common.bounded_sample(rows.limit(5), 500, "k").count() == 5
    assert common.bounded_sample(rows.limit(0), 500, "k").count() == 0


def test_repeated_ids_send_one_row_to_the_driver(spark):
    docs = spark.range(3_000).select(
        F.when(F.col("id") < 2_000, F.lit(1)).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = docs.select("doc_id").distinct().select("doc_id", F.lit(1).alias("quality"))
    kept = common.one_text(docs.join(labels, "doc_id"), "doc_id", "quality").collect()
    assert len(kept) == 1_001 and len({r.doc_id for r in kept}) == 1_001
    assert quality.fit_model(docs, labels, 400) is not None
    toxic = labels.select("doc_id", F.pmod("doc_id", F.lit(2)).alias("toxic"))
    assert toxicity.fit_model(docs, toxic, positives=100, unlabelled=100) is not None


def test_a_rare_language_is_learned(spark):
    draw = random.Random(2)
    letters = {"aa": "abcdef", "bb": "ghijkl", "rare": "mnopqr"}
    text = lambda lang: " ".join("".join(draw.choice(letters[lang]) for _ in range(5)) for _ in range(20))
    kinds = ["aa"] * 2_000 + ["bb"] * 2_000 + ["rare"] * 25
    docs = spark.createDataFrame([(i, text(k), k) for i, k in enumerate(kinds)], "doc_id long, text string, lang string")
    model = language.fit_model(docs, 100)
    assert model.languages == ["aa", "bb", "rare"]
    sizes = {r.lang: r["count"] for r in language.language_sample(docs, 100).groupBy("lang").count().collect()}
    assert sizes["rare"] == 25 and 60 < sizes["aa"] < 140 and 60 < sizes["bb"] < 140
    found = language.with_language(docs.filter("lang = 'rare'"), model)
    assert found.filter("language.lang_pred <> 'rare'").isEmpty()
    assert language.identify(docs.limit(0)).count() == 0
    assert language.identify(docs.selectExpr("*", "1 AS language", "2 AS n", "3 AS held_out")).columns == [
        "doc_id", "held_out", "lang_pred", "score"]


def test_secrets_are_learned_from_however_large_the_table(spark, monkeypatch):
    monkeypatch.setattr(secrets, "RANDOM_ROWS", 300)
    monkeypatch.setattr(secrets, "IDENTIFIER_ROWS", 300)
    draw = random.Random(1)
    key = lambda n: "".join(draw.choice(string.ascii_letters + string.digits) for _ in range(n))
    words = "customer address delivery statement international configuration parameter repository".split()
    name = lambda: "_".join(draw.choice(words) for _ in range(4))
    rows = [(i, f"token={key(40)} {name()} {name()}") for i in range(200)] + [(999, f"see {key(40)} here")]
    plain = spark.range(30_000).select((F.col("id") + 10_000).alias("doc_id"), F.concat(
        F.lit("the customer address and the delivery statement of repository "), F.col("id") % 7).alias("text"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for table in (docs, docs.unionByName(plain)):
        assert [r.spans for r in secrets.scan_documents(table).filter("doc_id = 999").collect()] == ["random:4:44"]


def test_very_long_texts_and_urls(spark):
    long = "fine words of a text " * 50_000
    docs = spark.createDataFrame([(1, long), (2, "fool " + long), (3, None)], "doc_id long, text string")
    model = toxicity.Weights(-3.0, {"fool": 6.0})
    assert {r.doc_id: r.score > 0.5 for r in toxicity.with_score(docs, model).collect()} == {1: False, 2: True, 3: False}
    pages = spark.createDataFrame(
        [(1, "http://a.net/" + "x/" * 50_000), (2, "x" * 100_000), (None, "http://b.org/fr/?" + "a=1&" * 20_000), (None, None)],
        "page_id long, url string").selectExpr("*", "1 AS host", "2 AS suffix", "3 AS score")
    found = url_filter.filter_pages(pages)
    assert sorted(((r.page_id, r.rule) for r in found.collect()), key=repr) == sorted(
        [(1, "net/"), (2, None), (None, "org/fr/"), (None, None)], key=repr)
