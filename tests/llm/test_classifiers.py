import numpy as np
import pytest
from pyspark.sql import functions as F

from larderspark.llm import gbt, language, quality, toxicity


@pytest.fixture(scope="module")
def tables(spark):
    sf = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def edges(spark, docs):
    extra = spark.createDataFrame(
        [(-1, None, None), (-2, "", "en"), (-3, "12 34!", "en"), (None, "the of and", "en"), (-4, "the " * 200_000, "en")],
        "doc_id long, text string, lang string")
    return docs.select("doc_id", "text", "lang").unionByName(extra).withColumn("score", F.lit("x")).withColumn("label", F.lit(1))


def test_trees_learn_and_flat_arrays_match_a_walk():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    model = gbt.fit(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.98

    def walk(row):
        total = model.base
        for at in model.roots:
            while model.feature[at] >= 0:
                at = model.left[at] + (row[model.feature[at]] > model.cut[at])
            total += model.value[at]
        return total

    assert np.allclose(model.raw(x[:50]), [walk(r) for r in x[:50]])
    assert gbt.fit(x, np.ones(3000)).score(x[:2]).min() > 0.99
    assert gbt.fit(x[:0], y[:0]).score(x[:1])[0] == 0.5


def test_quality_held_out(spark, tables):
    docs, labels = tables
    found = quality.score_documents(edges(spark, docs), labels)
    assert found.count() == docs.count() + 5
    assert found.filter("score is null or score < 0 or score > 1").isEmpty()
    rows = found.filter("held_out").join(labels, "doc_id").toPandas()
    assert (rows.predicted == rows.quality).mean() > 0.9
    assert quality.score_documents(docs, labels.limit(0)).filter("score <> 0.5").isEmpty()
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and 0.6 * docs.count() < kept.count() < docs.count()
    assert quality.score_documents(docs.limit(0), labels).count() == 0


def test_contradictory_and_null_labels_teach_nothing(spark):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, None), (None, 1), (3, 1), (3, 1), (4, 5)], "doc_id long, quality int")
    learned = quality.training_labels(labels, "quality", 1, -5).collect()
    assert [tuple(r) for r in learned] == [(3, 1)]


def test_toxicity_held_out(spark):
    draw = np.random.default_rng(1)
    words = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(1500):
        text = list(draw.choice(words, 40))
        toxic = i % 7 == 0
        if toxic:
            text[5] = str(draw.choice(["fool", "vermin", "VerminLike"]))
        rows.append((i, " ".join(text)))
        if i % 3 == 0:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows + [(5000, None), (5001, ""), (None, "fool")], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxicity.score_documents(docs, marks)
    assert found.count() == 1503 and found.filter("score is null or score < 0 or score > 1").isEmpty()
    p = found.filter("doc_id < 5000").toPandas()
    assert ((p.predicted == 1) == (p.doc_id % 7 == 0)).mean() > 0.97
    none = toxicity.score_documents(docs, marks.filter("toxic = 0"))
    assert none.filter("predicted <> 0").isEmpty()
    assert toxicity.score_documents(docs.limit(0), marks).count() == 0


def test_risk_is_learned_from_positives_and_unlabelled():
    draw = np.random.default_rng(3)
    clean, bad = draw.random((900, 6)) < 0.3, draw.random((100, 6)) < 0.3
    clean[:, 0], bad[:, 0] = False, True
    unlabelled = np.vstack([clean, bad]).astype(float)
    w, b = toxicity.minimise(bad[:60].astype(float), unlabelled, 0.1)
    score = unlabelled @ w + b
    assert (score[:900] < 0).mean() > 0.99 and (score[900:] > 0).mean() > 0.99


def test_language_held_out(spark, tables):
    docs, _ = tables
    found = language.identify(edges(spark, docs))
    rows = {r.doc_id: r for r in found.filter("doc_id < 0").collect()}
    assert rows[-1].lang_pred == rows[-2].lang_pred == rows[-3].lang_pred == "und"
    assert rows[-4].lang_pred == "en"
    held = found.filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert found.filter("score is null or score < 0 or score > 1").isEmpty()
    unknown = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert unknown.filter("lang_pred <> 'und'").isEmpty()


def test_language_backs_off_to_shorter_grams():
    model = language.Model(["a", "b"], {"known": 0}, {5: {}, 4: {}, 3: {"abc": 1}, 2: {"xy": 2}, 1: {"q": 3}},
                           np.array([[0, -9.0], [-9.0, 0], [0, -9.0], [-9.0, 0]]))
    import pandas as pd

    got = language.predict(model, pd.Series(["known", "zabcz", "zxyz", "zqz", "zzz", "17"]))
    assert got["lang_pred"].tolist() == ["a", "b", "a", "b", "a", "und"]
