import datetime as dt

import pytest
from pyspark.sql import functions as F

from larderspark import schemas
from larderspark.operators import histogram, product_docs, ranking, reports, reviews
from larderspark.operators.dedup import keep_first
from larderspark.plans import pipelines
from larderspark.sources import readers, writers


def review(spark, *rows):
    base = dict(Id=1, ProductId="P1", UserId="u", ProfileName="n", HelpfulnessNumerator=0,
                HelpfulnessDenominator=0, Score=5.0, Time=0, Summary="s", Text="t")
    data = [tuple({**base, "Id": i + 1, **r}[c] for c in schemas.REVIEWS.names) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schemas.REVIEWS)


def ids(df):
    return sorted(r.Id for r in df.select("Id").collect())


def test_validity_rules(spark):
    df = review(
        spark, {}, {"ProductId": " "}, {"Summary": "", "Text": "<p>"}, {"Summary": None, "Text": "x"},
        {"Score": 0.0}, {"Score": None}, {"Score": 6.0},
        {"HelpfulnessNumerator": 2, "HelpfulnessDenominator": 1}, {"HelpfulnessNumerator": None, "Text": "y"})
    assert ids(reviews.clean_reviews(df)) == [1, 4]


def test_keep_first_after_normalising(spark):
    df = review(spark, {"Text": "a  b"}, {"Text": "a <br> b"}, {"Text": "a b", "UserId": "v"})
    assert ids(reviews.clean_reviews(df)) == [1, 3]


def test_cleaning_is_idempotent(spark):
    df = review(spark, {"Text": "a  <b>b"}, {"Text": "a b"}, {"Score": 3.0})
    once = reviews.clean_reviews(df).select(*schemas.REVIEWS.names)
    assert sorted(reviews.clean_reviews(once).select(*schemas.REVIEWS.names).collect()) == sorted(once.collect())


def test_enrich(spark):
    row = reviews.enrich_reviews(review(
        spark, {"HelpfulnessNumerator": 1, "HelpfulnessDenominator": 4, "Summary": "", "Text": "héllo", "Time": 60},
        {"HelpfulnessDenominator": 0})).orderBy("Id").collect()
    assert row[0].helpfulness_ratio == 0.25 and row[1].helpfulness_ratio is None
    assert row[0].text_length == 5 and row[0].review_text == "héllo" and row[1].review_text == "s. t"
    assert row[0].review_timestamp == dt.datetime(1970, 1, 1, 0, 1)


def test_older_rules_differ(spark):
    df = review(spark, {"Text": " a "}, {"Text": "a", "UserId": "v"}, {"Text": "a  b"}, {"Text": None},
                {"Summary": None, "Text": "z", "HelpfulnessNumerator": 9})
    kept = reviews.clean_reviews_basic(df).orderBy("Id").collect()
    assert [(r.Id, r.Summary, r.Text) for r in kept] == [(1, "s", "a"), (3, "s", "a  b"), (5, "", "z")]


def test_product_document(spark):
    rows = [{"HelpfulnessDenominator": i % 3, "Summary": f"s{i}" if i != 4 else "", "Text": f"t{i} " * 100,
             "Score": float(1 + i % 5), "Time": i} for i in range(12)]
    doc = product_docs.product_documents(reviews.clean_reviews(review(spark, *rows))).first()
    order = sorted(range(12), key=lambda i: (-(i % 3), -(1 + i % 5), -len(f"t{i} " * 100), i))
    assert doc.summary_samples == [f"s{i}" for i in order if i != 4][:6]
    assert doc.text_samples == [(f"t{i} " * 100).strip()[:280] for i in order][:8]
    assert doc.label_hint == doc.summary_samples[0] and doc.review_count == 12
    assert doc.average_score == pytest.approx(2.75) and doc.average_helpfulness_ratio == 0.0
    assert doc.search_text.startswith(f"ProductId: P1. Label hint: {doc.label_hint}. Average score: 2.75. ")


def test_product_document_without_summary(spark):
    doc = product_docs.product_documents(reviews.clean_reviews(review(spark, {"Summary": ""}))).first()
    assert doc.label_hint is None and doc.summary_samples == []
    assert "Label hint: No short label available. Average score: 5.0." in doc.search_text


def test_hot_product_sends_few_rows(spark):
    """A third and more of all rows in one product: samples stay whole and bounded."""
    df = spark.range(30000).select(
        F.col("id").alias("Id"), F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("P"), F.col("id") % 50))
        .alias("ProductId"), F.lit("u").alias("UserId"), F.lit("n").alias("ProfileName"),
        F.lit(0).alias("HelpfulnessNumerator"), (F.col("id") % 7).cast("int").alias("HelpfulnessDenominator"),
        F.lit(4.0).cast("float").alias("Score"), F.col("id").cast("int").alias("Time"),
        F.concat(F.lit("s"), "id").alias("Summary"), F.concat(F.lit("t"), "id").alias("Text"))
    docs = product_docs.product_documents(reviews.clean_reviews(df)).filter("ProductId = 'HOT'").first()
    hot = sorted((i for i in range(0, 30000, 3)), key=lambda i: (-(i % 7), -len(f"t{i}"), i))
    assert docs.review_count == 10000 and docs.text_samples == [f"t{i}" for i in hot[:8]]


def test_basic_document_matches_plain_join(spark):
    rows = [{"Summary": f"title {i}", "Text": f"text {i}"} for i in range(900)]
    doc = product_docs.product_documents_basic(reviews.clean_reviews_basic(review(spark, *rows))).first()
    whole = " | ".join(f"title {i}" for i in range(900)) + " . " + "text 0 text 1 text 2"
    assert doc.texte_recherche == whole[:2000] and doc.extraits_utiles == [f"text {i}" for i in range(5)]


def test_basic_document_with_blank_titles(spark):
    rows = [{"Summary": "", "Text": f"text {i}"} for i in range(800)]
    doc = product_docs.product_documents_basic(reviews.clean_reviews_basic(review(spark, *rows))).first()
    assert doc.texte_recherche == (" | ".join([""] * 800) + " . ")[:2000]


def test_review_file_round_trip(spark, tmp_path):
    df = review(spark, {"Text": 'two\nlines, "quoted" ', "Summary": ""}, {"Text": "plain", "ProfileName": None})
    writers.write_csv(df, str(tmp_path / "r"))
    back = readers.read_reviews(spark, str(tmp_path / "r")).orderBy("Id").collect()
    assert [(r.Id, r.Text, r.Score) for r in back] == [(1, 'two\nlines, "quoted" ', 5.0), (2, "plain", 5.0)]
    assert "ProfileName" not in readers.read_reviews_tolerant(spark, str(tmp_path / "r")).columns
    (tmp_path / "bad.csv").write_text("Id,Other\n1,2\n")
    with pytest.raises(ValueError, match="missing required columns"):
        readers.read_reviews(spark, str(tmp_path / "bad.csv"))


def test_review_columns_are_taken_by_name(spark, tmp_path):
    names = [f.name for f in schemas.REVIEWS][::-1]
    row = {**dict.fromkeys(names, "1"), "Text": "fine", "Score": "x", "More": "?"}
    (tmp_path / "r.csv").write_text(",".join([*names, "More"]) + "\n" + ",".join(row[n] for n in [*names, "More"]) + "\n")
    (back,) = readers.read_reviews(spark, str(tmp_path / "r.csv")).collect()
    assert (back.Id, back.Text, back.Score) == (1, "fine", None)
    assert back.__fields__ == [f.name for f in schemas.REVIEWS]


def test_pipeline_outputs(spark, tmp_path):
    df = review(spark, {}, {"Text": "b"}, {"Score": 0.0})
    paths = pipelines.write_review_outputs(df, str(tmp_path))
    paths["other"] = str(tmp_path / "none.parquet")
    got = {r.artefact: (r.exists, r.rows) for r in pipelines.artefact_list(spark, paths).collect()}
    assert got["cleaned_reviews"] == got["cleaned_reviews_csv"] == got["sample_reviews"] == (True, 2)
    assert got["product_documents"] == (True, 1) and got["other"] == (False, None)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101])
def test_nearest_quantiles(spark, n):
    values = [(i * i) % 37 for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    row = histogram.nearest_quantiles(df, "v", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, median="m").first()
    ordered = sorted(values)
    for name, q in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99)):
        assert row[name] == ordered[int(q * (n - 1) + 0.5)]
    assert row.m == (ordered[(n - 1) // 2] + ordered[n // 2]) / 2


def test_keep_first_and_pages(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, "c"), (None, "x"), (None, "w")], "k int, v string")
    assert sorted(((r.k, r.v) for r in keep_first(df, ["k"], ["v"]).collect()), key=repr) == \
        sorted([(1, "a"), (2, None), (None, "w")], key=repr)
    rows = spark.createDataFrame([(1, f"p{i}", float(i % 4), i % 3, 1.0) for i in range(10)],
                                 "query_id int, product_id string, score double, nb_reviews int, avg_rating double")
    order = sorted(range(10), key=lambda i: (-(i % 4), -(i % 3), f"p{i}"))
    page = ranking.page(rows, ["query_id"], ranking.sort_order("relevance"), 2, 3).orderBy("rank").collect()
    assert [r.product_id for r in page] == [f"p{i}" for i in order[3:6]]


def test_report_counts_are_zero_after_cleaning(spark):
    df = review(spark, {}, {"Score": 0.0}, {"ProductId": ""}, {"Text": "x" * 100})
    cleaned = reviews.clean_reviews(df)
    report = {(r.section, r.metric): r.value for r in reports.quality_report(df, cleaned).collect()}
    assert report["overview", "rows_removed"] == 2
    assert all(report["checks", c] == 0 for c in (
        "missing_product_id", "missing_summary_and_text", "score_out_of_range", "helpfulness_invalid"))
    assert report["checks", "short_reviews_under_80_chars"] == 1


def test_completeness_rounds_half_up(spark):
    df = spark.createDataFrame([("a", "" if i else "x") for i in range(16)], "n string, b string")
    row = reports.completeness(df, ["n", "b"], ["n"]).first()
    assert row.total == 16 and row.n_pct == 100.0 and row.b_pct == 6.3
