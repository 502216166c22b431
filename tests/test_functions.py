import math
import uuid

import pytest
from pyspark.sql import functions as F

from larderspark.functions import ids, numeric, payload, text, vectors


def one(spark, expression, **values):
    fields = ", ".join(values) or "x"
    schema = ", ".join(f"{k} {v[0]}" for k, v in values.items()) or "x int"
    data = [tuple(v[1] for v in values.values())] if values else [(1,)]
    del fields
    return spark.createDataFrame(data, schema).select(expression.alias("r")).first().r


@pytest.mark.parametrize("raw, clean", [
    (None, ""), ("  a\t\nb ", "a b"), ("<b>x</b>y", "x y"), ("a b ", "a b"),
    ("a < b", "a < b"), ("<br/><br/>", ""), ("a  \x85 b", "a b"),
])
def test_normalize_text(spark, raw, clean):
    assert one(spark, text.normalize_text(F.col("c")), c=("string", raw)) == clean


def test_clean_text_keeps_null_and_strip_keeps_inner_space(spark):
    assert one(spark, text.clean_text(F.col("c")), c=("string", None)) is None
    assert one(spark, text.strip(F.col("c")), c=("string", " a  b　")) == "a  b"


@pytest.mark.parametrize("raw, clean", [
    ("en:Milk; fr:Lait ", "Milk, Lait"), (" Unknown ", ""), ("N/A", ""), ("-", ""), ("", ""),
    (None, ""), ("a,,,b", "a,,b"), ("a, ,b", "a,b"), ("xen:a", "xen:a"), (",en:a,", "a"),
])
def test_clean_field(spark, raw, clean):
    assert one(spark, text.clean_field(F.col("c")), c=("string", raw)) == clean


def test_initcap_after_any_separator(spark):
    got = one(spark, text.initcap_words(F.col("c")), c=("string", "BEEF, LOIN (top) 2nd-cut d'été"))
    assert got == "Beef, Loin (Top) 2nd-Cut D'Été"


def test_clip_text(spark):
    clip = lambda v, n: one(spark, text.clip_text(F.col("c"), n), c=("string", v))
    assert clip(" a  b. ", 180) == "a b"
    assert clip("one two, three", 9) == "one two..."
    assert clip("abcdefghij", 5) == "abcde..."  # no space: the whole cut stays


def test_literal_count_is_not_a_regex(spark):
    count = lambda t, n: one(
        spark, text.literal_count(F.col("t"), F.col("n")), t=("string", t), n=("string", n))
    assert count("c++ and c++", "c++") == 2
    assert count("a.b", ".") == 1
    assert count("aaa", "aa") == 1
    assert count("aaa", "") == 0


def test_distinct_texts_keeps_first_spelling(spark):
    got = one(spark, text.distinct_texts(F.col("c")),
              c=("array<string>", ["Good  tea", "good tea", " ", "GOOD TEA ", "bad"]))
    assert got == ["Good  tea", "bad"]
    assert one(spark, text.text_list(F.col("c")), c=("array<string>", None)) == []


def test_names(spark):
    assert one(spark, text.slug(F.col("c")), c=("string", "BGE-m3:latest")) == "bge_m3_latest"
    assert one(spark, text.suffix(F.col("c")), c=("string", "bge-m3:1.5")) == "bge_m3_1_5"


@pytest.mark.parametrize("raw, number", [
    ("12", 12), (" 12 ", 12), ("12.0", 12), ("1.9", 1), ("-1.9", -1), ("x", None), ("", None),
    (None, None), ("9007199254740993", 9007199254740993), ("1e400", None),
])
def test_to_long(spark, raw, number):
    assert one(spark, numeric.to_long(F.col("c")), c=("string", raw)) == number


@pytest.mark.parametrize("raw, number", [
    ("1.5", 1.5), (" 2 ", 2.0), ("1e3", 1000.0), ("nan", None), ("NaN", None), ("inf", None),
    ("12d", None), ("12f", None), ("", None), (".5", 0.5), ("5.", 5.0),
])
def test_numeric_text(spark, raw, number):
    assert one(spark, numeric.numeric_text(F.col("c")), c=("string", raw)) == number


@pytest.mark.parametrize("value, shown", [
    (5.0, "5"), (1.5, "1.5"), (12345678.0, "12345678"), (0.0001, "0.0001"), (-2.25, "-2.25"), (0.0, "0"),
])
def test_plain_number(spark, value, shown):
    assert one(spark, numeric.plain_number(F.col("c")), c=("double", value)) == shown


def test_angles(spark):
    degrees = lambda v: one(spark, numeric.angle_degrees(F.col("c")), c=("double", v))
    percent = lambda v: one(spark, numeric.angle_relevance(F.col("c")), c=("double", v))
    assert degrees(1.0000001) == 0.0 and percent(1.0000001) == 100
    assert degrees(-2.0) == 180.0 and percent(-0.5) == 0
    assert degrees(None) is None and percent(None) is None
    assert degrees(0.5) == 60.0 and percent(0.5) == round((1 - math.acos(0.5) / (math.pi / 2)) * 100)


@pytest.mark.parametrize("score, reference, percent", [
    (0.0, 0.0, 0), (-1.0, None, 0), (1.0, 100.0, 8), (10.0, 10.0, 99), (5.0, 10.0, 50), (3.0, None, 99),
])
def test_score_relevance(spark, score, reference, percent):
    got = one(spark, numeric.score_relevance(F.col("s"), F.col("r")), s=("double", score), r=("double", reference))
    assert got == percent


@pytest.mark.parametrize("name", ["P1", "héllo", "", "off:0001", "a b c"])
def test_point_id_is_uuid5(spark, name):
    got = one(spark, ids.stable_point_id(F.col("c")), c=("string", name))
    assert got == str(uuid.uuid5(uuid.NAMESPACE_URL, name))


def test_cosine(spark):
    cosine = lambda a, b: one(
        spark, vectors.cosine(F.col("a"), F.col("b")), a=("array<float>", a), b=("array<float>", b))
    assert cosine([1.0, 0.0], [0.0, 2.0]) == 0.0
    assert cosine([3.0, 4.0], [3.0, 4.0]) == pytest.approx(1.0)
    assert cosine([0.0, 0.0], [1.0, 1.0]) is None
    assert cosine([], [1.0]) is None and cosine(None, [1.0]) is None
    with pytest.raises(Exception, match="different dimensions"):
        cosine([1.0], [1.0, 2.0])


@pytest.mark.parametrize("raw, value", [
    ('{"a": 1}', 1), ('Sure!\n{"a": 2}\nBye', 2), ("no json", None), ("{broken", None), ("", None),
    ('{"a": 1} and {"a": 2}', None), (None, None), ('{"a": 3}] x', 3),
])
def test_extract_json(spark, raw, value):
    found = payload.extract_json(F.col("c"))
    assert one(spark, F.try_variant_get(found, "$.a", "int"), c=("string", raw)) == value


def test_payload_json(spark):
    df = spark.createDataFrame([(1, None, ["a"], [1.0])], "n int, s string, l array<string>, v array<double>")
    df = df.withColumn("t", F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))
    got = df.select(payload.payload_json(df, ["v"], id=F.lit("x")).alias("p")).first().p
    assert got == '{"n":1,"s":null,"l":["a"],"t":"2024-01-02 03:04:05","id":"x"}'


def test_scratch_folder_goes(spark, tmp_path, monkeypatch):
    from larderspark import session

    assert session.scratch_path(spark, "x").startswith(f"{session.scratch_root(spark)}/x-")
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path / "stages"))
    assert session.cut_lineage(spark.range(3)).count() == 3 and any((tmp_path / "stages").iterdir())
    session.clear_scratch(spark)
    assert not (tmp_path / "stages").exists()
