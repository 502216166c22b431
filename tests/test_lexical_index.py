"""The inverted index against a scan of all documents."""

import random

import pytest

from larderspark.operators import lexical, lexical_index
from larderspark.session import scratch_path

COLUMNS = lexical.Columns("id", "label", "body", "n", "stars", None, None)


@pytest.fixture(scope="module")
def products(spark):
    draw = random.Random(2)
    words = ["tea", "teapot", "green", "é", "日本", "a", "ab", "aba", "oil", "co-op", "50%", "x.y", "salt"]
    docs = [(f"d{i:03d}", " ".join(draw.choices(words, k=draw.randrange(9))), " ".join(draw.choices(words, k=2)),
             draw.randrange(5), float(draw.randrange(3))) for i in range(300)]
    docs += [("e1", None, None, None, None), ("e2", "", "", 1, 1.0), ("e3", "ababab " * 3000, "tea", 1, 1.0)]
    frame = spark.createDataFrame(docs, "id string, body string, label string, n long, stars double").repartition(3)
    return lexical.search_ready(frame, COLUMNS).cache()


@pytest.fixture(scope="module")
def asked(spark):
    texts = ["green tea", "TEA", "é", "日本", "a", "aba", "zzz", "oil 50%", "x.y", "", "  ", None, "teapot teapot", "tea", "quince"]
    return spark.createDataFrame(list(enumerate(texts)), "query_id int, query string")


@pytest.mark.parametrize("segment, block_bytes", [(4_096, 1 << 20), (50, 50_000)])
def test_same_ranking_as_a_scan(spark, products, asked, monkeypatch, segment, block_bytes):
    monkeypatch.setattr(lexical_index, "SEGMENT", segment)
    monkeypatch.setattr(lexical_index, "MOST_ENTRIES", 40 * segment)
    path = scratch_path(spark, "lexical-test")
    lexical_index.write_index(products, path)
    index = lexical_index.read_index(spark, path)
    want = sorted(map(tuple, lexical.lexical_ranking(products, asked, 7).collect()))
    found = sorted(map(tuple, lexical_index.indexed_ranking(index, asked, 7, block_bytes).collect()))
    assert found == want and len(want) > 40


@pytest.mark.parametrize("first", [1, 3])
def test_bounds_lose_nothing(spark, products, asked, monkeypatch, first):
    monkeypatch.setattr(lexical_index, "SEGMENT", 20)
    path = scratch_path(spark, "lexical-test")
    lexical_index.write_index(products, path)
    index = lexical_index.read_index(spark, path)
    chosen = asked.filter("query_id not in (4, 5)")
    want = sorted(map(tuple, lexical.lexical_ranking(products, chosen, 4).collect()))
    found, read, possible = lexical_index.bounded_ranking(index, chosen, 4, first)
    assert sorted(map(tuple, found.collect())) == want and 0 < read <= possible
    # one very good segment for the only query: the others are skipped
    one = spark.createDataFrame([(1, "ababab")], "query_id int, query string")
    best, read, possible = lexical_index.bounded_ranking(index, one, 1)
    assert [r.product_id for r in best.collect()] == ["e3"] and read == 1 <= possible
    assert lexical_index.bounded_ranking(index, asked.limit(0), 5)[0].count() == 0


def test_only_asked_partitions_and_candidates_are_read(spark, products):
    path = scratch_path(spark, "lexical-test")
    lexical_index.write_index(products, path)
    _, lists = lexical_index.read_index(spark, path)
    patterns = ["teapot"]
    read = lexical_index.asked_lists(lists, patterns)
    assert read.select("bucket").distinct().count() <= 4
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1][:60]
    having = products.filter("text_lower like '%teapot%' or label_lower like '%teapot%'").count()
    assert lexical_index.candidates(lists, patterns).distinct().count() == having < products.count()
    assert lexical_index.candidates(lists, ["quince"]).count() == 0


def test_packed_lists_come_back():
    for offsets in ([0], [4095], [0, 1, 2, 300, 4000], list(range(0, 4096, 17)), list(range(4096))):
        assert lexical_index.unpack(lexical_index.pack(offsets)).tolist() == offsets


def test_stretches_come_back_from_their_keys():
    for value in ("", "a", "ab", "aaaa", "日本\0語😀x", "tea\ntea"):
        keys, counts = lexical_index.gram_keys(value)
        want = {}
        for n in (1, 2, 3):
            for i in range(len(value) - n + 1):
                want[value[i : i + n]] = want.get(value[i : i + n], 0) + 1
        assert {lexical_index.gram_of(k): c for k, c in zip(keys.tolist(), counts.tolist())} == want


def test_empty_tables(spark, products, asked):
    path = scratch_path(spark, "lexical-test")
    lexical_index.write_index(products.limit(0), path)
    assert lexical_index.indexed_ranking(lexical_index.read_index(spark, path), asked, 5).count() == 0
    lexical_index.write_index(products, path + "b")
    index = lexical_index.read_index(spark, path + "b")
    assert lexical_index.indexed_ranking(index, asked.limit(0), 5).count() == 0
