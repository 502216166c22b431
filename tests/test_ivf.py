"""The inverted-file index against exact search."""

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from larderspark.operators import ivf, vector
from larderspark.session import scratch_path

POINT = "product_id string, embedding array<float>, review_count long, average_score double"


@pytest.fixture(scope="module")
def clustered(spark):
    """2,000 points around 40 directions, copies among them, 25 queries near them."""
    draw = np.random.default_rng(5)
    around = draw.standard_normal((40, 21))
    rows = around[draw.integers(0, 40, 2_000)] + 0.25 * draw.standard_normal((2_000, 21))
    rows[1_900:] = rows[:100]
    points = [(f"p{i:05d}", row.tolist(), int(i % 7), float(i % 5)) for i, row in enumerate(rows)]
    asked = [(i, (rows[i * 70] * 3).tolist()) for i in range(25)]
    return (spark.createDataFrame(points, POINT).repartition(5).cache(),
            spark.createDataFrame(asked, "query_id int, vector array<double>").cache())


def rows(ranking):
    return sorted((r.query_id, r["rank"], r.product_id, round(r.cosine, 9)) for r in ranking.collect())


def test_recall_and_candidates(spark, clustered):
    points, asked = clustered
    path = scratch_path(spark, "ivf-test")
    ivf.write_index(points, path)
    index = ivf.read_index(spark, path)
    assert index[1].count() == 2_000 and len(index[0].centres) == 7
    lists = [lists for _, _, lists in ivf.short_lists(*index, asked, 100)]
    assert sum(x.count() for x in lists) <= 0.1 * 2_000 * 25
    exact, found = rows(vector.vector_ranking(points, asked, 10)), rows(ivf.ivf_ranking(index, asked, 10))
    assert len(set(found) & set(exact)) >= 0.9 * len(exact)
    # all cells and a list that holds all points: exact
    assert rows(ivf.ivf_ranking(index, asked, 10, short=2_000, probes=1.0)) == exact
    assert rows(ivf.ivf_ranking(index, asked, 10, 2_000, 1.0, block_bytes=400_000 * 2)) == exact


def test_only_near_cells_and_codes_are_read(spark, clustered):
    points, asked = clustered
    path = scratch_path(spark, "ivf-test")
    ivf.write_index(points, path)
    model, stored = ivf.read_index(spark, path)
    (_, read, _), = ivf.short_lists(model, stored, asked.limit(1), 20)
    assert read.select("cell").distinct().count() == 2
    plan = read.select("code")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "ReadSchema: struct<code:binary>" in plan


def test_floor_ties_and_unusable_vectors(spark, clustered):
    points, asked = clustered
    dirty = points.unionByName(spark.createDataFrame(
        [("n1", None, 1, 1.0), ("n2", [0.0] * 21, 1, 1.0), ("n3", [float("nan")] * 21, 1, 1.0), ("n4", [], 1, 1.0)], POINT))
    floored = asked.withColumn("min_score", F.lit(0.97))
    path = scratch_path(spark, "ivf-test")
    ivf.write_index(dirty, path)
    index = ivf.read_index(spark, path)
    assert rows(ivf.ivf_ranking(index, floored, 10, 2_000, 1.0)) == rows(vector.vector_ranking(points, floored, 10))
    blank = spark.createDataFrame([(1, None), (2, [0.0] * 21)], "query_id int, vector array<double>")
    assert ivf.ivf_ranking(index, blank, 10).count() == 0
    with pytest.raises(ValueError):
        ivf.train(points.limit(0))
    with pytest.raises(PythonException):
        ivf.write_index(points.withColumn("embedding", F.slice("embedding", 1, 3 + F.col("review_count").cast("int"))), path + "x",
                        ivf.Model(np.eye(3), np.zeros((2, 1, 2))))


def test_exact_search_answers_without_an_index(spark, clustered):
    points, asked = clustered
    found, strategy = ivf.search_or_exact(spark, scratch_path(spark, "nowhere"), points, asked, 5)
    assert strategy == "exact" and rows(found) == rows(vector.vector_ranking(points, asked, 5))
    path = scratch_path(spark, "ivf-test")
    ivf.write_index(points, path)
    found, strategy = ivf.search_or_exact(spark, path, points, asked, 5, short=2_000, probes=1.0)
    assert strategy == "index" and rows(found) == rows(vector.vector_ranking(points, asked, 5))
