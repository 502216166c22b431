"""Cells with pivots and radii against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larderspark.operators import pruned, vector
from larderspark.session import scratch_path

POINT = "product_id string, embedding array<float>, review_count long, average_score double"


def rows(ranking):
    return sorted((r.query_id, r["rank"], r.product_id, round(r.cosine, 9)) for r in ranking.collect())


@pytest.fixture(scope="module", params=["clustered", "random"])
def case(request, spark):
    draw = np.random.default_rng(9)
    if request.param == "clustered":
        around = draw.standard_normal((30, 12)) * 4
        data = around[draw.integers(0, 30, 3_000)] + 0.1 * draw.standard_normal((3_000, 12))
    else:
        data = draw.standard_normal((3_000, 12))
    data[2_900:] = data[:100]  # ties
    points = [(f"p{i:05d}", x.tolist(), i % 5, float(i % 3)) for i, x in enumerate(data)]
    points += [("null", None, 1, 1.0), ("zero", [0.0] * 12, 1, 1.0), ("nan", [float("nan")] * 12, 1, 1.0)]
    asked = [(i, data[i * 101].tolist()) for i in range(20)] + [(99, draw.standard_normal(12).tolist()), (100, None)]
    stored = spark.createDataFrame(points, POINT).repartition(4).cache()
    path = scratch_path(spark, "cells-test")
    pruned.write_cells(stored, path)
    return request.param, stored, spark.createDataFrame(asked, "query_id int, vector array<double>").cache(), pruned.read_cells(spark, path)


def test_same_rows_as_exact_search(case):
    kind, points, asked, index = case
    found, scored = pruned.pruned_ranking(index, asked, 10)
    assert rows(found) == rows(vector.vector_ranking(points, asked, 10))
    share = pruned.read_share(scored, index, 21)
    assert share < 0.5 if kind == "clustered" else share <= 1


def test_floors_large_k_and_blocks(case):
    _, points, asked, index = case
    floored = asked.withColumn("min_score", F.when(F.col("query_id") % 2 == 0, F.lit(0.9)))
    found, _ = pruned.pruned_ranking(index, floored, 40, block_bytes=30_000)
    assert rows(found) == rows(vector.vector_ranking(points, floored, 40))
    assert pruned.pruned_ranking(index, asked.filter("query_id = 100"), 5)[0].count() == 0


def test_skipped_cells_are_not_read(case):
    kind, _, asked, index = case
    if kind == "clustered":
        cells, numbers, points = index
        plan = points.filter(F.col("cell").isin([int(numbers[0])]))._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [cell" in plan or "PartitionFilters: [isnotnull(cell" in plan
        assert (cells.radii > 0).any() and cells.rows.sum() == 3_000
