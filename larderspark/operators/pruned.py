"""Exact vector search that skips cells by their angles.

Vectors lie by cell in a stored table, and every cell has a pivot and a
radius: the largest angle between the pivot and one of its vectors. Angles
keep the triangle inequality, so no vector of a cell is nearer to a query than
the pivot's angle less the radius. A first pass over each query's nearest
cells gives a k-th best cosine; the second pass reads the cells that could
still hold a better one, and no others. No result is ever lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from larderspark.operators import ivf
from larderspark.operators.blocks import BLOCK_BYTES, bounded_blocks
from larderspark.operators.ranking import merge_top_k
from larderspark.operators.vector import (
    CELLS, ROW_BYTES, BestRows, _query_matrix, ranking_order, read_points, usable_queries,
)
from larderspark.session import cut_lineage

#: Slack of angles and cosines for rounding.
SLACK = 1e-7
#: Rows that the first pass looks at per query, at least, in multiples of k.
FIRST_ROWS = 8


@dataclass(frozen=True)
class Cells:
    """Per cell its pivot (a unit vector), radius (an angle) and number of rows."""

    pivots: np.ndarray
    radii: np.ndarray
    rows: np.ndarray

    def nearest_angles(self, unit: np.ndarray) -> np.ndarray:
        """The least possible angle between each query and a vector of each cell."""
        apart = np.arccos(np.clip(unit @ self.pivots.T, -1, 1))
        return np.maximum(apart - self.radii, 0)


def _assign(plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = plan.value
        for batch in batches:
            points = read_points(batch, pivots.shape[1])
            if points is None:
                continue
            block, norms, *_, kept = points
            near = (block / norms[:, None]) @ pivots.T
            cells = near.argmax(1)
            angles = np.arccos(np.clip(near[np.arange(len(near)), cells], -1, 1))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(angles), pa.array(cells, pa.int32())], [*kept.schema.names, "angle", "cell"])

    return run


def write_cells(points: DataFrame, path: str) -> None:
    """Write all usable points by cell to ``path``, then the cells with pivot, radius and rows.

    Pivots are means of a bounded sample's clusters; radii and counts are of all rows.
    """
    spark = points.sparkSession
    pivots = ivf.train(points).centres
    plan = spark.sparkContext.broadcast(pivots)
    narrow = ivf.usable(points).select(
        F.col("product_id").cast("string").alias("product_id"), F.col("embedding").cast("array<float>").alias("embedding"),
        *[F.coalesce(F.col(c).cast(kind) if c in points.columns else F.lit(None).cast(kind), F.lit(0).cast(kind)).alias(c)
          for c, kind in (("review_count", "bigint"), ("average_score", "double"))])
    schema = T.StructType([*narrow.schema.fields, T.StructField("angle", T.DoubleType()), T.StructField("cell", T.IntegerType())])
    placed = cut_lineage(narrow.mapInArrow(_assign(plan), schema), "placed")
    placed.drop("angle").repartitionByRange("cell", "product_id").sortWithinPartitions("cell", "product_id").write.mode(
        "overwrite").partitionBy("cell").parquet(f"{path}/points")
    listed = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pivots)], "cell int, pivot array<double>")
    placed.groupBy("cell").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("rows")).join(
        F.broadcast(listed), "cell").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")


def read_cells(spark: SparkSession, path: str) -> tuple[Cells, np.ndarray, DataFrame]:
    """(cells, their numbers, points)."""
    held = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()  # at most ivf.MOST_CELLS rows
    cells = Cells(np.array([r.pivot for r in held]), np.array([r.radius for r in held]), np.array([r.rows for r in held]))
    return cells, np.array([r.cell for r in held]), spark.read.parquet(f"{path}/points")


def _scan(plan, k: int, schema: pa.Schema):
    """mapInArrow function: the best ``k`` rows per query of one partition, of the cells that the query asks for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, unit, floors, mask = plan.value
        best = BestRows(names, floors, k)
        for batch in batches:
            points = read_points(batch, unit.shape[1])
            if points is None:
                continue
            block, norms, kept = points
            best.take(kept)
            cells = kept.column("cell").to_numpy(zero_copy_only=False)
            for cell in np.unique(cells):
                asked = np.flatnonzero(mask.get(int(cell), ()))
                rows = np.flatnonzero(cells == cell)
                step, near = max(1, CELLS // max(len(asked), 1)), unit[asked].T
                for low in range(0, len(rows) if len(asked) else 0, step):
                    part = rows[low : low + step]
                    scores = block[part] @ near
                    scores /= norms[part, None]
                    best.offer(scores, asked, part)
        yield from best.batches(schema)

    return run


def pruned_ranking(index: tuple[Cells, np.ndarray, DataFrame], queries: DataFrame, k: int,
                   block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(the rows of ``vector.vector_ranking``, pairs of query and point that were scored for them).

    Every pass reads only partitions of cells that some query of the block
    asks for, and scores a row only for the queries that ask for its cell.
    """
    cells, numbers, points = index
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("product_id", T.StringType()),
        T.StructField("cosine", T.DoubleType()), T.StructField("review_count", T.LongType()),
        T.StructField("average_score", T.DoubleType())])
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])
    context, results, scored = points.sparkSession.sparkContext, [], 0
    size = F.size("vector") * 8 + 64 + k * ROW_BYTES + len(numbers) * 2
    for block in bounded_blocks(usable_queries(queries), "query_id", size, block_bytes):
        names, matrix, floors = _query_matrix(block.collect())  # size checked
        unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True) if names else np.zeros((0, cells.pivots.shape[1]))

        def asked(mask: np.ndarray, least: np.ndarray) -> DataFrame:
            wanted = {int(n): mask[:, i] for i, n in enumerate(numbers) if mask[:, i].any()}
            read = points.filter(F.col("cell").isin(list(wanted)))
            plan = context.broadcast((names, unit, least, wanted))
            return merge_top_k(read.mapInArrow(_scan(plan, k, arrow), schema), ["query_id"], ranking_order(), k)

        angles = cells.nearest_angles(unit)
        order = np.argsort(angles, axis=1, kind="stable")
        before = np.cumsum(cells.rows[order], axis=1) - cells.rows[order]
        first = np.zeros_like(angles, bool)
        np.put_along_axis(first, order, before < FIRST_ROWS * k, axis=1)
        found = cut_lineage(asked(first, floors), "first-cells")
        kth = {r["query_id"]: r["least"] for r in found.groupBy("query_id").agg(
            F.count(F.lit(1)).alias("n"), F.min("cosine").alias("least")).filter(F.col("n") == k).collect()}  # a row per query
        bar = np.maximum(floors, [kth.get(n, -np.inf) for n in names]) if names else floors
        second = (np.cos(angles) >= bar[:, None] - SLACK) & ~first
        scored += int(((first | second) * cells.rows).sum())
        results.append(found.drop("rank"))
        if second.any():
            # a row below the bar of the first pass cannot get in
            results.append(cut_lineage(asked(second, bar).drop("rank"), "other-cells"))
    return merge_top_k(reduce(DataFrame.unionByName, results), ["query_id"], ranking_order(), k), scored


def read_share(scored: int, index: tuple[Cells, np.ndarray, DataFrame], queries: int) -> float:
    """Scored pairs over all pairs of queries and points."""
    return scored / max(1, queries * int(index[0].rows.sum()))
