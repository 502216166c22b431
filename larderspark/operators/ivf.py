"""Approximate vector search over an inverted-file index with product quantisation.

Every vector lies in the cell of its nearest centre; cells are partitions of a
stored table. Beside the vector a row holds a short code of its offset from
the centre: per few dimensions the number of the nearest entry of a codebook.
A query reads the codes of its nearest cells only, keeps a short list by the
decoded products, and reads the vectors of that list for exact cosines.

Centres and codebooks come from a bounded sample; every row is indexed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from larderspark.functions import numeric, vectors
from larderspark.operators.blocks import BLOCK_BYTES, bounded_blocks, small
from larderspark.operators.ranking import merge_top_k
from larderspark.operators.vector import (
    CELLS, DIGITS, ROW_BYTES, BestRows, _query_matrix, ranking_order, read_points, usable_queries, vector_ranking,
)
from larderspark.session import cut_lineage

#: Vectors that centres and codebooks are fitted on: at most so many, and so many bytes of doubles.
TRAINING_ROWS, TRAINING_BYTES = 20_000, 64 << 20
MOST_CELLS, CELL_ROWS, ENTRIES, WIDTH, ROUNDS = 1_024, 256, 256, 2, 8
#: Vectors of the sample that each codebook is fitted on, at most.
BOOK_ROWS = 4_096
#: Share of the cells that a query reads, and rows of its short list: recall is measured by ``ivf_recall``.
PROBES, SHORT = 0.25, 100
STEP = 4_096  # rows of one step of distances


@dataclass(frozen=True)
class Model:
    """``centres``: a row per cell; ``books``: (parts, entries, width) offsets per stretch of dimensions."""

    centres: np.ndarray
    books: np.ndarray

    def cells(self, unit: np.ndarray) -> np.ndarray:
        steps = [(unit[at : at + STEP] @ self.centres.T).argmax(1) for at in range(0, len(unit), STEP)]
        return np.concatenate(steps) if steps else np.zeros(0, np.int64)

    def codes(self, unit: np.ndarray, cells: np.ndarray) -> np.ndarray:
        offsets = padded(unit - self.centres[cells], self.books.shape[2])
        parts = np.split(offsets, len(self.books), axis=1)
        return np.stack([nearest(x, book) for x, book in zip(parts, self.books)], 1).astype(np.uint8)

    def decoded(self, cells: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Approximate unit vectors: every code looked up in its book, on top of the centre."""
        offsets = self.books[np.arange(len(self.books)), codes].reshape(len(codes), -1)
        return self.centres[cells] + offsets[:, : self.centres.shape[1]]


def padded(x: np.ndarray, width: int) -> np.ndarray:
    """Zero dimensions at the end up to a multiple of ``width``."""
    return np.pad(x, ((0, 0), (0, -x.shape[1] % width)))


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    lengths = (centres * centres).sum(1)
    steps = [(lengths - 2 * x[at : at + STEP] @ centres.T).argmin(1) for at in range(0, len(x), STEP)]
    return np.concatenate(steps) if steps else np.zeros(0, np.int64)


def k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` centres (fewer for fewer rows); an empty one stays where it was."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(ROUNDS):
        cell = nearest(x, centres)
        counts = np.bincount(cell, minlength=len(centres))
        sums = np.stack([np.bincount(cell, column, minlength=len(centres)) for column in x.T], 1)
        some = counts > 0
        centres[some] = sums[some] / counts[some, None]
    return centres


def usable(points: DataFrame) -> DataFrame:
    """Points with a finite, non-zero vector; others match nothing."""
    return points.filter((F.size("embedding") > 0) & vectors.norm(F.col("embedding")).between(5e-324, 1.7e308))


def train(points: DataFrame, width: int = WIDTH, seed: int = 11) -> Model:
    """Centres and codebooks from a bounded sample, chosen by the id's hash.

    About the square root of the rows as centres, but no cell of fewer than CELL_ROWS rows on average.
    """
    rows = usable(points)
    total, dimension = rows.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    if not total:
        raise ValueError("no usable vectors to index")
    bound = max(1, min(TRAINING_ROWS, TRAINING_BYTES // (8 * dimension)))
    share = F.pmod(F.xxhash64(F.lit(seed), "product_id"), F.lit(1 << 40)) < min(1 << 40, int((1 << 40) * bound / total) + 1)
    sample = rows.filter(share).select("embedding").limit(bound).toPandas()["embedding"]
    if not len(sample):
        sample = rows.select("embedding").limit(bound).toPandas()["embedding"]
    unit = np.stack(sample.to_numpy()).astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    centres = k_means(unit, max(1, min(MOST_CELLS, math.isqrt(total), total // CELL_ROWS)), seed)
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)
    few = unit[:BOOK_ROWS]
    offsets = padded(few - centres[(few @ centres.T).argmax(1)], width)
    books = [k_means(x, ENTRIES, seed + n) for n, x in enumerate(np.split(offsets, offsets.shape[1] // width, axis=1), 1)]
    return Model(centres, np.stack(books))


def _encode(plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, books = plan.value
        model = Model(centres, books)
        for batch in batches:
            points = read_points(batch, centres.shape[1])
            if points is None:
                continue
            block, norms, kept = points
            unit = block / norms[:, None]
            cells = model.cells(unit)
            raw, size = model.codes(unit, cells).tobytes(), len(books)
            codes = pa.array([raw[at : at + size] for at in range(0, len(raw), size)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, codes, pa.array(cells, pa.int32())], [*kept.schema.names, "code", "cell"])

    return run


def write_index(points: DataFrame, path: str, model: Model | None = None) -> Model:
    """Write all usable points (product_id, embedding, review_count, average_score) to ``path`` by cell, then the model.

    Rows are dealt out by ranges of (cell, id), so a crowded cell becomes
    several files and no task holds a whole one. The model is written last:
    without it there is no index.
    """
    spark = points.sparkSession
    model = train(points) if model is None else model
    plan = spark.sparkContext.broadcast((model.centres, model.books))
    narrow = usable(points).select(
        F.col("product_id").cast("string").alias("product_id"), F.col("embedding").cast("array<float>").alias("embedding"),
        F.coalesce(F.col("review_count").cast("bigint"), F.lit(0)).alias("review_count"),
        F.coalesce(F.col("average_score").cast("double"), F.lit(0.0)).alias("average_score"))
    schema = T.StructType([*narrow.schema.fields, T.StructField("code", T.BinaryType()), T.StructField("cell", T.IntegerType())])
    coded = cut_lineage(narrow.mapInArrow(_encode(plan), schema), "coded")  # the ranges are sampled: encode once
    coded.repartitionByRange("cell", "product_id").sortWithinPartitions("cell", "product_id").write.mode(
        "overwrite").partitionBy("cell").parquet(f"{path}/points")
    flat = [(model.centres.shape[1], model.books.shape[1], model.books.shape[2],
             model.centres.ravel().tolist(), model.books.ravel().tolist())]
    spark.createDataFrame(
        flat, "dimension int, entries int, width int, centres array<double>, books array<double>"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    return model


def read_index(spark: SparkSession, path: str) -> tuple[Model, DataFrame]:
    row = spark.read.parquet(f"{path}/model").first()
    centres = np.array(row.centres).reshape(-1, row.dimension)
    books = np.array(row.books).reshape(-1, row.entries, row.width)
    return Model(centres, books), spark.read.parquet(f"{path}/points")


def probed_cells(model: Model, unit: np.ndarray, probes: float) -> np.ndarray:
    """A mask (query, cell) of the nearest cells of each query."""
    count = max(1, math.ceil(probes * len(model.centres)))
    order = np.argsort(-(unit @ model.centres.T), axis=1, kind="stable")[:, :count]
    mask = np.zeros((len(unit), len(model.centres)), bool)
    np.put_along_axis(mask, order, True, axis=1)
    return mask


def _short_lists(plan, short: int, schema: pa.Schema):
    """mapInArrow function: per query the ``short`` best rows of one partition by decoded products."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, unit, centres, books, mask = plan.value
        model = Model(centres, books)
        best = BestRows(names, np.full(len(names), -np.inf), short)
        for batch in batches:
            cells = batch.column("cell").to_numpy(zero_copy_only=False)
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(cells), -1)
            best.take(batch)
            for cell in np.unique(cells):
                asked = np.flatnonzero(mask[:, cell])
                rows = np.flatnonzero(cells == cell) if len(asked) else asked
                step, near = min(STEP, max(1, CELLS // max(len(asked), 1))), unit[asked].T
                for low in range(0, len(rows), step):
                    part = rows[low : low + step]
                    best.offer(model.decoded(cells[part], codes[part]) @ near, asked, part)
        yield from best.batches(schema)

    return run


def short_lists(model: Model, points: DataFrame, queries: DataFrame, short: int = SHORT, probes: float = PROBES,
                block_bytes: int = BLOCK_BYTES) -> list[tuple[DataFrame, DataFrame, DataFrame]]:
    """Per block of queries: (its queries, the points of the cells they read, the short lists (query_id, product_id)).

    Only the columns of codes are read, and only of cells that some query of
    the block is near to. Every partition sends at most ``short`` rows per query.
    """
    spark = points.sparkSession
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("product_id", T.StringType()),
        T.StructField("near", T.DoubleType()), T.StructField("review_count", T.LongType()),
        T.StructField("average_score", T.DoubleType())])
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])
    held = F.size("vector") * 8 + 64 + short * ROW_BYTES + len(model.centres)
    out = []
    for block in bounded_blocks(usable_queries(queries), "query_id", held, block_bytes):
        names, matrix, _ = _query_matrix(block.collect())  # size checked
        unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True) if names else np.zeros((0, model.centres.shape[1]))
        mask = probed_cells(model, unit, probes)
        read = points.filter(F.col("cell").isin(np.flatnonzero(mask.any(0)).tolist()))
        plan = spark.sparkContext.broadcast((names, unit, model.centres, model.books, mask))
        found = read.select("product_id", "code", "cell", "review_count", "average_score").mapInArrow(
            _short_lists(plan, short, arrow), schema)
        order = [F.desc("near"), F.desc("review_count"), F.desc("average_score"), F.asc("product_id")]
        lists = merge_top_k(found, ["query_id"], order, short).select("query_id", "product_id")
        out.append((block, read, cut_lineage(lists, "short-lists")))
    return out


def ivf_ranking(index: tuple[Model, DataFrame], queries: DataFrame, k: int, short: int = SHORT, probes: float = PROBES,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The best ``k`` of every query's short list by exact cosine: columns and order as in ``vector_ranking``.

    ``index`` is from ``read_index``. More probes and a longer list raise the
    recall. Queries go out in blocks of a checked size; points are not
    shuffled, the short lists go to the points of the cells that were read.
    """
    model, points = index
    return rank_lists(model, short_lists(model, points, queries, max(short, k), probes, block_bytes), k)


def rank_lists(model: Model, blocks: list[tuple[DataFrame, DataFrame, DataFrame]], k: int) -> DataFrame:
    """The best ``k`` of every query of ``short_lists`` by exact cosine."""
    results = []
    for block, read, lists in blocks:
        known = lists.join(F.broadcast(block), "query_id")  # a block is small enough to be collected
        scored = read.select("product_id", "embedding", "review_count", "average_score").join(
            small(known, lists.count(), 8 * model.centres.shape[1] + ROW_BYTES), "product_id")
        cosine = numeric.round_even(vectors.cosine(F.col("embedding"), F.col("vector")), DIGITS)
        kept = scored.withColumn("cosine", cosine).filter("min_score is null or cosine >= min_score")
        results.append(merge_top_k(
            kept.select("query_id", "product_id", "cosine", "review_count", "average_score"), ["query_id"], ranking_order(), k))
    return reduce(DataFrame.unionByName, results)


def search_or_exact(spark: SparkSession, path: str, points: DataFrame, queries: DataFrame, k: int, **more) -> tuple[DataFrame, str]:
    """(ranking, "index"), or (ranking, "exact") over ``points`` where there is no index that can be read."""
    try:
        index = read_index(spark, path)
    except AnalysisException:  # no model: not there, or a write that did not finish
        return vector_ranking(points, queries, k), "exact"
    return ivf_ranking(index, queries, k, **more), "index"
