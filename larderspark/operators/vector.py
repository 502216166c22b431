"""Vector tables, exact cosine ranking."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from larderspark.functions import ids, numeric, vectors
from larderspark.functions.payload import payload_json
from larderspark.operators.blocks import BLOCK_BYTES, bounded_blocks
from larderspark.operators.ranking import merge_top_k
from larderspark.session import checkpoint_root, cut_lineage

# Cosines are compared at this precision, so equal vectors tie whatever the
# order of additions was.
DIGITS = 12
CELLS = 4_000_000  # scores of one step of a matrix product
ROUNDING = 2 * 10.0**-DIGITS  # more than two scores draw near by rounding
ROW_BYTES = 160  # one kept result row
LEAST_WAITING, RESULT_ROWS = 1 << 16, 10_000  # rows that wait to be merged; rows of a result batch


def dimension(df: DataFrame, vector: str = "embedding") -> int:
    """Length of the first vector of a table."""
    first = df.select(F.size(vector).alias("n")).filter("n > 0").first()
    if first is None:
        raise ValueError("no embeddings found")
    return first.n


def vector_table(df: DataFrame, id_column: str, vector: str = "embedding") -> DataFrame:
    """Point id, vector, its norm and all other columns as a JSON payload.

    Every vector must have the dimension of the first one.
    """
    for name in (id_column, vector):
        if name not in df.columns:
            raise ValueError(f"missing required column: {name}")
    n = dimension(df, vector)
    checked = F.when(
        F.size(vector) == n, F.col(vector).cast("array<float>")
    ).otherwise(F.raise_error(F.lit(f"a vector does not have {n} dimensions")).cast("array<float>"))
    product = F.col(id_column).cast("string")
    return df.select(
        ids.stable_point_id(product).alias("point_id"), product.alias("product_id"),
        checked.alias("embedding"), vectors.norm(checked).alias("norm"),
        payload_json(df, [vector], product_id=product).alias("payload"),
    )


def sequential_ids(df: DataFrame, order: str, name: str = "point_id") -> DataFrame:
    """Ids 0, 1, 2, … in key order without bringing the rows to one task.

    Rows are range-partitioned and stored; each partition then starts at the
    number of rows before it.
    """
    checkpoint_root(df.sparkSession)
    spread = df.repartitionByRange(order).sortWithinPartitions(order).checkpoint()
    numbered = spread.withColumn("_part", F.spark_partition_id()).withColumn(
        "_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per partition
    starts, total = [], 0
    for row in sorted(sizes, key=lambda r: r["_part"]):
        starts.append((row["_part"], total))
        total += row["n"]
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _start bigint")
    return numbered.join(F.broadcast(offsets), "_part").withColumn(
        name, F.col("_start") + F.col("_row")).drop("_part", "_row", "_start")


BASIC_DIMENSION = 1024
BASIC_TEXT_CHARS = 500


def vector_table_basic(df: DataFrame, dimension: int = BASIC_DIMENSION) -> DataFrame:
    """Older index: sequential ids, fixed dimension, payload text cut to 500."""
    cut = df.withColumn("texte_recherche", F.substring("texte_recherche", 1, BASIC_TEXT_CHARS))
    checked = F.when(F.size("embedding") == dimension, F.col("embedding")).otherwise(
        F.raise_error(F.lit(f"a vector does not have {dimension} dimensions")).cast("array<float>"))
    payload = F.to_json(F.struct("product_id", "note_moyenne", "nb_avis", "texte_recherche", "extraits_utiles"))
    return sequential_ids(
        cut.select("product_id", checked.alias("embedding"), payload.alias("payload")), "product_id")


def ranking_order() -> list[Column]:
    return [F.desc("cosine"), F.desc("review_count"), F.desc("average_score"), F.asc("product_id")]


def _query_matrix(rows) -> tuple[list, np.ndarray, np.ndarray]:
    matrix = np.array([r.vector for r in rows], dtype=np.float64)
    floors = np.array([-np.inf if r.min_score is None else r.min_score for r in rows])
    return [r.query_id for r in rows], matrix, floors


def _keep(best: tuple, k: int) -> tuple:
    """The first ``k`` rows per query of (query, score, reviews, rating, id, more columns)."""
    query, score, reviews, rating, product = best[:5]
    order = np.lexsort((product, -rating, -reviews, -score, query))
    sorted_query = query[order]
    starts = np.searchsorted(sorted_query, sorted_query, side="left")
    chosen = order[np.arange(len(order)) - starts < k]
    return tuple(column[chosen] for column in best)


class BestRows:
    """The best ``k`` rows per query that a task has seen.

    What a call adds is cut to ``k`` rows per query while it is still numbers:
    equal scores are told apart by the rank of their ids in the batch, and only
    kept rows get their ids as text. They wait until as many have come as are
    held, so a call costs what it adds, not what is held.
    """

    def __init__(self, names: list, floors: np.ndarray, k: int):
        self.names, self.k = names, k
        self.bar = floors.copy()  # a lower score cannot get in
        self.rows, self.waiting, self.waits = None, [], 0

    def take(self, batch: pa.RecordBatch) -> None:
        """The batch that the rows of the next calls of ``add`` are in."""
        self.product = batch.column("product_id")
        self.reviews = batch.column("review_count").to_numpy(zero_copy_only=False)
        self.rating = batch.column("average_score").to_numpy(zero_copy_only=False)
        self.order = pc.rank(self.product, sort_keys="ascending", tiebreaker="dense").to_numpy()

    def add(self, query: np.ndarray, score: np.ndarray, at: np.ndarray) -> None:
        if not len(query):
            return
        found = _keep((query, score, self.reviews[at], self.rating[at], self.order[at], at), self.k)
        self._raise(found)
        self.waiting.append((*found[:4], ids_of(self.product, found[5])))
        self.waits += len(found[0])
        if self.waits > max(LEAST_WAITING, 0 if self.rows is None else len(self.rows[0])):
            self._merge()

    def offer(self, scores: np.ndarray, queries: np.ndarray, at: np.ndarray, met: np.ndarray | None = None) -> None:
        """A matrix of scores, a row for each of the rows ``at``, a column for each of ``queries``; only pairs ``met`` count."""
        row, column = contenders(scores, self.bar[queries], self.k, met)
        score = np.round(scores[row, column], DIGITS)
        good = score >= self.bar[queries[column]]
        self.add(queries[column[good]], score[good], at[row[good]])

    def _raise(self, rows: tuple) -> None:
        """Queries with ``k`` rows (sorted by query, best first) let no lower score in."""
        counts = np.bincount(rows[0], minlength=len(self.names))
        full = counts == self.k
        self.bar[full] = np.maximum(self.bar[full], rows[1][np.cumsum(counts)[full] - 1])

    def _merge(self) -> None:
        if self.waiting:
            parts = self.waiting if self.rows is None else [self.rows, *self.waiting]
            self.rows, self.waiting, self.waits = _keep(tuple(map(np.concatenate, zip(*parts))), self.k), [], 0
            self._raise(self.rows)

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        self._merge()
        for low in range(0, 0 if self.rows is None else len(self.rows[0]), RESULT_ROWS):
            query, score, reviews, rating, product = (column[low : low + RESULT_ROWS] for column in self.rows)
            arrays = [[self.names[q] for q in query], product.tolist(), score, reviews, rating]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, type=f.type) for a, f in zip(arrays, schema)], schema=schema)


def contenders(scores: np.ndarray, bar: np.ndarray, k: int, met: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the scores, of those ``met``, that can be among the ``k`` best of their column.

    A score is in the running if it reaches the column's bar, and, where very
    many do, the k-th of the column; both but for what rounding may lift.
    """
    def reach(least: np.ndarray) -> np.ndarray:
        good = scores >= least - ROUNDING
        return good if met is None else good & met

    good = reach(bar)
    if len(scores) > k and np.count_nonzero(good) > 2 * k * scores.shape[1]:
        high = scores if met is None else np.where(met, scores, -np.inf)
        good = reach(np.maximum(bar, np.partition(high, len(scores) - k, axis=0)[len(scores) - k]))
    return np.nonzero(good)


def read_points(batch: pa.RecordBatch, dimension: int):
    """(vectors, norms, batch) of the usable rows, or None."""
    lengths = pc.fill_null(pc.list_value_length(batch.column("embedding")), 0)
    batch = batch.filter(pc.greater(lengths, 0))
    if batch.num_rows == 0:
        return None
    column = batch.column("embedding")
    if not pc.all(pc.equal(pc.list_value_length(column), dimension)).as_py():
        raise ValueError("vectors of different dimensions")
    block = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    norms = np.linalg.norm(block, axis=1)
    good = np.isfinite(norms) & (norms > 0)
    if not good.all():  # zero and non-finite vectors match nothing
        batch, block, norms = batch.filter(pa.array(good)), block[good], norms[good]
    return block, norms, batch


def ids_of(column: pa.Array, at: np.ndarray) -> np.ndarray:
    """The ids of some rows only: those of a whole batch would be one wide array."""
    return np.array(column.take(pa.array(at)).to_pylist(), dtype=object).astype(str)


def _scan(plan, k: int, schema: pa.Schema):
    """mapInArrow function: the best ``k`` rows per query of one partition.

    A batch of vectors meets all queries in one matrix product; only scores
    that reach the k-th of all before are looked at further.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix, floors = plan.value
        if not names:
            return
        unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
        best = BestRows(names, floors, k)
        step = max(1, CELLS // len(names))
        for batch in batches:
            points = read_points(batch, matrix.shape[1])
            if points is None:
                continue
            block, norms, kept = points
            best.take(kept)
            for lo in range(0, len(block), step):
                part = slice(lo, lo + step)
                scores = block[part] @ unit.T
                scores /= norms[part, None]
                best.offer(scores, np.arange(len(names)), np.arange(lo, lo + len(scores)))
        yield from best.batches(schema)

    return run


def usable_queries(queries: DataFrame) -> DataFrame:
    """query_id, vector, min_score of queries with a finite, non-zero vector; others match nothing."""
    threshold = F.col("min_score") if "min_score" in queries.columns else F.lit(None)
    return queries.select(
        "query_id", F.col("vector").cast("array<double>").alias("vector"),
        threshold.cast("double").alias("min_score"),
    ).filter((F.size("vector") > 0) & vectors.norm(F.col("vector")).between(5e-324, 1.7e308))


def rank_points(points: DataFrame, queries: DataFrame, k: int, scan: Callable, extra_bytes: int = 0,
                keep: Sequence[str] = (), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Run ``scan(plan, k, schema)`` over the points for blocks of queries."""
    def optional(name: str, kind: str) -> Column:
        value = F.col(name).cast(kind) if name in points.columns else F.lit(None).cast(kind)
        return F.coalesce(value, F.lit(0).cast(kind)).alias(name)

    narrow = points.select(
        F.col("product_id").cast("string").alias("product_id"),
        F.col("embedding").cast("array<float>").alias("embedding"),
        optional("review_count", "bigint"), optional("average_score", "double"), *keep)
    size = F.size("vector") * 8 + 64 + k * ROW_BYTES + extra_bytes
    blocks = bounded_blocks(usable_queries(queries), "query_id", size, block_bytes)
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("product_id", T.StringType()), T.StructField("cosine", T.DoubleType()),
        T.StructField("review_count", T.LongType()), T.StructField("average_score", T.DoubleType()),
    ])
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])
    context = points.sparkSession.sparkContext
    results = []
    for block in blocks:
        plan = context.broadcast(_query_matrix(block.collect()))  # size checked
        found = narrow.mapInArrow(scan(plan, k, arrow), schema)
        results.append(merge_top_k(found, ["query_id"], ranking_order(), k))
    if len(results) > 1:  # one pass per block; each is stored before the next
        results = [cut_lineage(r) for r in results]
    return reduce(DataFrame.unionByName, results)


def vector_ranking(points: DataFrame, queries: DataFrame, k: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The exact best ``k`` points per query by cosine, reviews, rating, id.

    ``points``: product_id, embedding and optionally review_count and
    average_score. ``queries``: query_id, vector and optionally min_score, the
    least cosine to report. Points are not shuffled; every partition sends at
    most ``k`` rows per query. Zero, missing and non-finite vectors never match.
    """
    return rank_points(points, queries, k, _scan, block_bytes=block_bytes)


def cosine_pairs(pairs: DataFrame, left: str, right: str, name: str = "cosine") -> DataFrame:
    """Cosine of two vector columns of the same row."""
    return pairs.withColumn(name, numeric.round_even(vectors.cosine(F.col(left), F.col(right)), DIGITS))


def centroids(df: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per key: averaged per position, so hot keys combine early."""
    cells = df.select(key, F.posexplode(vector).alias("pos", "x"))
    means = cells.groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(key).agg(F.transform(ordered, lambda c: c["x"]).alias("vector"))


def load_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
