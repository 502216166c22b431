"""Approximate vector search: random hyperplane signatures, exact re-scoring."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderspark.functions import vectors
from larderspark.operators.blocks import BLOCK_BYTES
from larderspark.operators.vector import CELLS, DIGITS, BestRows, rank_points, read_points

#: Measured on the given vectors: recall@10 of 0.96 or more (see README).
TABLES, BITS, SEED = 24, 8, 17
PROBE_BYTES = 16  # one (signature, query) pair of the lookup


def signatures(matrix: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    """One integer of ``bits`` signs per row and table."""
    planes = np.random.default_rng(seed).standard_normal((matrix.shape[1], tables * bits))
    signs = (matrix @ planes > 0).reshape(len(matrix), tables, bits)
    return (signs << np.arange(bits)).sum(axis=2).astype(np.int32)


def with_codes(df: DataFrame, vector: str, tables: int = TABLES, bits: int = BITS, seed: int = SEED) -> DataFrame:
    """Vectors with their signatures; store them together as the index.

    Null, empty, zero and non-finite vectors match nothing and are left out.
    """
    @F.pandas_udf("array<int>")
    def codes(column: pd.Series) -> pd.Series:
        if column.empty:
            return pd.Series([], dtype=object)
        return pd.Series(list(signatures(np.stack(column.to_numpy()).astype(np.float64), tables, bits, seed)))

    return df.filter((F.size(vector) > 0) & vectors.norm(F.col(vector)).between(5e-324, 1.7e308)).withColumn("codes", codes(F.col(vector)))


def _lookup(unit: np.ndarray, tables: int, bits: int, seed: int) -> list[tuple]:
    """Per table the sorted signatures near a query, and whose they are.

    Near means the signature of the query itself or one sign apart.
    """
    flips = np.concatenate([[0], 1 << np.arange(bits)]).astype(np.int32)
    near = signatures(unit, tables, bits, seed)[:, :, None] ^ flips
    owner = np.repeat(np.arange(len(unit)), bits + 1)
    out = []
    for t in range(tables):
        flat = near[:, t, :].ravel()
        order = np.argsort(flat, kind="stable")
        out.append((flat[order], owner[order]))
    return out


def _met(codes: np.ndarray, lookup: list[tuple], queries: int) -> np.ndarray:
    """A mask of the (row, query) pairs that share a signature in some table."""
    met = np.zeros((len(codes), queries), dtype=bool)
    for t, (near, owner) in enumerate(lookup):
        low = np.searchsorted(near, codes[:, t], side="left")
        count = np.searchsorted(near, codes[:, t], side="right") - low
        row = np.repeat(np.arange(len(codes)), count)
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        met[row, owner[np.repeat(low, count) + within]] = True
    return met


def _products(block: np.ndarray, unit: np.ndarray, row: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Dot products of some pairs."""
    step = max(1, CELLS // block.shape[1])
    parts = [np.einsum("ij,ij->i", block[row[i:i + step]], unit[query[i:i + step]])
             for i in range(0, len(row), step)]
    return np.concatenate(parts) if parts else np.zeros(0)


def ann_ranking(index: DataFrame, queries: DataFrame, k: int, tables: int = TABLES, bits: int = BITS,
                seed: int = SEED, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The best ``k`` candidates per query by exact cosine.

    ``index`` is the result of ``with_codes`` with the same parameters. More
    bits mean fewer candidates, more tables mean a better recall. The query
    side goes out in blocks of a checked size, as in exact search; points stay
    where they are, however many share one signature.
    """
    def scan(plan, k: int, schema: pa.Schema):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, matrix, floors = plan.value
            if not names:
                return
            unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
            lookup = _lookup(unit, tables, bits, seed)
            best = BestRows(names, floors, k)
            step = max(1, CELLS // len(names))
            for batch in batches:
                points = read_points(batch, matrix.shape[1])
                if points is None:
                    continue
                block, norms, kept = points
                best.take(kept)
                codes = kept.column("codes").flatten().to_numpy(zero_copy_only=False).reshape(-1, tables)
                for lo in range(0, len(block), step):
                    part = slice(lo, lo + step)
                    met = _met(codes[part], lookup, len(names))
                    if 16 * np.count_nonzero(met) > met.size:  # dense: one matrix product
                        scores = block[part] @ unit.T
                        scores /= norms[part, None]
                        best.offer(scores, np.arange(len(names)), np.arange(lo, lo + len(scores)), met)
                    else:
                        row, query = np.nonzero(met)
                        cosine = np.round(_products(block[part], unit, row, query) / norms[part][row], DIGITS)
                        good = cosine >= best.bar[query]
                        best.add(query[good], cosine[good], lo + row[good])
            yield from best.batches(schema)

        return run

    return rank_points(index, queries, k, scan, tables * (bits + 1) * PROBE_BYTES, ["codes"], block_bytes)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact results per query that the approximate search found."""
    found = approximate.select("query_id", "product_id", F.lit(1).alias("found"))
    return exact.join(found, ["query_id", "product_id"], "left").groupBy("query_id").agg(
        F.count(F.lit(1)).alias("relevant"), F.count("found").alias("found"),
    ).withColumn("recall", F.col("found") / F.col("relevant"))
