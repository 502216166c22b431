"""Bounded blocks of a query table.

Search streams the documents past the queries. The query side is sent to every
task, so its size is measured first and split until each block is small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 64 * 1024 * 1024
BROADCAST_BYTES = 128 * 1024 * 1024
ID_ROW_BYTES = 64  # a row of one or two ids and numbers


def bounded_blocks(df: DataFrame, key: str, size: Column, limit: int = BLOCK_BYTES) -> list[DataFrame]:
    """``df`` as blocks of at most ``limit`` bytes (``size`` is per row).

    One block for the usual query table. Rows go to blocks by key hash; the
    block sizes are measured and the number doubled until all of them fit.
    A single row above the limit cannot be split and is an error.
    """
    stats = df.agg(F.sum(size).alias("total"), F.max(size).alias("largest")).first()
    if (stats.largest or 0) > limit:
        raise ValueError(f"one row of the query table takes more than {limit} bytes")
    if (stats.total or 0) <= limit:
        return [df]
    heaviest = df.groupBy(key).agg(F.sum(size).alias("bytes")).agg(F.max("bytes")).first()[0]
    if heaviest > limit:  # rows of one key cannot be split
        raise ValueError(f"the rows of one {key} take more than {limit} bytes")
    n = math.ceil(2 * stats.total / limit)
    while True:
        block = F.pmod(F.xxhash64(key), F.lit(n))
        sizes = df.groupBy(block.alias("block")).agg(F.sum(size).alias("bytes"))
        if sizes.agg(F.max("bytes")).first()[0] <= limit:
            return [df.filter(block == b) for b in range(n)]
        n *= 2


def small(df: DataFrame, rows: int, row_bytes: int = ID_ROW_BYTES) -> DataFrame:
    """Broadcast hint if the known number of rows is within the byte bound.

    Beyond it Spark plans a shuffled join and splits skewed keys at run time.
    Only for frames of ids: ``row_bytes`` says how wide a row can be.
    """
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
