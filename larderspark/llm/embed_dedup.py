"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells.

Vectors are compared only within a group (equal label, equal length). Equal
vectors are one class with a multiplicity. Every class is at home in the cell
of its nearest centre and a guest in every other cell that could hold a
partner: a vector farther than the threshold angle from the border between
its own centre and another one has no partner in the other's cell. So cells
lose no pair, whatever the centres are; good centres only make it cheap.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from larderspark.llm.common import BLOCK_ROWS, BLOCK_TILES, bounded_sample, components, in_partitions, runs_of, spanning_edges, tiles
from larderspark.session import cut_lineage

THRESHOLD = 0.98
#: Vectors that the centres are fitted on, at most (chosen by hash).
TRAINING_ROWS = 20_000
#: Classes per home cell that the number of centres aims at, and its bounds.
CELL_ROWS, MOST_CENTRES = 2_000, 1_024
#: Bytes of the vectors of one block, about.
BLOCK_BYTES = 16 << 20
#: Slack of the border test for rounding.
SLACK = 1e-9


def unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow of squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def centres_of(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from k spread starting rows; empty cells keep their centre."""
    picks = [0]
    nearest = vectors @ vectors[0]
    while len(picks) < min(k, len(vectors)):
        picks.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, vectors @ vectors[picks[-1]])
    centres = vectors[picks]
    for _ in range(rounds):
        cell = (vectors @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, vectors)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centres)
    return centres


def fit_centres(classes: DataFrame, cell_rows: int = CELL_ROWS, rows: int = TRAINING_ROWS) -> dict[int, np.ndarray]:
    """Centres per vector length, about one per ``cell_rows`` classes of the largest group."""
    largest = classes.groupBy("label", "width").count().groupBy("width").agg(F.max("count").alias("n")).collect()
    counts = {r["width"]: min(MOST_CENTRES, -(-r["n"] // cell_rows)) for r in largest}
    many = [w for w, k in counts.items() if k > 1]
    out = {}
    if many:
        sample = bounded_sample(classes.filter(F.col("width").isin(many)), rows, "node").select("width", "embedding").toPandas()
        for width, part in sample.groupby("width"):
            out[int(width)] = centres_of(unit(part["embedding"]), counts[width])
    return out


def cells(classes: DataFrame, centres: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """``classes`` once per cell: column ``cell``, and ``home`` for its own one (first in the list)."""
    border = np.sqrt(1 - threshold**2) + SLACK
    # distances of centres from their products, rounded up; made once, here
    between = {width: np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0) + 1e-12) for width, c in centres.items()}

    @F.pandas_udf(ArrayType(IntegerType()))
    def of(vectors: pd.Series) -> pd.Series:
        out: list = [None] * len(vectors)
        widths = vectors.map(len).to_numpy()
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            c = centres.get(int(width))
            if c is None or len(c) < 2:
                for i in at:
                    out[i] = [0]
                continue
            apart = between[int(width)]
            for low in range(0, len(at), BLOCK_ROWS):
                rows = at[low : low + BLOCK_ROWS]
                near = unit(vectors.iloc[rows]) @ c.T
                own = near.argmax(1)
                gap = near[np.arange(len(rows)), own][:, None] - near
                guest = gap <= border * apart[own] + SLACK
                guest[np.arange(len(rows)), own] = False
                for i, home, row in zip(rows, own, guest):
                    out[i] = [int(home), *np.flatnonzero(row).tolist()]
        return pd.Series(out)

    return classes.select("*", F.posexplode(of("embedding")).alias("turn", "cell")).withColumn("home", F.col("turn") == 0).drop("turn")


def links(classes: DataFrame, threshold: float, cell_rows: int = CELL_ROWS, block: int | None = None) -> DataFrame:
    """(node, other, n): per class and block, the rows linked with it, and the edges of a spanning forest.

    Rows with ``n`` count links of ``node`` (with multiplicity, itself left
    out); rows with ``other`` are edges. A cell is cut into home and guest
    blocks of ``block`` rows (unset: as many as BLOCK_BYTES hold); only block
    pairs, never whole cells, are in memory, and they are multiplied tile by tile.
    """
    if block is None:
        widest = classes.agg(F.max("width")).first()[0] or 1
        block = min(max(BLOCK_BYTES // (8 * widest), BLOCK_ROWS), BLOCK_ROWS * BLOCK_TILES)
    placed = cells(classes, fit_centres(classes, cell_rows), threshold)
    sizes = placed.groupBy("label", "width", "cell").agg(
        F.greatest(F.lit(1), F.ceil(F.count_if("home") / block)).alias("homes"),
        F.ceil(F.count("*") / block).alias("alls"),
    )
    same = [placed[c].eqNullSafe(sizes[c]) for c in ("label", "width", "cell")]
    dealt = placed.join(sizes, same).select(placed["*"], "homes", "alls")
    spot = lambda n: F.pmod(F.xxhash64(F.lit("block"), "node"), F.col(n))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    keep = ["label", "width", "cell"]
    left = dealt.filter("home").withColumn("h", spot("homes")).withColumn("c", upto("alls")).withColumn("left", F.lit(True))
    right = dealt.withColumn("c", spot("alls")).withColumn("h", upto("homes")).withColumn("left", F.lit(False))
    rows = left.unionByName(right).select(*keep, "h", "c", "left", "node", "times", "embedding")
    rows = cut_lineage(rows, "cells")

    def compare(part: pd.DataFrame):
        label = part["label"].to_numpy()
        order, bounds = runs_of(label, *[part[c].to_numpy() for c in ("width", "cell", "h", "c")])
        node, times, side = (part[c].to_numpy()[order] for c in ("node", "times", "left"))
        vectors = part["embedding"].to_numpy()[order]
        for low, high in zip(bounds[:-1], bounds[1:]):
            l, r = low + np.flatnonzero(side[low:high]), low + np.flatnonzero(~side[low:high])
            if not len(l) or not len(r):
                continue
            left, right, n, edges = unit(vectors[l]), unit(vectors[r]), np.zeros(len(l), np.int64), []
            for i, j in tiles(len(l), len(r)):
                close = left[i] @ right[j].T >= threshold
                close &= node[l[i]][:, None] != node[r[j]][None, :]
                if close.any():
                    n[i] += close @ times[r[j]]
                    edges.append(spanning_edges(close, node[l[i]], node[r[j]]))
            some = n > 0
            if some.any():
                a, b = (np.concatenate(side) for side in zip(*edges))
                yield pd.DataFrame({
                    "node": np.concatenate([node[l][some], a]), "other": np.concatenate([np.full(some.sum(), -1), b]),
                    "n": np.concatenate([n[some], np.zeros(len(a), np.int64)]),
                })

    return in_partitions(rows, rows.count(), [*keep, "h", "c"], compare, "node long, other long, n long")


def group_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of (vec_id, embedding, label).

    Vectors link within equal non-null labels and equal lengths, at a cosine
    (double precision) of ``threshold`` or more. Rows with a null label, or a
    vector that is null, empty, zero or has null or non-finite components,
    link with nothing. Repeated rows count as links of one another. Null ids
    never become a component's id unless it has no other.
    """
    rows = embeddings.select("vec_id", "embedding", "label")
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    key = ["label", "width", "k1", "k2"]
    keyed = rows.filter(usable).select(
        "vec_id", "label", F.size("embedding").alias("width"), F.xxhash64("embedding").alias("k1"),
        F.hash("embedding").alias("k2"), "embedding",
    )
    classes = cut_lineage(
        keyed.groupBy(*key).agg(
            F.count("*").alias("times"), F.min("vec_id").alias("least"), F.any_value("embedding").alias("embedding")
        ).withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    found = cut_lineage(links(classes.select("label", "width", "node", "times", "embedding"), threshold, cell_rows), "links")
    counts = found.filter("other < 0").groupBy("node").agg(F.sum("n").alias("others"))
    roots = components(found.filter("other >= 0").select(F.col("node").alias("a"), F.col("other").alias("b")))
    rooted = cut_lineage(
        classes.select(*key, "node", "times", "least").join(counts, "node", "left").join(roots, "node", "left")
        .select(*key, "least", (F.coalesce("others", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                F.coalesce("root", "node").alias("root")),
        "rooted",
    )
    best = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    grouped = keyed.drop("embedding").join(rooted.join(best, "root").drop("root", "least"), key)
    alone = rows.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return grouped.select("vec_id", "n_links", "component_id").unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
