"""What several operators share: folds, bounded samples, connected components.

Every operator reads the columns it is told and returns columns of its own, so
extra columns of the input, whatever their names, neither disturb nor pass on,
unless a docstring says that the input's columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larderspark.session import cut_lineage

#: Rows of one in-memory comparison, and comparisons along a side of a block: rows are copied per block.
BLOCK_ROWS, BLOCK_TILES = 1024, 16
#: Rows that one task of a blocked comparison reads, about.
TASK_ROWS = 50_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def fold(row_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(row_id).cast("string").cast("binary")) % folds, F.lit(-1))


#: Whole texts that go to Python in one Arrow batch, at most.
TEXT_ROWS = 500
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored_in_batches(df: DataFrame, name: str, rows: int = TEXT_ROWS) -> DataFrame:
    """``df``, computed with Arrow batches of at most ``rows`` rows, and stored.

    A batch of whole texts is held several times at once outside the heap:
    growing vectors, the buffer they are sent from, and Python's copy. Spark
    plans a lazy frame with the setting of the time it is written, so the
    result is written here and the session's setting put back.
    """
    conf = df.sparkSession.conf
    before = conf.get(BATCH_ROWS, None)
    conf.set(BATCH_ROWS, str(rows))
    try:
        return cut_lineage(df, name)
    finally:
        if before is None:
            conf.unset(BATCH_ROWS)
        else:
            conf.set(BATCH_ROWS, before)


#: Steps of the share by which samples are drawn: fine enough for any table.
SHARE = 1 << 40


def drawn(share: Column, *keys: str) -> Column:
    """Whether the hash of ``keys`` falls into ``share`` (0 to 1)."""
    return F.pmod(F.xxhash64(F.lit("sample"), *keys), F.lit(SHARE)) < (share * SHARE).cast("long")


def bounded_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``rows`` rows with different ``keys``, chosen by their hash; all rows of a small table.

    The share follows from the counted size, so the sample has the same bound
    at every scale. Of rows with equal keys one is in the sample, so a key
    that a third of all rows have counts once (they are combined map-side).
    """
    total = df.count()
    if total <= rows:
        return df
    return df.filter(drawn(F.lit(rows / total), *keys)).dropDuplicates(list(keys))


def one_text(rows: DataFrame, row: str, *keep: str) -> DataFrame:
    """One row per ``row`` of (row, text, keep): that of the least text digest. ``keep`` is equal in all of them."""
    best = F.min_by("text", F.struct(F.xxhash64("text"), F.hash("text")))
    return rows.groupBy(row, *keep).agg(best.alias("text"))


def training_labels(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, label) of the learning folds, one row per document.

    Null ids and labels are left out, and so are documents with contradictory
    labels; repeated rows count once.
    """
    return (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .filter(fold("doc_id", folds) != held_out)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .filter("label = most")
        .select("doc_id", "label")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an undirected graph of long ids (a, b).

    Each round every node moves to its neighbour of least random priority (or
    stays), and the edges are drawn anew between the targets: the node of
    highest priority of each component always goes, on average a good share
    does, and stars collapse at once. Only minima per node are gathered, and a
    node with very many edges is a skewed join key that adaptive execution
    splits. The root is one member of the component, the same for all.
    """
    edges = cut_lineage(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )

    def few(df: DataFrame, rows: int) -> DataFrame:
        """At most ``rows`` rows, from no more tasks (and files) than they need."""
        return df.coalesce(max(1, -(-rows // TASK_ROWS)))

    labels, turn, left, nodes = None, 0, edges.count(), 0
    while left:
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        priority = lambda node: F.struct(F.xxhash64(F.lit(turn), node).alias("p"), F.col(node).alias("n"))
        moves = cut_lineage(
            few(both.groupBy("a").agg(F.min(priority("b")).alias("least"))
                .select(F.col("a").alias("node"), F.least("least", priority("a"))["n"].alias("target")), 2 * left),
            "moves",
        )
        drawn = (
            edges.join(moves.select(F.col("node").alias("a"), F.col("target").alias("x")), "a")
            .join(moves.select(F.col("node").alias("b"), F.col("target").alias("y")), "b")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        edges = cut_lineage(few(drawn, left), "edges")
        if labels is None:
            labels, nodes = moves.withColumnRenamed("target", "root"), 2 * left
        else:
            step = moves.select(F.col("node").alias("root"), "target")
            labels = cut_lineage(few(
                labels.join(step, "root", "left").select("node", F.coalesce("target", "root").alias("root")), nodes), "labels")
        left = edges.count()
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def in_partitions(df: DataFrame, rows: int, keys: list[str], work: Callable, schema: str) -> DataFrame:
    """``work`` on whole partitions of about TASK_ROWS rows that hold all rows of their keys.

    For keys with a bounded number of rows each: the number of partitions grows
    with the rows, so what a task holds does not.
    """
    import pandas as pd

    def whole(batches):
        held = [b for b in batches if len(b)]
        if held:
            yield from work(pd.concat(held, ignore_index=True))

    shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(shuffle, -(-rows // TASK_ROWS)), *keys).mapInPandas(whole, schema)


def runs_of(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and the bounds of their runs in it."""
    order = np.lexsort(columns[::-1])
    if not len(order):
        return order, np.zeros(1, int)
    new = np.zeros(len(order), bool)
    new[0] = True
    for c in columns:
        c = np.asarray(c)[order]
        new[1:] |= c[1:] != c[:-1]
    return order, np.append(np.flatnonzero(new), len(order))


def tiles(rows: int, columns: int, size: int = BLOCK_ROWS):
    """Pairs of slices that cover a matrix in pieces of at most ``size`` by ``size``."""
    for a in range(0, rows, size):
        for b in range(0, columns, size):
            yield slice(a, a + size), slice(b, b + size)


def spanning_edges(links: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of the bipartite link matrix: at most one edge per row and column.

    ``rows`` and ``columns`` name the two sides' nodes; a node may be on both.
    """
    r, c = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
    if not len(r):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    links = links[np.ix_(r, c)]
    nodes, at = np.unique(np.concatenate([rows[r], columns[c]]), return_inverse=True)
    left, right = at[: len(r)], at[len(r) :]
    label = np.arange(len(nodes))
    far = len(nodes)
    while True:
        before = label.copy()
        # least label over each row's links, then over each column's, then two hops along the labels
        np.minimum.at(label, left, np.where(links, label[right][None, :], far).min(1))
        np.minimum.at(label, right, np.where(links, label[left][:, None], far).min(0))
        label = label[label]
        label = label[label]
        if (label == before).all():
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]
