"""SimHash near-dedup with covering locality-sensitive hashing.

Every document has a 64-bit fingerprint of its word shingles. Fingerprints
that differ in at most ``radius`` bits are found in 2^(radius+1) - 1 tables,
each of which compares the bits under one mask. Bit i carries a vector of
radius + 1 bits; table v sees the bits whose vector has an odd product with v.
Any ``radius`` differing bits leave some v that is even with all their
vectors, so every pair within the radius agrees under some mask.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from larderspark.llm.common import BLOCK_ROWS, BLOCK_TILES, components, in_partitions, runs_of, spanning_edges, spare, tiles
from larderspark.session import cut_lineage

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit fingerprint of one whole text; 0 for null or no words.

    A-Z lower-cased, words between ASCII white space, shingles joined by one
    space, repeats included; fewer words than a shingle make one.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(len(words) - shingle + 1, 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:count].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    sums = np.zeros(64, np.int64)
    for low in range(0, count, 65_536):  # bounded memory for very long texts
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[low : low + 65_536], stops[low : low + 65_536])], "<u8")
        sums += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * sums > count, bitorder="little")
    return int(bits.view("<i8")[0])


@F.pandas_udf(LongType())
def fingerprint_column(texts: pd.Series) -> pd.Series:
    return texts.map(fingerprint).astype("int64")


def masks(radius: int = RADIUS) -> list[int]:
    """The signed 64-bit masks of all tables; the bits' vectors are dealt out in turn, none is zero."""
    codes = [1 + (bit * 11) % (2 ** (radius + 1) - 1) for bit in range(64)]
    out = []
    for v in range(1, 2 ** (radius + 1)):
        mask = sum(1 << bit for bit, code in enumerate(codes) if (code & v).bit_count() % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def linked(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK_ROWS * BLOCK_TILES) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints (column ``fp``) within the radius.

    Whatever is within the radius is connected by the edges, directly or over
    others that are; a bucket gives at most an edge per member and block, not
    all its pairs. Buckets of two are compared as they are counted. Larger
    ones are cut into blocks of ``block`` rows, and pairs of blocks are spread
    over the tasks, so no bucket has to fit into one; a pair is compared tile
    by tile.
    """
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius
    keyed = prints.select(
        "fp",
        F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                            for t, m in enumerate(masks(radius))])).alias("k"),
    ).select("fp", "k.t", "k.key")
    buckets = cut_lineage(
        keyed.groupBy("t", "key").agg(F.count("*").alias("size"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .filter("size > 2 or (size = 2 and bit_count(a ^ b) <= %d)" % radius),
        "buckets",
    )
    pairs = buckets.filter("size = 2").select("a", "b").distinct()
    large = buckets.filter("size > 2").select("t", "key", F.ceil(F.col("size") / block).alias("blocks"))
    members = (
        keyed.join(large, ["t", "key"])
        .withColumn("own", F.pmod(F.xxhash64(F.lit("block"), "fp"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                (F.col("own") <= F.col("other")).alias("left"), (F.col("own") >= F.col("other")).alias("right"), "fp")
    )
    members = cut_lineage(members, "members")

    def link(rows: pd.DataFrame):
        columns = [rows[c].to_numpy() for c in ("t", "key", "i", "j")]
        order, bounds = runs_of(*columns)
        fp, left, right = (rows[c].to_numpy()[order] for c in ("fp", "left", "right"))
        found = []
        for low, high in zip(bounds[:-1], bounds[1:]):
            x, y = fp[low:high][left[low:high]], fp[low:high][right[low:high]]
            for i, j in tiles(len(x), len(y)):
                close = np.bitwise_count((x[i, None] ^ y[None, j]).view(np.uint64)) <= radius
                found.append(spanning_edges(close, x[i], y[j]))
        if found:
            a, b = (np.concatenate(side) for side in zip(*found))
            yield pd.DataFrame({"a": a, "b": b}).drop_duplicates()

    local = in_partitions(members, members.count(), ["t", "key", "i", "j"], link, "a long, b long")
    return pairs.filter(near("a", "b")).unionByName(local)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row, stored."""
    return cut_lineage(docs.select("doc_id", fingerprint_column("text").alias("fp")), "fingerprints")


def rooted(prints: DataFrame, least: Column, radius: int = RADIUS) -> DataFrame:
    """(fp, least, root) per distinct fingerprint of ``prints``: the aggregate ``least``, one fingerprint per component."""
    distinct = cut_lineage(prints.groupBy("fp").agg(least.alias("least")), "distinct")
    roots = components(linked(distinct.select("fp"), radius))
    return cut_lineage(
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )


def groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) per distinct fingerprint of (doc_id, fp): the least id reachable by links.

    Null ids count only where a whole component has no other; its id is null.
    """
    members = rooted(prints, F.min("doc_id"), radius)
    best = members.groupBy("root").agg(F.min("least").alias("component_id"))
    return members.join(best, "root").select("fp", "component_id")


def group_documents(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    Null and empty texts have fingerprint zero and are linked like any other;
    equal texts are in one component; repeated rows are repeated in the result.
    """
    prints = fingerprints(docs)
    return prints.join(groups(prints, radius), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def text_digest() -> Column:
    """Identity of a text; null counts as empty, as it does for the fingerprint."""
    return F.md5(F.coalesce(F.col("text"), F.lit("")))


def keep_one(docs: DataFrame, radius: int = RADIUS, repeats: bool = True) -> DataFrame:
    """``docs``, all columns, with one document of every group: the least by (id, nulls last, text digest).

    A document is an id and a text, so of rows without ids, or with one id and
    several texts, one stays. Rows that repeat both of them stay if
    ``repeats``, whatever their other columns; else the first of them by the
    other columns stays, and every group has exactly one row.
    """
    prints = cut_lineage(
        docs.select("doc_id", text_digest().alias("digest"), fingerprint_column("text").alias("fp"))
        .groupBy("fp", "doc_id", "digest").agg(F.count("*").alias("n")),
        "fingerprints",
    )
    members = rooted(prints, F.min(F.struct(F.isnull("doc_id").alias("last"), "doc_id", "digest", "n")), radius)
    best = cut_lineage(members.groupBy("root").agg(F.min("least").alias("k")).select("k.doc_id", "k.digest", "k.n"), "kept")
    key = spare(docs, "digest")
    keyed = docs.withColumn(key, text_digest())

    def rows_of(kept: DataFrame) -> DataFrame:
        return keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["doc_id"]) & (keyed[key] == kept["digest"]), "left_semi")

    if repeats or best.filter("n > 1").isEmpty():
        return rows_of(best).drop(key)
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "text"]))
    turn = spare(keyed, "turn")
    first = Window.partitionBy("doc_id", key).orderBy(others)
    single = rows_of(best.filter("n > 1")).withColumn(turn, F.row_number().over(first)).filter(F.col(turn) == 1).drop(turn)
    return rows_of(best.filter("n = 1")).unionByName(single).drop(key)
