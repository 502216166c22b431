"""Benchmark decontamination by spaced seeds.

A document leaks a benchmark item if on some alignment of the two word
sequences at least ``EQUAL`` of ``WINDOW`` consecutive words agree (words
beyond an end agree with nothing). Fixed masks hash some positions of a
stretch and ignore the others. Whatever two positions of a window differ, one
of the masks fits between them, so the join of hashes misses no such window;
the words around each hit are then compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderspark.llm.common import spare
from larderspark.operators.blocks import bounded_blocks, small
from larderspark.session import cut_lineage

#: Positions that each mask looks at. Together they meet every choice of two differing words in a window.
MASKS = ((0, 3, 6, 7, 8, 9), (0, 1, 3, 4, 6, 10))
WINDOW, EQUAL = 13, 11
#: Bytes of seeds that one pass over the documents may broadcast.
BLOCK_BYTES = 32 << 20
SEED_BYTES = 64
#: Words of an item's stretch; longer items are cut into stretches that overlap by two windows.
STRETCH = 10_000


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the words (runs of letters and digits, lower case) of one whole text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def with_seeds(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep, at, seed) for every position of the hash array ``words`` and every mask that fits there."""
    word = lambda offset: F.get("words", F.col("at") + offset)
    seeds = F.array(*[
        F.when(F.col("at") + mask[-1] < F.size("words"), F.xxhash64(F.lit(n), *[word(o) for o in mask]))
        for n, mask in enumerate(MASKS)
    ])
    return (
        rows.select("*", F.posexplode_outer("words").alias("at", "_word"))  # outer: else the hashes are made twice
        .select(*keep, "at", F.explode(seeds).alias("seed")).filter("seed is not null")
    )


def equal_words(document: Column, item: Column, shift: Column, around: Column) -> Column:
    """Most equal words in WINDOW consecutive positions of an alignment, within reach of one hit.

    Item position ``q`` stands beside document position ``q + shift``.
    """
    low = F.greatest(around - WINDOW, -shift, F.lit(0))
    high = F.least(around + 2 * WINDOW, F.size(item), F.size(document) - shift)
    n = high - low
    same = F.zip_with(
        F.slice(item, low + 1, n), F.slice(document, low + shift + 1, n),
        lambda a, b: F.when(a == b, 1).otherwise(0),
    )

    def best(flags: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(flags) - WINDOW + 1, F.lit(1)))
        return F.array_max(F.transform(starts, lambda s: F.aggregate(
            F.slice(flags, s, F.lit(WINDOW)), F.lit(0), lambda total, x: total + x)))

    return F.get(F.transform(F.array(same), best), 0)  # an array of one binds the flags, which are made once


def leaks(docs: DataFrame, items: DataFrame, row: str = "doc_id", text: str = "text", least: int = EQUAL) -> DataFrame:
    """(row, item_id, equal_words): per pair with a leak, the most equal words of any window.

    ``items`` has (item_id, text); rows and items with null ids count like any
    other, equal ids are one. Null texts and texts shorter than ``least``
    words leak nothing. The documents are read once per block of items whose
    seeds fit into BLOCK_BYTES (measured), and are never shuffled: a hit
    carries counts only, and pairs are reduced before they are.
    """
    overlap = 2 * WINDOW
    low = F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - overlap - 1, F.lit(0)), F.lit(STRETCH - overlap)))
    held = cut_lineage(
        items.select("item_id", word_hashes(F.col("text")).alias("words")).distinct()
        .select("item_id", "words", low.alias("low")).select("item_id", F.slice("words", F.col("low") + 1, STRETCH).alias("words"))
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    sequences = docs.select(F.col(row).alias("id"), word_hashes(F.col(text)).alias("words"))
    found = None
    for part in bounded_blocks(held, "item", F.size("words") * (len(MASKS) * SEED_BYTES), BLOCK_BYTES):
        seeds = with_seeds(part, "item").select("item", F.col("at").alias("there"), "seed")
        hits = (
            with_seeds(sequences, "id", "words")
            .join(F.broadcast(seeds), "seed")
            .join(F.broadcast(part.select("item", "item_id", F.col("words").alias("theirs"))), "item")
            .select("id", "item_id", equal_words(
                F.col("words"), F.col("theirs"), F.col("at") - F.col("there"), F.col("there")).alias("equal_words"))
            .filter(F.col("equal_words") >= least)
        )
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy("id", "item_id").agg(F.max("equal_words").cast("long").alias("equal_words")).withColumnRenamed("id", row)


def text_key(text: Column) -> Column:
    """Identity of a text."""
    return F.struct(F.xxhash64(F.lit(1), text).alias("k1"), F.xxhash64(F.lit(2), text).alias("k2"))


def drop_leaking(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs``, all columns, without the rows whose text leaks an item.

    A row is judged by its own text only: rows with the same id, or without
    one, stay unless they leak themselves, and equal texts share their fate.
    Null texts stay. The leaking texts' keys are counted and broadcast, so
    documents are not shuffled; beyond the byte bound they are joined by key.
    """
    key = spare(docs, "leaking_text")
    keyed = docs.withColumn(key, text_key(F.col("text")))
    bad = cut_lineage(leaks(keyed, items, row=key).select(key).distinct(), "leaking")
    return keyed.join(small(bad, bad.count()), key, "left_anti").select(*docs.columns)
