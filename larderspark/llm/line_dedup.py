"""Line dedup: repeated runs of lines, found by a suffix array over line ids.

The documents' lines are one long sequence, cut at document ends. Prefix
doubling ranks its suffixes: round k orders the pairs (rank of the first 2^k
lines, rank of the next 2^k), and a rank stands for an interval of the suffix
array whose suffixes share 2^(k+1) lines. Suffixes whose interval has no
other member are done and leave. Going back from the longest powers to single
lines, the intervals are refined by halves to exact longest-common-prefix
intervals, until every suffix has the longest prefix that also starts
earlier. Such a run is a later copy and is deleted if it has enough words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larderspark.llm.common import spare
from larderspark.session import cut_lineage

#: A later copy of a run is deleted if it has so many words in all.
LEAST_WORDS = 20
BLANKS = r"[\x20\x09-\x0D]+"


def row_key(row: str, text: str) -> Column:
    """Order and identity of a document: its id, then a digest of its text. Null ids come first."""
    return F.struct(F.col(row).alias("id"), F.xxhash64(F.lit(1), text).alias("k1"), F.hash(F.lit(2), text).alias("k2"))


def lines_of(docs: DataFrame, row: str, text: str) -> DataFrame:
    """(doc, i, line, words): every line of every document. A line's id is a 96-bit digest."""
    line = F.col("raw")
    words = F.size(F.filter(F.split(line, BLANKS), lambda w: w != ""))
    return (
        docs.select(row_key(row, text).alias("doc"), F.posexplode(F.split(F.col(text), "\n")).alias("i", "raw"))
        .select("doc", "i", F.struct(F.xxhash64("raw").alias("h1"), F.hash("raw").alias("h2")).alias("line"), words.alias("words"))
    )


def place() -> Column:
    """Position in the whole sequence, comparable."""
    return F.struct("doc", "i")


def ranked(members: DataFrame, *keys: str) -> DataFrame:
    """(keys, rank, first): a rank for every repeated key, in key order, and the first place that has it.

    The order is a range-partitioned sort of the distinct repeated keys; ids
    that rise along it are the ranks.
    """
    repeated = members.groupBy(*keys).agg(F.count("*").alias("size"), F.min(place()).alias("first")).filter("size > 1")
    return repeated.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()).drop("size")


def rank_tables(lines: DataFrame) -> list[DataFrame]:
    """Table k: (doc, i, rank, first) of the places whose first 2^k lines occur again; table 0 also has ``words``."""
    table = cut_lineage(
        lines.join(ranked(lines, "line"), "line").select("doc", "i", "words", "rank", "first"), "doubling"
    )
    tables = []
    while not table.isEmpty():
        tables.append(table)
        step = 1 << (len(tables) - 1)
        ahead = Window.partitionBy("doc").orderBy("i").rangeBetween(step, step)
        pairs = cut_lineage(
            table.select("doc", "i", "rank", F.first("rank").over(ahead).alias("next")).filter("next is not null")
            .withColumnRenamed("rank", "head"),
            "pairs",
        )
        table = cut_lineage(
            pairs.join(ranked(pairs, "head", "next"), ["head", "next"]).select("doc", "i", "rank", "first"), "doubling"
        )
    return tables


def later_copies(tables: list[DataFrame]) -> DataFrame:
    """(doc, i, length, first): for every place the longest run of lines from it that also starts earlier, at ``first``.

    A node is a place in an interval: its first ``length`` lines are those at
    ``first``. At step k each interval splits by the next 2^k lines. Whoever
    is not the first of its part moves there; the first stands for it, so it
    is in both.
    """
    nodes = None
    for k in range(len(tables) - 1, -1, -1):
        table = tables[k].select("doc", "i", "rank", "first")
        if nodes is not None:
            reach = nodes.withColumn("at", F.col("i") + F.col("length"))
            ahead = table.select("doc", F.col("i").alias("at"), F.col("rank").alias("next"))
            reach = cut_lineage(reach.join(ahead, ["doc", "at"], "left").drop("at"), "reach")
            ends = reach.filter("next is null").select("doc", "i", "length", "first")  # nothing repeated follows
            goes_on = reach.filter("next is not null")
            parts = cut_lineage(  # stored: its size is known, and a hot part's rows can be split over tasks
                goes_on.groupBy("first", "length", "next")
                .agg(F.count("*").alias("size"), F.min(place()).alias("own")).filter("size > 1").drop("size"),
                "parts",
            )
            split = goes_on.join(parts, ["first", "length", "next"], "left")
            stays = F.when(F.col("own").isNull() | (place() == F.col("own")), F.struct("length", "first"))
            moves = F.when(F.col("own").isNotNull(), F.struct(
                (F.col("length") + (1 << k)).alias("length"), F.col("own").alias("first")))
            nodes = split.select("doc", "i", F.explode(F.array(stays, moves)).alias("to")).filter("to is not null").select(
                "doc", "i", "to.length", "to.first").unionByName(ends)
        if k + 1 < len(tables):
            deeper = tables[k + 1].filter(place() > F.col("first")).select("doc", "i")
            table = table.join(deeper, ["doc", "i"], "left_anti")
        fresh = table.select("doc", "i", F.lit(1 << k).alias("length"), "first")
        nodes = fresh if nodes is None else nodes.unionByName(fresh)
    best = F.max(F.struct("length", "first"))
    return nodes.filter(place() > F.col("first")).groupBy("doc", "i").agg(best.alias("best")).select("doc", "i", "best.*")


def repeated_runs(docs: DataFrame, row: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame | None:
    """(doc, i, length, words, first): later copies of runs of lines with ``least_words`` words or more.

    None if no line occurs twice. The order of documents is that of ``row_key``.
    """
    lines = lines_of(docs.select(row, text).filter(F.col(text).isNotNull()), row, text)
    # repeated rows are one document; its lines are shorter to compare than its text
    tables = rank_tables(cut_lineage(lines.dropDuplicates(["doc", "i"]), "lines"))
    if not tables:
        return None
    along = Window.partitionBy("doc").orderBy("i")
    sums = cut_lineage(tables[0].select("doc", "i", F.sum("words").over(along).alias("upto"), "words"), "sums")
    runs = later_copies(tables)
    begun = runs.join(sums.select("doc", "i", (F.col("upto") - F.col("words")).alias("before")), ["doc", "i"])
    ended = sums.select("doc", F.col("i").alias("last"), "upto")
    return (
        begun.withColumn("last", F.col("i") + F.col("length") - 1).join(ended, ["doc", "last"])
        .select("doc", "i", "length", (F.col("upto") - F.col("before")).alias("words"), "first")
        .filter(F.col("words") >= least_words)
    )


def deleted_ranges(runs: DataFrame) -> DataFrame:
    """(doc, ranges): per document the joined ranges (low, high: exclusive) of lines in some run, in order."""
    along = Window.partitionBy("doc").orderBy("i", "length")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    ends = runs.select("doc", "i", "length", (F.col("i") + F.col("length")).alias("end"))
    opened = ends.withColumn("new", (F.col("i") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int"))
    numbered = opened.withColumn("island", F.sum("new").over(along))
    return (
        numbered.groupBy("doc", "island").agg(F.min("i").alias("low"), F.max("end").alias("high"))
        .groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("ranges"))
    )


def dedup_lines(
    docs: DataFrame, row: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, removed: str = "removed_lines"
) -> DataFrame:
    """``docs``, all columns, with later copies of repeated runs deleted from ``text`` and their lines counted.

    Lines are what line feeds separate. The first occurrence of every line
    stays (documents in order of id, then of a text digest). Null texts stay
    null, texts without a deleted run stay as they are, and a text of which
    every line goes becomes empty. Repeated rows (same id and text) count as
    one document and get the same result. A column named ``removed`` is replaced.
    """
    runs = repeated_runs(docs, row, text, least_words)
    if runs is None:
        return docs.withColumn(removed, F.lit(0).cast("long"))
    key, ranges = spare(docs, "line_dedup_key"), spare(docs, "line_dedup_ranges")
    cuts = deleted_ranges(runs).select(F.col("doc").alias(key), F.col("ranges").alias(ranges))
    lines = F.split(F.col(text), "\n")
    # kept stretches: from the end of each range to the start of the next one
    tail = F.array(F.struct(F.size(lines).alias("low"), F.size(lines).alias("high")))
    starts = F.concat(F.array(F.lit(0)), F.transform(ranges, lambda r: r["high"]))
    stops = F.transform(F.concat(F.col(ranges), tail), lambda r: r["low"])
    bind = F.get(F.transform(F.array(lines), lambda whole: F.array_join(F.flatten(F.transform(
        F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda s: F.slice(whole, s["a"] + 1, s["b"] - s["a"]))), "\n")), 0)
    gone = F.aggregate(ranges, F.lit(0).cast("long"), lambda n, r: n + r["high"] - r["low"])
    return (
        docs.withColumn(key, row_key(row, text)).join(cuts, key, "left")
        .withColumn(removed, F.coalesce(gone, F.lit(0)))
        .withColumn(text, F.when(F.col(ranges).isNull(), F.col(text)).otherwise(bind))
        .drop(key, ranges)
    )
