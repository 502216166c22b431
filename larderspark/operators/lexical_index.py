"""Inverted q-gram index for keyword ranking.

Every document is listed under each stretch of one to ``GRAM`` characters of
its text and label. A literal of a query can only occur in documents that are
listed under all of its longest stretches, so a search reads the lists of the
asked stretches, intersects them, and counts exactly in the few documents
that are left. The ranking is that of a full scan, row by row.

A list also knows how often one document of its segment has the stretch, at
most. That bounds the score any document of a segment can reach, so a bounded
search starts with each query's best segments and reads others only while
they could still change its result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larderspark.operators import lexical
from larderspark.operators.blocks import bounded_blocks, small
from larderspark.operators.ranking import merge_top_k
from larderspark.session import cut_lineage

#: Characters of the longest stretches, and partitions of the lists.
GRAM, BUCKETS = 3, 64
#: Documents of one list: it is bounded, however common a stretch is.
SEGMENT = 4_096
#: Stretches of documents that a task sorts together.
MOST_ENTRIES = 2_000_000
#: Fields of a list beside its bucket.
LIST = "gram string, segment bigint, packed binary, most_text int, most_label int"


def bucket_of(gram: str) -> int:
    return zlib.crc32(gram.encode()) % BUCKETS


def gram_keys(value: str) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts): the stretches of ``value`` as numbers, 21 bits a character, and how often each begins there."""
    c = np.frombuffer(value.encode("utf-32-le"), np.uint32).astype(np.int64) + 1  # zero: no character
    one = c << 42
    two = one[:-1] | c[1:] << 21
    return np.unique(np.concatenate([one, two, two[:-1] | c[2:]]), return_counts=True)


def gram_of(key: int) -> str:
    return "".join(chr(c - 1) for c in (key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF) if c)


def longest_grams(pattern: str) -> list[str]:
    """The stretches that every document with the pattern is listed under."""
    n = min(GRAM, len(pattern))
    return sorted({pattern[i : i + n] for i in range(len(pattern) - n + 1)})


def pack(offsets: list[int]) -> bytes:
    """Rising numbers below SEGMENT as gaps, of one byte each if all of them fit, else of two."""
    gaps = np.diff(np.array(offsets, np.int64), prepend=-1) - 1
    kind = "<u1" if gaps.max() < 256 else "<u2"
    return kind[-1:].encode() + gaps.astype(kind).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed[1:], f"<u{packed[:1].decode()}").astype(np.int64) + 1) - 1


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: the lists of a partition's documents, segment by segment."""
    schema = pa.schema([("bucket", pa.int32()), ("gram", pa.string()), ("segment", pa.int64()), ("packed", pa.binary()),
                        ("most_text", pa.int32()), ("most_label", pa.int32())])
    parts: list[tuple] = []  # (keys, counts, row, side) of the segment's texts and labels
    size, now = 0, None

    def batch_of() -> pa.RecordBatch:
        keys = np.concatenate([p[0] for p in parts])
        counts = np.concatenate([p[1] for p in parts])
        row, side = (np.repeat([p[i] for p in parts], [len(p[0]) for p in parts]) for i in (2, 3))
        order = np.lexsort((row, keys))
        keys, counts, row, side = keys[order], counts[order], row[order], side[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        most = [np.maximum.reduceat(np.where(side == n, counts, 0), first) for n in (0, 1)]
        again = np.append(False, (keys[1:] == keys[:-1]) & (row[1:] == row[:-1]))  # in text and label
        keys, row = keys[~again], row[~again]
        opens = np.append(True, keys[1:] != keys[:-1])
        gaps = row - np.where(opens, -1, np.append(0, row[:-1])) - 1
        starts = np.flatnonzero(opens)
        narrow = (np.maximum.reduceat(gaps, starts) < 256).tolist()
        ones, twos = gaps.astype("<u1").tobytes(), gaps.astype("<u2").tobytes()
        ends = np.append(starts[1:], len(keys)).tolist()
        packed = [b"1" + ones[a:b] if few else b"2" + twos[2 * a : 2 * b] for a, b, few in zip(starts.tolist(), ends, narrow)]
        names = [gram_of(k) for k in keys[starts].tolist()]
        return pa.RecordBatch.from_arrays([
            pa.array([bucket_of(g) for g in names], pa.int32()), pa.array(names), pa.array([now] * len(names), pa.int64()),
            pa.array(packed, pa.binary()), *[pa.array(m, pa.int32()) for m in most]], schema=schema)

    for batch in batches:
        for row, *sides in zip(*(batch.column(c).to_pylist() for c in ("row", "text_lower", "label_lower"))):
            segment, offset = divmod(row, SEGMENT)
            if parts and (segment != now or size > MOST_ENTRIES):  # a segment may come in several lists
                yield batch_of()
                parts, size = [], 0
            now = segment
            for side, value in enumerate(sides):
                if value:
                    keys, counts = gram_keys(value)
                    parts.append((keys, counts, offset, side))
                    size += len(keys)
    if parts:
        yield batch_of()


def write_index(products: DataFrame, path: str) -> None:
    """Write the documents (from ``search_ready``) with row numbers, and their lists by bucket, to ``path``.

    Rows are numbered where they lie and listed in that order, so documents
    are not shuffled; only packed lists move, by ranges of (bucket, stretch).
    """
    products.withColumn("row", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{path}/documents")
    stored = products.sparkSession.read.parquet(f"{path}/documents").select("row", "text_lower", "label_lower")
    lists = cut_lineage(  # the ranges are sampled: list once
        stored.mapInArrow(_lists, f"bucket int, {LIST}"), "lists")
    lists.repartitionByRange("bucket", "gram", "segment").sortWithinPartitions("bucket", "gram").write.mode(
        "overwrite").partitionBy("bucket").parquet(f"{path}/lists")


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents, lists)."""
    lists = spark.read.schema(f"{LIST}, bucket int")  # no file tells it if all are empty
    return spark.read.parquet(f"{path}/documents"), lists.parquet(f"{path}/lists")


def asked_lists(lists: DataFrame, patterns: list[str]) -> DataFrame:
    """The lists of the patterns' stretches: only their buckets are read, and only their row groups."""
    wanted = sorted({g for p in patterns for g in longest_grams(p)})
    return lists.filter(F.col("bucket").isin(sorted({bucket_of(g) for g in wanted})) & F.col("gram").isin(wanted))


def candidates(lists: DataFrame, patterns: list[str]) -> DataFrame:
    """(row) of the documents that may have some of the patterns, once each.

    Lists meet per segment, so a task holds the asked lists of one segment:
    bounded numbers of patterns and rows.
    """
    needs = {p: longest_grams(p) for p in patterns}

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        known: dict[str, np.ndarray] = {}
        for gram, packed in zip(part["gram"], part["packed"]):  # a segment may have been listed in two tasks
            rows = np.zeros(SEGMENT, bool)
            rows[unpack(packed)] = True
            known[gram] = known[gram] | rows if gram in known else rows
        found = np.zeros(SEGMENT, bool)
        for grams_ in needs.values():
            if all(g in known for g in grams_):
                found |= reduce(np.logical_and, [known[g] for g in grams_])
        return pd.DataFrame({"row": int(part["segment"].iloc[0]) * SEGMENT + np.flatnonzero(found)})

    return asked_lists(lists, patterns).groupBy("segment").applyInPandas(meet, "row long")


def indexed_ranking(index: tuple[DataFrame, DataFrame], queries: DataFrame, k: int,
                    block_bytes: int = lexical.LEXICAL_BLOCK_BYTES) -> DataFrame:
    """``lexical.lexical_ranking`` of literal queries, reading only documents that may match.

    A document without any literal of a query scores nothing, so leaving it
    out changes no result. Queries go in blocks of a checked size; the row
    numbers found are broadcast only while they are few.
    """
    documents, lists = index
    terms = lexical.query_terms(queries)
    size = F.octet_length("phrase") * 2 + 64 + (2 * k + lexical.SPARE_ROWS) * lexical.ROW_BYTES
    results = []
    for block in bounded_blocks(terms, "query_id", size, block_bytes):
        patterns = sorted({t for r in block.select("terms").distinct().collect() for t in r.terms})  # size checked
        rows = cut_lineage(candidates(lists, patterns), "candidates")
        found = documents.join(small(rows, rows.count(), 16), "row", "left_semi").drop("row")
        asked = queries.join(F.broadcast(block.select("query_id")), "query_id", "left_semi")
        results.append(lexical.lexical_ranking(found, asked, k))
    if len(results) > 1:
        results = [cut_lineage(r) for r in results]
    return reduce(DataFrame.unionByName, results)


def score_bounds(lists: DataFrame, plan: list[tuple]) -> DataFrame:
    """(query, segment, bound): the most that a document of the segment can score, of all segments that may match.

    A literal occurs in a document no more often than each of its stretches.
    """
    weighed = [
        (q, [(longest_grams(p), w_text, w_label) for p, w_text, w_label in (
            (phrase, lexical.PHRASE_TEXT, lexical.PHRASE_LABEL), *((t, lexical.WORD_TEXT, lexical.WORD_LABEL) for t in terms))])
        for q, (_, phrase, terms) in enumerate(plan)]

    def bound(part: pd.DataFrame) -> pd.DataFrame:
        sides: dict[str, tuple[int, int]] = {}
        for gram, text_, label in zip(part["gram"], part["most_text"], part["most_label"]):
            known = sides.get(gram, (0, 0))
            sides[gram] = max(known[0], int(text_)), max(known[1], int(label))
        none = (0, 0)
        rows = []
        for q, uses in weighed:
            total = 0.0
            for grams_, w_text, w_label in uses:
                total += w_text * min(sides.get(g, none)[0] for g in grams_) + w_label * min(sides.get(g, none)[1] for g in grams_)
            if total > 0:
                rows.append((q, int(part["segment"].iloc[0]), total))
        return pd.DataFrame(rows, columns=["query", "segment", "bound"])

    patterns = [p for _, phrase, terms in plan for p in (phrase, *terms)]
    return asked_lists(lists, patterns).groupBy("segment").applyInPandas(bound, "query int, segment long, bound double")


def bounded_ranking(index: tuple[DataFrame, DataFrame], queries: DataFrame, k: int, first: int = 1,
                    block_bytes: int = lexical.LEXICAL_BLOCK_BYTES) -> tuple[DataFrame, int, int]:
    """(the rows of ``lexical.lexical_ranking``, segments read, segments that may match), over all blocks of queries.

    Each query starts with its ``first`` segments of the highest bound. A
    segment that is left is read only if its bound reaches the k-th score
    that some query has by then; ties are read. Nothing is lost.
    """
    documents, lists = index
    terms = lexical.query_terms(queries)
    size = F.octet_length("phrase") * 2 + 64 + (2 * k + lexical.SPARE_ROWS) * lexical.ROW_BYTES
    results, read, possible = [], 0, 0
    for block in bounded_blocks(terms, "query_id", size, block_bytes):
        plan = lexical._plan(block.collect())  # size checked
        if not plan:
            continue
        names = block.sparkSession.createDataFrame(
            [(q, i) for q, (ids, _, _) in enumerate(plan) for i in ids],
            f"query int, query_id {queries.schema['query_id'].dataType.simpleString()}")
        patterns = sorted({t for _, _, words in plan for t in words})
        asked = queries.join(F.broadcast(block.select("query_id")), "query_id", "left_semi")
        bounds = cut_lineage(score_bounds(lists, plan), "bounds")

        def ranked(segments: DataFrame) -> DataFrame:
            few = small(segments, segments.count(), 16)
            rows = cut_lineage(candidates(lists.join(few, "segment", "left_semi"), patterns), "candidates")
            found = documents.join(small(rows, rows.count(), 16), "row", "left_semi").drop("row")
            return cut_lineage(lexical.lexical_ranking(found, asked, k), "ranked")

        order = Window.partitionBy("query").orderBy(F.desc("bound"), "segment")
        start = cut_lineage(
            bounds.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= first).select("segment").distinct(), "start")
        best = ranked(start)
        kth = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("lexical_score").alias("least")).filter(F.col("n") == k)
        bars = names.join(kth, "query_id", "left").groupBy("query").agg(F.max("least").alias("bar"))
        left = cut_lineage(
            bounds.join(bars, "query").filter("bar is null or bound >= bar").select("segment").distinct()
            .join(start, "segment", "left_anti"), "left")
        more = left.count()
        read, possible = read + start.count() + more, possible + bounds.select("segment").distinct().count()
        results.append(merge_top_k(
            best.unionByName(ranked(left)).drop("rank"), ["query_id"], lexical.ranking_order(), k) if more else best)
    if not results:
        return lexical.lexical_ranking(documents.limit(0), queries, k), 0, 0
    return reduce(DataFrame.unionByName, results), read, possible
