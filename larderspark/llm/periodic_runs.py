"""Periodic runs: stretches of words that repeat with a period, by the branching-tandem test on an enhanced suffix array.

Prefix doubling orders the suffixes of many documents at once (a rank holds
the document, so suffixes compare within one only) and gives the lengths of
common prefixes. An interval of the suffix array with common length q is
looked at without building a tree: its children are the stretches between its
least values, and for every suffix i of all but the largest child the ranks of
i + q and i - q tell whether they lie in the interval too. If they do and the
next words differ, a square of period q ends there. Its rotations to the left
make the run; multiples of a run's period are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderspark.functions.binding import let

#: A run has so many words, and so many periods, at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Characters of the documents that are ordered together (a longer document alone), and suffixes looked at together.
TOGETHER, CHUNK = 500_000, 125_000
#: Steps along chains of pointers before the rest is searched by galloping.
HOPS = 40
BLANKS = r"[\x20\x09-\x0D]+"


def words_of(texts: pa.Array) -> pa.ListArray:
    """The words of every text: runs of characters that are no ASCII white space; none for null."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    some = pc.not_equal(split.values, "").to_numpy(zero_copy_only=False)
    offsets = split.offsets.to_numpy()
    kept = np.concatenate([[0], np.cumsum(some)])[offsets]
    return pa.ListArray.from_arrays(pa.array(kept, pa.int32()), split.values.filter(pa.array(some)))


def common_words(x: np.ndarray, y: np.ndarray, end: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Equal words from positions ``x`` and ``y`` on, less than 2^len(levels); ``levels[m]`` ranks 2^m words."""
    last = len(end) - 1
    x, y, total = x.copy(), y.copy(), np.zeros(len(x), np.int64)
    stop_x, stop_y = end[np.minimum(x - 1, last)], end[np.minimum(y - 1, last)]  # x - 1, y - 1 are in the same document
    for m in range(len(levels) - 1, -1, -1):
        rank = levels[m]
        same = (x < stop_x) & (y < stop_y)
        same &= rank[np.minimum(x, last)] == rank[np.minimum(y, last)]
        step = same.astype(np.int64) << m
        x += step
        y += step
        total += step
    return total


def suffix_array(codes: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, rank, common): suffixes in order, the rank of each, and words shared by rank k - 1 and k.

    ``end`` has each position's document end. ``common`` has a zero at both
    ends and between documents.
    """
    n = len(codes)
    first = doc.astype(np.int64) * (int(codes.max()) + 1) + codes
    order = np.argsort(first, kind="stable")
    found = first[order]
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    opens = np.append(True, found[1:] != found[:-1])
    rank[order] = np.maximum.accumulate(np.where(opens, slots, 0))
    common = np.zeros(n + 1, np.int64)
    levels, reach = [rank.astype(np.int32)], 1
    live = ~opens
    live[:-1] |= live[1:]
    slots = np.flatnonzero(live)
    while len(slots):
        at = order[slots]
        own = rank[at]
        beyond = at + reach
        after = np.where(beyond < end[at], rank[np.minimum(beyond, n - 1)], -1)
        pair = own * (n + 1) + after + 1
        turn = np.argsort(pair, kind="stable")
        at, own, pair = at[turn], own[turn], pair[turn]
        order[slots] = at
        opens = np.append(True, pair[1:] != pair[:-1])
        parted = opens.copy()
        parted[0] = False
        parted[1:] &= own[1:] == own[:-1]
        there = np.flatnonzero(parted)
        common[slots[there]] = reach + common_words(at[there - 1] + reach, at[there] + reach, end, levels[:-1])
        rank[at] = np.maximum.accumulate(np.where(opens, slots, 0))
        levels.append(rank.astype(np.int32))
        live = ~opens
        live[:-1] |= live[1:]
        slots = slots[live]
        reach *= 2
    return order, rank, common


def smaller(values: np.ndarray, ks: np.ndarray, step: int) -> np.ndarray:
    """For every k of ``ks`` the nearest index in direction ``step`` with a smaller value.

    Pointers hop over pointers; a few long chains are searched in growing slices.
    """
    to = np.arange(len(values)) + step
    busy = ks[values[to[ks]] >= values[ks]]
    for _ in range(HOPS):
        if not len(busy):
            break
        to[busy] = to[to[busy]]
        busy = busy[values[to[busy]] >= values[busy]]
    for k in busy.tolist():
        at, width, value = int(to[k]), 256, values[k]
        while True:
            low, high = (max(at - width + 1, 0), at + 1) if step < 0 else (at, min(at + width, len(values)))
            hit = np.flatnonzero(values[low:high] < value)
            if len(hit):
                to[k] = low + (hit[-1] if step < 0 else hit[0])
                break
            at, width = (low - 1 if step < 0 else high), width * 2
    return to[ks]


def squares(
    codes: np.ndarray, begin: np.ndarray, end: np.ndarray, order: np.ndarray, rank: np.ndarray, common: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(last, q): ends of stretches of LEAST_PERIODS * q words with period q that no next word continues."""
    # an interval with a long run has four members: three values in a row are no less than its own
    n = len(codes)
    up = np.concatenate([common, [0, 0]])
    triple = np.minimum(np.minimum(up[:-2], up[1:-1]), up[2:])  # of k, k + 1, k + 2
    best = triple.copy()
    best[1:] = np.maximum(best[1:], triple[:-1])
    best[2:] = np.maximum(best[2:], triple[:-2])
    every = np.flatnonzero(common > 0)
    lows, highs = smaller(common, every, -1), smaller(common, every, 1)
    keep = best[every] >= common[every]
    keep &= highs - lows >= LEAST_PERIODS
    keep &= LEAST_PERIODS * common[every] <= end[order[every]] - begin[order[every]]
    ks, lows, highs = every[keep], lows[keep], highs[keep]
    if not len(ks):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    name = lows * (n + 2) + highs
    turn = np.argsort(name, kind="stable")
    ks, lows, highs, name = ks[turn], lows[turn], highs[turn], name[turn]
    fresh = np.append(True, name[1:] != name[:-1])
    closes = np.append(fresh[1:], True)
    # children: from the interval's low end or the value before up to each value, and from the last value to the high end
    group = np.cumsum(fresh) - 1
    child_low = np.concatenate([np.where(fresh, lows, np.append(0, ks[:-1])), ks[closes]])
    child_high = np.concatenate([ks, highs[closes]])
    child_group = np.concatenate([group, group[closes]])
    sizes = child_high - child_low
    turn = np.lexsort((-sizes, child_group))
    rest = turn[np.append(False, child_group[turn][1:] == child_group[turn][:-1])]
    child_low, sizes, child_group = child_low[rest], sizes[rest], child_group[rest]
    heads = np.flatnonzero(fresh)
    length, low, high = common[ks[heads]], lows[heads], highs[heads]

    lasts, periods = [], []
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(CHUNK, sizes.sum() + CHUNK, CHUNK))
    a = 0
    for b in np.minimum(cuts + 1, len(sizes)).tolist():
        if b <= a:
            continue
        part = sizes[a:b]
        starts = np.repeat(child_low[a:b] - (np.cumsum(part) - part), part) + np.arange(part.sum())
        own = np.repeat(child_group[a:b], part)
        a = b
        i = order[starts]
        q, lo, hi = length[own], low[own], high[own]

        def inside(j, lo, hi):
            at = rank[j]
            return (at >= lo) & (at < hi)

        # i and i + q, of which i is the square's start; then i - q and i
        for s in (i, i - q):
            ok = np.flatnonzero((s - 2 * q >= begin[i]) & (s + 2 * q <= end[i]))
            for shift in (0, 1, -1, -2):
                ok = ok[inside(s[ok] + shift * q[ok], lo[ok], hi[ok])]
            last = s[ok] + 2 * q[ok]
            stop = end[i[ok]]
            ends = last == stop
            ends |= codes[np.minimum(last, n - 1)] != codes[np.minimum(last, n - 1) - q[ok]]
            lasts.append(last[ends])
            periods.append(q[ok][ends])
    found = np.unique(np.stack([np.concatenate(lasts), np.concatenate(periods)], 1), axis=0)
    return found[:, 0], found[:, 1]


def runs_of(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(position, words, period) rows, in order, of all runs in documents of ``lengths`` words, one after the other."""
    none = np.zeros((0, 3), np.int64)
    if not len(codes):
        return none
    stops = np.cumsum(lengths)
    begin, end = np.repeat(stops - lengths, lengths), np.repeat(stops, lengths)
    order, rank, common = suffix_array(codes, np.repeat(np.arange(len(lengths)), lengths), end)
    out, now, reach = [], -1, 0
    for last, q in zip(*(x.tolist() for x in squares(codes, begin, end, order, rank, common))):  # by end, then period
        if last != now:
            now, reach = last, last
        at = last - LEAST_PERIODS * q
        if at >= reach:
            continue  # inside a run of a smaller period with the same end: a multiple of it
        least, width = int(begin[last - 1]), 64
        while at > least:  # rotate to the left as long as words q apart agree
            low = max(at - width, least)
            differ = np.flatnonzero(codes[low:at] != codes[low + q : at + q])
            if len(differ):
                at = low + int(differ[-1]) + 1
                break
            at, width = low, width * 2
        reach = min(reach, at)
        if last - at >= LEAST_WORDS:
            out.append((at, last - at, q))
    return np.array(sorted(out, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3) if out else none


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, text) per row of (doc_id, text): its runs and what is left without their repeats.

    ``runs`` are (start, length, period) in words, by start, then period: a
    run is a stretch with smallest period ``period`` and at least
    LEAST_WORDS words and LEAST_PERIODS periods that no neighbouring word
    extends. ``text`` joins by single spaces the words that are in no run or
    only in the first period of those they are in. Null and empty texts have
    no word and an empty text. Rows are independent: repeated rows and ids are
    repeated in the result. No shuffle; a task holds documents of about
    TOGETHER characters, or one longer document, beside the Arrow batch it got
    (``common.stored_in_batches`` keeps that small).
    """
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def some(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        lists = words_of(texts)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        lengths = np.diff(offsets)
        codes = lists.values.dictionary_encode().indices.to_numpy().astype(np.int64)
        found = runs_of(codes, lengths)
        doc = np.searchsorted(offsets, found[:, 0], side="right") - 1
        bounds = np.searchsorted(doc, np.arange(len(lengths) + 1))
        columns = [pa.array(found[:, 0] - offsets[doc]), pa.array(found[:, 1]), pa.array(found[:, 2])]
        runs = pa.ListArray.from_arrays(
            pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(run_type)))
        gone = np.zeros(len(codes) + 1, np.int64)
        np.add.at(gone, found[:, 0] + found[:, 2], 1)
        np.add.at(gone, found[:, 0] + found[:, 1], -1)
        left = np.cumsum(gone)[:-1] == 0
        kept = np.concatenate([[0], np.cumsum(left)])[offsets]
        words = lists.values if left.all() else lists.values.filter(pa.array(left))
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), words), " ")
        return pa.RecordBatch.from_arrays([ids, pa.array(lengths), runs, text], ["doc_id", "n_words", "runs", "text"])

    def work(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(ids):
                before = sizes[at - 1] if at else 0
                to = max(int(np.searchsorted(sizes, before + TOGETHER, side="right")), at + 1)
                yield some(ids.slice(at, to - at), texts.slice(at, to - at))
                at = to

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, text string"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document (by crc32 of the id, h) the words from a on repeat with period p.

    g = h / 10, a = g % n, p = 1 + (n - a) / (3 + g % 8) for n words (whole
    quotients). Other documents, and those without an id or a word, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def altered(words: Column) -> Column:
        n = F.size(words)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        again = let(p, lambda p: F.transform(F.sequence(a, n - 1), lambda i: F.get(words, a + (i - a) % p)))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, 1, a), again), " "))

    words = F.filter(F.split(F.col("text"), BLANKS), lambda w: w != "")
    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(let(words, altered), F.col("text"))).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """One row per row of ``find_runs``: number of runs, the one with most periods, and digests of runs and text.

    Of runs with equally many periods (compared as exact quotients) the one
    that starts first, then the one of the least period; nulls without a run.
    """
    rank = lambda r: F.struct((r["length"] / r["period"]).alias("e"), (-r["start"]).alias("s"), (-r["period"]).alias("p"),
                              r["length"].alias("n"))
    most = F.array_max(F.transform("runs", rank))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("most", most).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("most.s")).alias("start"),
        F.col("most.n").alias("length"), (-F.col("most.p")).alias("period"),
        F.expr("1000 * most.n div -most.p").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )
