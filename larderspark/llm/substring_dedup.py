"""Substring dedup: suffix automata of reference shards, past which the documents' stretches are streamed.

A word goes if it is in a window of WINDOW words that also starts in a
document of a smaller id. Streaming every document past the automata of the
whole corpus would be quadratic, so a shard's automaton meets only what can
match in it. Of the GRAM-word grams of a window the one of least hash is its
anchor; equal windows have equal anchors. Grams that only one text has are
dropped; around the others, documents are cut into pieces of windows with one
anchor. Equal pieces are one with their least id. The pieces around one gram
are a reference shard: its automaton knows the least id of every sequence of
words, and every piece streams through it once for its matching statistics.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderspark.llm.common import TASK_ROWS
from larderspark.llm.periodic_runs import words_of
from larderspark.operators.blocks import bounded_blocks
from larderspark.session import cut_lineage

#: Words of a window, and of the grams that anchor it.
WINDOW, GRAM = 13, 5
#: Bytes of a word's hash in a piece.
WORD_BYTES = 6
#: Different pieces that a shard may hold; around a gram with more, pieces are cut into single windows.
SHARD_PIECES = 4_000
#: Bytes of automata that one pass over the documents may broadcast the words of, and of an automaton per word, about.
REFERENCE_BYTES, STATE_BYTES = 64 << 20, 800
#: Characters that are hashed together (a longer document alone).
TOGETHER = 2_000_000
#: Odd multipliers of the words of a gram, and of the mix after them.
MULTIPLIERS = np.array([xxhash.xxh64_intdigest(bytes([n])) | 1 for n in range(32)], np.uint64)


def batches_of(batches, size: int):
    """Record batches cut so that a part has about ``size`` characters of ``text``, or one row."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            to = max(int(np.searchsorted(sizes, before + size, side="right")), at + 1)
            yield batch.slice(at, to - at)
            at = to


def word_hashes(lists: pa.ListArray) -> np.ndarray:
    """64-bit hashes of all words; each distinct word is hashed once."""
    held = lists.values.dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in held.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
    return hashes[held.indices.to_numpy()]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MULTIPLIERS[-1]
    return x ^ (x >> np.uint64(29))


def anchors(hashes: np.ndarray, doc: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(starts, at, grams): all window starts within documents, each one's anchor place, and gram hashes by place."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(n - gram + 1, np.uint64)
    for j in range(gram):
        grams += hashes[j : n - gram + 1 + j] * MULTIPLIERS[j]
    grams = mixed(grams)
    best, at = grams[: n - window + 1].copy(), np.arange(n - window + 1)
    for j in range(1, window - gram + 1):
        other = grams[j : n - window + 1 + j]
        less = np.flatnonzero(other < best)
        best[less] = other[less]
        at[less] = less + j
    starts = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
    return starts, at[starts], grams


def with_class(docs: DataFrame) -> DataFrame:
    """(doc_id, text, c1, c2): c1 and c2 name the text."""
    return docs.select("doc_id", "text", F.xxhash64(F.lit(1), "text").alias("c1"), F.xxhash64(F.lit(2), "text").alias("c2"))


def gram_table(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(c1, gram) per text and anchor gram, some repeated."""

    def work(batches):
        for batch in batches_of(batches, TOGETHER):
            lists = words_of(batch.column("text"))
            offsets = lists.offsets.to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            starts, at, grams = anchors(word_hashes(lists), doc, window)
            at = at[np.append(True, at[1:] != at[:-1])] if len(at) else at
            text, gram = doc[at], grams[at] if len(at) else grams
            order = np.lexsort((gram, text))
            text, gram = text[order], gram[order]
            new = np.append(True, (text[1:] != text[:-1]) | (gram[1:] != gram[:-1]))[: len(text)]
            c1 = batch.column("c1").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(c1[text[new]]), pa.array(gram[new].view(np.int64))], ["c1", "gram"])

    return docs.select("c1", "text").mapInArrow(work, "c1 long, gram long")


def pieces(wanted: DataFrame, window: int = WINDOW) -> DataFrame:
    """(gram, doc, c1, c2, start, windows, words): runs of windows with one anchor, of rows (doc, c1, c2, text, grams).

    Only anchors whose gram is among the row's ``grams``. ``words`` are the
    windows' words as WORD_BYTES bytes of hash each: pieces that are compared
    have a gram in common, by 64 bits a word.
    """
    names = ["gram", "doc", "c1", "c2", "start", "windows", "words"]

    def work(batches):
        for batch in batches_of(batches, TOGETHER):
            lists = words_of(batch.column("text"))
            offsets = lists.offsets.to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            hashes = word_hashes(lists)
            starts, at, grams = anchors(hashes, doc, window)
            if not len(starts):
                continue
            shared = batch.column("grams")
            known = shared.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            own = pc.list_parent_indices(shared).to_numpy().astype(np.uint64)
            salt = lambda g, d: mixed(g + (d + np.uint64(1)) * MULTIPLIERS[-2])
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            sizes = np.diff(np.append(first, len(at)))
            place, text = at[first], doc[at[first]]
            ok = np.isin(salt(grams[place], text.astype(np.uint64)), salt(known, own))
            low, sizes, text, gram = starts[first][ok], sizes[ok], text[ok], grams[place[ok]]
            raw = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()
            words = [raw[WORD_BYTES * a : WORD_BYTES * (a + n + window - 1)] for a, n in zip(low.tolist(), sizes.tolist())]
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays([
                pa.array(gram.view(np.int64)), *(batch.column(c).take(rows) for c in ("doc", "c1", "c2")),
                pa.array(low - offsets[text]), pa.array(sizes), pa.array(words, pa.binary())], names)

    return wanted.select("doc", "c1", "c2", "text", "grams").mapInArrow(
        work, "gram long, doc long, c1 long, c2 long, start long, windows long, words binary")


class Automaton:
    """A suffix automaton of several sequences; a state knows the least owner of its sequences.

    Sequences are added by rising owner, so the first one that reaches a
    state is its least.
    """

    def __init__(self):
        self.next, self.link, self.length, self.least = [{}], [-1], [0], [None]

    def state(self, length: int, link: int, following: dict, least) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.least.append(least)
        return len(self.next) - 1

    def add(self, words: list, owner) -> None:
        last = 0
        for word in words:
            last = self.extend(last, word, owner)

    def extend(self, last: int, word, owner) -> int:
        following, link, length = self.next, self.link, self.length
        to = following[last].get(word)
        if to is not None and length[to] == length[last] + 1:
            return to
        if to is None:
            new = self.state(length[last] + 1, 0, {}, owner)
            at = last
            while at >= 0 and word not in following[at]:
                following[at][word] = new
                at = link[at]
            if at < 0:
                return new
            to = following[at][word]
            if length[to] == length[at] + 1:
                link[new] = to
                return new
        else:
            new, at = -1, last
        copy = self.state(length[at] + 1, link[to], dict(following[to]), self.least[to])
        link[to] = copy
        while at >= 0 and following[at].get(word) == to:
            following[at][word] = copy
            at = link[at]
        if new < 0:
            return copy
        link[new] = copy
        return new

    def statistics(self, words: list, most: int):
        """Per word: the length, at most ``most``, of the longest known sequence that ends there, and its least owner."""
        following, link, length, least = self.next, self.link, self.length, self.least
        at, known = 0, 0
        for word in words:
            while at and word not in following[at]:
                at = link[at]
                known = length[at]
            if word in following[at]:
                at, known = following[at][word], known + 1
            while at and length[link[at]] >= most:
                at = link[at]
            known = min(known, most, length[at])
            yield known, least[at]


def stale_windows(group: list[tuple], window: int) -> list[list[int]]:
    """Per (least owner, words) of a shard: the windows that an owner of a smaller id has too."""
    automaton = Automaton()
    for owner, words in sorted(group, key=lambda piece: piece[0]):
        automaton.add(words, owner)
    out = []
    for owner, words in group:
        found = automaton.statistics(words, window)
        out.append([i - window + 1 for i, (known, least) in enumerate(found) if known >= window and least < owner])
    return out


def judged(reference: DataFrame, window: int = WINDOW) -> DataFrame:
    """(gram, d1, d2, stale) of the pieces (gram, d1, d2, least, words) with a stale window.

    Shards stream by, sorted; one is held at a time.
    """

    def work(batches):
        now, held = None, []
        columns = ["gram", "d1", "d2", "least", "words"]

        def judge(out):
            if len(held) > 1:  # one piece alone has nothing to match
                group = [(r[3], [r[4][i : i + WORD_BYTES] for i in range(0, len(r[4]), WORD_BYTES)]) for r in held]
                out += [(*r[:3], stale) for r, stale in zip(held, stale_windows(group, window)) if stale]

        def batch_of(out):
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["gram", "d1", "d2", "stale"])

        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if row[0] != now:
                    judge(out)
                    now, held = row[0], []
                held.append(row)
            if out:
                yield batch_of(out)
        out = []
        judge(out)
        if out:
            yield batch_of(out)

    shuffle = int(reference.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(shuffle, -(-reference.count() // TASK_ROWS))
    return reference.repartition(parts, "gram").sortWithinPartitions("gram").mapInArrow(
        work, "gram long, d1 long, d2 long, stale array<int>")


def reference_spans(docs: DataFrame, reference: DataFrame, window: int = WINDOW, block_bytes: int = REFERENCE_BYTES) -> DataFrame:
    """(doc_id, spans) per row of ``docs``: maximal word ranges (low, high: exclusive) whose windows all occur in ``reference``.

    For a reference of modest size, (text), such as licence texts: shards of
    it, of a measured size, are broadcast, and every document is streamed past
    each shard's automaton. A text longer than a shard is cut into stretches
    that overlap by a window. Null texts have no word; rows are independent,
    so repeated rows and ids are repeated in the result.
    """
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    stretch = max(block_bytes // STATE_BYTES // 2, 4 * window)
    low = F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)), F.lit(stretch - window + 1)))
    held = cut_lineage(
        reference.select(words.alias("words")).distinct().select("words", low.alias("low"))
        .select(F.slice("words", F.col("low") + 1, stretch).alias("words")).filter(F.size("words") >= window)
        .withColumn("part", F.monotonically_increasing_id()), "reference")
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = cut_lineage(docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "streamed")

    def stream(sent):
        def work(batches):
            automaton = Automaton()
            for part in sent.value:
                automaton.add(part, 0)
            for batch in batches:
                rows, lows = [], []
                for row, ws in zip(batch.column("row").to_pylist(), words_of(batch.column("text")).to_pylist()):
                    ends = [i for i, (known, _) in enumerate(automaton.statistics(ws, window)) if known >= window]
                    rows += [row] * len(ends)
                    lows += [i - window + 1 for i in ends]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(lows, pa.int64())], ["row", "low"])

        return work

    found = None
    for block in bounded_blocks(held, "part", F.size("words") * STATE_BYTES, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast([r.words for r in block.select("words").collect()])  # size checked
        hits = base.select("row", "text").mapInArrow(stream(sent), "row long, low long")
        found = hits if found is None else found.unionByName(hits)

    def joined(lows):
        """Windows that touch or overlap are one span."""
        step = lambda spans, low: F.when(
            (F.size(spans) > 0) & (F.element_at(spans, -1)["high"] >= low),
            F.concat(F.slice(spans, 1, F.size(spans) - 1), F.array(F.struct(
                F.element_at(spans, -1)["low"].alias("low"), (low + window).alias("high"))))
        ).otherwise(F.concat(spans, F.array(F.struct(low.alias("low"), (low + window).alias("high")))))
        none = F.expr("cast(array() as array<struct<low: bigint, high: bigint>>)")
        return F.aggregate(lows, none, step)

    per_row = found.groupBy("row").agg(joined(F.array_sort(F.collect_set("low"))).alias("spans"))
    empty = F.expr("cast(array() as array<struct<low: bigint, high: bigint>>)")
    return base.select("row", F.col("doc_id").cast(kind)).join(per_row, "row", "left").select(
        "doc_id", F.coalesce("spans", empty).alias("spans"))


def with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"d1": F.xxhash64(F.lit(1), "words"), "d2": F.xxhash64(F.lit(2), "words")})


def bounded_shards(rows: DataFrame, most: int, window: int = WINDOW) -> DataFrame:
    """``rows`` (pieces with digests); those around a gram with more than ``most`` different ones as single windows.

    A single window's gram is its own digest, so its shard holds one piece.
    """
    hot = cut_lineage(
        rows.select("gram", "d1", "d2").distinct().groupBy("gram").count().filter(F.col("count") > most).select("gram"), "hot")
    if hot.isEmpty():
        return rows
    single = rows.join(hot, "gram", "left_semi").withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("windows") - 1)))
    words = F.substring("words", (WORD_BYTES * F.col("j") + 1).cast("int"), F.lit(WORD_BYTES * window))
    single = with_digest(single.withColumns({"words": words, "start": F.col("start") + F.col("j"), "windows": F.lit(1).cast("long")}))
    single = single.withColumn("gram", F.col("d1")).select(*rows.columns)
    return cut_lineage(rows.join(hot, "gram", "left_anti").select(*rows.columns).unionByName(single), "bounded")


def repeated_ranges(named: DataFrame, least_ids: DataFrame, window: int = WINDOW, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """(doc_id, c1, c2, ranges): (low, high: exclusive) word ranges to remove from the first document of every text.

    Some overlap. ``named`` as from ``with_class``, ``least_ids`` (c1, c2, least) its texts.
    """
    grams = cut_lineage(gram_table(named, window), "grams")
    shared = grams.groupBy("gram").agg(F.min("c1").alias("a"), F.max("c1").alias("b")).filter("a <> b").select("gram")
    of_text = grams.join(shared, "gram", "left_semi").groupBy("c1").agg(F.collect_set("gram").alias("grams"))
    wanted = cut_lineage(least_ids.join(of_text, "c1").withColumnRenamed("least", "doc"), "wanted")
    texts = named.withColumnRenamed("doc_id", "doc").join(wanted, ["doc", "c1", "c2"])
    found = with_digest(cut_lineage(pieces(texts, window), "pieces"))
    found = bounded_shards(found, shard_pieces, window)
    key = ["gram", "d1", "d2"]
    reference = cut_lineage(found.groupBy(*key).agg(F.min("doc").alias("least"), F.any_value("words").alias("words")), "reference")
    verdicts = cut_lineage(reference.select(*key, "least").join(judged(reference, window), key, "left"), "verdicts")
    placed = found.select(*key, "doc", "c1", "c2", "start", "windows").join(verdicts, key)
    span = lambda low, n: F.struct(low.alias("low"), (low + n + (window - 1)).alias("high"))
    whole = F.array(span(F.col("start"), F.col("windows")))
    each = F.transform("stale", lambda j: span(F.col("start") + j, F.lit(1)))
    spans = F.when(F.col("doc") > F.col("least"), whole).otherwise(each)
    return (
        placed.select(F.col("doc").alias("doc_id"), "c1", "c2", F.explode(spans).alias("span"))
        .groupBy("doc_id", "c1", "c2").agg(F.collect_set("span").alias("ranges"))
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """(doc_id, n_words, removed, text) per row of (doc_id, text): removed (low, high) word ranges, and the words left.

    Words are runs of characters that are no ASCII white space; what is left
    is joined by single spaces. A word is removed if a window of ``window``
    words around it also starts in a document of a smaller id. Windows are
    judged on the input. Rows with equal ids do not remove one another's
    words; rows without an id neither lose words nor take any. Null and empty
    texts have no word. Repeated rows are repeated in the result. Copies of a
    text lose all words at once (if a window fits into it); only its first
    document is cut into pieces.
    """
    named = with_class(docs)
    known = named.filter("doc_id is not null and text is not null")
    ids = cut_lineage(known.select("doc_id", "c1", "c2").distinct(), "ids")
    least_ids = cut_lineage(ids.groupBy("c1", "c2").agg(F.min("doc_id").alias("least")), "texts")
    ranges = repeated_ranges(known, least_ids, window, shard_pieces)
    copies = ids.join(least_ids, ["c1", "c2"]).filter("doc_id > least").select("doc_id", "c1", "c2")
    none = F.lit(None).cast("array<struct<low: long, high: long>>")
    changes = cut_lineage(
        ranges.withColumn("copy", F.lit(False)).unionByName(copies.withColumns({"ranges": none, "copy": F.lit(True)})), "changes")
    joined = known.join(changes, ["doc_id", "c1", "c2"], "left").select("doc_id", "text", "ranges", "copy")
    rest = named.filter("doc_id is null or text is null").select(
        "doc_id", "text", none.alias("ranges"), F.lit(None).cast("boolean").alias("copy"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, removed array<struct<low: long, high: long>>, text string"
    span_type = pa.struct([("low", pa.int64()), ("high", pa.int64())])

    def cut(batches):
        for batch in batches_of(batches, TOGETHER):
            lists = words_of(batch.column("text"))
            offsets = lists.offsets.to_numpy().astype(np.int64)
            lengths = np.diff(offsets)
            steps = np.zeros(offsets[-1] + 1, np.int64)
            copy = pc.fill_null(batch.column("copy"), False).to_numpy(zero_copy_only=False) & (lengths >= window)
            np.add.at(steps, offsets[:-1][copy], 1)
            np.add.at(steps, offsets[1:][copy], -1)
            spans = batch.column("ranges")
            parent = pc.list_parent_indices(spans).to_numpy()
            flat = spans.flatten()
            for name, step in (("low", 1), ("high", -1)):
                np.add.at(steps, offsets[parent] + flat.field(name).to_numpy(zero_copy_only=False), step)
            gone = np.cumsum(steps)[:-1] > 0
            kept = np.concatenate([[0], np.cumsum(~gone)])[offsets]
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), lists.values.filter(pa.array(~gone))), " ")
            # maximal ranges of removed words, cut at document ends
            doc = np.repeat(np.arange(len(lengths)), lengths)
            opens = gone & ~np.concatenate([[False], gone[:-1] & (doc[1:] == doc[:-1])])[: len(gone)]
            closes = gone & ~np.concatenate([gone[1:] & (doc[1:] == doc[:-1]), [False]])[: len(gone)]
            low, high = np.flatnonzero(opens), np.flatnonzero(closes) + 1
            bounds = np.searchsorted(low, offsets)
            base = offsets[doc[low]]
            removed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(low - base), pa.array(high - base)], fields=list(span_type)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths), removed, text], ["doc_id", "n_words", "removed", "text"])

    return joined.unionByName(rest).mapInArrow(cut, schema)


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row of ``remove_repeats``."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["high"] - r["low"])
    return found.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
