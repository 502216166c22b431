"""Packing: documents become token sequences of bounded length with little padding.

Documents are tokenised, cut where they exceed a sequence, and the pieces are
packed first-fit decreasing. Packing runs independently in randomised groups
of a bounded number of pieces, so it scales with the number of groups.
"""

from __future__ import annotations

import sys
import types
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderspark.session import cut_lineage

SEQUENCE_TOKENS = 2048
END_ID = 1
#: Pieces per randomised group, about.
GROUP_PIECES = 4_096
#: Bytes of words and ids that a task remembers in each of two generations, about, and of one entry beside its letters.
REMEMBERED_BYTES, ENTRY_BYTES = 48 << 20, 200
#: Marks that are a pre-token of their own after letters (an apostrophe may begin a contraction).
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Characters of texts that are encoded together (a longer text alone), and new words encoded in one go.
TOGETHER, WORDS = 4_000_000, 256


def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenizer_of(path: str):
    """One per Python worker and vocabulary. Only the vocabulary stays in memory after a task."""
    held = sys.modules.setdefault("_larder_tokenizers", types.ModuleType("_larder_tokenizers"))
    if path not in held.__dict__:
        from tokenizers import Tokenizer

        held.__dict__[path] = Tokenizer.from_file(path)
    return held.__dict__[path]


class Memory:
    """Ids of words in a table of bounded size: when the newer half is full, the older one is dropped.

    What is found in the older half moves to the newer one, so frequent words stay.
    """

    def __init__(self, most: int = REMEMBERED_BYTES):
        self.most, self.size = most, 0
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def known(self, words: list[str]) -> list[bytes | None]:
        out = list(map(self.new.get, words))
        if self.old:
            again = [(i, self.old[words[i]]) for i, ids in enumerate(out) if ids is None and words[i] in self.old]
            for i, ids in again:
                out[i] = ids
            self.put([words[i] for i, _ in again], [ids for _, ids in again])
        return out

    def put(self, words: list[str], ids: list[bytes]) -> None:
        if self.size > self.most:
            self.new, self.old, self.size = {}, self.new, 0
        self.new.update(zip(words, ids))
        self.size += sum(map(len, words)) + sum(map(len, ids)) + ENTRY_BYTES * len(words)


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit numbers.

    Byte-level BPE never merges across pre-tokens, and a pre-token never
    reaches across a single blank or line feed between other characters, so
    the ids of a text are those of its words, with the blank or line feed
    before each, one after the other. Each distinct word of many texts is
    encoded once, and the texts' ids are gathered by number. A text with any
    other white space, or with one of the vocabulary's special tokens, is
    encoded whole.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizer_of(path)
        self.special = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content})
        self.memory = Memory()
        self.marks: dict[str, bytes] = {}
        self.feed = self.plain("\n")

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def stems(self, fresh: list[str], blank: str) -> list[bytes]:
        """Ids of words of letters, after a blank or at a line's beginning; many are encoded in one go."""
        out: list[bytes] = []
        for low in range(0, len(fresh), WORDS):
            part = fresh[low : low + WORDS]
            # with a blank between them pre-token i is word i, with a line feed word i is pre-token 2i
            joined, step = (" " + " ".join(part), 1) if blank else ("\n".join(part), 2)
            found = self.tokenizer.encode(joined, add_special_tokens=False)
            ids, at = np.array(found.ids, "<u4").tobytes(), np.array(found.word_ids)
            starts = (4 * np.searchsorted(at, np.arange(0, step * len(part), step))).tolist()
            ends = (4 * np.searchsorted(at, np.arange(1, step * len(part) + 1, step))).tolist()
            out += [ids[a:b] for a, b in zip(starts, ends)]
        return out

    def learn(self, words: list[str], lead: str) -> list[bytes]:
        """Ids of words that begin with ``lead``, a line feed, or (empty) follow a blank.

        Letters and the marks after them are separate pre-tokens, so stems of
        letters are encoded together, whatever follows them.
        """
        skip = len(lead)
        blank, before = ("", self.feed) if lead else (" ", b"")
        marked = {w: w.rstrip(TAIL) for w in words if not w[skip:].isalpha()}
        letters = {stem for stem in marked.values() if stem[skip:].isalpha()}
        stems = list(letters)
        found = dict(zip(stems, self.memory.known(stems)))
        fresh = [*(w for w in words if w not in marked and w not in letters), *(w for w in stems if found[w] is None)]
        found.update(zip(fresh, [before + ids for ids in self.stems([w[skip:] for w in fresh], blank)]))
        out = []
        for w in words:
            stem = marked.get(w)
            if stem is None:
                out.append(found[w])
            elif stem in letters:
                mark = w[len(stem) :]
                out.append(found[stem] + (self.marks.get(mark) or self.marks.setdefault(mark, self.plain(mark))))
            else:
                out.append(before + self.plain(blank + w[skip:]))
        if len(self.marks) > 10_000:
            self.marks = {}
        return out

    def words(self, distinct: list[str]) -> list[bytes]:
        """Ids of every word: one after a line feed begins with it, all others follow a blank. Empty: white space is uneven."""
        known = self.memory.known(distinct)
        missing = [i for i, ids in enumerate(known) if ids is None]
        words = [distinct[i] for i in missing]
        if "\n".join(words).split() != [w.removeprefix("\n") for w in words]:
            for i in missing:
                if distinct[i].split() != [distinct[i].removeprefix("\n")]:
                    known[i] = b""
            missing = [i for i in missing if known[i] is None]
        for lead in ("", "\n"):
            mine = [i for i in missing if (distinct[i][0] == "\n") == bool(lead)]
            for i, ids in zip(mine, self.learn([distinct[i] for i in mine], lead)):
                known[i] = ids
        self.memory.put([distinct[i] for i in missing], [known[i] for i in missing])
        return known

    def encode(self, given: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, how many each has)."""
        lined = pc.binary_join_element_wise("\n", pc.replace_substring(given, "\n", " \n"), "")
        lists = pc.split_pattern(lined, " ")
        held = lists.values.dictionary_encode()
        at, offsets = held.indices.to_numpy(), lists.offsets.to_numpy().astype(np.int64)
        known = self.words(held.dictionary.to_pylist())
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        whole = np.minimum.reduceat(sizes[at], offsets[:-1]) == 0
        for mark in self.special:
            whole |= pc.match_substring(given, mark).to_numpy(zero_copy_only=False)
        table = np.frombuffer(b"".join(known), "<u4")
        begins = np.cumsum(sizes) - sizes
        # every word's ids, but for the line feed before the text
        begins, sizes = begins[at], sizes[at]
        lead = len(self.feed) // 4
        begins[offsets[:-1]] += lead
        sizes[offsets[:-1]] = np.maximum(sizes[offsets[:-1]] - lead, 0)
        sizes[np.repeat(whole, np.diff(offsets))] = 0
        ends = np.cumsum(sizes)
        ids = table[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1])]
        bounds = np.concatenate([[0], ends])[offsets]
        if not whole.any():
            return ids, np.diff(bounds)
        parts = [
            np.frombuffer(self.plain(t), "<u4") if w and t else ids[a:b]
            for t, w, a, b in zip(given.to_pylist(), whole.tolist(), bounds[:-1].tolist(), bounds[1:].tolist())
        ]
        return np.concatenate(parts), np.array([len(p) for p in parts])


def pieces(
    docs: DataFrame, vocabulary: str, tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, ids) per piece of every row of ``docs``.

    ``ids`` is the piece's ids as little-endian unsigned 32-bit bytes, null
    unless asked for. Ids are those of the untouched tokenizer without added
    special tokens; a special token written in a text is that token. Null
    text is empty; every document ends with ``end_id``, so none is without a
    piece. Pieces are ``tokens`` long but the last of a document. Rows are
    independent: null and repeated ids and repeated rows have their own pieces.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        encoder = Encoder(vocabulary)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
        types_ = [pa.int64()] * 4 + [pa.binary()]
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.string()), "")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            low = 0
            while low < batch.num_rows:
                high = max(int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + TOGETHER, side="right")), low + 1)
                ids, counts = encoder.encode(texts.slice(low, high - low))
                raw, at = ids.astype("<u4").tobytes(), 0
                rows: list[int] = []
                out: list[tuple] = []
                for row, n in enumerate(counts.tolist(), low):
                    mine = raw[at : at + 4 * n] + end
                    at += 4 * n
                    for start in range(0, n + 1, tokens):
                        part = mine[4 * start : 4 * (start + tokens)]
                        rows.append(row)
                        out.append((start, len(part) // 4, zlib.crc32(part), n + 1, part if with_ids else None))
                columns = [pa.array(c, t) for c, t in zip(zip(*out), types_)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *columns], names)
                low = high

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
    )


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of every item: items by falling length, each into the first bin that has room.

    A tournament tree over the bins keeps the most room below every node, so
    the first bin with enough room is found by one descent.
    """
    n = len(lengths)
    leaves = 1 << max(n - 1, 0).bit_length()
    room = [0] * leaves + [capacity] * leaves
    for at in range(leaves - 1, 0, -1):
        room[at] = room[2 * at]
    bins = np.zeros(n, np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        size, at = int(lengths[item]), 1
        while at < leaves:
            at *= 2
            if room[at] < size:
                at += 1
        bins[item] = at - leaves
        room[at] -= size
        at //= 2
        while at:
            a, b = room[2 * at], room[2 * at + 1]
            most = a if a > b else b
            if room[at] == most:
                break
            room[at] = most
            at //= 2
    return bins


def place(cut: DataFrame, tokens: int = SEQUENCE_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``; needs a stored frame, since it is read twice.

    Rows are pieces of their own, whatever their ids, so repeats are placed
    like any other. Pieces are dealt at random into groups of about ``group_pieces``. Whole
    sequences need no partner and are numbered like the rest.
    """
    total = cut.count()
    groups = max(1, -(-total // group_pieces))
    kept = [f for f in cut.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"
    names = [f.name for f in kept]

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group["_group"].iloc[0])
        group = group.sort_values(["length", "_salt"], ascending=[False, True], kind="stable", ignore_index=True)
        bins = first_fit_decreasing(group["length"].to_numpy(), tokens)
        order = np.argsort(bins, kind="stable")
        out = group.iloc[order][names].copy()
        lengths, at = out["length"].to_numpy(), bins[order]
        before = np.cumsum(lengths) - lengths
        opens = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        out["sequence_id"] = number * (1 << 32) + at
        out["offset"] = before - np.repeat(before[opens], np.diff(np.append(opens, len(at))))
        return out

    salt = F.xxhash64(F.lit("pack"), F.monotonically_increasing_id(), "ids_crc32", "start")
    dealt = cut.withColumn("_salt", salt).withColumn("_group", F.pmod(F.shiftright("_salt", 3), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(pack, schema)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece.

    Every id of every row of ``docs`` (repeated rows too) is in exactly one
    piece, and the offsets of a sequence run from 0 without a gap.
    """
    cut = cut_lineage(pieces(docs, vocabulary or public_vocabulary(), tokens, with_ids=False).drop("ids"), "pieces")
    return place(cut, tokens)


def sequences(docs: DataFrame, vocabulary: str | None = None, tokens: int = SEQUENCE_TOKENS, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, used): the packed sequences themselves.

    Sequences are padded with ``pad_id`` to ``tokens`` ids, except those whose
    length is a power of two.
    """
    cut = cut_lineage(pieces(docs, vocabulary or public_vocabulary(), tokens), "pieces")

    @F.pandas_udf("array<int>")
    def joined(parts: pd.Series) -> pd.Series:
        def one(rows):
            ids = np.frombuffer(b"".join(r["ids"] for r in rows), "<u4")
            full = len(ids) if len(ids) & (len(ids) - 1) == 0 else tokens
            return np.append(ids, np.full(full - len(ids), pad_id)).astype(np.int32)

        return parts.map(one)

    return place(cut, tokens).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("used")
    ).select("sequence_id", joined("parts").alias("ids"), "used")
