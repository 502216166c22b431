import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from larderspark.llm import packing

SCHEMA = "doc_id long, text string"


def test_first_fit_decreasing_matches_the_plain_form():
    draw = np.random.default_rng(2)
    for n in (0, 1, 2, 7, 300):
        sizes = draw.integers(1, 101, n)
        room, want = [], np.zeros(n, int)
        for item in np.argsort(-sizes, kind="stable"):
            at = next((i for i, r in enumerate(room) if r >= sizes[item]), len(room))
            if at == len(room):
                room.append(100)
            room[at] -= sizes[item]
            want[item] = at
        assert (packing.first_fit_decreasing(sizes, 100) == want).all()


@pytest.mark.parametrize("text", [
    "a b", "two  blanks", " lead", "trail ", "line\nfeed", "line\n\nfeed", "tab\tx", "it's 'quoted', isn't it?", "x\u00a0y",
    "naïve café, straße.", "a.b,c!", "...", "<|endoftext|> x", "१२ x2 3y", "no-break\u2009thin", "a \nb", "日本語 テキスト", "don't, can't.",
    "word|word | word", "\n", "e\u0301 combining", "A!! B!!",
])
def test_words_give_the_ids_of_the_whole_text(text):
    texts = [text, "", text, f"{text} more {text}", "plain words here", f"<|endoftext|>{text}", "a\u2581b <|endoftext", text * 40]
    check(packing.Encoder(packing.public_vocabulary()), texts)


def check(encoder, texts):
    """Against a fresh tokenizer that nobody has touched."""
    fresh = Tokenizer.from_file(packing.public_vocabulary())
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    for t, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == fresh.encode(t, add_special_tokens=False).ids, t


def test_random_texts_and_a_small_memory(monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 3)
    draw = random.Random(7)
    encoder = packing.Encoder(packing.public_vocabulary())
    encoder.memory = packing.Memory(2_000)
    parts = ["the", "Thing", "x1", "don't", "it's", "été", "a,b", "end.", "...", "12,5", "日本", "ß", "\u00a0", "\t", "\n", "\n", " ", "  ",
             "<|endoftext|>", "<|end", "\u200b", "\r\n", "e\u0301", "😀", "'ll", "A!!"]
    for _ in range(150):
        check(encoder, [draw.choice([" ", "", " "]).join(draw.choice(parts) for _ in range(draw.randrange(12))) for _ in range(6)])
    assert len(encoder.memory.new) + len(encoder.memory.old) < 400
    check(encoder, ["word " * 60_000, ""])


def test_pieces_make_whole_documents_and_gapless_sequences(spark):
    texts = [None, "", "one", "word " * 3000, "word " * 3000] + [f"text {i} " * (i % 50) for i in range(300)]
    docs = spark.createDataFrame([(i if i != 7 else None, t) for i, t in enumerate(texts)], SCHEMA)
    found = packing.pack_documents(docs, tokens=256).toPandas()
    encoder = packing.Encoder(packing.public_vocabulary())
    for i, t in enumerate(texts):
        ids = [*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
        mine = found[found.doc_id.isna()] if i == 7 else found[found.doc_id == i]
        mine = mine.sort_values("start")
        assert (mine.doc_tokens == len(ids)).all()
        at = 0
        for r in mine.itertuples():
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    ordered = found.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    used = ordered.groupby("sequence_id").length.sum()
    assert used.max() <= 256
    assert len(used) <= 1.02 * found.length.sum() / 256 + 2


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(1, "hello there"), (2, "more words here")], SCHEMA)
    (row,) = packing.sequences(docs, tokens=64).collect()
    encoder = packing.Encoder(packing.public_vocabulary())
    one, two = ([*encoder.tokenizer.encode(t).ids, 1] for t in ("hello there", "more words here"))
    assert row.ids[: row.used] in (one + two, two + one)
    assert len(row.ids) == (64 if row.used & (row.used - 1) else row.used)
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_null_ids_repeats_and_clashing_columns(spark):
    rows = [(None, "a b"), (None, "a b"), (3, "a b"), (3, "c"), (4, None), (4, "")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS start", "2 AS length", "3 AS sequence_id", "4 AS ids", "5 AS _group")
    found = packing.pack_documents(docs, tokens=16).collect()
    assert len(found) == len(rows) and sorted(r.doc_tokens for r in found) == [1, 1, 2, 3, 3, 3]
    spots = {(r.sequence_id, r.offset) for r in found}
    assert len(spots) == len(rows)
