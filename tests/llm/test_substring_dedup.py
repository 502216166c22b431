import hashlib
import random

import numpy as np
import pytest

from larderspark.llm import substring_dedup
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def test_automaton_gives_matching_statistics_and_least_owners():
    draw = random.Random(4)
    for _ in range(300):
        letters = draw.choice([2, 3, 8])
        texts = [[draw.randrange(letters) for _ in range(draw.randint(0, 12))] for _ in range(draw.randint(1, 6))]
        owners = sorted(draw.randrange(5) for _ in texts)
        automaton = substring_dedup.Automaton()
        for owner, text in zip(owners, texts):
            automaton.add(text, owner)
        query, most = [draw.randrange(letters + 1) for _ in range(15)], draw.randint(1, 6)
        for end, (known, least) in enumerate(automaton.statistics(query, most), 1):
            within = lambda n: [o for o, t in zip(owners, texts)
                                if any(t[i : i + n] == query[end - n : end] for i in range(len(t) - n + 1))]
            want = max(n for n in range(0, min(most, end) + 1) if n == 0 or within(n))
            assert known == want
            assert not known or least == min(within(known))


def corpus(draw):
    word = lambda: f"w{draw.randrange(400)}"
    passages = [[word() for _ in range(draw.randint(10, 40))] for _ in range(8)]
    docs = []
    for d in range(120):
        words = [word() for _ in range(draw.randrange(40))]
        for _ in range(draw.randrange(3)):
            part = list(draw.choice(passages))
            if draw.random() < 0.5:
                part[draw.randrange(len(part))] = word()
            low = draw.randrange(5)
            words[draw.randint(0, len(words)) : 0] = part[low:]
        docs.append((draw.randrange(1000), draw.choice([" ", "\n", " \t "]).join(words)))
    docs += [(2000 + i, docs[3][1]) for i in range(20)] + [(d, docs[5][1]) for d in (1, 1, 900)]
    docs += [(7, "same " * 60), (8, "same " * 30), (9, "same " * 12), (10, "a b " * 40), (11, "b a " * 40)]
    docs += [(50, None), (51, ""), (52, " \n"), (None, docs[3][1]), (None, docs[3][1]), (12, docs[4][1]), (12, docs[6][1] + " x")]
    docs += [(3000, " ".join(f"long{i % 5000}" for i in range(20_000))), (3001, " ".join(f"long{i}" for i in range(4000, 4100)))]
    return docs


@pytest.mark.parametrize("most", [2, 4_000])
def test_removed_words_match_brute_force(spark, most, monkeypatch):
    monkeypatch.setattr(substring_dedup, "TOGETHER", 20_000)
    rows = corpus(random.Random(most))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 AS c1", "2 AS least", "3 AS gram", "4 AS doc")
    found = substring_dedup.remove_repeats(docs, shard_pieces=most)
    want = brute.repeated_words(rows)
    plain = lambda r: (r.doc_id, r.n_words, tuple(i for s in r.removed for i in range(s.low, s.high)), r.text)
    assert sorted(map(plain, found.collect()), key=repr) == sorted(
        ((d, len(ws), tuple(sorted(gone)), " ".join(w for i, w in enumerate(ws) if i not in gone)) for d, ws, gone in want), key=repr)
    assert sum(len(gone) for *_, gone in want) > 1000
    digests = {(r.doc_id, r.n_removed, r.kept_sha256) for r in substring_dedup.digests(found).collect()}
    assert (7, 0, hashlib.sha256(" ".join(["same"] * 60).encode()).hexdigest()) in digests


def test_empty_tables_and_tables_without_repeats(spark):
    docs = spark.createDataFrame([(i, " ".join(f"{i}x{j}" for j in range(30))) for i in range(5)], SCHEMA)
    assert {(r.n_words, len(r.removed)) for r in substring_dedup.remove_repeats(docs).collect()} == {(30, 0)}
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_equal_windows_have_equal_anchors():
    draw = np.random.default_rng(1)
    hashes = draw.integers(0, 50, 500).astype(np.uint64)
    doc = np.repeat(np.arange(10), 50)
    starts, at, grams = substring_dedup.anchors(hashes, doc)
    assert len(starts) == 10 * (50 - 12) and ((at >= starts) & (at <= starts + 8)).all()
    seen = {}
    for s, a in zip(starts, at):
        assert seen.setdefault(hashes[s : s + 13].tobytes(), grams[a]) == grams[a]


@pytest.mark.parametrize("block_bytes", [64 << 20, 60_000])
def test_spans_of_a_given_reference(spark, block_bytes):
    draw = random.Random(9)
    word = lambda: f"w{draw.randrange(300)}"
    texts = [[word() for _ in range(n)] for n in (12, 13, 14, 40, 200)]
    docs = []
    for d in range(60):
        words = [word() for _ in range(draw.randrange(30))]
        for _ in range(draw.randrange(3)):
            part = list(draw.choice(texts))[draw.randrange(6):]
            if draw.random() < 0.4:
                part[draw.randrange(len(part))] = word()
            at = draw.randint(0, len(words))
            words[at:at] = part
        docs.append((d % 50, " ".join(words)))
    docs += [(None, None), (None, ""), (7, " ".join(texts[4]))]
    reference = spark.createDataFrame([(" ".join(t),) for t in texts] + [(None,), (" ".join(texts[3]),)], "text string")
    found = substring_dedup.reference_spans(spark.createDataFrame(docs, SCHEMA), reference, block_bytes=block_bytes)
    windows = {tuple(t[i : i + 13]) for t in texts for i in range(len(t) - 12)}
    want = []
    for d, text in docs:
        ws, spans = (text or "").split(), []
        for i in range(len(ws) - 12):
            if tuple(ws[i : i + 13]) in windows:
                if spans and spans[-1][1] >= i:
                    spans[-1][1] = i + 13
                else:
                    spans.append([i, i + 13])
        want.append((d, tuple(map(tuple, spans))))
    got = [(r.doc_id, tuple((s.low, s.high) for s in r.spans)) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and sum(len(s) for _, s in want) > 20
