import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from larderspark.llm import common, periodic_runs, queries
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def some_words(draw):
    n, letters = draw.choice([0, 1, 5, 6, 10, 30, 80]), draw.choice([1, 2, 3, 5])
    words = [draw.randrange(letters) for _ in range(n)]
    if n and draw.random() < 0.5:
        a = draw.randrange(n)
        p = draw.randint(1, max(1, (n - a) // 4))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("chunk, hops", [(500_000, 40), (5, 1)])
def test_runs_match_brute_force(monkeypatch, chunk, hops):
    monkeypatch.setattr(periodic_runs, "CHUNK", chunk)
    monkeypatch.setattr(periodic_runs, "HOPS", hops)
    draw, seen = random.Random(5), 0
    for _ in range(400):
        docs = [some_words(draw) for _ in range(draw.randint(1, 5))]
        lengths = np.array([len(d) for d in docs])
        found = periodic_runs.runs_of(np.array([w for d in docs for w in d], np.int64), lengths)
        want, at = [], 0
        for d in docs:
            want += [[at + start, length, period] for start, length, period in brute.runs(d)]
            at += len(d)
        assert found.tolist() == want
        seen += len(want)
    assert seen > 300


def test_query_columns_match_brute_force(spark):
    draw = random.Random(1)
    texts = [None, "", " \t\n", "a", "x " * 9, "a b c " * 5, "a b a b a b a b c a b a b", "\x1ca\x0bb\x0cc " * 4,
             "lorem " * 7 + "\n" + "ipsum dolor " * 6, " ".join(f"w{i % 997}" for i in range(20_000))]
    texts += [" ".join(f"w{w}" for w in some_words(draw)) for _ in range(150)]
    rows = list(enumerate(texts)) + [(None, "a " * 8), (None, "a " * 8), (4, "x " * 9)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS runs", "2 AS n_words", "3 AS most")
    found = periodic_runs.digests(periodic_runs.find_runs(periodic_runs.with_repeats(docs)))
    want, planted = [], 0
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words, planted = [words[i if i < a else a + (i - a) % p] for i in range(n)], planted + 1
        runs = brute.runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        gone = {i for start, length, period in runs for i in range(start + period, start + length)}
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want.append((
            doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in gone))))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr) and planted > 5
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def test_long_texts_and_small_slices(spark, monkeypatch):
    assert periodic_runs.runs_of(np.zeros(300_000, np.int64), np.array([300_000])).tolist() == [[0, 300_000, 1]]
    monkeypatch.setattr(periodic_runs, "TOGETHER", 10)
    docs = spark.createDataFrame([(i, "ab cd " * (i % 9)) for i in range(50)], SCHEMA)
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs.find_runs(docs).collect()}
    assert found == {i: [(0, 2 * (i % 9), 2)] if i % 9 >= 4 else [] for i in range(50)}


def test_few_texts_go_to_python_together(spark, monkeypatch):
    def sizes(docs):
        return docs.mapInArrow(lambda batches: (pa.record_batch([pa.array([len(b)])], ["n"]) for b in batches), "n long")

    docs = spark.range(1700).selectExpr("id AS doc_id", "'a b c' AS text").coalesce(1)
    monkeypatch.setattr(queries, "read", lambda *_: docs)
    monkeypatch.setattr(periodic_runs, "find_runs", sizes)
    monkeypatch.setattr(periodic_runs, "digests", lambda found: found)
    before = spark.conf.get(common.BATCH_ROWS)
    found = [r.n for r in queries.op11_periodic_runs(spark, "").collect()]
    assert sum(found) == 1700 and max(found) <= common.TEXT_ROWS
    assert spark.conf.get(common.BATCH_ROWS) == before
