import hashlib
import random
import zlib

import pytest

from larderspark.llm import conversation_trie
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string"


def compared(spark, rows, rebuilt, **more):
    found = conversation_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3), rebuilt=rebuilt, **more)
    want = brute.trie(rows, rebuilt)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    return want


@pytest.mark.parametrize("container, rebuilt", [(6, True), (100_000, False)])
def test_trie_matches_brute_force(spark, container, rebuilt):
    draw = random.Random(container)
    rows = []
    for c in [*range(0, 40), *range(100, 130), 250, 300, -7]:
        turns = draw.choice([1, 2, 3, 9])
        rows += [(c, t if draw.random() > 0.1 else None, draw.choice(["user", "bot", None]), draw.choice(["a", "é😀", "", None]))
                 for t in draw.sample(range(50), turns)]
    # a group of copies, a long one, and two that part after many turns
    rows += [(c, t, "user", f"copy {t}") for c in range(400, 440) for t in range(4)]
    rows += [(500, t, "user", f"long {t}") for t in range(60)]
    rows += [(c, t, "bot", f"long {t}" if t < 6 else f"{c} {t}") for c in (601, 702) for t in range(40)]
    want = compared(spark, rows, rebuilt, container_turns=container)
    assert max(r[1] for r in want) >= 60


def test_nulls_ties_empty_and_extra_columns(spark):
    rows = [(None, 1, "a", "b"), (3, None, None, None), (3, 1, "x", "y"), (3, 1, "x", "y"), (7, 2, "x", "long " * 20_000)]
    compared(spark, rows, False)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "2 AS conv", "3 AS c1", "4 AS saved", "5 AS pos")
    assert sorted(map(tuple, conversation_trie.prefix_trie(frame).collect()), key=repr) == sorted(brute.trie(rows, False), key=repr)
    empty = conversation_trie.prefix_trie(spark.createDataFrame([], SCHEMA), rebuilt=True)
    assert empty.count() == 0 and "ends_sha256" in empty.columns
    assert conversation_trie.prefix_trie(spark.createDataFrame(rows[:1], SCHEMA)).count() == 0


def test_a_conversation_that_loses_all_turns_stays_a_member(spark):
    short = next(c for c in range(901, 1000) if zlib.crc32(str(c).encode()) % 6 >= 2)
    want = compared(spark, [(short, 0, "user", "only"), (1, 0, "user", "x")], True)
    root = next(r for r in want if r[1] == 0)
    assert root[3] == 2 and root[7] != hashlib.sha256(b"").hexdigest()


def test_digests_of_large_groups_stream_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK_IDS", 7)
    pairs = [(1, c) for c in range(1, 200)] + [(500, 500), (500, 900)]
    found = {r.rep: r.sha for r in conversation_trie.id_digests(spark.createDataFrame(pairs, "rep long, conv long")).collect()}
    digest = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert found == {1: digest(range(1, 200)), 500: digest([500, 900])}
