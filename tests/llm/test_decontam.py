import itertools
import random

from larderspark.llm import decontam
from tests.llm import brute


def test_masks_meet_all_pairs_of_substitutions():
    for pair in itertools.combinations(range(decontam.WINDOW), 2):
        assert any(
            not set(pair) & {at + o for o in mask}
            for mask in decontam.MASKS for at in range(decontam.WINDOW - mask[-1])
        ), pair


def test_leaks_match_brute_force(spark):
    draw = random.Random(3)
    word = lambda: f"w{draw.randint(0, 40)}"
    items = [(i, [word() for _ in range(n)]) for i, n in enumerate((5, 11, 12, 13, 14, 30, 60))]
    docs = []
    for d in range(60):
        body = [word() for _ in range(draw.randint(0, 40))]
        if d % 2:
            source = draw.choice(items)[1]
            low = draw.randint(0, len(source) // 2)
            piece = [w if draw.random() > 0.12 else word() for w in source[low:]]
            at = draw.randint(0, len(body))
            body[at:at] = piece
        docs.append((d, ", ".join(body).upper()))
    docs += [(90, None), (91, ""), (92, docs[1][1]), (None, docs[3][1])]
    bench = [(i, " ".join(w)) for i, w in items] + [(100, None), (101, ""), (None, " ".join(items[6][1]))]
    found = decontam.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    want = {}
    for d, t in docs:
        for i, b in bench:
            n = brute.most_equal(brute.words(t), brute.words(b))
            if n >= decontam.EQUAL:
                want[d, i] = max(n, want.get((d, i), 0))
    assert {(r.doc_id, r.item_id): r.equal_words for r in found.collect()} == want and len(want) > 10


def test_blocks_give_the_same(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = lambda: sorted(map(tuple, decontam.leaks(docs, items).collect()))
    whole = rows()
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 60_000)
    assert rows() == whole


def test_clean_documents_stay_with_all_columns(spark):
    text = " ".join(f"word{i}" for i in range(20))
    docs = spark.createDataFrame([(1, text, "a"), (2, "other", "b"), (None, text, "c")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, text)], "item_id long, text string")
    kept = decontam.drop_leaking(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]
    assert decontam.leaks(docs, items.limit(0)).count() == 0
    assert decontam.drop_leaking(docs.limit(0), items).count() == 0


def test_rows_are_judged_by_their_own_text(spark):
    leak = " ".join(f"word{i}" for i in range(20))
    rows = [(1, "ok"), (None, leak), (None, "clean"), (None, "clean"), (4, leak), (4, "clean"), (5, None), (6, ""), (6, leak)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id AS id", "'x' AS words", "1 AS leaking_text")
    items = spark.createDataFrame([(7, leak), (None, leak)], "item_id long, text string")
    kept = decontam.drop_leaking(docs, items)
    assert kept.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert left == sorted([r for r in rows if r[1] != leak], key=repr)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # documents are not shuffled


def test_long_items_are_cut_into_stretches(spark, monkeypatch):
    monkeypatch.setattr(decontam, "STRETCH", 60)
    draw = random.Random(1)
    item = [f"w{draw.randrange(3000)}" for _ in range(500)]
    docs = [(at, " ".join(["x"] * 5 + item[at : at + 14] + ["y"] * 5)) for at in range(0, 500, 7)]
    found = decontam.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    want = {d: brute.most_equal(brute.words(t), item) for d, t in docs}
    assert {r.doc_id: r.equal_words for r in found.collect()} == {d: n for d, n in want.items() if n >= decontam.EQUAL}
