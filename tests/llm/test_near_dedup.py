import itertools
import random

import corpus_pipeline
import numpy as np

from larderspark.llm import common, embed_dedup, simhash
from tests.llm import brute


def test_masks_cover_every_choice_of_differing_bits():
    masks = simhash.masks(4)
    assert len(masks) == 31
    draw = random.Random(0)
    for bits in (draw.sample(range(64), 4) for _ in range(5000)):
        change = sum(1 << b for b in bits)
        assert any(not m & change for m in masks)


def test_fingerprints_match_brute_force():
    for t in (None, "", " \t", "One", "a b c", "A b  c\nd E", "É x\u00a0y z w", "word " * 70_000, "the cat sat on the mat " * 9):
        assert simhash.fingerprint(t) % (1 << 64) == brute.fingerprint(t), t


def test_groups_match_brute_force_whatever_the_blocks(spark):
    draw = random.Random(5)
    prints = {}
    for c in range(25):
        centre = draw.getrandbits(64)
        for k in range(draw.randint(1, 12)):
            prints[c * 100 + k] = centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5)))
    signed = {d: f - (1 << 64) if f >> 63 else f for d, f in prints.items()}
    frame = spark.createDataFrame(list(signed.items()), "doc_id long, fp long")
    want = brute.groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert len(set(want.values())) > 30
    for block in (1024, 3):
        edges = simhash.linked(frame.select("fp").distinct(), 4, block)
        roots = {r.node: r.root for r in common.components(edges).collect()}
        least = {}
        for d, f in signed.items():
            root = roots.get(f, f)
            least[root] = min(d, least.get(root, d))
        assert {d: least[roots.get(f, f)] for d, f in signed.items()} == want
    found = frame.join(simhash.groups(frame), "fp")
    assert {r.doc_id: r.component_id for r in found.collect()} == want


def test_documents_null_empty_repeated(spark):
    text = " ".join(f"w{i}" for i in range(400))
    near = text.replace("w399", "w400")
    rows = [(5, text, "a"), (3, near, "b"), (3, near, "c"), (9, None, "d"), (8, "", "e"), (None, text, "f"), (1, "else what", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = sorted((r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash.group_documents(docs).collect())
    group = {d: c for d, _, c in found}
    assert len(found) == 7 and group == {0: 3, 1: 1, 3: 3, 5: 3, 8: 8, 9: 8}
    assert [f for d, f, _ in found if d == 9] == ["0" * 16]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.component_id for r in kept.collect()) == ["b", "c", "e", "g"]
    assert simhash.group_documents(docs.limit(0)).count() == 0


def test_one_row_of_every_group_stays(spark):
    """Two groups without ids, a mixed one, rows repeated, and one id in two groups."""
    words = lambda a, n=300: " ".join(f"{a}{i}" for i in range(n))
    near = lambda a: words(a, 299) + " z"
    rows = [
        *[(None, words("a"), f"a{i}") for i in range(3)], (None, near("a"), "a3"),
        *[(None, near("b"), f"b{i}") for i in range(2)], (None, words("b"), "b2"),
        (None, words("c"), "c0"), (7, words("c"), "c1"), (9, near("c"), "c2"), (None, near("c"), "c3"),
        *[(1, words("d"), "d0")] * 4, (2, near("d"), "d1"), (1, near("d"), "d2"),
        (3, words("e"), "e0"), (3, words("f"), "f1"), (2, words("f"), "f0"),
        (5, None, "g0"), (5, "", "g1"), (None, None, "g2"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    for repeats in (False, True):
        kept = simhash.keep_one(docs, repeats=repeats)
        assert kept.columns == docs.columns
        found = {}
        for r in kept.collect():
            found.setdefault(r.digest[0], []).append(r)
        assert {g: {r.doc_id for r in f} for g, f in found.items()} == {"a": {None}, "b": {None}, "c": {7}, "d": {1}, "e": {3}, "f": {2}, "g": {5}}
        assert all(len({r.text or "" for r in f}) == 1 for f in found.values())
        assert repeats or all(len(f) == 1 for f in found.values()), found


def test_pipeline_stage_keeps_one_row_where_the_hot_id_is_null(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(None, text)] * 40 + [(None, text.replace("w299", f"v{i}")) for i in range(10)] + [(i, f"other{i} text {i}") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert corpus_pipeline.near_dedup(spark, docs, "").count() == 6


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 2000 + i) for i in range(60)] + [(5, 5), (7, 8), (8, 7)]
    found = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r.node: r.root for r in found}
    assert len(found) == 41 + 61
    assert len({roots[i] for i in range(41)}) == 1 and len({roots[n] for n in roots if n >= 1000}) == 1
    assert roots[0] != roots[1000]


def test_spanning_edges_are_few_and_connect():
    draw = np.random.default_rng(2)
    for n in (1, 5, 40):
        links = draw.random((n, n)) < 1.2 / n
        rows, columns = np.arange(n), np.arange(n) + 100
        a, b = common.spanning_edges(links, rows, columns)
        assert len(a) <= 2 * n
        pairs, mine = set(zip(*np.nonzero(links))), set(zip(a.tolist(), b.tolist()))
        nodes = {*rows[links.any(1)].tolist(), *columns[links.any(0)].tolist()}
        want = brute.groups(nodes, lambda x, y: (x, y - 100) in pairs)
        assert brute.groups(nodes, lambda x, y: (x, y) in mine or (y, x) in mine) == want


def test_vectors_match_brute_force_in_many_cells(spark):
    draw = np.random.default_rng(7)
    vectors, n = {}, 0
    for c in range(30):
        centre = draw.normal(size=6)
        for _ in range(draw.integers(1, 15)):
            v = centre + draw.normal(size=6) * draw.choice([0.0, 0.03, 0.12])
            vectors[n] = ([float(np.float32(x)) for x in v], int(c % 3) if c % 10 else None)
            n += 1
    vectors |= {900: (None, 1), 901: ([0.0] * 6, 1), 902: ([float("nan")] + [1.0] * 5, 1), 903: ([None] + [1.0] * 5, 1),
                904: ([float("inf")] * 6, 1), 905: ([], 1), 906: ([1.0, 2.0], 1), 907: ([2.0, 4.0], 1)}
    counts, least = brute.cosine_links(vectors)
    rows = [(i, v, label, "x") for i, (v, label) in vectors.items()]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, kept string")
    for cell_rows in (2000, 4):
        found = {r.vec_id: r for r in embed_dedup.group_vectors(frame, cell_rows=cell_rows).collect()}
        assert {i: r.n_links for i, r in found.items()} == counts
        assert {i: r.component_id for i, r in found.items()} == least
        assert all(r.kept == (i == r.component_id) for i, r in found.items())


def test_blocks_of_a_cell_lose_nothing(spark, monkeypatch):
    draw = np.random.default_rng(9)
    vectors = {i: ((np.ones(5) + draw.normal(size=5) * 0.09).round(3).tolist(), 1) for i in range(60)}
    counts, least = brute.cosine_links(vectors)
    classes = spark.createDataFrame([(1, 5, i, 1, v) for i, (v, _) in vectors.items()],
                                    "label int, width int, node long, times long, embedding array<double>")
    found = embed_dedup.links(classes, 0.98, block=7).toPandas()
    got = found[found.other < 0].groupby("node").n.sum()
    assert {i: int(got.get(i, 0)) for i in vectors} == counts
    edges = found[found.other >= 0]
    linked = {*zip(edges.node, edges.other), *zip(edges.other, edges.node)}
    assert brute.groups(list(vectors), lambda a, b: (a, b) in linked) == least


def test_repeated_vectors_and_empty_table(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [0.0, 1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embed_dedup.group_vectors(frame).collect())
    assert found == [(0, 3, 1, False), (1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True)]
    assert embed_dedup.group_vectors(frame.limit(0)).count() == 0
