"""The rows that a task keeps per query: what becomes text, and what is kept."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from larderspark.operators import ivf, vector

SCHEMA = pa.schema([("query_id", pa.int64()), ("product_id", pa.string()), ("near", pa.float64()),
                    ("review_count", pa.int64()), ("average_score", pa.float64())])


def points(draw, rows: int, first: int) -> pa.RecordBatch:
    ids = [f"p{(i * 7919) % 100_003}" for i in range(first, first + rows)]
    return pa.RecordBatch.from_pydict({
        "product_id": ids, "review_count": draw.integers(0, 3, rows), "average_score": draw.integers(0, 2, rows).astype(float),
        "cell": pa.array(np.zeros(rows), pa.int32()), "code": [bytes([c]) for c in draw.integers(0, 4, rows)]})


def test_only_kept_rows_become_text(monkeypatch):
    draw, seen, short = np.random.default_rng(3), [], 5
    counted = lambda column, at, f=vector.ids_of: seen.append(len(at)) or f(column, at)
    for module in (vector, ivf):
        monkeypatch.setattr(module, "ids_of", counted, raising=False)
    queries = draw.standard_normal((40, 2))
    plan = SimpleNamespace(value=(list(range(40)), queries, np.zeros((1, 2)), draw.standard_normal((1, 4, 2)), np.ones((40, 1), bool)))
    out = list(ivf._short_lists(plan, short, SCHEMA)(iter([points(draw, 3_000, 0), points(draw, 3_000, 3_000)])))
    assert sum(b.num_rows for b in out) == 40 * short
    assert max(seen) <= 40 * short  # not every row of every query


def test_ties_over_batches_and_merges(monkeypatch):
    monkeypatch.setattr(vector, "LEAST_WAITING", 50)
    monkeypatch.setattr(vector, "RESULT_ROWS", 7)
    draw, k = np.random.default_rng(4), 6
    best, rows = vector.BestRows(list("abc"), np.array([-np.inf, 0.5, 9.0]), k), []
    for n in range(12):
        batch = points(draw, 90, n * 90)
        scores = draw.integers(0, 4, (90, 3)) / 3
        met = draw.random((90, 3)) < 0.7
        best.take(batch)
        best.offer(scores, np.arange(3), np.arange(90), met)
        rows += [("abc"[q], scores[i, q], *(batch.column(c)[i].as_py() for c in ("review_count", "average_score", "product_id")))
                 for i, q in zip(*np.nonzero(met)) if scores[i, q] >= best_floor(q)]
    schema = SCHEMA.set(0, pa.field("query_id", pa.string()))
    got = [tuple(r.values()) for b in best.batches(schema) for r in b.to_pylist()]
    want = []
    for q in "abc":
        mine = sorted((r for r in rows if r[0] == q), key=lambda r: (-r[1], -r[2], -r[3], r[4]))[:k]
        want += [(q, r[4], round(r[1], vector.DIGITS), r[2], r[3]) for r in mine]
    assert got == want and len(got) == 2 * k


def best_floor(query: int) -> float:
    return (-np.inf, 0.5, 9.0)[query]
