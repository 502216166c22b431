import random

from larderspark.llm import line_dedup
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def texts_after(df):
    return {r.doc_id: (r.removed_lines, r.text) for r in df.collect()}


def test_runs_match_brute_force(spark):
    draw = random.Random(4)
    lines = [f"{'w ' * draw.randint(1, 4)}{i}" for i in range(5)]
    docs = [(d, "\n".join(draw.choice(lines) for _ in range(draw.randint(1, 9)))) for d in range(12)]
    docs += [(20, docs[3][1]), (21, "x\n" + docs[4][1]), (22, "\n".join([lines[0]] * 9))]
    gone = brute.removed_lines(docs, 8)
    found = texts_after(line_dedup.dedup_lines(spark.createDataFrame(docs, SCHEMA), least_words=8))
    for d, text in docs:
        kept = [line for i, line in enumerate(text.split("\n")) if (d, i) not in gone]
        assert found[d] == (sum(g[0] == d for g in gone), "\n".join(kept)), d


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [
        (1, None, "a"), (2, "", "b"), (3, long, "c"), (3, long, "d"), (4, long, "e"), (None, f"{long}\nend", "f"),
        (5, "short\nshort", "g"), (6, "\n", "h"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, removed_lines string").withColumnRenamed(
        "removed_lines", "line")
    found = {r.line: (r.text, r.removed_lines) for r in line_dedup.dedup_lines(docs).collect()}
    assert found["a"] == (None, 0) and found["b"] == ("", 0) and found["h"] == ("\n", 0)
    assert found["f"] == (f"{long}\nend", 0)  # the null id comes first
    assert found["c"] == found["d"] == found["e"] == ("", 1)  # repeated rows get one result
    assert found["g"] == ("short\nshort", 0)


def test_empty_table(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0
