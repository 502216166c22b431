import sys

import __spark_entry__ as entrypoint
import corpus_pipeline
import pytest

from larderspark.llm import queries

SF = "/root/testdata/sf0.001"
WITH_SQL = sorted(queries.ORACLES)


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert sorted(docs.dtypes) == sorted(spark.read.parquet(f"{SF}/documents.parquet").dtypes), name
        docs = corpus_pipeline.cut_lineage(docs, name)
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and 0.5 * counts[0] < counts[-1] < counts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == counts[-1]


def test_stages_match_brute_force(spark):
    """Near-dedup, line dedup and decontamination of one small corpus, stage by stage."""
    from tests.llm import brute

    words = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    item = words("bench", 30)
    texts = {
        1: words("a", 300), 2: words("a", 299) + " z", 3: words("b", 60) + "\n" + words("c", 40),
        4: words("d", 50) + "\n" + words("c", 40), 5: words("e", 40) + " " + item, 6: words("f", 30), 7: words("f", 30),
    }
    docs = spark.createDataFrame([(d, t, len(t)) for d, t in texts.items()], "doc_id long, text string, n_chars long")
    after = {r.doc_id: r.text for r in corpus_pipeline.line_dedup_texts(spark, docs, SF).collect()}
    gone = brute.removed_lines(list(texts.items()), 20)
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in texts.items()}
    assert after == {d: t for d, t in want.items() if t}
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()}
    prints = {d: brute.fingerprint(t) for d, t in texts.items()}
    assert kept == set(brute.groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4).values())


@pytest.mark.parametrize("key", WITH_SQL)
def test_queries_match_sql(spark, key):
    from tests import compare

    problem, _, n, checked = compare.compare(spark, compare.connection(SF), key, SF)
    assert checked and n and not problem, problem


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entrypoint.queries())
    numbers = [int(k[2 : k.index("_")]) for k in queries.QUERIES]
    assert numbers == sorted(numbers) and set(range(1, 11)) <= set(numbers)


def test_nothing_else_imports_the_package():
    import subprocess

    code = ("import sys; sys.modules['larderspark.llm'] = None; import __spark_entry__ as e;"
            "assert 'pipeline' not in e.queries() and len(e.queries()) > 80")
    done = subprocess.run([sys.executable, "-c", code], cwd=corpus_pipeline.__file__.rpartition("/")[0], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


@pytest.mark.parametrize("key", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_queries_without_sql_run_on_whole_tables(spark, key):
    df = queries.QUERIES[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    table = "pages" if key.startswith("op8") else "documents"
    first = df.columns[0]
    assert df.select(first).distinct().count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_stages_take_nulls_repeats_and_clashing_columns(spark):
    words = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = [(None, None), (None, ""), (None, words("g", 80)), (None, words("g", 80)), (None, words("h", 80)), (9001, words("i", 80)),
            (9001, words("j", 80)), (9001, words("j", 80)), (9002, None), (9003, "word " * 60_000)]
    odd = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "CAST(NULL AS STRING) AS lang", "CAST(NULL AS STRING) AS source", "CAST(length(text) AS LONG) AS n_chars")
    names = ["id", "doc", "i", "fp", "digest", "root", "least", "leaking_text", "start", "length", "sequence_id", "label", "score", "words"]
    whole = docs.unionByName(odd).selectExpr("*", *[f"'{n}' AS `{n}`" for n in names])
    for table in (whole, whole.limit(0)):
        kept = table
        for name, stage in corpus_pipeline.STAGES:
            kept = corpus_pipeline.cut_lineage(stage(spark, kept, SF), name)
            assert name == "pack" or sorted(kept.columns) == sorted(whole.columns), name
        assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(kept.columns)
        assert (kept.count() > 0) == (table is whole)
