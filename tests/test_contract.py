"""The registered queries: complete, checked, and with plans fit for large tables."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entrypoint
from larderspark.plans import fixtures, queries_catalog, queries_search, registry
from larderspark.streaming import jobs
from larderspark.operators.upsert import upsert
from larderspark.sources import tables
from tests import compare

# Approximate results have no SQL form; tests compare them with exact search.
WITHOUT_SQL = {"ann_search", "ann_recall", "ivf_search"}
ROOT = Path(__file__).resolve().parents[1]


def test_every_query_has_sql():
    assert set(registry.QUERIES) - set(registry.ORACLES) == WITHOUT_SQL
    assert set(registry.ORACLES) <= set(registry.QUERIES)
    assert set(registry.QUERIES) <= set(entrypoint.queries())
    assert set(entrypoint.oracle_sql()) <= set(entrypoint.queries())


def test_entry(spark, sf_dir):
    df = entrypoint.entry(spark)
    assert df.columns and df.count() > 0


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connection(sf_dir)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def has_no_cross_join(df):
    text = plan(df)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("key", list(registry.QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, key):
    problem, _, n, _ = compare.compare(spark, duck, key, sf_dir, has_no_cross_join)
    assert not problem
    assert n > 0


@pytest.mark.parametrize("key", ["clean_reviews", "keep_first_by_key", "lexical_score", "vector_search"])
def test_rows_are_cut_before_the_shuffle(spark, sf_dir, key):
    text = plan(entrypoint.queries()[key](spark, sf_dir))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_columns_are_pruned(spark, sf_dir):
    text = plan(entrypoint.queries()["embed_input"](spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_upsert_stream_equals_batch(spark, sf_dir, tmp_path, collect):
    part = fixtures.table(spark, sf_dir, "part")
    base, delta = part.limit(50), part.selectExpr(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice + 1 AS p_retailprice")
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    tables.create(base, table, ["p_partkey"])
    delta.repartition(3).write.parquet(source)
    changes = jobs.read_stream(spark, source, delta.schema, 1)
    jobs.upsert_stream(changes, table, ["p_partkey"], ["p_name"], str(tmp_path / "ck")).awaitTermination()
    want = collect(upsert(base, delta, ["p_partkey"]))
    assert collect(tables.read(spark, table)) == want
    jobs.upsert_stream(changes, table, ["p_partkey"], ["p_name"], str(tmp_path / "ck2")).awaitTermination()
    assert collect(tables.read(spark, table)) == want


def test_embed_stream_equals_batch(spark, sf_dir, tmp_path, collect):
    from larderspark.operators import embedding
    from larderspark.schemas import struct, L, VECTOR

    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    docs.repartition(4).write.parquet(source)
    docs.limit(30).write.mode("append").parquet(source)  # again: not embedded twice
    stream = jobs.read_stream(spark, source, docs.schema, 1)
    jobs.embed_stream(stream, "doc_id", "text", out, str(tmp_path / "ck")).awaitTermination()
    got = jobs.read_embedded(spark, out, struct(doc_id=L, embedding=VECTOR)).select("doc_id", "embedding")
    want = embedding.embed_documents(docs, "doc_id", "text").select("doc_id", "embedding")
    assert collect(got) == collect(want)


def test_streams_are_dealt_out_like_their_input(spark, sf_dir, tmp_path, collect, monkeypatch):
    """No task writes a fixed share of all documents: as many files arrive as the input has."""
    docs = fixtures.table(spark, sf_dir, "documents").repartition(8)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    arrived, batches, read_stream = [], [], jobs.read_stream

    def seen(session, path, schema, files):
        arrived.append(len(session.read.parquet(path).inputFiles()))
        batches.append(-(-arrived[-1] // files))
        return read_stream(session, path, schema, files)

    monkeypatch.setattr(jobs, "read_stream", seen)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a file a task
    try:
        got = collect(queries_search.embed_stream(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert arrived == [16] and batches == [3]
    assert got == collect(queries_search.embed_documents(spark, sf_dir))


def test_bench_prints_one_line(sf_dir):
    env = {**os.environ, "BENCH_SF_DIR": sf_dir, "BENCH_CPUS": "2", "BENCH_KEYS": "table_counts",
           "LARDER_DRIVER_MEMORY": "1g"}
    done = subprocess.run([sys.executable, "bench.py"], cwd=ROOT, env=env, capture_output=True, text=True, timeout=300)
    report = json.loads(done.stdout.strip().splitlines()[-1])
    assert report["sf"] == 0.001 and set(report["queries"]) == {"table_counts"}


def test_catalogue_and_reviews_share_the_search_operators():
    assert "catalog_keyword_search" in queries_search.QUERIES and "products_master" in queries_catalog.QUERIES
