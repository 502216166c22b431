"""Bucketed tables, lookups, bitmaps and sketches against plain results."""

import random
from collections import Counter

from pyspark.sql import functions as F

from larderspark.operators import embedding, facets, sketches
from larderspark.session import cut_lineage
from larderspark.sources import layouts


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_rows(spark, df):
    """Rows that the file scan of ``df`` handed on (the plan runs once, without adaptive parts)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        execution = df._jdf.queryExecution()
        execution.executedPlan().executeCollect()
        leaves = execution.executedPlan().collectLeaves()
        return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_bucketed_tables_join_without_a_shuffle(spark, collect):
    left = spark.range(500).select((F.col("id") * 3).alias("k"), F.lit("a").alias("a"))
    right = spark.range(700).select((F.col("id") * 2).alias("k"), F.array(F.lit(1.0)).alias("embedding"))
    stored = [layouts.write_bucketed(df, "k", 8) for df in (left, right)]
    joined = embedding.join_embeddings(stored[0].hint("merge"), stored[1], "k")
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    assert collect(joined) == collect(embedding.join_embeddings(left, right, "k"))
    todo = stored[0].hint("merge").join(stored[1].select("k"), "k", "left_anti")
    assert "Exchange" not in plan_of(todo) and todo.count() == left.join(right, "k", "left_anti").count()


def test_absent_ids_read_no_row_group(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = spark.range(20_000).select((F.col("id") * 10).cast("string").alias("id"), F.rand(1).alias("x"))
    layouts.write_lookup(rows.coalesce(4), path, ["id"], 20_000)
    assert [r.id for r in layouts.lookup(spark, path, "id", ["500"]).collect()] == ["500"]
    assert layouts.lookup(spark, path, "id", ["500", "77", "501"]).count() == 1
    assert scanned_rows(spark, layouts.lookup(spark, path, "id", ["500"])) > 0
    # within the ranges of the files, but in no Bloom filter
    assert sum(scanned_rows(spark, layouts.lookup(spark, path, "id", [x])) for x in ("5003", "77771", "1001x")) == 0


def test_bitmaps_count_like_group_by(spark):
    draw = random.Random(3)
    rows = [(draw.choice("abc"), draw.choice([1, 2, None]), draw.choice(["x", "y"])) for _ in range(3_000)]
    frame = spark.createDataFrame(rows * 30, "color string, size int, shop string").repartition(5)
    table = cut_lineage(facets.bitmaps(frame, {"color": "color", "size": "size", "shop": "shop"}))
    assert table.select("bucket").distinct().count() >= 5
    assert {(r.value, r.n) for r in facets.counts(table, "color").collect()} == set((k, 30 * n) for k, n in Counter(r[0] for r in rows).items())
    text = lambda v: None if v is None else str(v)
    want = Counter((r[0], text(r[1])) for r in rows)
    assert {(r.color, r["size"], r.n) for r in facets.pair_counts(table, "color", "size").collect()} == {(*k, 30 * n) for k, n in want.items()}
    chosen = Counter(r[0] for r in rows if r[1] == 2 and r[2] == "x")
    found = facets.filtered_counts(table, {"size": ["2", "9"], "shop": ["x"]}, "color")
    assert {(r.value, r.n) for r in found.collect()} == {(k, 30 * n) for k, n in chosen.items()}
    assert facets.bitmaps(frame.limit(0), {"color": "color"}).count() == 0


def test_sketches_of_any_range(spark):
    draw = random.Random(8)
    rows = [(draw.choice("st"), draw.randrange(30), int(draw.expovariate(0.001)), draw.randrange(20_000)) for _ in range(60_000)]
    frame = spark.createDataFrame(rows, "source string, d int, size int, user int").withColumn(
        "day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))
    table = cut_lineage(sketches.daily(frame, ["source"], F.col("day"), F.col("size"), {"users": F.col("user")}))
    assert table.count() == 60
    for low, high, days in ((None, None, range(30)), ("2024-01-05", "2024-01-09", range(4, 9)), ("2024-01-30", None, [29])):
        part = sketches.merged(table, ["source"], ["users"], low, high)
        for r in part.select("source", "rows", sketches.quantile(0.9).alias("q"), sketches.distinct("users").alias("n")).collect():
            mine = [x for x in rows if x[0] == r.source and x[1] in days]
            sizes, users = [x[2] for x in mine], len({x[3] for x in mine})
            assert r["rows"] == len(mine)
            assert sum(s < r.q for s in sizes) / len(sizes) <= 0.9 + sketches.RANK_ERROR
            assert sum(s <= r.q for s in sizes) / len(sizes) >= 0.9 - sketches.RANK_ERROR
            assert abs(r.n - users) <= sketches.SET_ERROR * users
    empty = sketches.daily(frame.limit(0), ["source"], F.col("day"), F.col("size"), {"users": F.col("user")})
    assert sketches.merged(empty, ["source"], ["users"]).count() == 0


def test_export_computes_its_texts_once(spark, tmp_path):
    from larderspark.plans import catalog_jobs

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    schema = "product_id string, product_name string, payload string"
    products = spark.createDataFrame([(f"p{i}", f"name {i}", "{}") for i in range(50)], schema)
    documents = products.selectExpr("product_id AS source_product_id", "product_name AS search_text", "payload").mapInArrow(
        counted, "source_product_id string, search_text string, payload string")
    report = catalog_jobs.export_catalog(products, documents, str(tmp_path / "out"))
    assert seen.value == 50 and report["documents_unique_ids"] == 50 and report["status"] == "passed"
