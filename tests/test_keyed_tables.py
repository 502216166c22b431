"""What a keyed table stores beside itself."""

from larderspark.sources import tables


def test_rows_are_written_once(spark, tmp_path, collect, monkeypatch):
    path, stored = str(tmp_path / "t"), []
    monkeypatch.setattr(tables, "cut_lineage", lambda df, name="stage", f=tables.cut_lineage: stored.append(name) or f(df, name))
    tables.create(spark.range(100).selectExpr("id", "id * 2 AS v"), path, ["id"], 4)
    tables.apply(spark.range(90, 120).selectExpr("id", "-id AS v"), path, ["id"])
    tables.delete(spark, path, spark.range(5))
    assert stored == ["changes", "gone"]  # the changes alone, not the buckets that they touch
    want = [(i, 2 * i if i < 90 else -i) for i in range(5, 120)]
    assert sorted(collect(tables.read(spark, path))) == want
    # a table may still be made from itself, and emptied bucket by bucket
    tables.create(tables.read(spark, path).filter("id < 50"), path, ["id"], 4)
    assert sorted(collect(tables.read(spark, path))) == want[:45]
    tables.delete(spark, path, spark.range(6, 50))
    assert collect(tables.read(spark, path)) == [(5, 10)]
    tables.apply(spark.range(5, 7).selectExpr("id", "0L AS v"), path, ["id"])
    assert collect(tables.read(spark, path)) == [(5, 0), (6, 0)]
