import json

import pytest
from pyspark.sql import functions as F

from larderspark.operators import catalog, ledger, master, nutrition, quality
from larderspark.operators.upsert import last_wins, upsert, upsert_partial
from larderspark.plans import catalog_jobs
from larderspark.sources import readers, tables


def dump(spark, *rows, columns="code string, product_name string, categories string"):
    return spark.createDataFrame(list(rows), columns)


def test_codes_and_useful_fields(spark):
    df = dump(spark, (" 12345678 ", "tea", "x"), ("1234567890123", "tea", "x"), ("1234567", "tea", "x"),
              ("12345678\n1", "tea", "x"), ("٣٣٣٣٣٣٣٣", "tea", "x"), ("22345678", "te", "x"),
              ("32345678", "tea", ""), ("42345678", "unknown", "x"), ("52345678", " N/A ", "x"))
    assert sorted(r.code for r in catalog.clean_catalog(df).collect()) == ["12345678", "1234567890123"]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="product_name"):
        catalog.clean_catalog(spark.createDataFrame([("1",)], "code string"))


def test_limit_takes_codes_in_order(spark):
    df = dump(spark, *[(f"{90000000 - i}", "tea", "x") for i in range(20)])
    assert [r.code for r in catalog.clean_catalog(df, 2).orderBy("code").collect()] == ["89999981", "89999982"]


def test_nutriments_and_payload(spark):
    df = dump(spark, ("12345678", "tea; green", "en:a,,fr:b", "A", "nan", "1.5", "12f"),
              columns="code string, product_name string, categories string, nutriscore_grade string, "
                      "`energy-kcal_100g` string, fat_100g string, salt_100g string")
    row = catalog.clean_catalog(df).first()
    assert row.product_name == "tea green" and row.categories == "a,b" and row.nutriscore == "a"
    assert row.nutriments == {"fat_100g": 1.5} and row.brand == "" and row.source_url.endswith("/product/12345678")
    assert json.loads(row.raw_payload) == {
        "code": "12345678", "product_name": "tea green", "brands": "", "categories": "a,b",
        "nutriscore_grade": "a", "fat_100g": 1.5}
    plain = catalog.clean_catalog(dump(spark, ("12345678", "tea", "x"))).first()
    assert plain.nutriments == {} and json.loads(plain.raw_payload)["code"] == "12345678"


def test_payloads(spark):
    payloads = [
        {"code": "1", "product": {"product_name": "  ", "product_name_fr": "thé  vert", "nutriscore_score": 3,
                                  "nutriments": {"fat_100g": 1, "x": "y"}}},
        {"product": {"code": 22, "generic_name": "g", "brands": ["list"]}},
        {"code": "3", "product": {"product_name": 5}}, {"code": "4"}, {"product": {"product_name": "n"}},
    ]
    df = spark.createDataFrame([(json.dumps(p),) for p in payloads] + [("oops",)], "payload string")
    got = {r.code: r for r in catalog.normalize_payloads(df).collect()}
    assert set(got) == {"1", "22"}
    assert got["1"].product_name == "thé vert" and got["1"].nutriscore == "" and got["1"].nutriments == {"fat_100g": 1.0}
    assert got["22"].product_name == "g" and got["22"].brand == ""


def test_payloads_keep_the_whole_nutriments_object(spark):
    given = {"a": {"fat_100g": 1.5, "fat_unit": "g", "energy": "12", "none": None, "flag": True, "deep": {"x": ["y", 2]}, "é": ""},
             "b": {}, "c": None, "d": ["g"], "e": "g"}
    payloads = [{"code": k, "product": {"product_name": "tea", "nutriments": v}} for k, v in given.items()]
    payloads.append({"code": "f", "product": {"product_name": "tea"}})
    df = spark.createDataFrame([(json.dumps(p),) for p in payloads], "payload string")
    got = {r.code: r for r in catalog.normalize_payloads(df).collect()}
    assert {k: json.loads(r.nutriments_json) for k, r in got.items()} == {
        k: v if isinstance(v, dict) else {} for k, v in {**given, "f": None}.items()}
    assert got["a"].nutriments["fat_100g"] == 1.5 and "fat_unit" not in got["a"].nutriments


def test_payloads_go_into_an_older_catalogue_table(spark, tmp_path):
    """A table written before the column was there keeps its rows and gets the column."""
    old = catalog.clean_catalog(dump(spark, ("12345678", "tea", "x"))).drop("nutriments_json")
    tables.create(old, f"{tmp_path}/catalog", ["code"])
    payload = {"code": "87654321", "product": {"product_name": "tea", "nutriments": {"fat_unit": "g"}}}
    catalog_jobs.load(catalog.normalize_payloads(
        spark.createDataFrame([(json.dumps(payload),)], "payload string")), f"{tmp_path}/catalog", ["code"])
    rows = tables.read(spark, f"{tmp_path}/catalog").collect()
    assert {r.code: r.nutriments_json for r in rows} == {"12345678": None, "87654321": '{"fat_unit":"g"}'}


def test_nutrition_fan_out_takes_least_id(spark):
    facts = spark.createDataFrame(
        [(2, 1, 1008, 9.0), (1, 1, 1008, 5.0), (3, 1, 1004, 2.5), (4, 2, 999, 1.0)],
        "id bigint, fdc_id bigint, nutrient_id bigint, amount double")
    foods = spark.createDataFrame([(1, "BEEF, RAW", "Meat"), (2, "x", None), (3, "EGG", None)],
                                  "fdc_id bigint, description string, food_category string")
    got = {r.product_id: r for r in master.from_nutrition(foods, facts).collect()}
    assert got["usda:1"].nutrition_summary == "Energy: 5 kcal | Fat: 2.5 g"
    assert got["usda:1"].product_name == "Beef, Raw" and "usda:2" not in got
    assert got["usda:3"].nutrition_summary == ""
    assert json.loads(got["usda:3"].payload) == {"fdc_id": 3, "description": "EGG", "category": None}


def test_nutrient_bounds(spark):
    raw = spark.createDataFrame(
        [("1", "1", "1", a, None, None, None, None) for a in ("0", "-1", "1000001", "x", None)]
        + [("2.0", "7", "1", "1000000", "3.0", "1", "2", "1.5")],
        "id string, fdc_id string, nutrient_id string, amount string, data_points string, min string, max string, median string")
    got = sorted(tuple(r) for r in nutrition.food_nutrients(raw).select("id", "amount", "data_points").collect())
    assert got == [(1, 0.0, None), (2, 1000000.0, 3)]


def test_search_text(spark):
    df = spark.createDataFrame(
        [("off:1", "tea", " brand ", "", "i" * 500, None, "a", "openfoodfacts", "{}"),
         ("off:2", "t", "", "", "", "", "", "openfoodfacts", "{}")],
        "product_id string, product_name string, brand string, categories string, ingredients_text string, "
        "allergens string, nutriscore string, source_dataset string, payload string")
    rows = master.search_documents(df).collect()
    assert [r.search_text for r in rows] == ["tea brand " + "i" * 400 + " Nutri-Score A"]


def base_and_delta(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, n int")
    delta = spark.createDataFrame([(2, "B", 20), (3, "C", 30)], "k int, v string, n int")
    return base, delta


def test_upsert(spark, collect):
    base, delta = base_and_delta(spark)
    once = upsert(base, delta, ["k"])
    assert collect(once) == [(1, "a", 1), (2, "B", 20), (3, "C", 30)]
    assert collect(upsert(once, delta, ["k"])) == collect(once)
    keys = upsert(base.select("k"), delta.select("k"), ["k"])
    assert collect(keys) == [(1,), (2,), (3,)]
    doubled = delta.union(delta.withColumn("n", F.lit(99)))
    assert collect(last_wins(doubled, ["k"], [F.desc("n")])) == [(2, "B", 99), (3, "C", 99)]


def test_partial_upsert(spark, collect):
    base, delta = base_and_delta(spark)
    got = upsert_partial(base, delta, ["k"], ["n"], {"v": F.lit("!")})
    assert collect(got) == [(1, "a", 1), (2, "!", 20), (3, "!", 30)]
    assert collect(upsert_partial(base, delta, ["k"], ["n"])) == [(1, "a", 1), (2, "b", 20), (3, "C", 30)]


def test_gate(spark):
    good = spark.createDataFrame([("1", "tea")], "product_id string, product_name string")
    docs = spark.createDataFrame([("1", "tea text")], "product_id string, search_text string")
    assert quality.assert_quality(good, docs)["status"] == "passed"
    bad = good.union(good).union(spark.createDataFrame([("2", " ")], good.schema))
    for products, documents, message in (
            (bad, docs, "duplicate product_id"), (bad, docs, "blank product_name"),
            (good.limit(0), docs, "products_master is empty"), (good, docs.limit(0), "product_search_documents is empty"),
            (good, docs.union(docs), "product_search_documents contains duplicate"),
            (good, docs.withColumn("search_text", F.lit("  ")), "blank search_text")):
        with pytest.raises(RuntimeError, match=message):
            quality.assert_quality(products, documents)


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert ledger.run_logged(spark, path, "ok", lambda: 7) == 7

    def broken():
        raise KeyError("lost")

    with pytest.raises(KeyError):
        ledger.run_logged(spark, path, "bad", broken)
    runs = {r.source: r for r in ledger.latest_runs(ledger.read_ledger(spark, path)).collect()}
    assert runs["ok"].status == "succeeded" and runs["ok"].row_count == 7 and runs["ok"].finished_at
    assert runs["bad"].status == "failed" and "lost" in runs["bad"].notes


def test_keyed_table(spark, tmp_path, collect):
    path = str(tmp_path / "t")
    assert tables.read(spark, path) is None
    base, delta = base_and_delta(spark)
    tables.apply(base, path, ["k"], buckets=8)
    tables.apply(delta, path, ["k"])
    tables.apply(delta, path, ["k"])  # again: the same table
    assert collect(tables.read(spark, path)) == [(1, "a", 1), (2, "B", 20), (3, "C", 30)]
    tables.delete(spark, path, spark.createDataFrame([("1",), ("7",)], "k string"))  # cast to the table's type
    assert collect(tables.read(spark, path)) == [(2, "B", 20), (3, "C", 30)]
    tables.apply(delta.limit(1).selectExpr("k", "'new' AS more"), path, ["k"])
    assert {r.more for r in tables.read(spark, path).collect()} == {"new", None}
    tables.create(tables.read(spark, path).filter("k = 3"), path, ["k"])
    assert [r.k for r in tables.read(spark, path).collect()] == [3]


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    files = lambda: {f.relative_to(path): f.name for f in (tmp_path / "t").rglob("key_bucket=*/*.parquet")}
    tables.create(spark.range(1000).withColumn("v", F.lit(1)), path, ["id"], buckets=16)
    before = files()
    delta = spark.range(5, 8).withColumn("v", F.lit(2))
    touched = tables.changed_buckets(delta, ["id"], 16)
    tables.apply(delta, path, ["id"])
    same = {f for f in before if f in files()}
    assert {int(str(f).split("=")[1].split("/")[0]) for f in same} == set(range(16)) - set(touched) and len(touched) <= 3
    assert tables.read(spark, path).groupBy("v").count().orderBy("v").collect() == [(1, 997), (2, 3)]


def test_a_refreshed_master_equals_a_rebuilt_one(spark, tmp_path, collect):
    house = str(tmp_path)
    rows = [(f"{n:08d}", f"tea {n}", "x") for n in range(40)]
    new = catalog.clean_catalog(dump(spark, *rows))
    old = new.filter("code > '00000004'").withColumn(
        "product_name", F.when(F.col("code") < "00000010", F.lit("old name")).otherwise(F.col("product_name")))
    extra = catalog.clean_catalog(dump(spark, ("99999999", "gone", "x")))
    foods = spark.createDataFrame([(n, f"FOOD {n}", "c") for n in range(20)], "fdc_id bigint, description string, food_category string")
    facts = spark.createDataFrame([(n, n % 20, 1008, float(n)) for n in range(20, 60)],
                                  "id bigint, fdc_id bigint, nutrient_id bigint, amount double")
    tables.create(old.unionByName(extra), f"{house}/catalog", ["code"])
    tables.create(foods.withColumn("description", F.when(F.col("fdc_id") == 3, F.lit("x")).otherwise(F.col("description"))),
                  f"{house}/foods", ["fdc_id"])
    tables.create(facts.filter("id > 25"), f"{house}/food_nutrients", ["id"])
    catalog_jobs.rebuild_master(spark, house)
    # inserts, updates, deletes; a name that becomes too short; nutrient rows that come and go
    tables.apply(new, f"{house}/catalog", ["code"])
    tables.delete(spark, f"{house}/catalog", extra.select("code"))
    last = foods.withColumn("description", F.when(F.col("fdc_id") == 7, F.lit("y")).otherwise(F.col("description")))
    tables.apply(last, f"{house}/foods", ["fdc_id"])
    tables.apply(facts.filter("id <= 25"), f"{house}/food_nutrients", ["id"])
    tables.delete(spark, f"{house}/food_nutrients", facts.filter("id = 59").select("id"))
    looked = catalog_jobs.refresh_master(
        spark, house, codes=new.filter("code <= '00000010'").select("code").unionByName(extra.select("code")),
        fdc_ids=spark.createDataFrame([(3,), (7,)], "fdc_id long"),
        nutrients=facts.filter("id <= 25 or id = 59").select("fdc_id"))
    assert 15 < looked < 25
    want = master.products_master(new, last, facts.filter("id < 59"))
    assert collect(tables.read(spark, f"{house}/master").drop("updated_at")) == collect(want)
    assert collect(tables.read(spark, f"{house}/search_documents").drop("updated_at")) == collect(master.search_documents(want))


def test_jobs_end_to_end(spark, tmp_path):
    raw, house, out = tmp_path / "raw", str(tmp_path / "house"), str(tmp_path / "out")
    raw.mkdir()
    files = {
        "food_category": "id,code,description\n1,0100, Dairy  and Egg \n",
        "food": "fdc_id,data_type,description,food_category_id,publication_date\n"
                '10,f,"MILK, ""WHOLE""",1.0,2024-01-01\n11,f,,1,2024-01-01\n',
        "foundation_food": "fdc_id,NDB_number,footnote\n10,1,\n",
        # another order and one more column: read by name
        "nutrient": "rank,id,name,unit_name,extra,nutrient_nbr\n300,1008,Energy,KCAL,x,208\n",
        "food_nutrient": "id,fdc_id,nutrient_id,amount,data_points,min,max,median\n1,10,1008,61.5,,,,\n",
        "measure_unit": "id,name\n1,cup\n",
        "food_portion": "id,fdc_id,measure_unit_id,amount,gram_weight,portion_description,modifier\n1,10,1,1,244,,\n",
    }
    for name, body in files.items():
        (raw / f"{name}.csv").write_text(body)
    (raw / "dump.tsv").write_text(
        "code\tproduct_name\tcategories\tbrands\n12345678\tGreen tea\ten:teas\tB\textra\n1\tbad\tx\ty\n")
    assert catalog_jobs.import_nutrition(spark, str(raw), house) == 7
    assert catalog_jobs.import_catalog(spark, str(raw / "dump.tsv"), house) == 1
    catalog_jobs.rebuild_master(spark, house)
    catalog_jobs.rebuild_master(spark, house)  # a second run changes nothing
    table = tables.read(spark, f"{house}/master")
    got = {r.product_id: r for r in table.collect()}
    assert set(got) == {"off:12345678", "usda:10"}
    assert got["usda:10"].product_name == 'Milk, "Whole"' and got["usda:10"].categories == "Dairy and Egg"
    assert got["usda:10"].nutrition_summary == "Energy: 61.5 kcal"
    documents = tables.read(spark, f"{house}/search_documents")
    report = catalog_jobs.export_catalog(table, documents, out)
    assert report["products_rows"] == report["documents_rows"] == 2
    shown = spark.read.parquet(f"{out}/product_search_documents.parquet").orderBy("product_id").collect()
    assert shown[0].search_text == "Green tea B teas" and isinstance(shown[0].updated_at, str)
    (raw / "payloads.json").write_text(json.dumps(
        {"code": "12345678", "product": {"product_name": "Green tea, new"}}) + "\n{}\n")
    assert catalog_jobs.import_payloads(spark, str(raw / "payloads.json"), house) == 1
    catalog_jobs.rebuild_master(spark, house)
    table = tables.read(spark, f"{house}/master")
    assert {r.product_id: r.product_name for r in table.collect()}["off:12345678"] == "Green tea, new"
    spark.createDataFrame(
        [(1, " tea ", 2, "p", "us", "E", "train", 1, 1), (2, "tea", 2, "p", "us", "Z", "train", 1, 1)],
        "example_id int, query string, query_id int, product_id string, product_locale string, esci_label string, "
        "split string, small_version int, large_version int").write.parquet(str(raw / "examples"))
    assert catalog_jobs.import_examples(spark, str(raw / "examples"), house) == 1
    runs = ledger.latest_runs(ledger.read_ledger(spark, f"{house}/runs")).collect()
    assert len(runs) == 4 and {r.status for r in runs} == {"succeeded"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        readers.read_nutrition(spark, str(raw), "food").unionByName(
            readers.read_nutrition(spark, str(tmp_path), "food")).collect()


def test_table_with_limit(spark):
    spark.range(10).withColumn("v", F.lit(1)).createOrReplaceTempView("some_table")
    assert readers.read_table(spark, "some_table", ["id"], 3, ["id"]).columns == ["id"]
    assert readers.read_table(spark, "some_table", ["id"], 3, ["id"]).count() == 3
    with pytest.raises(ValueError, match="order"):
        readers.read_table(spark, "some_table", ["id"], 3)
    assert readers.read_table(spark, "some_table").count() == 10


def test_dump_files_with_other_column_order_are_an_error(spark, tmp_path):
    from larderspark import schemas

    names = list(schemas.CATALOG_REQUIRED)
    for n, order in enumerate((names, names[::-1])):
        (tmp_path / f"{n}.tsv").write_text("\t".join(order) + "\n" + "\t".join(order) + "\n")
    assert readers.read_catalog_dump(spark, str(tmp_path / "0.tsv")).count() == 1
    with pytest.raises(Exception, match="(?i)header|schema"):
        readers.read_catalog_dump(spark, str(tmp_path)).collect()


def test_barcodes(spark):
    values = spark.createDataFrame([("2, 1,,3",)], "value string")
    lines = spark.createDataFrame([("# no",), (" 4 ",), ("",), ("5,6",), (" # kept",)], "value string")
    got = [r.barcode for r in readers.barcode_list(values, lines).collect()]
    assert got == sorted(["1", "2", "3", "4", "5,6", "# kept"])


def test_optional_source(spark, tmp_path):
    empty = readers.read_optional(spark, str(tmp_path / "none"), spark.range(1).schema)
    assert empty.columns == ["id"] and empty.count() == 0


def test_benchmark_file(spark, tmp_path):
    (tmp_path / "q.json").write_text(json.dumps([{"query": "a", "top_k": 3, "positive_groups": [["x", "y"], ["z"]]}]))
    row = readers.read_benchmark(spark, str(tmp_path / "q.json")).first()
    assert (row.query, row.top_k, row.positive_groups) == ("a", 3, [["x", "y"], ["z"]])
