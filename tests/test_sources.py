import gzip
import json

import pytest
from pyspark.sql import functions as F

from panelweave.functions import dates, numeric, text
from panelweave.operators import spatial
from panelweave.sources import contracts, keyindex, readers, refresh, sinks
from panelweave.streaming import arrivals
from panelweave.workload import exchange


def values(df, expr, *inputs):
    return [r[0] for r in df.sparkSession.createDataFrame([(i,) for i in inputs], "x string").select(expr).collect()]


def test_csv_contract(spark, tmp_path):
    (tmp_path / "ok.csv").write_text("a,b\n1,x\n2,y\n")
    (tmp_path / "bad.csv").write_text("a,c\n1,x\n")
    assert readers.read_csv(spark, str(tmp_path / "ok.csv"), "a int, b string").count() == 2
    with pytest.raises(Exception):
        readers.read_csv(spark, str(tmp_path / "bad.csv"), "a int, b string").collect()


def test_bom_and_latin1_and_quotes(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes("﻿code,name\n1,Côte\n".encode("utf-8"))
    (tmp_path / "latin.csv").write_bytes("code,name\n1,Côte\n".encode("latin-1"))
    (tmp_path / "t.tsv").write_text('abbrev \tcountry\n"A"\t"Upper Volta"\n')
    bom = readers.read_text_table(spark, str(tmp_path / "bom.csv"), ["code", "name"], sep=",")
    latin = readers.read_text_table(spark, str(tmp_path / "latin.csv"), ["code"], sep=",", encoding="ISO-8859-1")
    assert bom.first()["name"] == latin.first()["name"] == "Côte"
    tsv = readers.read_text_table(spark, str(tmp_path / "t.tsv"), ["abbrev", "country"])
    assert tuple(tsv.first()) == ("A", "Upper Volta")
    with pytest.raises(ValueError, match="lacks"):
        readers.read_text_table(spark, str(tmp_path / "t.tsv"), ["missing"])


def test_long_csv_filters(spark, tmp_path):
    (tmp_path / "q.csv").write_text("item,cpc,year\n1,'0111,2000\n2,'2111,2000\n3,'0112,1900\n")
    crop = F.startswith(text.bare_code(F.col("cpc")), F.lit("01"))
    out = readers.read_long(spark, str(tmp_path / "q.csv"), "item int, cpc string, year int", [crop, F.col("year") >= 1961])
    assert [r["item"] for r in out.collect()] == [1]


def test_many_files_with_an_empty_one(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "d" / "y1"))
    spark.range(0).write.parquet(str(tmp_path / "d" / "y2"))
    out = readers.read_many(spark, str(tmp_path / "d" / "*"))
    assert out.count() == 3


def test_file_name_attributes(spark, tmp_path):
    spark.range(2).coalesce(1).write.parquet(str(tmp_path / "x"))
    out = spark.read.parquet(str(tmp_path / "x")).select(readers.name_part(r"part-(\d+)").alias("p"), readers.name_part(r"(zzz)").alias("z"))
    assert out.first()["p"] == "00000" and out.first()["z"] is None


def test_indicator_records(spark, tmp_path):
    doc = {"code": "X.Y", "column": "wb_x", "data": [{"countryiso3code": "AAA", "date": "2000", "value": 1.5}, {"countryiso3code": "", "date": "2001", "value": None}]}
    (tmp_path / "x.json").write_text(json.dumps(doc, indent=1))
    got = readers.read_indicators(spark, str(tmp_path / "x.json")).collect()
    assert [(r["column"], r["iso3"], r["year"], r["value"]) for r in got] == [("wb_x", "AAA", 2000, 1.5), ("wb_x", None, 2001, None)]


def test_geojson_features(spark, tmp_path):
    ring = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[1, 1, 9], [2, 1, 9], [2, 2, 9], [1, 2, 9], [1, 1, 9]]
    doc = {"type": "FeatureCollection", "features": [
        {"properties": {"value": "3", "reporting_date": "2015-02-01"}, "geometry": {"type": "Polygon", "coordinates": [ring, hole]}},
        {"properties": {"value": "2", "reporting_date": None}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [hole]]}},
        {"properties": {"value": "1"}, "geometry": {"type": "Point", "coordinates": [1, 1]}},
    ]}
    (tmp_path / "ET_201502.json").write_text(json.dumps(doc))
    feats = readers.read_features(spark, str(tmp_path / "*.json"), "value string, reporting_date string")
    assert feats.count() == 2
    geom = spatial.polygons(readers.feature_polygons(feats, ["value"]), ["value"])
    from panelweave.functions import geo

    areas = {r["value"]: r["a"] for r in geom.select("value", geo.edges_area(F.col("edges")).alias("a")).collect()}
    assert areas == {"3": 15.0, "2": 17.0}
    assert feats.select(F.regexp_extract("file", r"^([A-Z]{2})_", 1)).first()[0] == "ET"


def test_lookup_lines(spark, tmp_path):
    (tmp_path / "readme.txt").write_text("Intro\n1  whea  wheat\n2  rice  rice\nend\n")
    out = readers.parse_lines(spark, str(tmp_path / "readme.txt"), r"^\s*(\d+)\s+(\w{4})\s+(\w+)$", ["n", "code", "name"], 2)
    assert sorted(r["code"] for r in out.collect()) == ["rice", "whea"]
    with pytest.raises(ValueError, match="expected 3"):
        readers.parse_lines(spark, str(tmp_path / "readme.txt"), r"^\s*(\d+)\s+(\w{4})\s+(\w+)$", ["n", "code", "name"], 3)


def test_cells(frame):
    df = frame("lon double, lat double, v double, year int", (190.25, 0.75, 5.0, 2000), (0.25, -0.25, -9999.0, 2000), (1.0, 1.0, float("nan"), 2000))
    got = [tuple(r) for r in readers.cells_of(df, "lon", "lat", "v", 0.5, -9999.0).collect()]
    assert got == [(-340, 1, 2000, 5.0), (0, -1, 2000, None), (2, 2, 2000, None)]


def test_text_functions(frame):
    df = frame("x string", ("Lamb **",))
    assert values(df, text.strip_footnote(F.col("x")), "Lamb **", "Rice, Thai 5%", " a  b ") == ["Lamb", "Rice, Thai 5%", "a b"]
    assert values(df, text.unwrap(F.col("x")), "($/mt)", " kg ", None) == ["$/mt", "kg", ""]
    assert values(df, text.slug(F.col("x")), "Café, Añejo 5%", None, "Ærø Straße ﬁn ½ K", " --", "naïve—x", "e\u0301a") == ["cafe_anejo_5", None, "r_strae_fin_12_k", "", "naivex", "ea"]
    assert values(df, text.brace_names(F.col("x")), "fao_{a, b}_t", "plain") == [["fao_a_t", "fao_b_t"], ["plain"]]
    assert values(df, text.label_code(F.col("x")), "whea Wheat and more") == ["whea"]
    assert values(df, text.unquote(F.col("x")), ' "x" ') == ["x"]


def test_date_functions(frame):
    df = frame("x string", ("",))
    assert values(df, dates.fiscal_year(F.col("x")), "FY89", "FY00", "FY26") == [1989, 2000, 2026]
    with pytest.raises(Exception, match="not a fiscal year"):
        values(df, dates.fiscal_year(F.col("x")), "1989")
    assert values(df, dates.year_of(F.col("x")), "2015-02-01", "nonsense", None) == [2015, None, None]


def test_number_functions(frame):
    df = frame("x string", ("",))
    x = F.col("x")
    assert values(df, numeric.number_or_null(x, [".."]), "1.5", "..", "abc", None) == [1.5, None, None, None]
    assert values(df, numeric.strict_number(x), "2", "", None) == [2.0, None, None]
    with pytest.raises(Exception, match="not a number"):
        values(df, numeric.strict_number(x), "abc")
    d = x.cast("double")
    assert values(df, numeric.human(d), "1234567", "0", "0.0123", None) == ["1.23M", "0.00", "0.0123", "—"]
    assert values(df, numeric.finite(x.cast("double")), "NaN", "Infinity", "-Infinity", "1") == [None, None, None, 1.0]
    assert values(df, numeric.round_even(x.cast("double"), 0), "0.5", "1.5", "2.5") == [0.0, 2.0, 2.0]
    assert values(df, numeric.known_flag(d > 1), "2", "1", None) == [1.0, 0.0, None]
    assert values(df, numeric.flag(d > 1), "2", None) == [1, 0]
    assert values(df, numeric.clip(d, 0, 1), "3", "-1", None) == [1.0, 0.0, None]
    assert values(df, numeric.ratio(d, d - d), "3") == [None]


def test_contract_and_vocabulary(frame):
    df = frame("k string", ("a",), ("b",))
    with pytest.raises(Exception, match="unexpected k"):
        contracts.require_values(df, "k", ["a"]).collect()
    assert contracts.require_values(df, "k", ["a", "b"]).count() == 2
    got = {r["name"]: r["status"] for r in contracts.source_contract(df, "g", ["k", "z"], min_rows=3, row_cap=2, allowed={"k": ["a"]}).collect()}
    assert set(got.values()) == {"FAIL"} and len(got) == 4


def test_manifests(spark, tmp_path, frame):
    frame("year int, d date").count()
    df = spark.sql("select 2000 as year, date'2000-03-01' as d union all select 2000, date'2000-01-01' union all select 2001, null")
    got = {r["year"]: (r["n_rows"], str(r["first_date"]), str(r["last_date"])) for r in contracts.manifest(df, ["year"], "d").collect()}
    assert got == {2000: (2, "2000-01-01", "2000-03-01"), 2001: (1, "None", "None")}
    df.coalesce(1).write.parquet(str(tmp_path / "m"))
    assert contracts.file_manifest(spark.read.parquet(str(tmp_path / "m")), "d").first()["n_rows"] == 3


def test_refresh_keeps_settled_years(spark, tmp_path):
    path = str(tmp_path / "events")
    old = spark.createDataFrame([(y, i, "old") for y in (2000, 2001, 2002) for i in range(3)], "year int, id int, tag string")
    refresh.refresh_years(old, path, [2000, 2001, 2002])
    new = old.withColumn("tag", F.lit("new"))
    refresh.refresh_trailing(new, path, 2002, trailing=2)
    got = {(r["year"], r["tag"]): r["count"] for r in spark.read.parquet(path).groupBy("year", "tag").count().collect()}
    assert got == {(2000, "old"): 3, (2001, "new"): 3, (2002, "new"): 3}
    refresh.refresh_trailing(new.filter("year <> 2002"), path, 2002, trailing=2)  # a due year without rows goes
    assert {r["year"] for r in spark.read.parquet(path).select("year").distinct().collect()} == {2000, 2001}
    assert refresh.due_years(1999, 2002, [2000, 2001, 2002], 2) == [1999, 2001, 2002]


def test_arriving_files_replace_events(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("in", "out", "chk"))
    schema = spark.createDataFrame([], "id string, year int, n int").schema
    spark.createDataFrame([("a", 2000, 1), ("b", 2001, 1)], schema).coalesce(1).write.parquet(src)
    arrivals.follow_files(spark, src, schema, out, chk, "id").awaitTermination()
    spark.createDataFrame([("a", 2000, 9), ("c", 2000, 1)], schema).coalesce(1).write.mode("append").parquet(src)
    arrivals.follow_files(spark, src, schema, out, chk, "id").awaitTermination()
    got = sorted((r["id"], r["year"], r["n"]) for r in spark.read.parquet(out).collect())
    assert got == [("a", 2000, 9), ("b", 2001, 1), ("c", 2000, 1)]
    # a revised year leaves the old partition, which here is emptied
    spark.createDataFrame([("b", 2003, 7)], schema).coalesce(1).write.mode("append").parquet(src)
    arrivals.follow_files(spark, src, schema, out, chk, "id").awaitTermination()
    got = sorted((r["id"], r["year"], r["n"]) for r in spark.read.parquet(out).collect())
    assert got == [("a", 2000, 9), ("b", 2003, 7), ("c", 2000, 1)]


def test_csv_export_keeps_the_text_na(spark, tmp_path, frame):
    path = str(tmp_path / "x")
    df = frame("k string, g string, v double", ("1", "NA", 0.123456), ("2", None, None))
    sinks.write_csv(df, path, ["k"])
    files = [p for p in (tmp_path / "x").iterdir() if p.name.endswith(".csv.gz")]
    body = "".join(gzip.open(p, "rt").read() for p in files)
    assert "1,NA,0.1235" in body
    back = {r["k"]: r["g"] for r in spark.read.option("header", True).csv(path).collect()}
    assert back == {"1": "NA", "2": None}


def test_type_shrinking(frame):
    df = frame("a double, b double, c string", (1.0, 1.23456, "x"), (None, 2.0, "y"))
    out = sinks.shrink_types(df)
    assert out.schema["a"].dataType.simpleString() == "bigint" and out.first()["b"] == 1.235
    assert [r["a"] for r in out.collect()] == [1, None]


def test_gated_and_bounded_exports(spark, tmp_path):
    df = spark.range(10).withColumn("secret", F.lit(1))
    with pytest.raises(sinks.ExportRefused):
        sinks.publishable(df, ["secret"])
    assert sinks.publishable(df, ["secret"], drop=True).columns == ["id"]
    assert sinks.publishable(df, ["secret"], confirm_private=True).columns == ["id", "secret"]
    with pytest.raises(sinks.ExportRefused, match="more than 5"):
        sinks.bounded_export(df, str(tmp_path / "x"), 5)
    assert sinks.bounded_export(df, str(tmp_path / "y"), 10) == 10


def test_sorted_parquet(spark, tmp_path):
    path = str(tmp_path / "s")
    sinks.write_sorted(spark.range(1000).withColumn("k", (F.col("id") * 7919) % 1000), path, ["k"], 4)
    got = spark.read.parquet(path).withColumn("f", F.input_file_name()).groupBy("f").agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("f").collect()
    assert all(x["b"] < y["a"] for x, y in zip(got, got[1:])) and len(got) > 1


def test_build_report(frame):
    out = sinks.build_report(frame("a int, b string", (1, None), (2, "x")), {"matched": 1})
    assert "columns: 2" in out and "50.00%" in out and "matched: 1" in out


def test_feature_files_are_bounded(spark):
    """A hot group of features goes to many files, each of bounded size, and none is lost."""
    features = spark.range(20_000).select(F.when(F.col("id") < 19_900, 1).otherwise(2).alias("g"), F.col("id").alias("k"), F.struct("id").alias("feature"))
    files = [(r["g"], [f["id"] for f in json.loads(r["value"])["features"]]) for r in exchange.feature_files(features, "g", "k").collect()]
    assert sorted(k for _, ks in files for k in ks) == list(range(20_000)) and all((g == 1) == (k < 19_900) for g, ks in files for k in ks)
    assert max(len(ks) for _, ks in files) < 2 * exchange.FEATURES and len(files) == 21


def test_key_index_reads_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "keys")
    rows = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("id"), (F.col("id") % 5 + 2000).cast("int").alias("year"))
    keyindex.add(rows, path, "id", "year", 0)
    asked = spark.createDataFrame([("k7",), ("k8",), ("new",)], "id string")
    years = keyindex.years_of(asked, path, "id")
    assert sorted(r["year"] for r in years.collect()) == [2002, 2003]
    plan = years._jdf.queryExecution().executedPlan().toString()
    touched = {r["b"] for r in asked.select(keyindex.bucket("id").alias("b")).collect()}
    assert f"PartitionFilters: [bucket" in plan and len(touched) == 3
    for folder in (tmp_path / "keys").iterdir():  # nothing else is read: spoil it
        if folder.is_dir() and int(folder.name.split("=")[1]) not in touched:
            for file in folder.iterdir():
                file.write_bytes(b"spoiled")
    assert sorted(r["year"] for r in keyindex.years_of(asked, path, "id").collect()) == [2002, 2003]


def test_key_index_compacts_finished_batches(spark, tmp_path):
    path = str(tmp_path / "keys")
    for batch, year in enumerate((2000, 2001, 2002)):
        keyindex.add(spark.createDataFrame([("a", year), ("b", 1990)], "id string, year int"), path, "id", "year", batch)
    assert keyindex.crowded(spark, path, 3) == [] and len(keyindex.crowded(spark, path, 2)) in (1, 2)
    keyindex.compact(spark, path, 2, 2)  # batch 2 may be repeated: what it listed stays beside the newest of before
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("key", "year", "batch").collect())
    assert got == [("a", 2001, 1), ("a", 2002, 2), ("b", 1990, 1), ("b", 1990, 2)]
    assert keyindex.crowded(spark, path, 2) == []


def test_arrivals_find_rows_of_a_table_without_an_index(spark, tmp_path):
    """A table that stood there before is listed once; twelve batches in a row compact the index and lose nothing."""
    src, out, chk, schema = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "chk"), "id string, year int, n int"
    spark.createDataFrame([("a", 1990, 0), ("z", 1990, 5)], schema).write.partitionBy("year").parquet(out)
    for k in range(12):
        spark.createDataFrame([("a", 2000 + k % 4, k), (f"n{k}", 2010, k)], schema).coalesce(1).write.mode("append").parquet(src)
        arrivals.follow_files(spark, src, spark.createDataFrame([], schema).schema, out, chk, "id").awaitTermination()
    got = {r["id"]: (r["year"], r["n"]) for r in spark.read.parquet(out).collect()}
    assert got == {"a": (2003, 11), "z": (1990, 5)} | {f"n{k}": (2010, k) for k in range(12)}
    assert spark.read.parquet(out).count() == 14
