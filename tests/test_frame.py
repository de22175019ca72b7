import math

import pytest
from pyspark.sql import functions as F

from panelweave import session
from panelweave.operators import frame as fr
from panelweave.operators import joins, select, series


def test_mask_truth_table(frame, rows):
    spine = frame("district_id string, iso3 string", ("d1", "A"), ("d2", "B"))
    events = frame("district_id string, year int, n double", ("d1", 2001, 4.0))
    span = frame("iso3 string, first_year int, last_year int", ("A", 2000, 2002))
    out = fr.attach(fr.dense_frame(spine, 1999, 2003), events, ["district_id", "year"], ["n"], "mask", span, "iso3")
    got = {(r["district_id"], r["year"]): r["n"] for r in out.collect()}
    assert [got["d1", y] for y in range(1999, 2004)] == [None, 0.0, 4.0, 0.0, None]
    assert all(got["d2", y] is None for y in range(1999, 2004))


def test_mask_keeps_a_match_outside_the_window(frame):
    spine = frame("district_id string, iso3 string", ("d1", "A"))
    events = frame("district_id string, year int, n double", ("d1", 1999, 1.0), ("d1", 2001, 4.0))
    span = frame("iso3 string, first_year int, last_year int", ("A", 2000, 2002))
    out = fr.attach(fr.dense_frame(spine, 1999, 2003), events, ["district_id", "year"], ["n"], "mask", span, "iso3")
    assert {r["year"]: r["n"] for r in out.collect()}[1999] == 1.0


def test_zero_and_null_policies(frame):
    base = fr.dense_frame(frame("district_id string", ("a",)), 2000, 2001)
    layer = frame("district_id string, year int, n bigint", ("a", 2000, 3))
    zero = fr.attach(base, layer, ["district_id", "year"], ["n"], "zero")
    null = fr.attach(base, layer, ["district_id", "year"], ["n"], "null")
    assert {r["year"]: r["n"] for r in zero.collect()} == {2000: 3, 2001: 0}
    assert zero.schema["n"].dataType.simpleString() == "bigint"
    assert {r["year"]: r["n"] for r in null.collect()} == {2000: 3, 2001: None}


def test_duplicate_right_key_fails(frame):
    base = fr.dense_frame(frame("district_id string", ("a",)), 2000, 2001)
    layer = frame("district_id string, year int, n bigint", ("a", 2000, 3), ("a", 2000, 4))
    with pytest.raises(Exception, match="duplicate key"):
        fr.attach(base, layer, ["district_id", "year"], ["n"]).collect()


@pytest.mark.parametrize("mode,want", [("latest", [("LM", True), ("L", False), ("LM", True), ("LM", False), ("LM", True)]), ("asof", [(None, False), ("L", False), ("L", True), ("LM", False), ("LM", True)])])
def test_carry_modes(frame, mode, want):
    base = fr.dense_frame(frame("district_id string, iso3 string", ("d", "A")), 1989, 1993)
    series_ = frame("iso3 string, year int, g string", ("A", 1990, "L"), ("A", 1992, "LM"))
    out = fr.carry_class(base, series_, "iso3", "g", mode).orderBy("year").collect()
    assert [(r["g"], r["g_carried"]) for r in out] == want


def test_log_change_over_gaps(frame):
    df = frame("k string, year int, p double", ("a", 2000, 1.0), ("a", 2001, None), ("a", 2002, 4.0), ("b", 2000, 2.0), ("b", 2002, 8.0))
    loose = {(r["k"], r["year"]): r["d"] for r in series.log_change(df, ["k"], "p", "d").collect()}
    strict = {(r["k"], r["year"]): r["d"] for r in series.log_change(df, ["k"], "p", "d", strict=True).collect()}
    assert loose["b", 2002] == pytest.approx(math.log(4)) and strict["b", 2002] is None
    assert [loose["a", y] for y in (2000, 2001, 2002)] == [None, None, None]


def test_non_positive_price_has_no_log(frame):
    df = frame("k string, year int, p double", ("a", 2000, 0.0), ("a", 2001, 2.0), ("a", 2002, 4.0))
    got = [r["d"] for r in series.log_change(df, ["k"], "p", "d").orderBy("year").collect()]
    assert got[:2] == [None, None] and got[2] == pytest.approx(math.log(2))


def test_period_expansion(frame):
    df = frame("i int, a int, b int", (1, 1980, 1991), (2, 2023, 2030), (3, 2026, 2030))
    got = sorted((r["i"], r["year"]) for r in joins.expand_periods(df, "a", "b", 1989, 2025).collect())
    assert got == [(1, 1989), (1, 1990), (1, 1991), (2, 2023), (2, 2024), (2, 2025)]


def test_anomaly_guard(frame):
    steady = [("x", 1989 + i, 20.0 + 0.01 * (i % 2)) for i in range(22)]
    real = [("y", 1989 + i, 20.0 + (i % 5)) for i in range(22)]
    short = [("z", 2007 + i, float(i)) for i in range(6)]
    df = frame("d string, year int, v double", *steady, *real, *short)
    got = series.standardised_anomaly(df, "d", "v", "z", (1989, 2010)).collect()
    assert all(r["z"] is None for r in got if r["d"] in ("x", "z"))
    assert all(r["z"] is not None for r in got if r["d"] == "y")


def test_lag_needs_the_year_before(frame):
    df = frame("d string, year int, v double", ("a", 2000, 1.0), ("a", 2001, 2.0), ("a", 2003, 3.0))
    got = [r["v_lag1"] for r in series.lagged(df, ["d"], ["v"]).orderBy("year").collect()]
    assert got == [None, 1.0, None]


def test_shift_share_cases(frame):
    base = fr.dense_frame(frame("d string", ("a",), ("b",), ("c",)), 2001, 2001)
    areas = frame("d string, crop string, area double", ("a", "maize", 5.0), ("a", "wheat", 2.0), ("a", "yam", 3.0), ("b", "yam", 4.0))
    prices = frame("code string, year int, p double", ("m", 2000, 1.0), ("m", 2001, math.exp(0.1)), ("w", 2000, None), ("w", 2001, 3.0))
    xw = frame("crop string, code string", ("maize", "m"), ("wheat", "w"))
    out = series.shift_share(base, areas, prices, xw, "d", "crop", "code", "area", "p", 2000, 2001)
    got = {r["d"]: (r["shock"], r["coverage"]) for r in out.collect()}
    assert got["a"] == (pytest.approx(0.05), pytest.approx(0.7))
    assert got["b"] == (0.0, 0.0) and got["c"] == (None, None)


def test_densify(frame):
    long = frame("d string, year int, c string, v double", ("a", 2000, "x", 1.0))
    out = fr.densify(long, frame("d string", ("a",), ("b",)), "d", "c", ["x", "y"], 2000, 2001, ["v"])
    assert out.count() == 8 and out.filter(F.col("v").isNotNull()).count() == 1


def test_salted_join_equals_plain_join(frame, spark):
    left = spark.range(5000).select(F.when(F.col("id") < 2500, F.lit(7)).otherwise(F.col("id") % 50).alias("k"), F.col("id"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("left", "inner"):
        salted = joins.salted_join(left, right, ["k"], ["id"], how, salts=8)
        plain = left.join(right, "k", how)
        assert sorted(map(tuple, salted.select("id", "k", "v").collect()), key=str) == sorted(map(tuple, plain.select("id", "k", "v").collect()), key=str)


def test_lookup_takes_the_shuffle_way_when_large(frame, spark):
    left = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    right = spark.range(10).select(F.col("id").alias("k"), (F.col("id") + 1).alias("v"))
    out = joins.lookup(left, right, ["k"], ["id"], max_rows=3)
    assert out.filter(F.col("v") == F.col("k") + 1).count() == 1000


def test_hot_keys_are_found_while_the_table_is_written(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 100 == 1, 6).otherwise(F.col("id")).alias("k"), "id")
    held, hot = joins.staged_with_hot(df, ["k"], 0.01)
    want = [r["h"] for r in spark.sql("select xxhash64(5L) as h union all select xxhash64(6L)").collect()]
    assert want[0] in hot and set(hot) <= set(want) and held.columns == ["k", "id"] and held.count() == 50_000
    assert joins.staged_with_hot(df.limit(0), ["k"])[1] == []


def test_salted_join_reads_its_left_side_once(spark):
    left = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    out = joins.salted_join(left, spark.range(2).withColumnRenamed("id", "k").withColumn("v", F.col("k")), ["k"], ["id"], "left", salts=8)
    assert out.count() == 1000 and "Range (0, 1000" not in out._jdf.queryExecution().executedPlan().toString()


def test_hot_keys(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("k"))
    assert [r["k"] for r in joins.hot_keys(df, ["k"], 0.1).collect()] == [1]


def test_crosswalk_guard(frame):
    df = frame("name string, year int", ("x", 1990), ("y", 1950))
    xw = frame("name string, iso3 string")
    joined, unmapped = joins.crosswalk_join(df, xw, ["name"], ["year"])
    assert unmapped.count() == 2
    with pytest.raises(Exception, match="unmapped row"):
        joins.guard_mapped(joined, "iso3", F.col("year") >= 1989, "names").collect()
    assert joins.guard_mapped(joined, "iso3", F.col("year") > 2000, "names").count() == 2


def test_successors_must_not_overlap(frame):
    codes = frame("code string, successor string", ("SUN", "RUS"), ("YUG", "SRB"))
    df = frame("code string, year int, v int", ("SUN", 1990, 1), ("RUS", 1992, 2), ("YUG", 1990, 3), ("FRA", 1990, 4))
    got = sorted((r["code"], r["year"], r["v"]) for r in joins.successor_codes(df, codes, "code", "year").collect())
    assert got == [("FRA", 1990, 4), ("RUS", 1990, 1), ("RUS", 1992, 2), ("SRB", 1990, 3)]
    with pytest.raises(Exception, match="two codes report RUS 1990"):
        joins.successor_codes(df.union(frame("code string, year int, v int", ("RUS", 1990, 9))), codes, "code", "year").collect()


def test_filters_are_counted_by_the_job_that_writes(frame, tmp_path):
    df = frame("a int, b int", (1, 1), (2, None), (3, 3), (None, 4))
    kept, told = select.observed(df, {"known": F.col("a").isNotNull(), "high": F.col("b") > 2})
    kept.write.parquet(str(tmp_path / "x"))
    assert told() == {"all": 4, "known": 3, "high": 1} and df.sparkSession.read.parquet(str(tmp_path / "x")).count() == 1


def test_shared_folders_carry_their_scheme(spark):
    assert session.run_folder(spark).startswith("file:/") and session.qualified(spark, "/a/b") == "file:/a/b"
    assert session.qualified(spark, "file:///a/b").startswith("file:/")
