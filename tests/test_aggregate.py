import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.operators import aggregate, checks, reshape, select, stats


def test_fractionalisation_case(frame):
    df = frame("d string, g string, a double", ("x", "p", 3.0), ("x", "q", 1.0))
    assert aggregate.fractionalisation(df, ["d"], "g", "a", "f").first()["f"] == pytest.approx(0.375)


def test_mode_tie_goes_up(frame):
    df = frame("d string, phase int, a double", ("x", 2, 1.0), ("x", 3, 1.0))
    assert aggregate.weighted_mode(df, ["d"], "phase", "a", "m").first()["m"] == 3


def test_crisis_share_case(frame):
    df = frame("phase int, a double", (2, 3.0), (4, 1.0))
    assert df.agg(aggregate.share_where(F.col("phase") >= 3, "a").alias("s")).first()["s"] == pytest.approx(0.25)


def test_clip_and_weighted_mean(frame):
    df = frame("a double, e boolean", (0.7, True), (0.6, True), (0.2, False))
    assert df.agg(aggregate.clipped_sum(F.col("e"), "a").alias("s")).first()["s"] == 1.0
    wm = frame("x double, w double", (2.0, 1.0), (None, 3.0))
    assert wm.agg(aggregate.weighted_mean("x", "w").alias("m")).first()["m"] == 2.0


def test_sum_forms(frame):
    df = frame("k string, v double", ("a", None), ("a", None))
    got = df.groupBy("k").agg(F.sum("v").alias("null_form"), aggregate.sum_or_zero("v").alias("zero_form")).first()
    assert got["null_form"] is None and got["zero_form"] == 0.0


def test_exact_quantiles_with_a_hot_group(spark):
    rng = np.random.default_rng(0)
    groups = np.where(rng.random(6000) < 0.4, 0, rng.integers(1, 30, 6000))
    values = np.where(rng.random(6000) < 0.3, 5.0, np.round(rng.normal(0, 10, 6000), 2))
    values[groups == 7] = 1.0
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(groups, values)], "g int, v double")
    marks = {"p0": 0.0, "p5": 0.05, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["g"]: r for r in aggregate.exact_quantiles(df, ["g"], "v", marks).collect()}
    assert len(got) == len(set(groups))
    for g in set(groups):
        want = np.quantile(values[groups == g], list(marks.values()))
        assert [got[g][m] for m in marks] == pytest.approx(list(want))


def test_weighted_quantile(frame):
    df = frame("k int, v double, w double", (1, 10.0, 1.0), (1, 20.0, 1.0), (1, 30.0, 5.0), (2, 1.0, 0.5), (2, 2.0, 0.5), (2, None, 9.0))
    got = {r["k"]: r["m"] for r in aggregate.exact_quantiles(df, ["k"], "v", {"m": 0.5}, weight="w").collect()}
    assert got == {1: 30.0, 2: 1.0}


def test_weighted_median_keeps_the_last_decimal(frame):
    """Two parts in 10^12 short of half: adding the ranges' sums must not round them away."""
    df = frame("k string, v double, w double", ("a", 1.0, 0.999999999998), ("a", 2.0, 1.0), ("b", 1.0, 1.0), ("b", 2.0, 1.0))
    got = {r["k"]: r["m"] for r in aggregate.exact_quantiles(df, ["k"], "v", {"m": 0.5}, weight="w").collect()}
    assert got == {"a": 2.0, "b": 1.0}


def test_interpolated_weighted_quantile(frame):
    """By hand: middles of the weights at 0.5, 1.5, 4.5 of 7, so 3.5 lies two thirds of the way from 20 to 30."""
    df = frame("k int, v double, w double", (1, 10.0, 1.0), (1, 20.0, 1.0), (1, 30.0, 5.0), (2, 1.0, 0.5), (2, 2.0, 0.5), (3, 4.0, 0.1))
    got = {r["k"]: r["m"] for r in aggregate.exact_quantiles(df, ["k"], "v", {"m": 0.5}, weight="w", interpolate=True).collect()}
    assert got == {1: pytest.approx(20 + 10 * 2 / 3), 2: 1.5, 3: 4.0}


def test_weights_add_up_the_same_in_any_order(spark):
    """Ten tenths on either side of the half: no rounding decides which value is the median."""
    rows = [(v, 0.1) for v in range(20)]
    for seed in range(3):
        shuffled = [rows[i] for i in np.random.default_rng(seed).permutation(20)]
        df = spark.createDataFrame(shuffled, "v int, w double").repartition(5)
        assert aggregate.exact_quantiles(df, [], "v", {"m": 0.5}, weight="w").first()["m"] == 9


def test_zero_totals_are_unknown_not_fatal(frame):
    df = frame("k int, c string, a double", (1, "x", 0.0), (1, "y", 0.0), (2, "x", 1.0), (2, "y", 3.0))
    share = {(r["k"], r["c"]): r["s"] for r in aggregate.shares(df, ["k"], "c", "a", "s").collect()}
    assert share == {(1, "x"): None, (1, "y"): None, (2, "x"): 0.25, (2, "y"): 0.75}
    mixed = {r["k"]: r["f"] for r in aggregate.fractionalisation(df, ["k"], "c", "a", "f").collect()}
    assert mixed == {1: None, 2: 0.375}
    where = df.groupBy("k").agg(aggregate.share_where(F.col("c") == "x", "a").alias("s")).collect()
    assert {r["k"]: r["s"] for r in where} == {1: None, 2: 0.25}


def test_gate_names_every_failing_check(frame):
    rows = [("g", f"check {k:02d}", "FAIL", 1) for k in range(80)]
    with pytest.raises(checks.CheckFailed) as failed:
        checks.gate(frame("grp string, name string, status string, violations bigint", *rows))
    assert all(name in str(failed.value) for _, name, _, _ in rows)


def test_histogram_edges(frame):
    df = frame("v double", *[(float(i),) for i in range(13)])
    got = {r["bin"]: r["n"] for r in aggregate.histogram(df, "v", 12).collect()}
    assert got[11] == 2 and sum(got.values()) == 13
    flat = aggregate.histogram(frame("v double", (3.0,), (3.0,)), "v", 12).collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(0, 2)]


def test_null_group_key_is_dropped(frame):
    df = frame("k string, v double", (None, 1.0), ("a", 3.0))
    for how in ("mean", "median", "sum", "max"):
        assert [tuple(r) for r in aggregate.group_metric(df, "k", "v", how).collect()] == [("a", 3.0)]


def test_rollup_rules():
    assert aggregate.rollup_rule("deaths_best_total", []) == "sum"
    assert aggregate.rollup_rule("coups_total", ["coups_total"]) == "mean"
    assert aggregate.rollup_rule("fao_maize_prod_t", []) == "sum"
    assert aggregate.rollup_rule("precip_mm", []) == "mean"


def test_keep_one_is_deterministic(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), (F.col("id") % 3).alias("p"), F.col("id").alias("v"))
    a = sorted(map(tuple, select.keep_one(df, ["k"], [select.descending("p")]).collect()))
    b = sorted(map(tuple, select.keep_one(df.repartition(7), ["k"], [select.descending("p")]).collect()))
    assert a == b and len(a) == 10 and all(p == 2 for _, p, _ in a)


def test_picked_groups_match_plain_rank(spark):
    df = spark.range(3000).select((F.col("id") % 4).alias("k"), F.col("id").alias("o"))
    picks = spark.createDataFrame([(1,), (2,)], "k bigint")
    got = sorted((r["k"], r["o"]) for r in select.picked_groups(df, picks, ["k"], 100, ["o"]).collect())
    assert got == [(k, k + 4 * i) for k in (1, 2) for i in range(100)]


def test_sample_is_seeded_and_whole(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("d"), "id")
    a = select.sample_entities(df, "d", 20, 42, always=[3]).select("d").distinct().collect()
    b = select.sample_entities(df.repartition(9), "d", 20, 42, always=[3]).select("d").distinct().collect()
    assert sorted(a) == sorted(b) and 3 in {r["d"] for r in a} and len(a) in (20, 21)
    assert select.sample_entities(df, "d", 20, 42).count() == 200


def test_row_rules(frame):
    df = frame("a int, b int, c string", (2, 1, "D2; F"), (0, None, "A1"), (None, None, None))
    got = df.select(
        reshape.row_count(["a", "b"], lambda x: x != 0).alias("n"), reshape.any_part_in("c", "[;,]", ["F"]).alias("low"),
        reshape.any_positive(["c", "a"]).alias("flag"),
    ).collect()
    assert [tuple(r) for r in got] == [(2, True, 1), (0, False, 0), (0, False, 0)]


def test_holders(frame):
    schema = "iso3 string, `col.a` int, `colstart.a_mean` double, `colend.a_mean` double, `col.b` int, `colstart.b_mean` double, `colend.b_mean` double"
    df = frame(schema, ("x", 1, 1900.0, 1960.0, 1, 1880.0, 1960.0), ("y", 0, None, None, 0, None, None), ("z", 1, 1900.0, None, 0, 1800.0, 1990.0))
    got = df.select("iso3", *[v.alias(k) for k, v in reshape.holders({n: (f"col.{n}", f"colstart.{n}_mean", f"colend.{n}_mean") for n in "ab"}).items()])
    rows = {r["iso3"]: tuple(r)[1:] for r in got.collect()}
    assert rows["x"] == ("b", 2, 1880.0, 1960.0, 80.0)
    assert rows["y"] == ("None", 0, None, None, None)
    assert rows["z"] == (None, 1, 1900.0, None, None)


def test_checks_fail_closed_and_gate(frame):
    df = frame("v int", (1,), (None,))
    bad = checks.rows_hold(df, "g", {"v is 1": F.col("v") == 1})
    assert [tuple(r) for r in bad.collect()] == [("g", "v is 1", "FAIL", 1)]
    with pytest.raises(checks.CheckFailed, match="v is 1"):
        checks.gate(bad)
    good = checks.rows_hold(df.filter("v = 1"), "g", {"v is 1": F.col("v") == 1})
    assert checks.gate(good) is good and "1 of 1 checks passed" in checks.summary_text(good)


def test_each_check_can_fail(frame, spark):
    df = frame("d string, year int, v double", ("a", 2000, 1.0), ("a", 2000, 2.0), ("b", 2001, None))
    one = frame("d string, v double", ("a", 5.0))
    failing = checks.report(
        checks.unique_key(df, "g", "unique", ["d", "year"]),
        checks.balanced(df, "g", "balanced", "d", 2000, 2001),
        checks.rows_hold(df, "g", checks.known_keys(["v"])),
        checks.totals_match(df, one, "g", ["v"]),
        checks.counts_match(df, one, "g", ["v"]),
        checks.key_set_equals(df, one, "g", "sets", ["d"]),
        checks.subset_of(df, one, "g", "subset", ["d"]),
        checks.constant_per(df, "g", "constant", ["d"], "v"),
        checks.varies_somewhere(one, "g", "varies", ["d"], "v"),
        checks.shares_sum_to_one(df, "g", "shares", ["d"], "v"),
        checks.expected_values(df.filter("d = 'b'"), one, "g", "expected", ["d"], "v"),
        checks.landed(one, df.filter("d = 'b'"), "g", "landed", ["d"], "v"),
        checks.types_match(df, "g", {"v": "bigint"}),
        checks.documented(df, "g", "documented", spark.createDataFrame([("d",)], "column string")),
    )
    assert {r["status"] for r in failing.collect()} == {"FAIL"}


def test_clustered_ols_against_dummies(spark):
    rng = np.random.default_rng(3)
    n = 800
    year, g = rng.integers(0, 5, n), rng.integers(0, 12, n)
    x = np.column_stack([250000 + 50 * rng.normal(size=n), rng.normal(size=n), rng.random(n)])
    y = 0.002 * x[:, 0] - x[:, 1] + year + 0.5 * g * rng.random(n)
    df = spark.createDataFrame([(float(a), *map(float, b), int(t), int(c)) for a, b, t, c in zip(y, x, year, g)], "y double, x1 double, x2 double, x3 double, t int, g int")
    df = df.union(spark.createDataFrame([(None, 1.0, 1.0, 1.0, 1, 1)], df.schema))
    got = {r["term"]: r for r in stats.clustered_ols(df, "y", ["x1", "x2", "x3"], "t", "g").collect()}
    dummies = (year[:, None] == np.arange(5)).astype(float)
    design = np.column_stack([x - x.mean(0), dummies])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    u = y - design @ beta
    bread = np.linalg.inv(design.T @ design)
    scores = np.array([design[g == c].T @ u[g == c] for c in range(12)])
    v = bread @ (scores.T @ scores) @ bread * 12 / 11 * (n - 1) / (n - 8)
    for i, term in enumerate(["x1", "x2", "x3"]):
        assert got[term]["coef"] == pytest.approx(beta[i], rel=1e-6)
        assert got[term]["std_err"] == pytest.approx(math.sqrt(v[i, i]), rel=1e-6)
        assert got[term]["n"] == n and got[term]["clusters"] == 12


def test_profile_kinds(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("many"), (F.col("id") % 3).alias("few"), F.lit(None).cast("string").alias("none"))
    got = {r["column"]: r for r in stats.profile(df, df.columns).collect()}
    assert got["many"]["kind"] == "numeric" and got["many"]["median"] == 49.5 and got["many"]["n_distinct"] == 100
    assert got["few"]["kind"] == "categorical" and got["few"]["min"] is None
    assert got["none"]["n_distinct"] == 0 and got["none"]["pct"] == 0.0
    words = spark.createDataFrame([("many", "Number of things")], "column string, definition string")
    table = stats.dictionary(stats.profile(df, df.columns), words, {"Main": ["m", "f"]}, "THING")
    assert [(r["column"], r["layer"]) for r in table.collect()] == [("many", "Main")]


def test_correlation_is_pairwise_complete(frame):
    df = frame("a double, b double, c double", (1.0, 2.0, 1.0), (2.0, 4.0, None), (3.0, 6.0, 5.0), (4.0, None, 2.0))
    got = {(r["x"], r["y"]): r["r"] for r in stats.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(1.0) and got["a", "c"] == pytest.approx(np.corrcoef([1, 3, 4], [1, 5, 2])[0, 1])


def test_correlations_of_many_columns(spark):
    """175 columns with gaps, in one block and in several, against numpy on the common rows."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(120, 175)) @ rng.normal(size=(175, 175)) + 1e6
    x[rng.random(x.shape) < 0.1] = None
    x[:, 3] = 7.1
    x[:, 4] = None
    names = [f"c{k}" for k in range(175)]
    rows = [[None if np.isnan(v) else float(v) for v in row] for row in x]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(3)
    for block in (512, 60):
        got = {(r["x"], r["y"]): r["r"] for r in stats.correlation_matrix(df, names, block).collect()}
        assert len(got) == 175 * 175
        for i in (0, 1, 3, 4, 59, 60, 119, 174):
            for j in range(175):
                both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
                if {i, j} & {3, 4}:
                    assert got[names[i], names[j]] is None
                else:
                    assert got[names[i], names[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_correlations_of_odd_values(frame):
    nan = float("nan")
    df = frame("a double, b double, c double", (1.0, 2.0, None), (2.0, 1.0, nan), (3.0, 5.0, None), (None, nan, 4.0))
    got = {(r["x"], r["y"]): r["r"] for r in stats.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 1, 5])[0, 1]) and math.isnan(got["a", "c"]) and math.isnan(got["b", "b"])
    assert {r["r"] for r in stats.correlation_matrix(df.limit(0), ["a", "b"]).collect()} <= {None}


def test_collinear_regressors_are_named(frame):
    df = frame("y double, x double, z double, e int, g int", *[(float(k % 5), float(k), 2.0 * k, k % 3, k % 4) for k in range(30)])
    with pytest.raises(ValueError, match="collinear"):
        stats.clustered_ols(df, "y", ["x", "z"], "e", "g")
