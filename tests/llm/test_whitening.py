"""Whitening against exact sums over rationals, and on awkward tables."""

import math
from fractions import Fraction

import numpy as np
import pytest

from panelweave.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, deviation string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in enumerate(vectors)], SCHEMA)


def brute(vectors, components=8):
    """The contract in whole numbers and numpy's own covariance of doubles."""
    x = [[math.floor(1024 * Fraction(float(c))) + 100000 for c in np.float32(v)] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(row[k] for row in x) for k in range(d)]
    u = [[n * row[k] - s[k] for k in range(d)] for row in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in u), n**3)) for j in range(d)] for i in range(d)])
    e, axes = np.linalg.eigh(v)
    order = np.argsort(-e)[:components]
    z = np.array(u, "f8") / n @ axes[:, order] / np.sqrt(e[order])
    return n, [sum(a * a for a in r) for r in u], z, e[order] / np.trace(v)


def check(spark, vectors, components=8):
    n, deviation, z, share = brute(vectors, components)
    got = {(r.vec_id, r.component): r for r in whitening.digest(table(spark, vectors)).collect()}
    assert len(got) == n * z.shape[1]
    signs = [1 if got[0, k + 1].whitened * z[0, k] > 0 else -1 for k in range(z.shape[1])]
    for (i, k), r in got.items():
        assert r.n == n and r.deviation == deviation[i]
        assert r.whitened * signs[k - 1] == pytest.approx(z[i, k - 1], rel=1e-7, abs=1e-8)
        assert r.explained == pytest.approx(share[k - 1], rel=1e-9) and r.identity_error < 1e-9


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    check(spark, (rng.normal(size=(60, 11)) @ rng.normal(size=(11, 11))).tolist())


def test_fewer_dimensions_than_components(spark):
    rng = np.random.default_rng(4)
    check(spark, rng.normal(size=(40, 3)).tolist(), 3)


def test_wide_values_stay_exact():
    rng = np.random.default_rng(5)
    for top in (1 << 20, 1 << 45, 1 << 62):
        w = rng.integers(-top, top, (70, 4))
        assert whitening.square_sums(w).tolist() == [sum(int(a) ** 2 for a in w[:, k]) for k in range(4)]
    wide = np.array([[3 << 90, -5], [7, 1 << 80]], object)
    assert whitening.square_sums(wide).tolist() == [(3 << 90) ** 2 + 49, 25 + (1 << 160)]
    assert whitening.centred(np.array([[5], [8]]), 2, [13]).tolist() == [[-3], [3]]


def test_huge_entries_give_no_deviation(spark):
    vectors = [[1e30, 1.0], [-1e30, 2.0], [5.0, 3.0]]
    rows = whitening.digest(table(spark, vectors)).collect()
    assert len(rows) == 6 and all(r.deviation is None for r in rows if r.vec_id < 2)


def test_rows_that_take_no_part(spark):
    good = np.random.default_rng(6).normal(size=(30, 4)).tolist()
    bad = [None, [], [1.0, None, 2.0, 3.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = whitening.digest(table(spark, good + bad)).collect()
    assert {r.vec_id for r in rows} == set(range(30)) and {r.n for r in rows} == {30}


def test_repeated_rows_null_ids_and_empty(spark):
    same = spark.createDataFrame([(None, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0])], "vec_id long, embedding array<double>")
    rows = whitening.digest(same).collect()
    assert len(rows) == 6 and {r.deviation for r in rows} == {0} and {r.whitened for r in rows} == {None} and {r.identity_error for r in rows} == {0.0}
    assert whitening.digest(same.limit(0)).collect() == []
