"""Geometry against analytic cases, dense sampling and brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.functions import geo
from panelweave.operators import spatial
from panelweave.plans import spatial_layers

RINGS = "id string, is_hole boolean, ring array<struct<x double, y double>>"


def square(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def floats(ring):
    return [(float(x), float(y)) for x, y in ring]


def star(rng, cx, cy, n=11, low=0.4, high=1.3):
    """A random simple, non-convex ring."""
    turns = [2 * math.pi * (i + rng.uniform(0, 0.9)) / n for i in range(n)]
    radii = [rng.uniform(low, high) for _ in turns]
    pts = [(cx + r * math.cos(t), cy + r * math.sin(t)) for r, t in zip(radii, turns)]
    return pts + [pts[0]]


def even_odd(rings, x, y):
    inside = np.zeros_like(x, dtype=bool)
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if y1 == y2:
                continue
            hit = ((y1 > y) != (y2 > y)) & (x < x1 + (x2 - x1) * (y - y1) / (y2 - y1))
            inside ^= hit
    return inside


def geometry(frame, polygons):
    rows = [(i, hole, floats(ring)) for i, rings in polygons.items() for hole, ring in rings]
    return spatial.polygons(frame(RINGS, *rows), ["id"])


def test_points_two_shapes(frame, rows):
    geom = geometry(frame, {"1": [(False, square(0, 0, 4, 4))], "2": [(False, [(4, 0), (8, 0), (4, 4), (4, 0)])]})
    pts = frame("p int, x double, y double", (1, 1.0, 1.0), (2, 5.0, 1.0), (3, 9.0, 9.0), (4, 4.0, 1.0), (5, 7.0, 3.0))
    for size in (0.7, 1.0, 50.0):
        got = {r["p"]: r["id"] for r in spatial.points_to_polygons(pts, geom, "id", "x", "y", size).collect()}
        assert got == {1: "1", 2: "2", 3: None, 4: "2", 5: None}


def test_overlapping_polygons_give_the_lowest_once(frame):
    geom = geometry(frame, {"b": [(False, square(0, 0, 2, 2))], "a": [(False, square(1, 1, 3, 3))]})
    pts = frame("p int, x double, y double", (1, 1.5, 1.5), (2, 0.5, 0.5))
    got = [(r["p"], r["id"]) for r in spatial.points_to_polygons(pts, geom, "id", "x", "y", 1.0, "inner").orderBy("p").collect()]
    assert got == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("size,max_rows", [(0.3, 10**6), (0.5, 10**6), (1.0, 10**6), (5.0, 10**6), (100.0, 10**6), (1.0, 1), (100.0, 1)])
def test_points_match_brute_force(spark, frame, size, max_rows):
    rng = random.Random(4)
    shapes = {f"s{i:02d}": [(False, star(rng, rng.uniform(0, 6), rng.uniform(0, 6)))] for i in range(12)}
    shapes["hole"] = [(False, square(-3, -3, -1, -1)), (True, square(-2.5, -2.5, -1.5, -1.5)), (False, square(-2.2, -2.2, -1.8, -1.8))]
    pts = np.random.default_rng(1).uniform(-4, 8, (4000, 2))
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "p int, x double, y double")
    out = spatial.points_to_polygons(df, geometry(frame, shapes), "id", "x", "y", size, max_rows=max_rows)
    got = {r["p"]: r["id"] for r in out.collect()}
    assert len(got) == 4000 and out.count() == 4000
    masks = {i: even_odd([r for _, r in rings], pts[:, 0], pts[:, 1]) for i, rings in shapes.items()}
    for k in range(4000):
        hits = [i for i in shapes if masks[i][k]]
        assert got[k] == (min(hits) if hits else None)


def test_coverage_weights_of_a_shifted_square(frame):
    geom = geometry(frame, {"a": [(False, square(0.5, 0.5, 1.5, 1.5))]})
    got = {(r["cx"], r["cy"]): r["w"] for r in spatial.coverage_weights(geom, "id", 1.0).collect()}
    assert got == {(i, j): pytest.approx(0.25) for i in (0, 1) for j in (0, 1)}


def test_tiny_polygons_keep_their_cells(frame):
    tiny = {"thin": [(False, square(3, 2, 3.00001, 3))], "dot": [(False, square(100, 50, 100 + 1e-7, 50 + 1e-7))]}
    geom = geometry(frame, tiny)
    got = {(r["id"], r["cx"], r["cy"]): r["w"] for r in spatial.coverage_weights(geom, "id", 1.0).collect()}
    assert got == {("thin", 3, 2): pytest.approx(1e-5), ("dot", 100, 50): pytest.approx(1e-14, rel=1e-6)}
    other = geometry(frame, {"big": [(False, square(0, 0, 200, 200))]}).withColumnRenamed("id", "other")
    area = {r["id"]: r["area"] for r in spatial.overlay_area(geom, other, "id", "other", 1.0).collect()}
    assert area == {"thin": pytest.approx(1e-5), "dot": pytest.approx(1e-14, rel=1e-6)}


def test_one_large_polygon_against_many_small(frame):
    """Each pair meets only the large polygon's pieces in its own columns."""
    rng = random.Random(2)
    large = star(rng, 50, 50, 4000, 20, 49)
    small = {f"s{k}": [(False, square(x, y, x + 1, y + 1))] for k, (x, y) in enumerate((rng.uniform(0, 99), rng.uniform(0, 99)) for _ in range(200))}
    left, right = geometry(frame, {"large": [(False, large)]}), geometry(frame, small).withColumnRenamed("id", "other")
    area = {r["other"]: r["area"] for r in spatial.overlay_area(left, right, "id", "other", 1.0).collect()}
    g = (np.arange(40) + 0.5) / 40
    for name, [(_, ring)] in list(small.items())[:40]:
        x, y = (a.ravel() for a in np.meshgrid(ring[0][0] + g, ring[0][1] + g))
        assert area.get(name, 0) == pytest.approx(even_odd([large], x, y).mean(), abs=0.05)


def test_zonal_mean_skips_nodata(frame):
    geom = geometry(frame, {"a": [(False, square(0.5, 0.5, 1.5, 1.5))], "b": [(False, square(5, 5, 6, 6))]})
    cells = frame("cx bigint, cy bigint, v double", (0, 0, 1.0), (1, 0, 2.0), (0, 1, 3.0), (1, 1, None), (5, 5, None))
    weights = spatial.coverage_weights(geom, "id", 1.0)
    got = {r["id"]: (r["mean"], r["count"]) for r in spatial.zonal_stats(cells, weights, "id", "v", (), geom).collect()}
    assert got == {"a": (pytest.approx(2.0), pytest.approx(0.75)), "b": (None, 0.0)}
    access = {r["id"]: r for r in spatial_layers.market_access(cells, weights, geom, "id", "v", 2015).collect()}
    assert access["a"]["travel_time_median"] == 2.0 and access["b"]["travel_time_mean"] is None
    assert access["a"]["travel_time_log1p"] == pytest.approx(math.log(3)) and access["b"]["travel_time_log1p"] is None


def test_coverage_weights_by_sampling(frame):
    rng = random.Random(9)
    shapes = {f"s{i}": [(False, star(rng, 2 + 0.3 * i, 1.7))] for i in range(5)}
    shapes["holed"] = [(False, square(0.2, 0.2, 3.9, 3.7)), (True, star(rng, 2.0, 2.0, 9, 0.3, 0.9))]
    weights = spatial.coverage_weights(geometry(frame, shapes), "id", 0.8).collect()
    got = {(r["id"], r["cx"], r["cy"]): r["w"] for r in weights}
    grid = (np.arange(300) + 0.5) / 300 * 0.8
    for ident, rings in shapes.items():
        for cx in range(-1, 7):
            for cy in range(-1, 7):
                x, y = np.meshgrid(cx * 0.8 + grid, cy * 0.8 + grid)
                share = even_odd([r for _, r in rings], x, y).mean()
                assert got.get((ident, cx, cy), 0.0) == pytest.approx(share, abs=0.01)


def test_tall_polygon_fills_gap_rows(frame):
    geom = geometry(frame, {"a": [(False, square(0.25, 0.5, 3.75, 9.5))]})
    got = {(r["cx"], r["cy"]): r["w"] for r in spatial.coverage_weights(geom, "id", 1.0).collect()}
    assert len(got) == 40 and sum(got.values()) == pytest.approx(3.5 * 9)
    assert got[(1, 4)] == pytest.approx(1.0) and got[(0, 4)] == pytest.approx(0.75) and got[(0, 0)] == pytest.approx(0.375)


def test_overlay_squares_and_holes(frame):
    a = geometry(frame, {"a": [(False, square(0, 0, 2, 2))], "h": [(False, square(0, 0, 3, 3)), (True, square(1, 1, 2, 2))]})
    b = geometry(frame, {"b": [(False, square(1, 1, 3, 3))]}).withColumnRenamed("id", "jd")
    for size in (0.4, 1.0, 10.0):
        got = {r["id"]: r["area"] for r in spatial.overlay_area(a, b, "id", "jd", size).collect()}
        assert got == {"a": pytest.approx(1.0), "h": pytest.approx(3.0)}


def test_overlay_by_sampling(frame):
    rng = random.Random(2)
    ours = {f"a{i}": [(False, star(rng, i, 1.0))] for i in range(4)}
    theirs = {f"b{i}": [(False, star(rng, i + 0.5, 1.2, 14))] for i in range(4)}
    theirs["ring"] = [(False, square(0, 0, 4, 3)), (True, square(1, 0.5, 2.5, 2.0))]
    out = spatial.overlay_area(geometry(frame, ours), geometry(frame, theirs).withColumnRenamed("id", "jd"), "id", "jd", 0.9)
    got = {(r["id"], r["jd"]): r["area"] for r in out.collect()}
    n = 900
    side = (np.arange(n) + 0.5) / n
    x, y = np.meshgrid(-2 + 8 * side, -2 + 6 * side)
    unit = 48 / n / n
    for i, r in ours.items():
        for j, s in theirs.items():
            want = (even_odd([q for _, q in r], x, y) & even_odd([q for _, q in s], x, y)).sum() * unit
            assert got.get((i, j), 0.0) == pytest.approx(want, abs=0.01)


def test_candidate_pairs_are_unique(frame):
    a = geometry(frame, {"a": [(False, square(0, 0, 9, 9))]})
    b = geometry(frame, {"b": [(False, square(1, 1, 8, 8))]}).withColumnRenamed("id", "jd")
    assert spatial.candidate_pairs(a, b, "id", "jd", 1.0).count() == 1


def test_equal_area_corner_and_total(spark):
    r = spark.range(1).select(geo.equal_area_x(F.lit(180.0)).alias("x"), geo.equal_area_y(F.lit(90.0)).alias("y")).first()
    assert r["x"] == pytest.approx(17367530.445, abs=1e-3) and r["y"] == pytest.approx(7342230.136, abs=1e-3)
    assert 4 * r["x"] * r["y"] == pytest.approx(5.1007e14, rel=1e-4)


def test_projected_area_of_a_degree_cell(frame):
    geom = spatial.projected(geometry(frame, {"a": [(False, square(10, 0, 11, 1))]}))
    area = geom.select(geo.edges_area(F.col("edges")).alias("a")).first()["a"]
    assert area == pytest.approx(1.2309e10, rel=1e-3)


def test_hole_area_is_subtracted(frame):
    geom = geometry(frame, {"a": [(False, square(0, 0, 3, 3)), (True, square(1, 1, 2, 2))]})
    assert geom.select(geo.edges_area(F.col("edges")).alias("a")).first()["a"] == pytest.approx(8.0)


def test_ring_faults(frame):
    df = frame(RINGS, ("ok", False, floats(square(0, 0, 1, 1))), ("open", False, floats(square(0, 0, 1, 1)[:4])), ("flat", False, floats([(0, 0), (1, 1), (2, 2), (0, 0)])), ("few", False, floats([(0, 0), (1, 1)])), ("none", False, []), ("nan", False, floats([(0, 0), (1, 0), (float("nan"), 1), (0, 0)])), ("small", False, floats(square(5, 5, 5 + 1e-9, 5 + 1e-9))))
    got = {r["id"]: r["fault"] for r in spatial.ring_faults(df).collect()}
    assert got == {"open": "not closed", "flat": "zero area", "few": "too few points", "none": "empty", "nan": "unknown coordinate"}


def test_coverage_weights_keep_their_bits_far_out(frame):
    """A box's weights are its sides' products, rounded once: ties between sums of weights hold at any distance."""
    boxes = {f"s{k}": (k % 32 + 0.15, k // 32 + 0.1, k % 32 + 0.9, k // 32 + 0.85) for k in range(59000, 59200)}
    geom = geometry(frame, {n: [(False, square(*b))] for n, b in boxes.items()})
    for r in spatial.coverage_weights(geom, "id", 0.4).collect():
        x0, y0, x1, y1 = boxes[r["id"]]
        wide, tall = min(x1, (r["cx"] + 1) * 0.4) - max(x0, r["cx"] * 0.4), min(y1, (r["cy"] + 1) * 0.4) - max(y0, r["cy"] * 0.4)
        assert r["w"] == wide * tall / (0.4 * 0.4), r


def test_mosaic_first_tile_with_data(frame):
    tiles = frame("cx int, cy int, t int, v double", (0, 0, 1, None), (0, 0, 2, 5.0), (1, 0, 1, 0.0), (1, 0, 2, 9.0), (2, 0, 1, None))
    got = {r["cx"]: r["v"] for r in spatial.mosaic(tiles, "v", "t").collect()}
    assert got == {0: 5.0, 1: 0.0, 2: None}


def test_longitude_wraps(spark):
    got = [r[0] for r in spark.createDataFrame([(0.0,), (180.0,), (190.0,), (359.0,)], "l double").select(geo.wrap_longitude(F.col("l"))).collect()]
    assert got == [0.0, -180.0, -170.0, -1.0]


def test_located_events_plan_has_no_nested_loop(frame):
    geom = geometry(frame, {"a": [(False, square(0, 0, 1, 1))]})
    pts = frame("p int, x double, y double", (1, 0.5, 0.5))
    plan = spatial.points_to_polygons(pts, geom, "id", "x", "y", 1.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_points_inside_random_shapes(frame):
    rng = random.Random(9)
    shapes = {f"s{k}": [(False, star(rng, 5 * k, 3 * k))] for k in range(20)} | {"holed": [(False, square(0, 0, 10, 10)), (True, square(1, 1, 9, 9)[::-1])]}
    for r in geometry(frame, shapes).select("id", geo.inside_point(F.col("edges")).alias("p")).collect():
        rings = [ring for _, ring in shapes[r["id"]]]
        assert even_odd(rings, np.array([r["p"]["x"]]), np.array([r["p"]["y"]]))[0], r["id"]


def test_inside_point_works_out_each_step_once(frame):
    """Heights and crossings are sorted once a polygon, not once for every edge and stretch that looks at them."""
    ring = star(random.Random(5), 3, 2, 600)
    found = geometry(frame, {"a": [(False, ring)]}).select(geo.inside_point(F.col("edges")).alias("p"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("array_sort(") == 2
    p = found.first()["p"]
    assert even_odd([ring], np.array([p["x"]]), np.array([p["y"]]))[0]


def test_intersecting_counts_touch(frame):
    left = geometry(frame, {"a": [(False, square(0, 0, 1, 1))], "b": [(False, square(3, 3, 4, 4))]})
    others = {"side": (1, 0, 2, 1), "corner": (1, 1, 2, 2), "inside": (0.2, 0.2, 0.4, 0.4), "around": (-1, -1, 2, 2), "apart": (1.001, 0, 2, 1), "same": (0, 0, 1, 1)}
    right = geometry(frame, {n: [(False, square(*s))] for n, s in others.items()}).withColumnRenamed("id", "other")
    got = sorted((r["id"], r["other"]) for r in spatial.intersecting(left, right, "id", "other", 0.7).collect())
    assert got == [("a", n) for n in ("around", "corner", "inside", "same", "side")]


def test_one_index_serves_several_overlays(frame):
    spine = geometry(frame, {"a": [(False, square(0, 0, 4, 4))], "b": [(False, square(4, 0, 8, 4))]})
    index = spatial.overlay_index(spine, "id", 1.0)
    for x in (1, 3, 6):
        layer = geometry(frame, {"l": [(False, square(x, 1, x + 2, 3))]}).withColumnRenamed("id", "other")
        direct = {r["id"]: r["area"] for r in spatial.overlay_area(spine, layer, "id", "other", 1.0).collect()}
        assert {r["id"]: r["area"] for r in spatial.overlay_area(index, layer, "id", "other", 1.0).collect()} == direct
    with pytest.raises(ValueError, match="grid"):
        spatial.overlay_area(index, layer, "id", "other", 2.0)
