"""Ring quality against brute force over all pairs of sides, and nesting by sampling."""

import math
import random

import pytest
from pyspark.sql import functions as F

from panelweave.operators import rings as quality
from panelweave.operators import spatial

SCHEMA = "id string, ring array<struct<x double, y double>>"


def square(x0, y0, x1, y1):
    return [(float(x), float(y)) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]


def star(seed, n, cx=0.0, cy=0.0, low=0.4, high=1.3):
    rng = random.Random(seed)
    turns = [2 * math.pi * (i + rng.uniform(0, 0.9)) / n for i in range(n)]
    points = [(cx + r * math.cos(t), cy + r * math.sin(t)) for t in turns for r in [rng.uniform(low, high)]]
    return points + points[:1]


def brute(ring):
    pts = [p for i, p in enumerate(ring) if i == 0 or p != ring[i - 1]]
    sides, n, found = list(zip(pts, pts[1:])), len(pts) - 1, 0
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    sign = lambda v: (v > 0) - (v < 0)
    for i in range(n):
        for j in range(i + 1, n):
            (a, b), (c, d) = sides[i], sides[j]
            s1, s2, t1, t2 = turn(a, b, c), turn(a, b, d), turn(c, d, a), turn(c, d, b)
            boxes = all(max(min(a[k], b[k]), min(c[k], d[k])) <= min(max(a[k], b[k]), max(c[k], d[k])) for k in (0, 1))
            if not boxes or sign(s1) * sign(s2) > 0 or sign(t1) * sign(t2) > 0:
                continue
            if j == i + 1 or (i == 0 and j == n - 1):
                ahead = (b[0] - a[0]) * (d[0] - c[0]) + (b[1] - a[1]) * (d[1] - c[1])
                found += s1 == 0 and s2 == 0 and (ahead < 0 or n == 2)
            else:
                found += 1
    return found


def count(frame, **named):
    df = frame(SCHEMA, *named.items())
    return {r["id"]: r for r in quality.crossings(df, ["id"]).collect()}


def test_known_shapes(frame):
    got = count(
        frame,
        eight=[(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)], square=square(0, 0, 2, 2), doubled=[p for p in square(0, 0, 3, 1) for _ in range(2)],
        spike=[(0.0, 0.0), (4.0, 0.0), (2.0, 0.0), (2.0, 3.0), (0.0, 0.0)], touch=[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 0.0), (0.0, 4.0), (0.0, 0.0)],
        pinch=[(0.0, 0.0), (2.0, 2.0), (4.0, 0.0), (4.0, 4.0), (2.0, 2.0), (0.0, 4.0), (0.0, 0.0)],
    )
    assert set(got) == {"eight", "spike", "touch", "pinch"}
    assert (got["eight"]["crossings"], got["eight"]["x"], got["eight"]["y"]) == (1, 0.5, 0.5)
    assert (got["pinch"]["crossings"], got["pinch"]["x"], got["pinch"]["y"]) == (4, 2.0, 2.0)
    assert (got["touch"]["x"], got["touch"]["y"]) == (2.0, 0.0)


def test_random_rings_match_all_pairs(frame):
    rng = random.Random(7)
    named = {f"clean{k}": star(k, 40 + 30 * k) for k in range(4)}
    for k in range(12):
        named[f"wild{k}"] = [(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(4 + 5 * k)]
        named[f"lattice{k}"] = [(float(rng.randrange(6)), float(rng.randrange(6))) for _ in range(12)]
    named = {k: v if v[0] == v[-1] else v + v[:1] for k, v in named.items()}
    assert {k: r["crossings"] for k, r in count(frame, **named).items()} == {k: n for k, v in named.items() if (n := brute(v))}


def test_a_crowded_corner_is_cut_finer(frame):
    """Hundreds of sides in one cell of a huge ring, one knot among them."""
    small = [(1e-4 * x, 1e-4 * y) for x, y in star(3, 500)][:-1]
    knot = list(small)
    knot[200], knot[201] = knot[201], knot[200]
    far = [(900.0, -500.0), (900.0, 500.0)]
    named = {"clean": small + far + small[:1], "knot": knot + far + knot[:1]}
    assert {k: r["crossings"] for k, r in count(frame, **named).items()} == {k: n for k, v in named.items() if (n := brute(v))}


def test_faults_name_the_first_reason(frame):
    eight = [(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (0.0, 3.0), (0.0, 0.0)]
    df = frame(SCHEMA, ("a", square(0, 0, 1, 1)), ("b", eight), ("c", square(0, 0, 1, 1)[:3]), ("d", None), ("e", square(0, 0, 1, 1)[:4]))
    assert {r["id"]: r["fault"] for r in quality.faults(df, ["id"]).collect()} == {"b": "self-crossing", "c": "too few points", "d": "empty", "e": "not closed"}
    assert quality.faults(df.limit(0), ["id"]).collect() == []


@pytest.mark.parametrize("size", [0.7, 3.0, 50.0])
def test_nesting_of_squares(frame, size):
    """Boxes in boxes, two islands in one hole, a ring that touches its parent, and another polygon around it all."""
    shapes = {0: square(0, 0, 20, 20), 1: square(1, 1, 19, 19), 2: square(2, 2, 8, 8), 3: square(10, 2, 18, 18), 4: square(3, 3, 7, 7), 5: square(30, 0, 34, 4), 6: square(30, 1, 32, 3)}
    shapes[7] = star(5, 60, 5.0, 5.0, 0.5, 1.4)
    df = frame("id int, k int, ring array<struct<x double, y double>>", *[(1, k, r) for k, r in shapes.items()], (2, 0, square(-5, -5, 50, 50)))
    got = {(r["id"], r["k"]): (r["depth"], r["parent"], r["is_hole"], r["part"]) for r in quality.parts(df, "id", "k", size).collect()}
    assert got == {
        (1, 0): (0, None, False, 0), (1, 1): (1, 0, True, 0), (1, 2): (2, 1, False, 2), (1, 3): (2, 1, False, 3), (1, 4): (3, 2, True, 2),
        (1, 5): (0, None, False, 5), (1, 6): (1, 5, True, 5), (1, 7): (4, 4, False, 7), (2, 0): (0, None, False, 0),
    }


def test_a_long_boundary_over_many_rows(spark, frame):
    """A polygon of 100,000 edges over 500 grid rows: no exchange carries its edge array, and points fall where they should."""
    n = 100_000
    ring = [(250 + 240 * math.cos(2 * math.pi * k / n) * (1 + 0.01 * (k % 2)), 250 + 240 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    edges = [(*a, *b) for a, b in zip(ring, ring[1:] + ring[:1])]
    schema = "id string, edges array<struct<x1 double, y1 double, x2 double, y2 double>>"
    geom = spatial.boxed(spark.createDataFrame([("big", edges)], schema))
    points = spark.range(4000).select(
        F.col("id").alias("p"), (F.col("id") * 37 % 499 + 0.3).cast("double").alias("x"), (F.col("id") * 91 % 487 + 0.7).cast("double").alias("y")
    )
    got = {r["p"]: r["id"] for r in spatial.points_to_polygons(points, geom, "id", "x", "y", 1.0).collect()}
    for p in range(4000):
        away = math.hypot(p * 37 % 499 + 0.3 - 250, p * 91 % 487 + 0.7 - 250)
        if away < 236 or away > 246:
            assert got[p] == ("big" if away < 236 else None)
    plan = spatial.trapezoids(geom, "id", 1.0)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert all("edges" not in line for line in moved)
