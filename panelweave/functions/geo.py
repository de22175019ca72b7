"""Coordinate and ring expressions, all native."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: WGS84 ellipsoid, standard parallel 30 degrees (EPSG:6933)
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
PARALLEL = 30.0

ECC2 = FLATTENING * (2 - FLATTENING)
ECC = math.sqrt(ECC2)
K0 = math.cos(math.radians(PARALLEL)) / math.sqrt(1 - ECC2 * math.sin(math.radians(PARALLEL)) ** 2)


def wrap_longitude(lon: Column) -> Column:
    """0..360 to -180..180."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def equal_area_x(lon: Column) -> Column:
    """Metres east on the cylindrical equal-area grid."""
    return F.radians(lon) * F.lit(SEMI_MAJOR * K0)


def equal_area_y(lat: Column) -> Column:
    """Metres north on the cylindrical equal-area grid."""
    s = F.sin(F.radians(lat))
    q = F.lit(1 - ECC2) * (
        s / (1 - F.lit(ECC2) * s * s) - F.ln((1 - F.lit(ECC) * s) / (1 + F.lit(ECC) * s)) / F.lit(2 * ECC)
    )
    return q * F.lit(SEMI_MAJOR / (2 * K0))


def in_box(x: Column, y: Column, west: float, south: float, east: float, north: float) -> Column:
    return x.between(west, east) & y.between(south, north)


def flat_point(point: Column) -> Column:
    """Drop height from a point struct."""
    return F.struct(point["x"].alias("x"), point["y"].alias("y"))


def ring_area(ring: str) -> Column:
    """Signed shoelace area of a closed ring column, positive counter-clockwise."""
    return F.expr(_ring_area(ring))


def _ring_area(ring: str) -> str:
    cross = (
        f"({ring}[i - 1].x - {ring}[0].x) * ({ring}[i].y - {ring}[0].y)"
        f" - ({ring}[i].x - {ring}[0].x) * ({ring}[i - 1].y - {ring}[0].y)"
    )
    return f"if(size({ring}) < 3, 0D, aggregate(sequence(1, greatest(size({ring}) - 1, 1)), 0D, (total, i) -> total + ({cross}) / 2))"


def oriented_edges(ring: str, is_hole: str) -> Column:
    """Directed edges of a closed ring: outer rings counter-clockwise, holes clockwise."""
    turned = f"if(({_ring_area(ring)} > 0) = {is_hole}, reverse({ring}), {ring})"
    step = "named_struct('x1', p.x, 'y1', p.y, 'x2', r[i + 1].x, 'y2', r[i + 1].y)"
    # a one-element array gives the turned ring a name inside the lambda
    return F.expr(f"flatten(transform(array({turned}), r -> transform(slice(r, 1, size(r) - 1), (p, i) -> {step})))")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once a row, not again wherever, and for each array element that, it is named."""
    return F.transform(F.array(value), use)[0]


def inside_point(edges: Column) -> Column:
    """A point inside a polygon: the middle of the widest stretch on a line half-way up its box."""

    def between(tall: Column) -> Column:
        # half-way between two neighbouring vertex heights, so the line meets no vertex
        half = (F.get(tall, F.lit(0)) + F.get(tall, F.size(tall) - 1)) / 2
        at = _let(half, lambda h: F.least(F.size(F.filter(tall, lambda y: y <= h)) - 1, F.size(tall) - 2))
        return _let(at, lambda i: (F.get(tall, i) + F.get(tall, i + 1)) / 2)

    def widest(xs: Column, y: Column) -> Column:
        stretches = F.transform(F.sequence(F.lit(0), F.size(xs) - 2, F.lit(2)), lambda i: F.struct((xs[i + 1] - xs[i]).alias("wide"), ((xs[i + 1] + xs[i]) / 2).alias("x")))
        return F.struct(F.when(F.size(xs) > 1, F.array_max(stretches)["x"]).alias("x"), y.alias("y"))

    def crossed(y: Column) -> Column:
        crossing = F.filter(edges, lambda e: (e["y1"] > y) != (e["y2"] > y))
        xs = F.transform(crossing, lambda e: e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"]))
        return _let(F.array_sort(xs), lambda xs: widest(xs, y))

    heights = F.array_sort(F.array_distinct(F.flatten(F.transform(edges, lambda e: F.array(e["y1"], e["y2"])))))
    return _let(heights, lambda tall: _let(between(tall), crossed))


def project_edges(edges: Column) -> Column:
    """Edges in degrees to edges in equal-area metres."""
    return F.transform(
        edges,
        lambda e: F.struct(
            equal_area_x(e["x1"]).alias("x1"),
            equal_area_y(e["y1"]).alias("y1"),
            equal_area_x(e["x2"]).alias("x2"),
            equal_area_y(e["y2"]).alias("y2"),
        ),
    )


def edges_area(edges: Column) -> Column:
    """Area of a polygon from its oriented edges, holes subtracted."""
    base = edges[0]["y1"]
    return F.aggregate(
        edges, F.lit(0.0), lambda a, e: a + (e["x1"] - e["x2"]) * ((e["y1"] - base) + (e["y2"] - base)) / 2
    )
