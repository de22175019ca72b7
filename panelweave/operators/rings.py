"""Quality of polygon rings: crossings of a ring with itself, and how rings nest.

Ring tables have key columns, ``ring`` (``ARRAY<STRUCT<x, y>>``, closed) and, once
known, ``is_hole``. A polygon's rings are numbered by ``number``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.functions import geo
from panelweave.operators import spatial
from panelweave.session import stage

CROWD = 64  # segments of a ring that one cell may hold before it is cut anew
FINER, LEVELS = 8, 6  # cells a crowded side is cut into, and how often


def segments(rings: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, n, at, x1, y1, x2, y2): the sides of each ring in order; points repeated in a row count once."""
    moved = F.expr("filter(ring, (p, i) -> i = 0 or p.x <> ring[i - 1].x or p.y <> ring[i - 1].y)")
    kept = rings.select(*key, moved.alias("_p")).filter(F.size("_p") > 1)
    sides = F.expr("transform(slice(_p, 1, size(_p) - 1), (p, i) -> named_struct('x1', p.x, 'y1', p.y, 'x2', _p[i + 1].x, 'y2', _p[i + 1].y))")
    return kept.select(*key, (F.size("_p") - 1).alias("n"), F.posexplode(sides).alias("at", "s")).select(*key, "n", "at", "s.*")


def _cells(sides: DataFrame, key: Sequence[str], count: Column) -> DataFrame:
    """Deal sides to the cells they touch, of ``count`` by ``count`` cells of side ``size`` from (``x0``, ``y0``) on."""

    def through(df: DataFrame, low: Column, high: Column, start: str, into: str) -> DataFrame:
        index = lambda v: F.floor((v - F.col(start)) / F.col("size")).cast("bigint")
        ends = df.withColumns({"_first": F.greatest(index(low), F.lit(0)), "_last": F.least(index(high), count.cast("bigint") - 1)})
        return ends.filter("_first <= _last").withColumn(into, F.explode(F.sequence("_first", "_last")))

    pad = F.col("size") * 1e-9
    wide = through(sides, F.least("x1", "x2") - pad, F.greatest("x1", "x2") + pad, "x0", "_cx")
    slope = F.try_divide(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1"))
    at = lambda x: F.when(slope.isNotNull(), F.col("y1") + slope * (x - F.col("x1")))
    west = F.greatest(F.col("x0") + F.col("_cx") * F.col("size"), F.least("x1", "x2"))
    east = F.least(F.col("x0") + (F.col("_cx") + 1) * F.col("size"), F.greatest("x1", "x2"))
    ya, yb = F.coalesce(at(west), F.col("y1")), F.coalesce(at(east), F.col("y2"))
    slack = pad + F.greatest(F.abs(ya), F.abs(yb)) * 1e-14
    tall = through(wide, F.least(ya, yb) - slack, F.greatest(ya, yb) + slack, "y0", "_cy")
    return tall.select(*key, "n", "at", "x1", "y1", "x2", "y2", "x0", "y0", "size", "_cx", "_cy")


def _turn(p: str, x: Column, y: Column) -> Column:
    """On which side of side ``p`` a point lies; the same number whichever end comes first."""
    return (F.col(f"x2{p}") - F.col(f"x1{p}")) * (y - F.col(f"y1{p}")) - (F.col(f"y2{p}") - F.col(f"y1{p}")) * (x - F.col(f"x1{p}"))


def crossings(rings: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, crossings, x, y): rings that meet themselves, how many pairs of sides do, and the lowest, then most western meeting point.

    Sides that follow each other meet at their common point and count only
    where the second turns back over the first. Sides are dealt to cells
    measured by the ring, about one side a cell; crowded cells are cut finer.
    Pairs meet inside a cell, and one that meets in several counts once.
    """
    key = list(key)
    sides = segments(rings, key)
    low, high = lambda c: F.min(F.least(f"{c}1", f"{c}2")), lambda c: F.max(F.greatest(f"{c}1", f"{c}2"))
    box = sides.groupBy(*key).agg(
        low("x").alias("x0"), low("y").alias("y0"), F.greatest(high("x") - low("x"), high("y") - low("y")).alias("_side"),
    )
    across = F.ceil(F.sqrt(F.col("n"))) + 1  # one more than the box needs, so that its far sides lie inside
    sized = sides.join(box, key).withColumn("size", F.col("_side") / (across - 1)).filter("_side > 0").drop("_side")
    dealt, done = stage(_cells(sized, key, across)), []
    place = [*key, "size", "x0", "y0", "_cx", "_cy"]
    for level in range(LEVELS + 1):
        counts = dealt.groupBy(*place).agg(F.count(F.lit(1)).alias("_held")).filter("_held > 1")
        crowded = stage(counts.filter(F.col("_held") > (CROWD if level < LEVELS else 1 << 62)).select(*place))
        done.append(dealt.join(counts.filter(F.col("_held") <= (CROWD if level < LEVELS else 1 << 62)).select(*place), place))
        if not crowded.limit(1).count():
            break
        # a crowded cell is a small box of its own: only what lies in it goes on
        inner = dealt.join(crowded, place).withColumns({
            "x0": F.col("x0") + F.col("_cx") * F.col("size"), "y0": F.col("y0") + F.col("_cy") * F.col("size"), "size": F.col("size") / FINER,
        }).drop("_cx", "_cy")
        dealt = stage(_cells(inner, key, F.lit(FINER)))
    met = done[0]
    for more in done[1:]:
        met = met.unionByName(more)
    half = lambda p: met.select(*place, F.col("n"), *[F.col(c).alias(c + p) for c in ("at", "x1", "y1", "x2", "y2")])
    pairs = half("a").join(half("b").drop("n"), place).filter("ata < atb")
    s1, s2 = _turn("a", F.col("x1b"), F.col("y1b")), _turn("a", F.col("x2b"), F.col("y2b"))
    t1, t2 = _turn("b", F.col("x1a"), F.col("y1a")), _turn("b", F.col("x2a"), F.col("y2a"))
    boxes = F.lit(True)
    for c in "xy":
        start = F.greatest(F.least(c + "1a", c + "2a"), F.least(c + "1b", c + "2b"))
        boxes = boxes & (start <= F.least(F.greatest(c + "1a", c + "2a"), F.greatest(c + "1b", c + "2b")))
    meets = boxes & (F.signum(s1) * F.signum(s2) <= 0) & (F.signum(t1) * F.signum(t2) <= 0)
    follows, closes = F.col("atb") == F.col("ata") + 1, (F.col("ata") == 0) & (F.col("atb") == F.col("n") - 1)
    ahead = (F.col("x2a") - F.col("x1a")) * (F.col("x2b") - F.col("x1b")) + (F.col("y2a") - F.col("y1a")) * (F.col("y2b") - F.col("y1b"))
    flat = (s1 == 0) & (s2 == 0)
    back = flat & (ahead < 0)
    fault = meets & F.when(follows | closes, back | ((F.col("n") == 2) & flat)).otherwise(True)
    # where they cross, or the lowest, then most western end that lies on the other side
    share = s1 / (s1 - s2)
    cross = F.struct((F.col("y1b") + share * (F.col("y2b") - F.col("y1b"))).alias("y"), (F.col("x1b") + share * (F.col("x2b") - F.col("x1b"))).alias("x"))
    end = lambda p, k: F.struct(F.col(f"y{k}{p}").alias("y"), F.col(f"x{k}{p}").alias("x"))
    within = lambda p, x, y: x.between(F.least(f"x1{p}", f"x2{p}"), F.greatest(f"x1{p}", f"x2{p}")) & y.between(F.least(f"y1{p}", f"y2{p}"), F.greatest(f"y1{p}", f"y2{p}"))
    touching = F.array_min(F.array_compact(F.array(*[
        F.when((turn == 0) & within(o, F.col(f"x{k}{p}"), F.col(f"y{k}{p}")), end(p, k))
        for turn, p, o, k in ((s1, "b", "a", 1), (s2, "b", "a", 2), (t1, "a", "b", 1), (t2, "a", "b", 2))
    ])))
    proper = (F.signum(s1) * F.signum(s2) < 0) & (F.signum(t1) * F.signum(t2) < 0)
    points = pairs.filter(fault).select(*key, "ata", "atb", F.when(proper, cross).otherwise(touching).alias("p")).dropDuplicates([*key, "ata", "atb"])
    first = points.groupBy(*key).agg(F.count(F.lit(1)).alias("crossings"), F.min("p").alias("p"))
    return first.select(*key, "crossings", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def faults(rings: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rings that cannot be used, with the first reason that holds; self-crossing is looked for where nothing simpler is wrong."""
    simple = spatial.ring_faults(rings)
    sound = rings.join(simple.select(*key), list(key), "left_anti")
    crossed = sound.join(crossings(sound, key).select(*key), list(key), "left_semi").withColumn("fault", F.lit("self-crossing"))
    return simple.unionByName(crossed)


def inner_point(ring: str = "ring") -> Column:
    """A point strictly inside a sound ring: the middle of its first stretch at a height between its two lowest."""
    heights = f"array_sort(array_distinct(transform({ring}, p -> p.y)))"
    level = f"(({heights})[0] + ({heights})[1]) / 2"
    sides = f"transform(slice({ring}, 1, size({ring}) - 1), (p, i) -> named_struct('a', p, 'b', {ring}[i + 1]))"
    hits = f"array_sort(transform(filter({sides}, s -> (s.a.y > v) <> (s.b.y > v)), s -> s.a.x + (v - s.a.y) * (s.b.x - s.a.x) / (s.b.y - s.a.y)))"
    return F.expr(f"transform(array({level}), v -> named_struct('x', (({hits})[0] + ({hits})[1]) / 2, 'y', v))[0]")


def nested(rings: DataFrame, ident: str, number: str, size: float) -> DataFrame:
    """Add ``depth``, ``parent`` and ``is_hole`` to sound rings that are known by (ident, number) only.

    A ring's own inner point is looked up in the trapezoids of the other rings
    of its polygon. Where rings do not cross, a larger one that holds it is
    around the ring. Even depth is land, odd depth a hole, and the parent is
    the smallest ring around. Rings may touch; of equal ones the lowest number
    is outside.
    """
    area = F.abs(geo.ring_area("ring"))
    key = F.struct(F.col(ident).alias("i"), F.col(number).alias("k"), area.alias("a"))
    outlines = rings.select(key.alias("_ring"), F.lit(False).alias("is_hole"), "ring")
    index = spatial.trapezoids(spatial.polygons(outlines, ["_ring"]), "_ring", size).select(
        F.col("_ring.i").alias("_i"), F.col("_ring.k").alias("_k"), F.col("_ring.a").alias("_a"), *[F.col(c).alias(f"_{c}") for c in ("cx", "cy", "low", "high", "l", "r")]
    )
    points = rings.select(ident, number, area.alias("_own"), inner_point().alias("_p")).withColumns({
        "_pcx": spatial.cell(F.col("_p.x"), size), "_pcy": spatial.cell(F.col("_p.y"), size),
    })
    x, y = F.col("_p.x"), F.col("_p.y")
    at = lambda s: F.col(f"_{s}.x") + F.col(f"_{s}.k") * (y - F.col(f"_{s}.y"))
    same_cell = (F.col("_i") == F.col(ident)) & (F.col("_cx") == F.col("_pcx")) & (F.col("_cy") == F.col("_pcy"))
    larger = (F.col("_a") > F.col("_own")) | ((F.col("_a") == F.col("_own")) & (F.col("_k") < F.col(number)))
    around = points.join(index, same_cell & larger & (y >= F.col("_low")) & (y < F.col("_high")) & (x >= at("l")) & (x < at("r"))).select(ident, number, "_k")
    depth = stage(around.groupBy(ident, number).agg(F.count(F.lit(1)).alias("depth")))
    # the smallest ring around is the deepest of them
    deep = depth.select(F.col(ident), F.col(number).alias("_k"), F.col("depth").alias("_d"))
    nearest = around.join(deep, [ident, "_k"], "left").groupBy(ident, number).agg(F.max_by("_k", F.coalesce("_d", F.lit(0))).alias("parent"))
    out = rings.drop("is_hole").join(depth, [ident, number], "left").join(nearest, [ident, number], "left")
    return out.withColumn("depth", F.coalesce("depth", F.lit(0)).cast("bigint")).withColumn("is_hole", F.col("depth") % 2 == 1)


def parts(rings: DataFrame, ident: str, number: str, size: float) -> DataFrame:
    """Rings with ``part``: an outer ring names its part and takes the holes right inside it; an island in a hole is a part of its own."""
    return nested(rings, ident, number, size).withColumn("part", F.when(F.col("is_hole"), F.col("parent")).otherwise(F.col(number)))
