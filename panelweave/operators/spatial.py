"""Spatial joins as equi-joins on grid cells, with native geometry expressions.

A geometry table has one row per polygon and a column ``edges``:
``ARRAY<STRUCT<x1,y1,x2,y2>>``, every ring of every part, outer rings
counter-clockwise and holes clockwise. Nothing here leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.functions import geo
from panelweave.operators.aggregate import exact_quantiles
from panelweave.operators.joins import BROADCAST_ROWS, lookup
from panelweave.session import stage

NOISE = 1e-11  # of a polygon's own area: what rounding leaves where nothing overlaps


def polygons(rings: DataFrame, ident: Sequence[str]) -> DataFrame:
    """Ring rows (ident, is_hole, ring) to one row per polygon with its edges and box."""
    edges = rings.select(*ident, geo.oriented_edges("ring", "is_hole").alias("_e"))
    return boxed(edges.groupBy(*ident).agg(F.flatten(F.collect_list("_e")).alias("edges")))


def boxed(geom: DataFrame) -> DataFrame:
    """Add the bounding box of ``edges``."""
    return geom.withColumns({
        side + end: F.expr(f"array_{end}(transform(edges, e -> {fold}(e.{side}1, e.{side}2)))")
        for side in "xy" for end, fold in (("min", "least"), ("max", "greatest"))
    })


def projected(geom: DataFrame) -> DataFrame:
    """A geometry table in equal-area metres."""
    return boxed(geom.withColumn("edges", geo.project_edges(F.col("edges"))))


def own_area(edges: str = "edges") -> Column:
    """Area inside the edges, taken from the box corner so that a small polygon far out keeps its digits."""
    return F.expr(f"abs(aggregate({edges}, 0D, (a, e) -> a + (e.x1 - xmin) * (e.y2 - ymin) - (e.x2 - xmin) * (e.y1 - ymin))) / 2")


def ring_faults(rings: DataFrame) -> DataFrame:
    """Rings that cannot be used, with the reason; the rest may go on."""
    ring = F.col("ring")
    box = F.expr("(array_max(transform(ring, p -> p.x)) - array_min(transform(ring, p -> p.x))) * (array_max(transform(ring, p -> p.y)) - array_min(transform(ring, p -> p.y)))")
    unknown = F.exists(ring, lambda p: p.isNull() | p["x"].isNull() | p["y"].isNull() | F.isnan(p["x"]) | F.isnan(p["y"]) | (F.abs(p["x"]) == float("inf")) | (F.abs(p["y"]) == float("inf")))
    ends_differ = F.element_at(ring, 1) != F.element_at(ring, -1)
    fault = (
        F.when(ring.isNull() | (F.size(ring) == 0), "empty")
        .when(unknown, "unknown coordinate")
        .when(F.size(ring) < 4, "too few points")
        .when(ends_differ, "not closed")
        .when(F.abs(geo.ring_area("ring")) <= box * NOISE, "zero area")
    )
    return rings.withColumn("fault", fault).filter(F.col("fault").isNotNull())


def _shared_out(df: DataFrame, *keys: str) -> DataFrame:
    """Few rows with much work each: spread them by a fixed count, which AQE does not undo."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(size)).cast("bigint")


def _span(low: Column, high: Column) -> Column:
    return F.explode(F.sequence(low, high))


FAR = 1e300
REF = 0.4636476090008061  # of a cell's height: a level that vertices and grid corners keep clear of

# Edges point upward here (level ones to the right), so polygons that share an edge agree on all of this.
_SLOPE = "(e.x2 - e.x1) / (e.y2 - e.y1)"


def _beyond(x: str, y: str) -> str:
    """Edge ``e`` passes height ``y`` further east than ``x``."""
    return f"({_turn(x, y)} < 0)"


def _above(x: str, y: str) -> str:
    """Edge ``e`` passes column side ``x`` higher than ``y``; the same test as ``_beyond``, so the two never disagree."""
    return f"({_turn(x, y)} * signum(e.x2 - e.x1) > 0)"


def _turn(x: str, y: str) -> str:
    return f"(({x} - e.x1) * (e.y2 - e.y1) - ({y} - e.y1) * (e.x2 - e.x1))"


def _cell_edges(geom: DataFrame, ident: str, size: float) -> DataFrame:
    """(ident, cy, cx, edges, passing): what each cell of a polygon has of its boundary.

    Edges are cut to grid rows and dealt to the cells they touch before they
    move, one small row each. ``passing`` counts those that pass the row's
    reference height inside the cell.
    """
    upward = "e.y1 < e.y2 or (e.y1 = e.y2 and e.x1 <= e.x2)"
    edges = geom.select(ident, F.explode("edges").alias("e")).select(
        ident, F.expr(f"if({upward}, e, named_struct('x1', e.x2, 'y1', e.y2, 'x2', e.x1, 'y2', e.y1)) as e")
    )
    rows = edges.withColumn("cy", _span(cell(F.col("e.y1"), size), cell(F.col("e.y2"), size)))
    at = lambda y: f"if(e.y1 = e.y2, null, e.x1 + {_SLOPE} * ({y} - e.y1))"
    low, high = at(f"greatest(e.y1, cy * {size}D)"), at(f"least(e.y2, (cy + 1) * {size}D)")
    reach = rows.withColumns({"_a": F.expr(f"coalesce({low}, e.x1)"), "_b": F.expr(f"coalesce({high}, e.x2)")})
    pad = f"({size}D * 1e-9 + greatest(abs(_a), abs(_b)) * 1e-14)"  # an edge on a cell's side belongs to both cells
    first, last = F.expr(f"least(_a, _b) - {pad}"), F.expr(f"greatest(_a, _b) + {pad}")
    dealt = reach.withColumn("cx", _span(cell(first, size), cell(last, size))).select(ident, "cy", "cx", "e")
    ref = f"((cy + {REF}D) * {size}D)"
    passes = f"(e.y1 > {ref}) <> (e.y2 > {ref}) and {_beyond(f'cx * {size}D', ref)} and not {_beyond(f'(cx + 1) * {size}D', ref)}"
    return _shared_out(dealt, ident, "cy").groupBy(ident, "cy", "cx").agg(
        F.collect_list("e").alias("edges"), F.count_if(F.expr(passes)).alias("passing")
    )


def trapezoids(geom: DataFrame, ident: str, size: float) -> DataFrame:
    """Polygons cut into trapezoids per grid cell.

    Rows (cx, cy, ident, low, high, l, r): a point of the cell is inside
    exactly when low <= y < high and it lies from line ``l`` up to line ``r``.
    A cell knows its own edges only. How many edges pass further east is a
    running count along the row, taken at the row's reference height; it gives
    the inside of cells that no edge touches, and the east side of the others.
    A cell with edges is sliced at their ends and where they pass its sides; in
    a slice the edges, in order, bound the inside by turns.
    """
    row = Window.partitionBy(ident, "cy").orderBy(F.desc("cx"))
    east = F.coalesce(F.sum("passing").over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carried = _cell_edges(geom, ident, size).withColumns({"_east": east, "_next": F.lead("cx").over(row)})
    far = f"named_struct('m', {{0}}D, 'x', {{0}}D, 'y', 0D, 'k', 0D)"
    # the cells up to the next one with edges come along where they are inside
    inside = "_next < cx - 1 and (_east + passing) % 2 = 1"
    each = carried.withColumn("_own", F.col("cx")).withColumn("cx", F.explode(F.expr(f"if({inside}, sequence(_next + 1, cx), array(cx))")))
    filled = each.withColumns({
        "_east": F.expr("if(cx = _own, _east, _east + passing)"), "edges": F.expr("if(cx = _own, edges, slice(edges, 1, 0))"),
    })
    sides = filled.selectExpr(
        ident, "cx", "cy", "edges", "_east", f"cx * {size}D as west", f"(cx + 1) * {size}D as east", f"cy * {size}D as south", f"(cy + 1) * {size}D as north",
        f"(cy + {REF}D) * {size}D as _ref",
    )
    crosses = "(e.x1 > {0}) <> (e.x2 > {0})"
    on_side = "transform(filter(edges, e -> " + crosses + "), e -> e.y1 + ({0} - e.x1) * (e.y2 - e.y1) / (e.x2 - e.x1))"
    heights = f"concat(array(south, north), transform(edges, e -> e.y1), transform(edges, e -> e.y2), {on_side.format('west')}, {on_side.format('east')})"
    cut = sides.withColumn("_cuts", F.expr(f"array_sort(array_distinct(filter({heights}, y -> y between south and north)))"))
    slices = cut.select(
        ident, "cx", "cy", "edges", "_east", "west", "east", "_ref",
        F.expr("inline(transform(slice(_cuts, 1, size(_cuts) - 1), (y, i) -> named_struct('low', y, 'high', _cuts[i + 1])))"),
    ).withColumn("_mid", (F.col("low") + F.col("high")) / 2)
    # edges that pass the east side between the reference height and this one
    between = f"size(filter(edges, e -> {crosses.format('east')} and {_above('east', '_ref')} <> {_above('east', '_mid')}))"
    x_at_mid = f"(e.x1 + {_SLOPE} * (_mid - e.y1))"
    line = f"named_struct('m', {x_at_mid}, 'x', e.x1, 'y', e.y1, 'k', {_SLOPE})"
    own = f"transform(filter(edges, e -> (e.y1 > _mid) <> (e.y2 > _mid) and {_beyond('west', '_mid')} and not {_beyond('east', '_mid')}), e -> {line})"
    lines = f"array_sort(if((_east + {between}) % 2 = 1, array_append({own}, {far.format(FAR)}), {own}))"
    bounds = f"if(size(_lines) % 2 = 1, concat(array({far.format(-FAR)}), _lines), _lines)"
    # a slice with nothing inside gives an empty array here and explodes to no row
    turns = "transform(filter(_bounds, (b, i) -> i % 2 = 0), (b, i) -> named_struct('l', b, 'r', _bounds[2 * i + 1]))"
    return slices.withColumn("_lines", F.expr(lines)).withColumn("_bounds", F.expr(bounds)).select("cx", "cy", ident, "low", "high", F.expr(f"inline({turns})"))


def _at(line: Column, y: Column) -> Column:
    return line["x"] + line["k"] * (y - line["y"])


def with_rivals(index: DataFrame, ident: str) -> DataFrame:
    """Add to each trapezoid those of lower-named polygons that may overlap it.

    Trapezoids of one polygon never overlap. A cell of several is cut into
    slabs at all their heights and each slab swept from west to east with the
    furthest east side so far: who begins before it overlaps someone. Only
    slabs with such a meeting are paired, inside the slab; a cell with one
    gives slabs instead of its trapezoids. Neighbours with a common edge are
    no rivals, so a clean partition of the plane costs the sweep only.
    """
    spot, heights = ["cx", "cy"], F.array_sort(F.collect_set("y")).alias("cuts")
    crowded = index.groupBy(*spot).agg(F.min(ident).alias("_a"), F.max(ident).alias("_b")).filter("_a <> _b").select(*spot)
    several = index.join(crowded, spot)
    cuts = several.select(*spot, F.explode(F.array("low", "high")).alias("y")).groupBy(*spot).agg(heights)
    inside = "filter(cuts, y -> y >= low and y <= high)"
    slabs = several.join(cuts, spot).withColumn("_y", F.expr(inside)).select(
        *spot, ident, "l", "r", F.expr("inline(transform(slice(_y, 1, size(_y) - 1), (y, i) -> named_struct('low', y, 'high', _y[i + 1])))")
    )
    low, high = F.col("low"), F.col("high")
    west_to_east = Window.partitionBy(*spot, "low").orderBy(_at(F.col("l"), low) + _at(F.col("l"), high), _at(F.col("r"), low) + _at(F.col("r"), high), ident)
    so_far = west_to_east.rowsBetween(Window.unboundedPreceding, -1)
    early = (_at(F.col("l"), low) < F.max(_at(F.col("r"), low)).over(so_far)) | (_at(F.col("l"), high) < F.max(_at(F.col("r"), high)).over(so_far))
    swept = stage(slabs.withColumn("_meets", F.coalesce(early, F.lit(False))))
    met = swept.filter("_meets").select(*spot, "low").distinct()

    other = swept.join(met, [*spot, "low"], "left_semi").select(*spot, "low", *[F.col(c).alias(f"_{c}") for c in (ident, "high", "l", "r")])

    def passes(a: str, b: str) -> Column:
        """Line ``a`` is left of line ``b`` somewhere in the slab."""
        return (_at(F.col(a), low) < _at(F.col(b), low)) | (_at(F.col(a), high) < _at(F.col(b), high))

    overlap = (F.col(f"_{ident}") < F.col(ident)) & passes("l", "_r") & passes("_l", "r")
    rival = F.struct(low.alias("low"), F.col("_high").alias("high"), F.col("_l").alias("l"), F.col("_r").alias("r"))
    key = [*spot, ident, "low", "l"]
    rivals = swept.select(*key, "r", "high").join(other, [*spot, "low"]).filter(overlap).groupBy(*key).agg(F.collect_list(rival).alias("rivals"))
    torn = rivals.select(*spot).distinct()
    clean = index.join(torn, spot, "left_anti").withColumn("rivals", F.lit(None).cast(rivals.schema["rivals"].dataType))
    return clean.select(*index.columns, "rivals").unionByName(swept.join(torn, spot, "left_semi").join(rivals, key, "left").select(*index.columns, "rivals"))


def points_to_polygons(
    points: DataFrame, geom: DataFrame, ident: str, x: str, y: str, size: float, how: str = "left", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Give each point the lowest-named polygon it lies in (half-open edges).

    A point meets only the trapezoids of its own cell, by plain comparisons
    that compile with the join. The points are never regrouped: a match that
    a lower-named polygon also holds is dropped on the row itself.
    """
    if ident in points.columns:
        raise ValueError(f"points already have a column {ident}")
    index = with_rivals(stage(trapezoids(geom, ident, size)), ident).select(
        F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), ident,
        *[F.col(c).alias(f"_{c}") for c in ("low", "high", "rivals")],
        *[F.col(f"{s}.{c}").alias(f"_{s}{c}") for s in "lr" for c in "xyk"],
    )
    located = points.withColumns({"_cx": cell(F.col(x), size), "_cy": cell(F.col(y), size)})
    px, py = F.col(x), F.col(y)

    def edge(s: str) -> Column:
        return F.col(f"_{s}x") + F.col(f"_{s}k") * (py - F.col(f"_{s}y"))

    within = (py >= F.col("_low")) & (py < F.col("_high")) & (px >= edge("l")) & (px < edge("r"))
    load = F.lit(1) + F.coalesce(F.size("_rivals"), F.lit(0))
    joined = lookup(located, index, ["_cx", "_cy"], [x, y], how, max_rows, load, within)
    taken = F.expr(
        f"exists(_rivals, t -> {y} >= t.low and {y} < t.high and {x} >= t.l.x + t.l.k * ({y} - t.l.y) and {x} < t.r.x + t.r.k * ({y} - t.r.y))"
    )
    kept = joined.filter(F.col("_rivals").isNull() | ~taken)
    return kept.select(*points.columns, ident)


def _mean_height(low: Column, high: Column, left: Column, right: Column) -> Column:
    """Mean height above ``low`` of a line from ``left`` to ``right`` held in [low, high]."""
    span = high - low

    def primitive(v: Column) -> Column:
        t = v - low
        return F.when(t <= 0, F.lit(0.0)).when(t >= span, span * span / 2 + span * (t - span)).otherwise(t * t / 2)

    rise = right - left
    flat = F.greatest(F.lit(0.0), F.least(span, (left + right) / 2 - low))
    level = F.abs(rise) < span * 1e-9
    return F.when(level, flat).otherwise((primitive(right) - primitive(left)) / F.when(level, F.lit(1.0)).otherwise(rise))


def column_pieces(geom: DataFrame, ident: Sequence[str], size: float) -> DataFrame:
    """Edges cut at grid columns: (ident, cx, sign, xl, yl, xr, yr) with xl < xr.

    ``sign`` is +1 for an upper boundary and -1 for a lower one.
    """
    edges = geom.select(*ident, F.explode("edges").alias("e")).filter(F.col("e.x1") != F.col("e.x2"))
    forward = F.col("e.x1") < F.col("e.x2")
    ends = edges.select(
        *ident,
        F.when(forward, F.lit(-1.0)).otherwise(F.lit(1.0)).alias("sign"),
        *[F.when(forward, F.col(f"e.{a}")).otherwise(F.col(f"e.{b}")).alias(n) for a, b, n in (("x1", "x2", "xa"), ("y1", "y2", "ya"), ("x2", "x1", "xb"), ("y2", "y1", "yb"))],
    )
    cut = ends.withColumn("cx", _span(cell(F.col("xa"), size), cell(F.col("xb"), size)))
    xl = F.greatest(F.col("xa"), F.col("cx") * F.lit(size))
    xr = F.least(F.col("xb"), (F.col("cx") + 1) * F.lit(size))
    slope = (F.col("yb") - F.col("ya")) / (F.col("xb") - F.col("xa"))
    placed = cut.withColumns({"xl": xl, "xr": xr, "_m": slope}).filter(F.col("xl") < F.col("xr"))
    return placed.select(
        *ident,
        "cx",
        "sign",
        "xl",
        (F.col("ya") + F.col("_m") * (F.col("xl") - F.col("xa"))).alias("yl"),
        "xr",
        (F.col("ya") + F.col("_m") * (F.col("xr") - F.col("xa"))).alias("yr"),
    )


def coverage_weights(geom: DataFrame, ident: str, size: float) -> DataFrame:
    """Fraction of each grid cell covered by each polygon: (ident, cx, cy, w).

    Area under the upper boundary minus area under the lower one, column by
    column. An edge adds its exact area to the rows it runs through and its
    signed width to every row below; the running sum down the column
    spreads the latter, so interior cells never see an edge. Computed once per
    grid and reused for every time step.

    A lower edge is measured from the cell's top, where it ends what came from
    above. Widths then cancel exactly, and a side parallel to the grid is
    rounded no more often than the product of width and height: running
    weights that tie on paper tie far from the origin too.
    """
    pieces = column_pieces(geom.withColumn("_own", own_area()), [ident, "_own"], size)
    low, high = cell(F.least("yl", "yr"), size), cell(F.greatest("yl", "yr"), size)
    rows = pieces.withColumn("_first", low).withColumn("cy", _span(F.col("_first") - 1, high))
    width = F.col("xr") - F.col("xl")
    south, north = F.col("cy") * F.lit(size), (F.col("cy") + 1) * F.lit(size)
    here, upper = F.col("cy") >= F.col("_first"), F.col("sign") > 0
    mean = _mean_height(south, north, F.col("yl"), F.col("yr"))
    part = F.when(here, width * F.when(upper, mean).otherwise((north - south) - mean))
    ended = F.when(here & ~upper, width)
    open_below = F.when(~here, width * F.col("sign"))
    per_row = rows.groupBy(ident, "_own", "cx", "cy").agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(n) for c, n in ((part, "_part"), (ended, "_ended"), (open_below, "_open"))]
    )
    down = Window.partitionBy(ident, "cx").orderBy(F.desc("cy"))
    carried = per_row.withColumns({
        "_carry": F.sum("_open").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_next": F.lead("cy").over(down),
    })
    filled = carried.select(
        ident, "_own", "cx", "_part", "_ended", "_carry", F.col("cy").alias("_top"),
        _span(F.coalesce(F.col("_next") + 1, F.col("cy")), F.col("cy")).alias("cy"),
    )
    top = F.col("cy") == F.col("_top")
    through = F.col("_carry") - F.when(top, F.col("_ended")).otherwise(F.lit(0.0))
    area = through * (north - south) + F.when(top, F.col("_part")).otherwise(F.lit(0.0))
    share = area / F.lit(size * size)
    # a full cell keeps the rounding of its sides; only what overlaps itself is held at 1
    held = F.when(share > 1 + 1e-9, F.lit(1.0)).otherwise(share)
    return filled.filter(area > F.col("_own") * F.lit(NOISE)).select(ident, "cx", "cy", held.alias("w"))


def zonal_stats(
    cells: DataFrame,
    weights: DataFrame,
    ident: str,
    value: str,
    by: Sequence[str] = (),
    frame: DataFrame | None = None,
) -> DataFrame:
    """Coverage-weighted mean and covered cell count per polygon (and time step).

    Nodata cells carry no weight. With ``frame``, the rows every polygon and
    step should have, those without any cell appear too: mean null, count 0.
    """
    known = cells.filter(F.col(value).isNotNull()).select("cx", "cy", *by, value)
    joined = lookup(known, weights, ["cx", "cy"], [*by, value], "inner")
    stats = joined.groupBy(ident, *by).agg(
        F.try_divide(F.sum(F.col(value) * F.col("w")), F.sum("w")).alias("mean"), F.sum("w").alias("count")
    )
    if frame is None:
        return stats
    dense = frame.select(ident, *by).join(stats, [ident, *by], "left")
    return dense.withColumn("count", F.coalesce("count", F.lit(0.0)))


def zonal_quantile(
    cells: DataFrame, weights: DataFrame, ident: str, value: str, p: float, name: str, by: Sequence[str] = (), interpolate: bool = False
) -> DataFrame:
    """Lowest cell value at which the running covered area reaches ``p`` of the total, or the interpolated one."""
    known = cells.filter(F.col(value).isNotNull()).select("cx", "cy", *by, value)
    joined = lookup(known, weights, ["cx", "cy"], [*by, value], "inner")
    return exact_quantiles(joined, [ident, *by], value, {name: p}, weight="w", interpolate=interpolate)


def mosaic(tiles: DataFrame, value: str, order: str) -> DataFrame:
    """Overlapping tiles to one grid: the first tile with data wins a cell."""
    known = F.col(value).isNotNull()
    return tiles.groupBy("cx", "cy").agg(F.min_by(value, F.when(known, F.col(order))).alias(value))


def candidate_pairs(left: DataFrame, right: DataFrame, a: str, b: str, size: float, touching: bool = False) -> DataFrame:
    """Polygon pairs whose boxes overlap, or with ``touching`` at least touch, each once.

    Boxes are spread over cells; a pair is kept only in the cell that holds
    the lower-left corner of the common box, so no distinct is needed.
    """
    def spread(df: DataFrame, ident: str, tag: str) -> DataFrame:
        own = F.col("own") if "own" in df.columns else own_area()
        return df.select(
            F.col(ident), own.alias("own" + tag), *[F.col(c).alias(c + tag) for c in ("xmin", "xmax", "ymin", "ymax")],
            _span(cell(F.col("xmin"), size), cell(F.col("xmax"), size)).alias("_cx"),
        ).select("*", _span(cell(F.col("ymin" + tag), size), cell(F.col("ymax" + tag), size)).alias("_cy"))

    west, south = F.greatest("xmin_a", "xmin_b"), F.greatest("ymin_a", "ymin_b")
    east, north = F.least("xmax_a", "xmax_b"), F.least("ymax_a", "ymax_b")
    met = (west <= east) & (south <= north) if touching else (west < east) & (south < north)
    owner = (F.col("_cx") == cell(west, size)) & (F.col("_cy") == cell(south, size))
    return (
        spread(left, a, "_a")
        .join(spread(right, b, "_b"), ["_cx", "_cy"])
        .filter(met & owner)
        .select(
            a, b, F.least("ymin_a", "ymin_b").alias("_base"), F.least("own_a", "own_b").alias("_own"),
            cell(west, size).alias("_west"), cell(F.least("xmax_a", "xmax_b"), size).alias("_east"),
        )
    )


@dataclass(frozen=True)
class OverlayIndex:
    """Polygons prepared for overlays on one grid: boxes with areas, and boundary pieces, both written once."""

    boxes: DataFrame
    pieces: DataFrame
    size: float


def overlay_index(geom: DataFrame, ident: str, size: float) -> OverlayIndex:
    """What every overlay with these polygons needs of them, staged: build it once for a spine and hand it to each layer."""
    boxes = stage(geom.select(ident, own_area().alias("own"), "xmin", "xmax", "ymin", "ymax"))
    return OverlayIndex(boxes, stage(column_pieces(geom, [ident], size)), size)


def overlay_area(left: DataFrame | OverlayIndex, right: DataFrame, a: str, b: str, size: float) -> DataFrame:
    """Intersection area of every overlapping polygon pair: (a, b, area). ``left`` may be an index built before.

    Both boundaries are cut at grid columns. The area is the signed sum, over
    boundary pieces that share a column and a stretch of it, of the area
    under the lower of the two. A pair is unfolded into the columns of its
    common box, so a large polygon brings to each pair only the pieces there.
    """
    indexed = isinstance(left, OverlayIndex)
    if indexed and left.size != size:
        raise ValueError(f"the index is on a grid of {left.size}, not {size}")
    boxes, pieces = (left.boxes, left.pieces) if indexed else (left, column_pieces(left, [a], size))
    pairs = candidate_pairs(boxes, right, a, b, size).withColumn("cx", _span(F.col("_west"), F.col("_east")))
    ours = pieces.select(a, "cx", F.col("sign").alias("s1"), *[F.col(c).alias(c + "1") for c in ("xl", "yl", "xr", "yr")])
    theirs = column_pieces(right, [b], size).select(b, "cx", F.col("sign").alias("s2"), *[F.col(c).alias(c + "2") for c in ("xl", "yl", "xr", "yr")])
    met = pairs.join(ours, [a, "cx"]).join(theirs, [b, "cx"]).filter(F.greatest("xl1", "xl2") < F.least("xr1", "xr2"))
    stretch = met.withColumns({"_l": F.greatest("xl1", "xl2"), "_r": F.least("xr1", "xr2")})

    def height(n: str, at: str) -> Column:
        slope = (F.col("yr" + n) - F.col("yl" + n)) / (F.col("xr" + n) - F.col("xl" + n))
        return F.col("yl" + n) + slope * (F.col(at) - F.col("xl" + n)) - F.col("_base")

    h = stretch.withColumns({"f1": height("1", "_l"), "f2": height("1", "_r"), "g1": height("2", "_l"), "g2": height("2", "_r")})
    width, d1, d2 = F.col("_r") - F.col("_l"), F.col("f1") - F.col("g1"), F.col("f2") - F.col("g2")
    meet = d1 / F.when(d1 == d2, F.lit(1.0)).otherwise(d1 - d2)
    top = F.col("f1") + (F.col("f2") - F.col("f1")) * meet
    low1, low2 = F.least("f1", "g1"), F.least("f2", "g2")
    straight = (low1 + low2) / 2
    bent = (low1 + top) / 2 * meet + (top + low2) / 2 * (1 - meet)
    under = width * F.when(d1 * d2 < 0, bent).otherwise(straight)
    parts = h.groupBy(a, b).agg(F.sum(F.col("s1") * F.col("s2") * under).alias("area"), F.max("_own").alias("_own"))
    return parts.filter(F.col("area") > F.col("_own") * F.lit(NOISE)).drop("_own")


def intersecting(left: DataFrame, right: DataFrame, a: str, b: str, size: float) -> DataFrame:
    """Polygon pairs that have a point in common, a touching corner or side included: (a, b).

    Either the pair shares area, or two of its edges meet. Edges meet only
    inside a grid column of the pair's common box, and only where their own
    boxes do.
    """
    pairs = candidate_pairs(left, right, a, b, size, touching=True)
    unfolded = pairs.select(a, b, _span(F.col("_west"), F.col("_east")).alias("cx"))

    def edges(df: DataFrame, ident: str, n: str) -> DataFrame:
        each = df.select(ident, F.explode("edges").alias("e"))
        low, high = cell(F.least("e.x1", "e.x2"), size), cell(F.greatest("e.x1", "e.x2"), size)
        return each.select(ident, _span(low, high).alias("cx"), *[F.col(f"e.{c}").alias(c + n) for c in ("x1", "y1", "x2", "y2")])

    def side(p: str, q: str, x: str, y: str) -> Column:
        """Which side of the line p-q a point lies on."""
        return F.signum((F.col("x2" + p) - F.col("x1" + p)) * (F.col(y + q) - F.col("y1" + p)) - (F.col("y2" + p) - F.col("y1" + p)) * (F.col(x + q) - F.col("x1" + p)))

    boxes_meet = F.lit(True)
    for c in "xy":
        low = F.greatest(F.least(c + "1_p", c + "2_p"), F.least(c + "1_q", c + "2_q"))
        boxes_meet = boxes_meet & (low <= F.least(F.greatest(c + "1_p", c + "2_p"), F.greatest(c + "1_q", c + "2_q")))
    cross = (side("_p", "_q", "x1", "y1") * side("_p", "_q", "x2", "y2") <= 0) & (side("_q", "_p", "x1", "y1") * side("_q", "_p", "x2", "y2") <= 0)
    met = unfolded.join(edges(left, a, "_p"), [a, "cx"]).join(edges(right, b, "_q"), [b, "cx"]).filter(boxes_meet & cross).select(a, b)
    return met.union(overlay_area(left, right, a, b, size).select(a, b)).distinct()


def same_home(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Overlaps inside the polygon's own country; slivers across a border go."""
    return pairs.filter(F.col(left) == F.col(right))


def unmatched_shares(joined: DataFrame, ident: str, masses: Mapping[str, str]) -> DataFrame:
    """Share of points, and of each mass, that fell in no polygon."""
    lost = F.col(ident).isNull()
    out = [F.count(F.lit(1)).alias("n"), F.count_if(lost).alias("n_unmatched")]
    for name, column in masses.items():
        out.append(F.try_divide(F.coalesce(F.sum(F.when(lost, F.col(column))), F.lit(0.0)), F.sum(column)).alias(name))
    return joined.agg(*out)
