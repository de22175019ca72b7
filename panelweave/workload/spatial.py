"""Spatial queries. District polygons are laid out from the supplier key on a
lattice 32 wide; each is a square with a cut corner, a diamond hole and an
island. Points scatter around their supplier's square, often into a neighbour's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.functions import numeric
from panelweave.operators import frame, joins, reshape, rings, select, spatial
from panelweave.plans import spatial_layers
from panelweave.workload.base import FIRST, FRAME_SQL, LAST, SPINE_SQL, Tables, query
from panelweave.workload.panels import KINDS

WIDE = 32
GRID = 0.4
OUTER = [(0.0, 0.0), (1.0, 0.0), (1.0, 0.6), (0.6, 1.0), (0.0, 1.0), (0.0, 0.0)]
HOLE = [(0.4, 0.2), (0.6, 0.4), (0.4, 0.6), (0.2, 0.4), (0.4, 0.2)]
ISLAND = [(0.85, 0.85), (0.95, 0.85), (0.95, 0.95), (0.85, 0.95), (0.85, 0.85)]
BOX = [(0.15, 0.1), (0.9, 0.1), (0.9, 0.85), (0.15, 0.85), (0.15, 0.1)]
FOOTPRINT = [(0.5, 0.3), (1.7, 0.3), (1.7, 1.2), (0.5, 1.2), (0.5, 0.3)]


def _corner(key: str) -> tuple[Column, Column]:
    return F.col(key) % WIDE, F.floor(F.col(key) / WIDE)


def _ring(key: str, shape) -> Column:
    points = ", ".join(f"named_struct('x', {key} % {WIDE} + {a}D, 'y', floor({key} / {WIDE}) + {b}D)" for a, b in shape)
    return F.expr(f"array({points})")


def district_rings(t: Tables) -> DataFrame:
    each = F.array(*[
        F.struct(F.lit(hole).alias("is_hole"), _ring("s_suppkey", shape).alias("ring"))
        for hole, shape in ((False, OUTER), (True, HOLE), (False, ISLAND))
    ])
    return t.read("supplier").select(F.col("s_suppkey").alias("district_id"), F.inline(each))


def districts(t: Tables) -> DataFrame:
    return spatial.polygons(district_rings(t), ["district_id"])


def boxes(t: Tables, table: str, key: str, shape, ident: str, *extra: str) -> DataFrame:
    outlines = t.read(table).select(F.col(key).alias(ident), *extra, F.lit(False).alias("is_hole"), _ring(key, shape).alias("ring"))
    return spatial.polygons(outlines, [ident, *extra])


def points(t: Tables, *extra: str) -> DataFrame:
    x, y = _corner("l_suppkey")
    return t.read("lineitem").select(
        (x + (F.col("l_orderkey") % 997 + 0.37) / 997 * 1.5 - 0.25).alias("lon"),
        (y + (F.col("l_partkey") % 991 + 0.41) / 991 * 1.5 - 0.25).alias("lat"),
        F.year("l_shipdate").alias("year"),
        F.col("l_returnflag").alias("kind"),
        F.col("l_quantity").alias("best"),
        "l_linestatus",
        "l_partkey",
        *extra,
    )


POINTS_SQL = f"""select *, floor(lon) as gx, floor(lat) as gy, lon - floor(lon) as fx, lat - floor(lat) as fy from (
  select (l_suppkey % {WIDE}) + ((l_orderkey % 997) + 0.37) / 997 * 1.5 - 0.25 as lon,
    floor(l_suppkey / {WIDE}) + ((l_partkey % 991) + 0.41) / 991 * 1.5 - 0.25 as lat,
    cast(year(l_shipdate) as integer) as year, l_returnflag as kind, l_quantity as best, l_linestatus, l_partkey from lineitem)"""
INSIDE_SQL = """((fx + fy < 1.6 and not (abs(fx - 0.4) + abs(fy - 0.4) < 0.2)) or (fx between 0.85 and 0.95 and fy between 0.85 and 0.95))"""
PLACED_SQL = f"""select p.*, s.s_suppkey as district_id from ({POINTS_SQL}) p
  left join supplier s on s.s_suppkey = gy * {WIDE} + gx and gx between 0 and {WIDE - 1} and gy >= 0 and {INSIDE_SQL}"""


def placed(t: Tables, how: str = "left") -> DataFrame:
    return spatial.points_to_polygons(points(t), districts(t), "district_id", "lon", "lat", 1.0, how)


@query(
    "points_in_districts",
    "SP-1 JN-16 FLT-8",
    f"select district_id::double as district_id, count(*) as n, cast(sum(best) as bigint) as mass from ({PLACED_SQL}) group by 1",
)
def points_in_districts(t: Tables):
    return placed(t).groupBy(F.col("district_id").cast("double").alias("district_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("best").cast("bigint").alias("mass")
    )


_KIND_SQL = ", ".join(
    f"coalesce(w.{m}_{s}, 0)::bigint as {m}_{s}" for m in ("n_events", "deaths") for s in (*KINDS.values(), "total")
)
_WIDE_SQL = ", ".join(
    f"coalesce(sum({e}) filter (where kind = '{k}'), 0) as {m}_{s}" for m, e in (("n_events", "1"), ("deaths", "best")) for k, s in KINDS.items()
) + ", count(*) as n_events_total, sum(best) as deaths_total"


@query(
    "located_event_panel",
    "SP-2 JN-17 AGG-1 PRJ-6 PRJ-8",
    f"""with w as (select district_id, year, {_WIDE_SQL} from ({PLACED_SQL}) where district_id is not null group by 1, 2)
    select f.district_id, f.year, {_KIND_SQL}
    from ({FRAME_SQL}) f left join w on f.district_id = w.district_id and f.year = w.year""",
)
def located_event_panel(t: Tables):
    long, wide = spatial_layers.event_layers(
        points(t), districts(t), "district_id", "lon", "lat", 1.0, "kind", KINDS, {"deaths": "best"}
    )
    columns = [f"{m}_{s}" for m in ("n_events", "deaths") for s in (*KINDS.values(), "total")]
    wide = wide.select("district_id", "year", *[F.col(c).cast("bigint").alias(c) for c in columns])
    base = frame.dense_frame(t.spine.select("district_id"), FIRST, LAST)
    return frame.attach(base, wide, ["district_id", "year"], columns, "zero", checked=True)


@query(
    "unmatched_share",
    "SP-10",
    f"""select count(*) as n, count(*) filter (where district_id is null) as n_unmatched,
      round(coalesce(sum(case when district_id is null then best end), 0.0) / sum(best), 8) as mass from ({PLACED_SQL})""",
)
def unmatched_share(t: Tables):
    out = spatial.unmatched_shares(placed(t), "district_id", {"mass": "best"})
    return out.withColumn("mass", F.round("mass", 8))


def _cells_sql(x: str, y: str, size: float) -> str:
    return f"floor(({x}) / {size}), floor(({y}) / {size})"


_BOX_SQL = f"""select s_suppkey as district_id, s_suppkey % {WIDE} + 0.15::double as x0, s_suppkey % {WIDE} + 0.9::double as x1,
  floor(s_suppkey / {WIDE}) + 0.1::double as y0, floor(s_suppkey / {WIDE}) + 0.85::double as y1 from supplier"""
WEIGHTS_SQL = f"""select district_id, cast(cx as bigint) as cx, cast(cy as bigint) as cy,
    (least(x1, (cx + 1) * {GRID}::double) - greatest(x0, cx * {GRID}::double)) * (least(y1, (cy + 1) * {GRID}::double) - greatest(y0, cy * {GRID}::double)) / ({GRID}::double * {GRID}::double) as w
  from (select *, unnest(generate_series(cast(floor(y0 / {GRID}) as bigint), cast(floor(y1 / {GRID}) as bigint))) as cy
    from (select *, unnest(generate_series(cast(floor(x0 / {GRID}) as bigint), cast(floor(x1 / {GRID}) as bigint))) as cx from ({_BOX_SQL})))
  where least(x1, (cx + 1) * {GRID}::double) - greatest(x0, cx * {GRID}::double) > 1e-9 and least(y1, (cy + 1) * {GRID}::double) - greatest(y0, cy * {GRID}::double) > 1e-9"""
CELLS_SQL = f"""select cx, cy, year, case when m <= 34 then m end as value from (
  select cast(floor(lon / {GRID}) as bigint) as cx, cast(floor(lat / {GRID}) as bigint) as cy, year, sum(best) / count(best) as m
  from ({POINTS_SQL}) group by 1, 2, 3)"""


def weights(t: Tables) -> DataFrame:
    return spatial.coverage_weights(boxes(t, "supplier", "s_suppkey", BOX, "district_id"), "district_id", GRID)


def cells(t: Tables) -> DataFrame:
    """A yearly raster: mean event size per grid cell, with a nodata sentinel above 34."""
    placed_cells = points(t).withColumns({"cx": spatial.cell(F.col("lon"), GRID), "cy": spatial.cell(F.col("lat"), GRID)})
    mean = placed_cells.groupBy("cx", "cy", "year").agg((F.sum("best") / F.count("best")).alias("m"))
    raw = F.when(F.col("m") <= 34, F.col("m")).otherwise(F.lit(-9999.0))
    return mean.select("cx", "cy", "year", numeric.without_nodata(raw, -9999.0).alias("value"))


@query("coverage_weights", "SP-4", f"select district_id, cx, cy, round(w, 6) as w from ({WEIGHTS_SQL})")
def coverage_weights(t: Tables):
    return weights(t).withColumn("w", F.round("w", 6))


@query(
    "zonal_mean",
    "SP-3 JN-21 AGG-10 FN-19 SP-12",
    f"""with z as (select district_id, year, sum(value * w) / sum(w) as mean, sum(w) as cnt
      from ({CELLS_SQL}) c join ({WEIGHTS_SQL}) w on c.cx = w.cx and c.cy = w.cy where value is not null group by 1, 2)
    select f.district_id, f.year, round(z.mean, 6) as mean, round(coalesce(z.cnt, 0.0), 6) as cnt
    from ({FRAME_SQL}) f left join z on f.district_id = z.district_id and f.year = z.year""",
)
def zonal_mean(t: Tables):
    base = frame.dense_frame(t.spine.select("district_id"), FIRST, LAST)
    z = spatial.zonal_stats(cells(t), weights(t), "district_id", "value", ["year"], base)
    return z.select("district_id", "year", F.round("mean", 6).alias("mean"), F.round("count", 6).alias("cnt"))


@query(
    "zonal_median",
    "AGG-11 SP-3",
    f"""with i as (select district_id, value as v, sum(w) as w from ({CELLS_SQL}) c join ({WEIGHTS_SQL}) w on c.cx = w.cx and c.cy = w.cy
      where value is not null group by 1, 2),
    j as (select district_id, v, cast(w / max(w) over (partition by district_id) as decimal(38,12)) as w from i),
    r as (select *, sum(w) over (partition by district_id order by v) as run, sum(w) over (partition by district_id) as tot from j)
    select district_id, min(v) filter (where run::double >= tot::double * 0.5) as median from r group by 1""",
)
def zonal_median(t: Tables):
    return spatial.zonal_quantile(cells(t), weights(t), "district_id", "value", 0.5, "median")


@query(
    "zonal_median_interpolated",
    "AGG-11",
    f"""with i as (select district_id, value as v, sum(w) as w from ({CELLS_SQL}) c join ({WEIGHTS_SQL}) w on c.cx = w.cx and c.cy = w.cy
      where value is not null group by 1, 2),
    r as (select *, sum(w) over (partition by district_id order by v) - w / 2 as mid, sum(w) over (partition by district_id) / 2 as half from i),
    e as (select district_id, max(half) as half, max(mid) filter (where mid <= half) as m0, min(mid) filter (where mid >= half) as m1,
      max(v) filter (where mid <= half) as v0, min(v) filter (where mid >= half) as v1 from r group by 1)
    select district_id, round(coalesce(v0 + (v1 - v0) * coalesce((half - m0) / nullif(m1 - m0, 0), 0), v0, v1), 6) as median from e""",
)
def zonal_median_interpolated(t: Tables):
    found = spatial.zonal_quantile(cells(t), weights(t), "district_id", "value", 0.5, "median", interpolate=True)
    return found.withColumn("median", F.round("median", 6))


_FOOT_SQL = f"""select c_custkey, c_nationkey, c_mktsegment, c_custkey % {WIDE} + 0.5::double as u0, c_custkey % {WIDE} + 1.7::double as u1,
  floor(c_custkey / {WIDE}) + 0.3::double as v0, floor(c_custkey / {WIDE}) + 1.2::double as v1 from customer"""
OVERLAY_SQL = f"""select district_id, c_custkey, c_nationkey, c_mktsegment,
    (least(x1, u1) - greatest(x0, u0)) * (least(y1, v1) - greatest(y0, v0)) as area
  from ({_BOX_SQL}) join ({_FOOT_SQL}) on least(x1, u1) - greatest(x0, u0) > 1e-9 and least(y1, v1) - greatest(y0, v0) > 1e-9"""


def footprints(t: Tables) -> DataFrame:
    return boxes(t, "customer", "c_custkey", FOOTPRINT, "c_custkey", "c_nationkey", "c_mktsegment")


def overlay(t: Tables) -> DataFrame:
    ours, theirs = boxes(t, "supplier", "s_suppkey", BOX, "district_id"), footprints(t)
    area = spatial.overlay_area(ours, theirs, "district_id", "c_custkey", 1.0)
    return area.join(t.read("customer").select("c_custkey", "c_nationkey", "c_mktsegment"), "c_custkey")


@query("overlay_area", "SP-5 JN-19", f"select district_id, c_custkey, round(area, 6) as area from ({OVERLAY_SQL})")
def overlay_area(t: Tables):
    return overlay(t).select("district_id", "c_custkey", F.round("area", 6).alias("area"))


@query(
    "same_home_overlay",
    "JN-20 SP-11",
    f"""select district_id, count(*) as n, round(sum(area), 6) as area
    from ({OVERLAY_SQL}) o join supplier on s_suppkey = district_id where c_nationkey = s_nationkey group by 1""",
)
def same_home_overlay(t: Tables):
    homes = t.read("supplier").select(F.col("s_suppkey").alias("district_id"), "s_nationkey")
    kept = spatial.same_home(overlay(t).join(homes, "district_id"), "c_nationkey", "s_nationkey")
    return kept.groupBy("district_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("area"), 6).alias("area"))


@query(
    "layers_of_one_index",
    "SP-5 JN-19 SP-12",
    f"""select district_id, c_mktsegment as layer, count(*) as n, round(sum(area), 6) as area from ({OVERLAY_SQL})
    where c_mktsegment in ('BUILDING', 'MACHINERY', 'FURNITURE') group by 1, 2""",
)
def layers_of_one_index(t: Tables):
    """Three layers laid over the same districts, whose boundary is cut to the grid and written once."""
    index, feet = spatial.overlay_index(boxes(t, "supplier", "s_suppkey", BOX, "district_id"), "district_id", 1.0), footprints(t)
    out = None
    for name in ("BUILDING", "MACHINERY", "FURNITURE"):
        area = spatial.overlay_area(index, feet.filter(F.col("c_mktsegment") == name), "district_id", "c_custkey", 1.0)
        part = area.groupBy("district_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("area"), 6).alias("area")).withColumn("layer", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.select("district_id", "layer", "n", "area")


_STATUS_SQL = "1994 + cast(c_custkey % 5 as integer) as a, 1996 + cast(c_custkey % 7 as integer) as b"


@query(
    "group_exclusion_layer",
    "DOM-10 JN-22 AGG-12 AGG-13 AGG-16",
    f"""with per as (select *, {_STATUS_SQL} from ({OVERLAY_SQL})),
    y as (select district_id, c_mktsegment as grp, cast(unnest(generate_series(greatest(a, {FIRST}), least(b, {LAST}))) as integer) as year, area,
      c_mktsegment in ('BUILDING', 'MACHINERY') as excl from per where greatest(a, {FIRST}) <= least(b, {LAST})),
    g as (select district_id, year, grp, sum(area) as a from y group by 1, 2, 3),
    f as (select district_id, year, 1 - sum(a * a) / (sum(a) * sum(a)) as frac from g group by 1, 2)
    select y.district_id, y.year, count(distinct grp) as n_groups,
      round(least(1.0, greatest(0.0, coalesce(sum(case when excl then area / 0.5625 end), 0.0))), 6) as share_excluded,
      round(coalesce(sum(case when excl then area / 0.5625 end), 0.0), 6) as share_excluded_raw,
      round(max(f.frac), 6) as fractionalisation,
      (sum(case when excl then area end) > 0 and sum(case when excl then area end) is not null)::integer as any_excluded
    from y join f on y.district_id = f.district_id and y.year = f.year group by 1, 2""",
)
def group_exclusion_layer(t: Tables):
    key = F.col("c_custkey")
    parts = overlay(t).withColumns({"a": (1994 + key % 5).cast("int"), "b": (1996 + key % 7).cast("int"), "district_area": F.lit(0.5625)})
    yearly = joins.expand_periods(parts, "a", "b", FIRST, LAST)
    excluded = yearly.withColumn("excluded", F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    layer = spatial_layers.exclusion(excluded, "district_id", "c_mktsegment", "area", "district_area", "excluded")
    return layer.select(
        "district_id", "year", "n_groups",
        *[F.round(c, 6).alias(c) for c in ("share_excluded", "share_excluded_raw", "fractionalisation")], "any_excluded",
    )


@query(
    "food_phase_layer",
    "DOM-9 AGG-17 AGG-18 AGG-19",
    f"""with p as (select district_id, 1996 + cast(c_custkey % 4 as integer) as year, 1 + cast(c_custkey % 5 as integer) as phase, area from ({OVERLAY_SQL})),
    m as (select district_id, year, phase, row_number() over (partition by district_id, year order by round(sum(area), 9) desc, phase desc) as rn from p group by 1, 2, 3)
    select p.district_id, p.year, max(p.phase) as phase_max, count(*) as n_reports,
      round(coalesce(sum(case when p.phase >= 3 then area end), 0.0) / sum(area), 6) as crisis_share,
      max(m.phase) as phase_modal, (max(p.phase) >= 3)::integer as crisis_flag, 1 as covered
    from p join m on p.district_id = m.district_id and p.year = m.year and m.rn = 1 group by 1, 2""",
)
def food_phase_layer(t: Tables):
    key = F.col("c_custkey")
    phased = overlay(t).withColumns({
        "year": (1996 + key % 4).cast("int"), "phase": (1 + key % 5).cast("int"), "area": F.round("area", 9),
    })
    layer = spatial_layers.food_phase(phased, "district_id", "phase", "area", crisis=3)
    return layer.withColumn("crisis_share", F.round("crisis_share", 6))


@query(
    "field_polygon_census",
    "JN-18 SP-6 AGG-3 AGG-5 JN-3 PRJ-15",
    f"""with o as (select district_id, count(*) as n_fields, sum((c_mktsegment in ('BUILDING', 'FURNITURE'))::integer) as oil,
      sum((c_mktsegment = 'MACHINERY')::integer) as gas, min(case when c_nationkey > 0 then 1900 + c_nationkey end) as first_year
      from ({OVERLAY_SQL}) group by 1)
    select s.district_id, coalesce(o.n_fields, 0) as n_fields, (coalesce(o.oil, 0) > 0)::integer as has_oil,
      (coalesce(o.gas, 0) > 0)::integer as has_gas, (coalesce(o.n_fields, 0) > 0)::integer as has_any, o.first_year::double as first_year
    from ({SPINE_SQL}) s left join o on s.district_id = o.district_id""",
)
def field_polygon_census(t: Tables):
    hits = overlay(t).withColumn("found", F.when(F.col("c_nationkey") > 0, 1900 + F.col("c_nationkey")))
    flags = {"has_oil": F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), "has_gas": F.col("c_mktsegment") == "MACHINERY"}
    census = spatial_layers.deposit_census(hits, t.spine, "district_id", "fields", flags=flags, first_year="found")
    return census.select("district_id", "n_fields", "has_oil", "has_gas", "has_any", F.col("first_year").cast("double").alias("first_year"))


@query(
    "deposit_point_census",
    "SP-6 JN-17 FLT-7 AGG-2 AGG-3 JN-3",
    f"""with d as (select district_id, l_linestatus, kind from ({PLACED_SQL}) where district_id is not null and kind <> 'R'),
    o as (select district_id, count(*) as n, sum((kind = 'A')::integer) as n_a, sum((l_linestatus = 'F')::integer) as n_f from d group by 1)
    select s.district_id, coalesce(o.n, 0) as n_deposits, coalesce(o.n_a, 0)::bigint as n_alluvial, coalesce(o.n_f, 0)::bigint as n_primary,
      (coalesce(o.n, 0) > 0)::integer as has_any
    from ({SPINE_SQL}) s left join o on s.district_id = o.district_id""",
)
def deposit_point_census(t: Tables):
    coded = points(t).withColumn("precision", F.concat_ws("; ", F.col("kind"), F.col("l_linestatus")))
    precise = coded.filter(~reshape.any_part_in("precision", "[;,]", ["R"]))
    hits = spatial.points_to_polygons(precise, districts(t), "district_id", "lon", "lat", 1.0, "inner")
    counts = {"n_alluvial": F.col("kind") == "A", "n_primary": F.col("l_linestatus") == "F"}
    return spatial_layers.deposit_census(hits, t.spine, "district_id", "deposits", counts=counts).select(
        "district_id", "n_deposits", "n_alluvial", "n_primary", "has_any"
    )


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "crop_mix",
    "SP-7 PRJ-5 AGG-7 AGG-37 VAL-28",
    f"""with a as (select district_id, p_type as crop, sum(case when best >= 2 then best else 0.0 end) as area
      from ({PLACED_SQL}) join part on p_partkey = l_partkey where district_id is not null group by 1, 2)
    select district_id, crop, area, area / sum(area) over (partition by district_id) as share from a where area > 0""",
)
def crop_mix(t: Tables):
    typed = points(t).join(t.read("part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    area = F.when(F.col("best") >= 2, F.col("best")).otherwise(F.lit(0.0))
    pixels = typed.select("lon", "lat", *[F.when(F.col("p_type") == c, area).otherwise(F.lit(0.0)).alias(c) for c in _TYPES])
    mix = spatial_layers.crop_mix(pixels, districts(t), "district_id", "lon", "lat", 1.0, _TYPES)
    return mix.select("district_id", "crop", "area", "share")


@query(
    "tile_mosaic",
    "SRC-14 SRC-13",
    f"""with tl as (select cast(floor(lon / {GRID}) as bigint) as cx, cast(floor(lat / {GRID}) as bigint) as cy, kind, sum(best) / count(best) as m
      from ({POINTS_SQL}) group by 1, 2, 3)
    select cx, cy, arg_min(case when m <= 27 then m end, kind) filter (where m <= 27) as value from tl group by 1, 2""",
)
def tile_mosaic(t: Tables):
    gridded = points(t).withColumns({"cx": spatial.cell(F.col("lon"), GRID), "cy": spatial.cell(F.col("lat"), GRID)})
    tiles = gridded.groupBy("cx", "cy", "kind").agg((F.sum("best") / F.count("best")).alias("m"))
    return spatial.mosaic(tiles.withColumn("value", F.when(F.col("m") <= 27, F.col("m"))), "value", "kind")


@query(
    "near_duplicate_sites",
    "WIN-3",
    f"""select round(lon, 6) as lon, round(lat, 6) as lat from (select lon, lat, row_number() over (partition by round(lon, 3), round(lat, 3) order by lon, lat) as rn
      from ({POINTS_SQL})) where rn = 1""",
)
def near_duplicate_sites(t: Tables):
    return select.near_duplicates(points(t).select("lon", "lat"), "lon", "lat").select(F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query(
    "two_source_presence",
    "SET-5",
    f"""with u as (select district_id, count(*) as n from ({PLACED_SQL}) where district_id is not null and kind = 'A' group by 1),
    m as (select district_id, count(*) as n from ({PLACED_SQL}) where district_id is not null and kind = 'R' group by 1)
    select s.district_id, case when s.region = 'AFRICA' then coalesce(u.n, 0) else coalesce(m.n, 0) end as n_gold,
      (coalesce(u.n, 0) > 0 or coalesce(m.n, 0) > 0)::integer as has_gold
    from ({SPINE_SQL}) s left join u on s.district_id = u.district_id left join m on s.district_id = m.district_id""",
)
def two_source_presence(t: Tables):
    big = points(t).filter(F.col("kind").isin("A", "R"))
    hits = spatial.points_to_polygons(big, districts(t), "district_id", "lon", "lat", 1.0, "inner")
    found = spatial_layers.two_source_presence(t.spine, hits, "kind", "A", "R", "district_id", F.col("region") == "AFRICA", "gold")
    return found.select("district_id", "n_gold", "has_gold")


BOW = [(0.1, 0.1), (0.9, 0.8), (0.9, 0.1), (0.1, 0.6), (0.1, 0.1)]
NEST = [OUTER, HOLE, [(0.35, 0.35), (0.45, 0.35), (0.45, 0.45), (0.35, 0.45), (0.35, 0.35)], [(0.38, 0.38), (0.42, 0.38), (0.42, 0.42), (0.38, 0.42), (0.38, 0.38)], ISLAND]


def flawed_rings(t: Tables) -> DataFrame:
    """A ring for every district; the account balance decides what is wrong with it."""
    full = _ring("s_suppkey", BOX)
    x, y = _corner("s_suppkey")
    line = F.array(*[F.struct((x + d).alias("x"), (y + d).alias("y")) for d in (0.0, 0.5, 1.0, 0.0)])
    broken = (
        F.when(F.col("s_acctbal") < 0, line)
        .when(F.col("s_acctbal") >= 9000, F.slice(full, 1, 3))
        .when(F.col("s_acctbal") >= 8000, F.slice(full, 1, 4))
        .when(F.col("s_acctbal") >= 5000, _ring("s_suppkey", BOW))
        .otherwise(full)
    )
    return t.read("supplier").select(F.col("s_suppkey").alias("district_id"), broken.alias("ring"))


@query(
    "ring_faults",
    "SP-9",
    """select s_suppkey as district_id, 'zero area' as fault from supplier where s_acctbal < 0
    union all select s_suppkey, 'too few points' from supplier where s_acctbal >= 9000
    union all select s_suppkey, 'not closed' from supplier where s_acctbal >= 8000 and s_acctbal < 9000
    union all select s_suppkey, 'self-crossing' from supplier where s_acctbal >= 5000 and s_acctbal < 8000""",
)
def ring_faults(t: Tables):
    return rings.faults(flawed_rings(t), ["district_id"]).select("district_id", "fault")


@query(
    "ring_crossings",
    "SP-9",
    f"""select s_suppkey as district_id, 1::bigint as crossings, round(s_suppkey % {WIDE} + 0.65 / 1.5, 6)::double as x,
      round(floor(s_suppkey / {WIDE}) + 0.1 + 0.875 * (0.65 / 1.5 - 0.1), 6)::double as y
    from supplier where s_acctbal >= 5000 and s_acctbal < 8000""",
)
def ring_crossings(t: Tables):
    return rings.crossings(flawed_rings(t).filter(F.size("ring") > 4), ["district_id"]).select("district_id", "crossings", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(
    "ring_parts",
    "SP-9",
    f"""select s_suppkey as district_id, number, depth::bigint as depth, parent::double as parent, is_hole, part
    from supplier, (values (0, 0, null, false, 0), (1, 1, 0, true, 0), (2, 2, 1, false, 2), (3, 3, 2, true, 2), (4, 0, null, false, 4)) as v(number, depth, parent, is_hole, part)
    where number <> 3 or s_suppkey % 2 = 0""",
)
def ring_parts(t: Tables):
    each = F.array(*[F.struct(F.lit(k).alias("number"), _ring("s_suppkey", shape).alias("ring")) for k, shape in enumerate(NEST)])
    flat = t.read("supplier").select(F.col("s_suppkey").alias("district_id"), F.inline(each)).filter("number <> 3 or district_id % 2 = 0")
    return rings.parts(flat, "district_id", "number", 1.0).select("district_id", "number", "depth", F.col("parent").cast("double").alias("parent"), "is_hole", "part")


@query(
    "alignment_band",
    "SP-8 FN-15",
    f"select round(avg(value), 6) as mean, (avg(value) between 15 and 35) as ok from ({CELLS_SQL}) where (cx + 0.5) * {GRID} between 2 and 12 and (cy + 0.5) * {GRID} between 0 and 3",
)
def alignment_band(t: Tables):
    return spatial_layers.alignment(cells(t), "value", GRID, (2, 0, 12, 3), (15, 35)).withColumn("mean", F.round("mean", 6))
