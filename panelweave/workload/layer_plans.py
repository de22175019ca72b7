"""The layer plans themselves, over given tables bound to the columns that their sources have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.functions import geo
from panelweave.operators import checks, joins, spatial
from panelweave.plans import country_layers, district_layers, spatial_layers
from panelweave.workload.base import FACTS_SQL, SPINE_SQL, YEARLY_SQL, Tables, query
from panelweave.workload.spatial import BOX, CELLS_SQL, INSIDE_SQL, PLACED_SQL, POINTS_SQL, WEIGHTS_SQL, WIDE, boxes, cells, districts, points, weights

LINES_SQL = POINTS_SQL.replace("l_quantity as best,", "l_quantity as best, l_orderkey, l_linenumber, l_suppkey,")
LOCATED_SQL = PLACED_SQL.replace(POINTS_SQL, LINES_SQL)


def events(t: Tables) -> DataFrame:
    """Lines as located events with an id, a kind and numbers that may be text."""
    lines = points(t, "l_orderkey", "l_linenumber", "l_suppkey")
    return lines.withColumn("event", F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "kind", "year", "best")]))


@query(
    "market_access",
    "AGG-11 SP-3",
    f"""with i as (select district_id, value as v, sum(w) as w from (select cx, cy, value from ({CELLS_SQL}) where year = 1998) c join ({WEIGHTS_SQL}) w on c.cx = w.cx and c.cy = w.cy
      where value is not null group by 1, 2),
    j as (select district_id, v, cast(w / max(w) over (partition by district_id) as decimal(38,12)) as w from i),
    r as (select *, sum(w) over (partition by district_id order by v) as run, sum(w) over (partition by district_id) as tot from j),
    m as (select district_id, min(v) filter (where run::double >= tot::double * 0.5) as median, sum(v * w::double) / sum(w::double) as mean from r group by 1)
    select s_suppkey as district_id, round(median, 6) as travel_time_median, round(mean, 6) as travel_time_mean, round(ln(1 + median), 6) as travel_time_log1p, 1998 as snapshot_year
    from supplier left join m on m.district_id = s_suppkey""",
)
def market_access(t: Tables):
    tile = cells(t).filter("year = 1998").drop("year")
    geom = boxes(t, "supplier", "s_suppkey", BOX, "district_id")
    out = spatial_layers.market_access(tile, weights(t), geom, "district_id", "value", 1998)
    return out.select("district_id", *[F.round(c, 6).alias(c) for c in ("travel_time_median", "travel_time_mean", "travel_time_log1p")], "snapshot_year")


_TYPES = {"A": "Battles", "N": "Protests", "R": "Riots"}
_TYPE_SQL = "case kind when 'A' then 'Battles' when 'N' then 'Protests' else 'Riots' end"


@query(
    "unrest_layer",
    "DOM-1 AGG-1 PRJ-6",
    f"""select district_id, year, count(*) as acled_events_total, count(*) filter (kind = 'A') as acled_events_battles, count(*) filter (kind = 'N') as acled_events_protests,
      count(*) filter (kind = 'R') as acled_events_riots, 0::bigint as acled_events_vac, 0::bigint as acled_events_explosions, 0::bigint as acled_events_strategic, sum(best)::bigint as acled_fatalities
    from (select distinct lon, lat, year, kind, best, l_orderkey, l_linenumber, l_suppkey, l_partkey, district_id from ({LOCATED_SQL}))
    where district_id is not null and l_linenumber % 3 <> 2 group by 1, 2""",
)
def unrest_layer(t: Tables):
    """Every line is there twice, as a source repeats an event; a third is too imprecise to locate."""
    kind = F.col("kind")
    raw = events(t).select(
        F.col("event").alias("event_id_cnty"), F.when(kind == "A", "Battles").when(kind == "N", "Protests").otherwise("Riots").alias("event_type"),
        F.lit("ISO").alias("iso"), F.concat(F.col("year").cast("string"), F.lit("-06-15")).alias("event_date"),
        F.col("lat").cast("string").alias("latitude"), F.col("lon").cast("string").alias("longitude"),
        (F.col("l_linenumber") % 3 + 1).cast("string").alias("geo_precision"), F.col("best").cast("bigint").cast("string").alias("fatalities"),
    )
    wide, _ = district_layers.unrest_events(district_layers.tidy_unrest(raw.union(raw)), districts(t), 1.0)
    return wide


@query(
    "trap_layer",
    "AGG-4 FN-7",
    f"""with g as (select district_id, year, count(*) as checks, sum(case when kind = 'A' then best else 0 end) as confirmed, sum(best) as suspected from ({LOCATED_SQL}) where district_id is not null group by 1, 2)
    select district_id, year, checks as "faw_n_trap_checks", confirmed::double as "faw_confirmed_sum", suspected::double as "faw_suspconf_sum", (confirmed > 0)::integer as "faw_present",
      round(confirmed::double / checks, 6) as "faw_catch_rate" from g""",
)
def trap_layer(t: Tables):
    raw = events(t).select(
        F.col("event").alias("id"), F.col("lat").cast("string").alias("lat"), F.col("lon").cast("string").alias("long"), F.concat(F.col("year").cast("string"), F.lit("-01-02")).alias("date"),
        F.when(F.col("kind") == "A", F.col("best").cast("string")).alias("faw_confirmed_count"), F.col("best").cast("string").alias("faw_suspected_plus_confirmed_count"),
    )
    return district_layers.traps(raw, districts(t), 1.0).withColumn("faw_catch_rate", F.round("faw_catch_rate", 6))


@query(
    "swarm_layer",
    "SET-2 AGG-2",
    f"""with g as (select district_id, year, count(*) filter (kind = 'A') as s, count(*) filter (kind = 'R') as b, sum(case when kind = 'A' then best else 0 end)::double as ha
      from ({LOCATED_SQL}) where district_id is not null and kind in ('A', 'R') group by 1, 2)
    select district_id, year, s as dl_swarm_obs, b as dl_band_obs, ha as dl_area_treated_ha, s + b as dl_gregarious_obs, 1 as dl_present_flag from g""",
)
def swarm_layer(t: Tables):
    """Two files; that of the bands has no treated area."""
    seen = events(t).select("kind", F.col("lat").cast("string").alias("lat"), F.col("lon").cast("string").alias("lon"), F.concat(F.col("year").cast("string"), F.lit("-03-04")).alias("start_date"), "best")
    swarms = seen.filter("kind = 'A'").select("lat", "lon", "start_date", F.lit("SWARM").alias("category"), F.col("best").cast("string").alias("area_treated_in_ha"))
    bands = seen.filter("kind = 'R'").select("lat", "lon", "start_date", F.lit("BAND").alias("category"))
    return district_layers.swarms([swarms, bands], districts(t), 1.0)


@query(
    "regime_bridge",
    "JN-13 WIN-1",
    f"""with n as (select n_nationkey as k, n_name as iso3 from nation),
    s as (select k, y::integer as year, ((k * 7 + y) % 21 - 10)::double as polity2 from (select k, unnest(generate_series(1990, 2005)) as y from n)),
    c as (select case when k >= 20 then (select iso3 from n where n.k = s.k - 20) else (select iso3 from n where n.k = s.k) end as iso3, year, polity2, k < 20 as late from s where year between 1996 and 1999)
    select iso3, year, polity2, (abs(polity2) <= 5)::integer::double as anocracy_flag from (select *, row_number() over (partition by iso3, year order by late) as rn from c) where rn = 1""",
)
def regime_bridge(t: Tables):
    """State codes to countries; the last five codes are successors whose override wins the years both report."""
    nation = t.read("nation").select(F.col("n_nationkey").alias("ccode"), F.col("n_name").alias("iso3"))
    yearly = nation.select("ccode", F.explode(F.sequence(F.lit(1990), F.lit(2005))).alias("year"))
    scores = yearly.withColumn("polity2", (F.col("ccode") * 7 + F.col("year")) % 21 - 10)
    overrides = nation.select((F.col("ccode") + 20).alias("ccode"), "iso3").filter("ccode <= 24")
    return country_layers.polity(scores, nation, overrides, (1996, 1999))


_COUP_SQL = f"""select iso3, year, d % 3 as a, (d + year) % 3 as b from (select s.iso3, f.year, s.district_id as d from ({SPINE_SQL}) s join (select distinct district_id, year from ({FACTS_SQL})) f on s.district_id = f.district_id)"""


@query(
    "coup_counts",
    "DOM-12 PRJ-9 FLT-2",
    f"""select iso3, year, sum((a > 0)::integer + (b > 0)::integer)::bigint as coups_total, sum((a = 2)::integer + (b = 2)::integer)::bigint as coups_successful,
      sum((a = 1)::integer + (b = 1)::integer)::bigint as coups_failed from ({_COUP_SQL}) where a > 0 or b > 0 group by 1, 2""",
)
def coup_counts(t: Tables):
    seen = t.facts.select("district_id", "year").distinct().join(t.spine.select("district_id", "iso3"), "district_id")
    slots = seen.select(
        F.concat(F.lit('"'), "iso3", F.lit('"')).alias("country"), F.col("year").cast("string").alias("year"),
        (F.col("district_id") % 3).cast("string").alias("coup1"), ((F.col("district_id") + F.col("year")) % 3).cast("string").alias("coup2"),
    )
    crosswalk = t.read("nation").select(F.col("n_name").alias("country"), F.col("n_name").alias("iso3"))
    out = country_layers.coup_counts(slots, crosswalk, ["coup1", "coup2"], (1900, 2100))
    return out.select("iso3", "year", *[F.col(c).cast("bigint").alias(c) for c in ("coups_total", "coups_successful", "coups_failed")])


_ITEMS = [1717, 15, 27]
_PRODUCTION_SQL = f"""select s.iso3, f.year, case f.kind when 'A' then 1717 when 'N' then 15 else 27 end as item_code,
    case f.l_linestatus when 'F' then 'Production' else 'Yield' end as element, sum(f.best)::double as value
  from ({FACTS_SQL}) f join ({SPINE_SQL}) s on s.district_id = f.district_id group by 1, 2, 3, 4"""


def _production(t: Tables) -> DataFrame:
    """Production records: country codes, units and values as text, with an element and a country nobody asked for."""
    lines = t.facts.join(t.spine.select("district_id", "iso3"), "district_id").join(t.read("nation").select(F.col("n_name").alias("iso3"), "n_nationkey"), "iso3")
    item = F.when(F.col("kind") == "A", 1717).when(F.col("kind") == "N", 15).otherwise(27)
    sums = lines.groupBy("n_nationkey", "year", item.alias("item"), "l_linestatus").agg(F.sum("best").alias("v"))
    made = F.col("l_linestatus") == "F"
    raw = sums.select(
        F.concat(F.lit("'"), F.format_string("%03d", F.col("n_nationkey") + 1)).alias("Area Code (M49)"), F.col("year").cast("string").alias("Year"),
        F.col("item").cast("string").alias("Item Code"), F.concat(F.lit("item "), "item").alias("Item"), F.when(made, "5510").otherwise("5412").alias("Element Code"),
        F.when(made, "t").otherwise("kg/ha").alias("Unit"), F.col("v").cast("string").alias("Value"),
    )
    return raw.union(raw.withColumns({"Element Code": F.lit("1"), "Unit": F.lit("?")})).union(raw.withColumn("Area Code (M49)", F.lit("'999")))


def _m49(t: Tables) -> DataFrame:
    return t.read("nation").select((F.col("n_nationkey") + 1).cast("int").alias("m49"), F.col("n_name").alias("iso3"))


@query(
    "production_long",
    "DOM-11 FLT-3",
    f"""select iso3, year, item_code, 'item ' || item_code as item, element, case element when 'Production' then 't' else 'kg/ha' end as unit, value,
      (item_code = 1717)::integer as is_aggregate from ({_PRODUCTION_SQL})""",
)
def production_long(t: Tables):
    return country_layers.production_long(_production(t), _m49(t)).select("iso3", "year", "item_code", "item", "element", "unit", "value", "is_aggregate")


@query(
    "production_wide",
    "DOM-11 PRJ-6",
    f"""select iso3, year, max(value) filter (item_code = 1717 and element = 'Production') as fao_cereal_prod_t, max(value) filter (item_code = 1717 and element = 'Yield') as fao_cereal_yield_kgha,
      max(value) filter (item_code = 15 and element = 'Production') as fao_wheat_prod_t, max(value) filter (item_code = 27 and element = 'Yield') as fao_rice_yield_kgha
    from ({_PRODUCTION_SQL}) group by 1, 2""",
)
def production_wide(t: Tables):
    wide = country_layers.production_wide(country_layers.production_long(_production(t), _m49(t)))
    return wide.select("iso3", "year", "fao_cereal_prod_t", "fao_cereal_yield_kgha", "fao_wheat_prod_t", "fao_rice_yield_kgha")


_UNIT, _NEXT = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)], [(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0), (1.0, 0.0)]


@query(
    "touching_footprints",
    "JN-18",
    f"""select s_suppkey as district_id, c_custkey from supplier join customer
      on s_suppkey % {WIDE} - c_custkey % {WIDE} between 0 and 2 and floor(s_suppkey / {WIDE}) - floor(c_custkey / {WIDE}) between -1 and 1""",
)
def touching_footprints(t: Tables):
    """Unit squares against unit squares one to the east: most pairs share only a side or a corner."""
    ours, theirs = boxes(t, "supplier", "s_suppkey", _UNIT, "district_id"), boxes(t, "customer", "c_custkey", _NEXT, "c_custkey")
    return spatial.intersecting(ours, theirs, "district_id", "c_custkey", 1.0)


@query(
    "inside_points",
    "FN-15",
    "select s_suppkey as district_id, true as inside from supplier",
)
def inside_points(t: Tables):
    """A point of each district, located again with the districts' own rule."""
    point = geo.inside_point(F.col("edges"))
    found = districts(t).select(F.col("district_id").alias("of"), point.alias("p")).select("of", F.col("p.x").alias("lon"), F.col("p.y").alias("lat"))
    located = spatial.points_to_polygons(found, districts(t), "district_id", "lon", "lat", 1.0)
    return located.select(F.col("of").alias("district_id"), (F.col("of") == F.col("district_id")).alias("inside"))


_HALF = "(select max(s_suppkey) // 2 from supplier)"


@query(
    "successor_codes",
    "FLT-13",
    f"""with c as (select case when (district_id <= {_HALF}) = (year < 1998) then district_id + 2 * {_HALF} + 1 else district_id end as code, year, n from ({YEARLY_SQL}))
    select case when code > {_HALF} and code <= 2 * {_HALF} + 1 then code - {_HALF} else code end as district_id, year, n from c""",
)
def successor_codes(t: Tables):
    """The upper half of the spine are former codes that report until 1997, the lower half their successors from then on.

    Everyone's reports of the other years go under codes of their own, which nobody succeeds.
    """
    d, half = F.col("district_id"), F.floor(t.spine.agg(F.max("district_id")).scalar() / 2)
    apart = (d <= half) == (F.col("year") < 1998)
    coded = t.yearly.select(F.when(apart, d + 2 * half + 1).otherwise(d).alias("district_id"), "year", "n")
    former = t.spine.filter(d > half).select("district_id", (d - half).alias("successor"))
    return joins.successor_codes(coded, former, "district_id", "year")


@query(
    "coverage_checks",
    "VAL-6 VAL-14 VAL-15",
    f"""with y as (select *, case when year >= 1999 then n end as late, case when year < 0 then n end as never from ({YEARLY_SQL})),
    e as (select c, (floor((year - 1990) / 5) * 5 + 1990)::int as era, count(v) as k from (
      select year, unnest(['n', 'late']) as c, unnest([n, late]) as v from y) group by 1, 2),
    g as (select e.*, (c = 'late' and era = 1990) as told from e)
    select 'coverage' as grp, c || ' has values' as name, case when v = 0 then 'PASS' else 'FAIL' end as status, v::bigint as violations from (
      select 'n' as c, (count(n) = 0)::int as v from y union all select 'late', (count(late) = 0)::int from y union all select 'never', (count(never) = 0)::int from y)
    union all select 'coverage', 'every empty era is documented', case when count(*) filter (k = 0 and not told) = 0 then 'PASS' else 'FAIL' end, count(*) filter (k = 0 and not told) from g
    union all select 'coverage', 'every documented gap is empty', case when count(*) filter (k > 0 and told) = 0 then 'PASS' else 'FAIL' end, count(*) filter (k > 0 and told) from g
    union all select 'coverage', 'columns documented', 'FAIL', 2""",
)
def coverage_checks(t: Tables):
    yearly = t.yearly.withColumns({"late": F.when(F.col("year") >= 1999, F.col("n")), "never": F.when(F.col("year") < 0, F.col("n"))})
    gaps = t.spark.createDataFrame([("late", 1990)], "column string, era int")
    words = t.spark.createDataFrame([("{district_id,year}",), ("n",), ("{value,other}",)], "column string")
    return checks.report(
        checks.some_known(yearly, "coverage", ["n", "late", "never"]),
        checks.gaps_documented(yearly, "coverage", ["n", "late"], 1990, 5, gaps),
        checks.documented(yearly, "coverage", "columns documented", words),
    )
