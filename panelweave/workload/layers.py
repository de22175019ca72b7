"""Queries through the panel assembly and the layer plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.functions import dates, numeric, text
from panelweave.operators import aggregate, frame, spatial, stats
from panelweave.plans import panel as pn
from panelweave.plans import spatial_layers
from panelweave.session import stage
from panelweave.workload import spatial as sp
from panelweave.workload.analytics import FAMILIES, MEASURES, PANEL_SQL, panel
from panelweave.workload.base import FIRST, FRAME_SQL, LAST, SEVERE_SQL, Tables, mean_cents, mean_cents_sql, query


@query("assembled_panel", "DOM-1 JN-1 JN-2 JN-3 JN-4 JN-5 JN-7 JN-8 ORD-2", PANEL_SQL)
def assembled_panel(t: Tables):
    """The panel, finished: written once and read back."""
    return stage(panel(t))


@query(
    "study_panel",
    "DOM-5 DOM-6 DOM-7 FLT-6 FLT-11 PRJ-16 PRJ-17",
    f"""with kept as (select n_name as iso3, case when r_name = 'AMERICA' then n_name else r_name end as area from nation join region on n_regionkey = r_regionkey),
    first as (select district_id, min(case when kind = 'A' then year end) as first_year from ({SEVERE_SQL}) where year <= {LAST} group by 1)
    select f.district_id, f.iso3, f.year, k.area as region, o.n_status_f::double as n_status_f, c.mean_balance,
      case when k.area = 'AFRICA' then a.first_year::double end as first_year,
      case when k.area = 'AFRICA' then (f.year - a.first_year)::double end as years_since,
      case when k.area = 'AFRICA' then (f.year >= a.first_year)::integer::double end as arrived
    from (select district_id, iso3, year from ({FRAME_SQL})) f join kept k on f.iso3 = k.iso3 and k.area in ('AFRICA', 'ASIA')
    left join (select n_name as iso3, cast(year(o_orderdate) as integer) as year, count(*) filter (where o_orderstatus = 'F') as n_status_f
      from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2) o on f.iso3 = o.iso3 and f.year = o.year
    left join (select n_name as iso3, {mean_cents_sql('c_acctbal')} as mean_balance from customer join nation on c_nationkey = n_nationkey group by 1) c on f.iso3 = c.iso3
    left join first a on f.district_id = a.district_id""",
)
def study_panel(t: Tables):
    nation = t.read("nation").join(t.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    crosswalk = nation.select(F.col("n_name").alias("iso3"), F.col("r_name").alias("continent"), F.col("n_name").alias("unregion"))
    regions = pn.regions(crosswalk, ["AFRICA", "ASIA"], split="AMERICA")
    base = frame.dense_frame(t.spine.select("district_id", "iso3"), FIRST, LAST)
    study = pn.study_subset(base, regions).drop("continent")
    orders = t.read("orders").join(t.read("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    status = orders.groupBy(F.col("n_name").alias("iso3"), F.year("o_orderdate").alias("year")).agg(F.count_if(F.col("o_orderstatus") == "F").cast("double").alias("n_status_f"))
    people = t.read("customer").join(t.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    balance = people.groupBy(F.col("n_name").alias("iso3")).agg(mean_cents("c_acctbal").alias("mean_balance"))
    first = pn.arrival(t.severe, F.col("kind") == "A", LAST, "first_year")
    rich = pn.enrich(study, [pn.Layer("status", status, "country_year", checked=True), pn.Layer("people", balance, "country", checked=True), pn.Layer("arrival", first, "district", checked=True)])
    timed = pn.arrival_clock(rich, "first_year", "years_since", "arrived")
    return pn.mask_region(timed, "AFRICA", ["first_year", "years_since", "arrived"])


@query(
    "zonal_guard",
    "SP-12 VAL-9",
    f"""select 'zonal' as grp, 'unknown iff uncovered' as name, case when v = 0 then 'PASS' else 'FAIL' end as status, v as violations from (
      select count(*) filter (where (mean is null) <> (cnt = 0)) as v from (
        select f.district_id, f.year, z.mean, coalesce(z.cnt, 0.0) as cnt from ({FRAME_SQL}) f left join (
          select district_id, year, sum(value * w) / sum(w) as mean, sum(w) as cnt from ({sp.CELLS_SQL}) c
          join ({sp.WEIGHTS_SQL}) w on c.cx = w.cx and c.cy = w.cy where value is not null group by 1, 2) z
        on f.district_id = z.district_id and f.year = z.year))""",
)
def zonal_guard(t: Tables):


    base = frame.dense_frame(t.spine.select("district_id"), FIRST, LAST)
    stats_ = spatial.zonal_stats(sp.cells(t), sp.weights(t), "district_id", "value", ["year"], base)
    return spatial_layers.coverage_guard(stats_, "unknown iff uncovered")


@query(
    "slugged_names",
    "FN-2 FN-3 FN-4 PRJ-1",
    """select p_name, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as slug, count(*) as n,
      max(p_brand) as unit from part group by p_name""",
)
def slugged_names(t: Tables):
    named = t.read("part").groupBy("p_name").agg(F.count(F.lit(1)).alias("n"), F.max("p_brand").alias("b"))
    marked = named.withColumns({"raw": F.concat(F.translate("p_name", "aeo", "áèö"), F.lit(" **")), "unit": text.unwrap(F.concat(F.lit("("), "b", F.lit(")")))})
    slugged = text.with_slug(marked.withColumn("clean", text.strip_footnote(F.col("raw"))), "clean", "slug")
    return slugged.select("p_name", "slug", "n", "unit")


@query(
    "years_from_text",
    "FN-7 FN-8 FN-9 SRC-8",
    """select cast(year(o_orderdate) as integer) as year, count(*) as n, count(*) filter (where o_orderstatus = 'F') as n_dated,
      max(case when year(o_orderdate) % 100 >= 89 then 1900 + year(o_orderdate) % 100 else 2000 + year(o_orderdate) % 100 end)::integer as fiscal
    from orders group by 1""",
)
def years_from_text(t: Tables):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    worded = t.read("orders").select(
        F.when(F.col("o_orderstatus") == "F", day).otherwise("no date").alias("reported"), day.alias("projected"),
        F.concat(F.lit("FY"), F.date_format("o_orderdate", "yy")).alias("label"), F.lit(None).cast("string").alias("missing"),
    )
    return worded.groupBy(dates.first_date("missing", "projected").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count(dates.year_of(F.col("reported"))).alias("n_dated"), F.max(dates.fiscal_year(F.col("label"))).alias("fiscal")
    )


@query(
    "column_dictionary",
    "ANA-9 ANA-10 AGG-14 AGG-12",
    "select * from (" + " union all ".join(
        f"select '{c}' as column, '{layer}' as layer, 'known as {c}' as definition, round(count({c}) * 100.0 / count(*), 6) as pct, count(distinct {c}) as n_distinct from ({PANEL_SQL})"
        for c, layer in zip(MEASURES, ["Counts", "Counts", "Unrest", "World", "World", "Other", "Other"])
    ) + ") where contains(definition, 'wb') or contains(definition, 'events')",
)
def column_dictionary(t: Tables):
    data = stage(panel(t))  # written once, then read by each part of the profile
    words = t.spark.createDataFrame([(c, f"known as {c}") for c in MEASURES], "column string, definition string")
    profiled = stats.profile(data, MEASURES)
    found = stats.dictionary(profiled, words, FAMILIES, "WB").unionByName(stats.dictionary(profiled, words, FAMILIES, "events"))
    return found.withColumn("pct", F.round("pct", 6))


@query(
    "country_profile",
    "ANA-5 AGG-22",
    f"select year, cast(sum(n_events_total) as bigint) as n_events_total, round(avg(wb_gdp), 6) as wb_gdp from ({PANEL_SQL}) where iso3 = 'NATION_3' group by 1",
)
def country_profile(t: Tables):
    mine = panel(t).filter(F.col("iso3") == "NATION_3")
    rules = {c: aggregate.rollup_rule(c, ["wb_gdp"]) for c in ("n_events_total", "wb_gdp")}
    return aggregate.rollup(mine, ["year"], rules).withColumn("wb_gdp", F.round("wb_gdp", 6))


@query(
    "two_metric_correlation",
    "ANA-1 FN-10 FN-11",
    f"""select round(corr(ln(1 + e), g), 6) + 0.0 as r, count(*) as n from (
      select iso3, year, sum(n_events_total) as e, avg(wb_gdp) as g from ({PANEL_SQL}) group by 1, 2) where e is not null and g is not null""",
)
def two_metric_correlation(t: Tables):
    yearly = aggregate.rollup(panel(t), ["iso3", "year"], {"n_events_total": "sum", "wb_gdp": "mean"})
    pair = yearly.select(F.log1p("n_events_total").alias("x"), numeric.finite(F.col("wb_gdp")).alias("y")).na.drop()
    return pair.agg((F.round(F.corr("x", "y"), 6) + 0.0).alias("r"), F.count(F.lit(1)).alias("n"))


