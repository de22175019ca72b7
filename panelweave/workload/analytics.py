"""Roll-ups, profiles, correlations and regression over the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.operators import aggregate, frame, stats
from panelweave.plans import panel as pn
from panelweave.workload.base import FACTS_SQL, FIRST, FRAME_SQL, LAST, NATIONAL_SQL, SEVERE_SQL, SPINE_SQL, Tables, mean_cents_sql, query

# A small wide panel: zero-filled counts, a masked count, a national series and a mean.
PANEL_SQL = f"""select f.district_id, f.iso3, f.region, f.year, coalesce(e.n_events_total, 0) as n_events_total,
    coalesce(e.deaths_best, 0.0) as deaths_best,
    case when u.unrest is not null then u.unrest when f.year between s.a and s.b then 0.0 end as acled_events_total,
    n.gdp as wb_gdp, n.n_orders::double as wb_orders, e.yield as yield_mean, c.area as cropland_ha
  from ({FRAME_SQL}) f
  left join (select district_id, year, count(*) as n_events_total, sum(best) as deaths_best, {mean_cents_sql('case when l_discount < 0.05 then l_extendedprice end')} as yield from ({FACTS_SQL}) where l_tax <= 0.06 group by 1, 2) e on f.district_id = e.district_id and f.year = e.year
  left join (select district_id, year, count(*)::double as unrest from ({SEVERE_SQL}) group by 1, 2) u on f.district_id = u.district_id and f.year = u.year
  left join (select iso3, min(year) as a, max(year) as b from ({SEVERE_SQL}) join ({SPINE_SQL}) using (district_id) group by 1) s on f.iso3 = s.iso3
  left join ({NATIONAL_SQL}) n on f.iso3 = n.iso3 and f.year = n.year
  left join (select l_suppkey as district_id, sum(l_quantity) as area from lineitem join part on l_partkey = p_partkey where p_type in ('ECONOMY', 'PROMO') group by 1) c on f.district_id = c.district_id"""
MEASURES = ["n_events_total", "deaths_best", "acled_events_total", "wb_gdp", "wb_orders", "yield_mean", "cropland_ha"]


def panel(t: Tables):
    out = pn.assemble(t.spine.select("district_id", "iso3", "region"), FIRST, LAST, layers(t))
    return pn.ordered_panel(out, ["district_id", "iso3", "region", "year", *MEASURES])


def layers(t: Tables) -> list[pn.Layer]:
    yearly, key = t.district_years, ["district_id", "year"]
    unrest = yearly.select(*key, "acled_events_total").na.drop()
    span = frame.observed_span(unrest.join(t.spine, "district_id"), "iso3")
    area = t.crops.filter(F.col("crop").isin("ECONOMY", "PROMO")).groupBy("district_id").agg(F.sum("area").alias("cropland_ha"))
    national = t.national.select("iso3", "year", F.col("gdp").alias("wb_gdp"), F.col("n_orders").cast("double").alias("wb_orders"))
    return [
        pn.Layer("events", yearly.select(*key, "n_events_total", "deaths_best"), "district_year", policy="zero", checked=True),
        pn.Layer("unrest", unrest, "district_year", policy="mask", span=span, checked=True),
        pn.Layer("national", national, "country_year", checked=True),
        pn.Layer("prices", yearly.select(*key, "yield_mean"), "district_year", checked=True),
        pn.Layer("crops", area, "district", checked=True),
    ]


@query("wide_panel", "DOM-1 DOM-6 JN-2 JN-3 JN-4 JN-5 JN-7 JN-8", PANEL_SQL)
def wide_panel(t: Tables):
    return panel(t)


@query(
    "country_rollup_typed",
    "AGG-22 AGG-24 ANA-4 ANA-5",
    f"""select iso3, year, cast(sum(n_events_total) as bigint) as n_events_total, round(coalesce(sum(acled_events_total), 0), 6) as acled_events_total,
      round(avg(wb_gdp), 6) as wb_gdp, round(avg(yield_mean), 6) as yield_mean, coalesce(sum(cropland_ha), 0.0) as cropland_ha
    from ({PANEL_SQL}) group by 1, 2""",
)
def country_rollup_typed(t: Tables):
    columns = ["n_events_total", "acled_events_total", "wb_gdp", "yield_mean", "cropland_ha"]
    rules = {c: aggregate.rollup_rule(c, ["wb_gdp"]) for c in columns}
    out = aggregate.rollup(panel(t), ["iso3", "year"], rules)
    return out.withColumns({
        "acled_events_total": F.round("acled_events_total", 6), "wb_gdp": F.round("wb_gdp", 6), "yield_mean": F.round("yield_mean", 6),
    })


@query(
    "country_rollup_families",
    "AGG-9 AGG-20 AGG-21 AGG-23",
    f"""select iso3, year, cast(sum(n_events_total) as bigint) as n_events_total, sum(acled_events_total) as acled_events_total,
      round(sum(yield_mean * coalesce(cropland_ha, 0)) / nullif(sum(case when yield_mean is not null then coalesce(cropland_ha, 0) end), 0), 4) as yield_mean,
      arg_min(wb_gdp, district_id) filter (where wb_gdp is not null) as wb_gdp
    from ({PANEL_SQL}) group by 1, 2""",
)
def country_rollup_families(t: Tables):
    rules = {"n_events_total": "sum_known", "acled_events_total": "sum_known", "yield_mean": "wmean:cropland_ha", "wb_gdp": "first"}
    out = aggregate.rollup(panel(t), ["iso3", "year"], rules, order="district_id")
    return out.withColumn("yield_mean", F.round("yield_mean", 4))


@query(
    "broadcast_columns",
    "AGG-24 VAL-20",
    "select * from (" + " union all ".join(
        f"select '{c}' as column, coalesce(bool_and(m <= 1), true) as constant from (select iso3, year, count(distinct {c}) as m from ({PANEL_SQL}) group by 1, 2)"
        for c in MEASURES
    ) + ")",
)
def broadcast_columns(t: Tables):
    return aggregate.constant_within(panel(t), ["iso3", "year"], MEASURES)


@query(
    "column_coverage",
    "AGG-14 SNK-5 VAL-6",
    "select * from (" + " union all ".join(f"select '{c}' as column, count({c}) as known, round(count({c}) * 100.0 / count(*), 6) as pct from ({PANEL_SQL})" for c in MEASURES) + ")",
)
def column_coverage(t: Tables):
    return stats.coverage(panel(t), MEASURES).withColumn("pct", F.round("pct", 6))


FAMILIES = {"Counts": ["n_events", "deaths_"], "Unrest": ["acled_"], "World": ["wb_"]}


@query(
    "column_families",
    "ANA-8 ANA-10",
    "select family, count(*) as n_columns, round(avg(pct), 6) as mean_pct from (" + " union all ".join(
        f"select '{fam}' as family, count({c}) * 100.0 / count(*) as pct from ({PANEL_SQL})"
        for c, fam in zip(MEASURES, ["Counts", "Counts", "Unrest", "World", "World", "Other", "Other"])
    ) + ") group by 1",
)
def column_families(t: Tables):
    return stats.families(stats.coverage(panel(t), MEASURES), FAMILIES).withColumn("mean_pct", F.round("mean_pct", 6))


_PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"]


@query(
    "column_profile",
    "ANA-9 ANA-11 AGG-14 AGG-38",
    "select * from (" + " union all ".join(
        f"""select '{c}' as column, count({c}) as known, 100.0::double as pct, count(distinct {c}) as n_distinct, {kind}"""
        for c, kind in [
            (c, f"'numeric' as kind, min({c})::double + 0.0 as min, max({c})::double as max, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as sd, quantile_cont({c}, 0.5) as median from lineitem")
            for c in ("l_quantity", "l_extendedprice")
        ] + [
            ("l_discount", "'categorical', null, null, null, null, null from lineitem"),
            ("l_returnflag", "'categorical', null, null, null, null, null from lineitem"),
            ("l_shipdate", "'categorical', null, null, null, null, null from lineitem"),
        ]
    ) + ")",
)
def column_profile(t: Tables):
    out = stats.profile(t.read("lineitem"), _PROFILED)
    return out.withColumns({"mean": F.round("mean", 6), "sd": F.round("sd", 6)})


@query(
    "distribution",
    "AGG-15 AGG-28",
    """select count(o_totalprice) as n, round(avg(o_totalprice), 4) as mean, round(stddev_samp(o_totalprice), 4) as sd, min(o_totalprice) as min,
      max(o_totalprice) as max, round(quantile_cont(o_totalprice, 0.05), 4) as p5, round(quantile_cont(o_totalprice, 0.5), 4) as p50, round(quantile_cont(o_totalprice, 0.95), 4) as p95 from orders""",
)
def distribution(t: Tables):
    out = stats.distribution(t.read("orders"), "o_totalprice")
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "sd", "p5", "p50", "p95")})


@query(
    "grouped_quantiles",
    "AGG-15 AGG-28 AGG-38",
    """select l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) as q25, round(quantile_cont(l_extendedprice, 0.5), 4) as q50,
      round(quantile_cont(l_extendedprice, 0.75), 4) as q75 from lineitem group by 1""",
)
def grouped_quantiles(t: Tables):
    marks = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    out = aggregate.exact_quantiles(t.read("lineitem"), ["l_returnflag"], "l_extendedprice", marks)
    return out.withColumns({c: F.round(c, 4) for c in marks})


@query(
    "histogram_12",
    "AGG-27 ANA-11",
    """with b as (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders)
    select least(11, cast(floor((o_totalprice - lo) / ((hi - lo) / 12)) as bigint)) as bin, count(*) as n, min(lo) as low, min(hi) as high from orders, b group by 1""",
)
def histogram_12(t: Tables):
    return aggregate.histogram(t.read("orders"), "o_totalprice", 12)


@query(
    "histogram_by_group",
    "AGG-27",
    """with b as (select p_type, min(p_retailprice) as lo, max(p_retailprice) as hi from part group by 1)
    select p.p_type, least(39, cast(floor((p_retailprice - lo) / ((hi - lo) / 40)) as bigint)) as bin, count(*) as n, min(lo) as low, min(hi) as high
    from part p join b on p.p_type = b.p_type group by 1, 2""",
)
def histogram_by_group(t: Tables):
    return aggregate.histogram(t.read("part"), "p_retailprice", 40, ["p_type"])


@query(
    "top_values",
    "AGG-26",
    "select p_brand, count(*) as n from part group by 1 order by n desc, p_brand limit 6",
)
def top_values(t: Tables):
    return aggregate.top_values(t.read("part"), "p_brand", 6)


@query(
    "group_mean_metric",
    "AGG-25",
    "select o_orderpriority, round(avg(o_totalprice), 4) as o_totalprice from orders group by 1",
)
def group_mean_metric(t: Tables):
    return aggregate.group_metric(t.read("orders"), "o_orderpriority", "o_totalprice", "mean").withColumn("o_totalprice", F.round("o_totalprice", 4))


@query(
    "group_median_metric",
    "AGG-25 AGG-38",
    "select o_orderpriority, round(quantile_cont(o_totalprice, 0.5), 4) as o_totalprice from orders group by 1",
)
def group_median_metric(t: Tables):
    return aggregate.group_metric(t.read("orders"), "o_orderpriority", "o_totalprice", "median").withColumn("o_totalprice", F.round("o_totalprice", 4))


@query(
    "era_missingness",
    "AGG-30 VAL-14",
    "select * from (" + " union all ".join(
        f"select cast(floor((year - {FIRST}) / 5) * 5 + {FIRST} as integer) as era, '{c}' as column, round(count({c}) * 100.0 / count(*), 6) as pct_known from ({PANEL_SQL}) group by 1"
        for c in MEASURES
    ) + ")",
)
def era_missingness(t: Tables):
    return aggregate.era_missingness(panel(t), MEASURES, FIRST, 5).withColumn("pct_known", F.round("pct_known", 6))


@query(
    "header_metrics",
    "AGG-35 AGG-12",
    f"select count(*) as n_rows, count(distinct iso3) as n_countries, count(distinct year) as n_years, count(distinct district_id) as n_districts from ({PANEL_SQL})",
)
def header_metrics(t: Tables):
    return panel(t).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("iso3").alias("n_countries"),
        F.count_distinct("year").alias("n_years"), F.count_distinct("district_id").alias("n_districts"),
    )


@query(
    "global_totals",
    "ANA-7 AGG-31",
    f"select year, cast(sum(n_events_total) as bigint) as events, sum(deaths_best) as deaths, coalesce(sum(acled_events_total), 0.0) as unrest from ({PANEL_SQL}) group by 1",
)
def global_totals(t: Tables):
    return panel(t).groupBy("year").agg(
        F.sum("n_events_total").alias("events"), F.sum("deaths_best").alias("deaths"), aggregate.sum_or_zero("acled_events_total").alias("unrest")
    )


@query(
    "entity_trajectory",
    "ANA-6 VAL-16",
    f"select year, n_events_total, wb_gdp from ({PANEL_SQL}) where district_id = (select min(s_suppkey) from supplier where s_acctbal = (select max(s_acctbal) from supplier)) and year in (1995, 1997, 2001, 2003)",
)
def entity_trajectory(t: Tables):
    richest = t.read("supplier").orderBy(F.desc("s_acctbal"), "s_suppkey").limit(1).select(F.col("s_suppkey").alias("district_id"))
    return panel(t).join(richest, "district_id", "left_semi").filter(F.col("year").isin(1995, 1997, 2001, 2003)).select("year", "n_events_total", "wb_gdp")


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "correlation_matrix",
    "ANA-1 ANA-2",
    "select * from (" + " union all ".join(f"select '{a}' as x, '{b}' as y, round(corr({a}, {b}), 6) + 0.0 as r from lineitem" for a in _CORR for b in _CORR) + ")",
)
def correlation_matrix(t: Tables):
    return stats.correlation_matrix(t.read("lineitem"), _CORR).withColumn("r", F.round("r", 6) + 0.0)


@query(
    "ranked_drivers",
    "ANA-3 ANA-13",
    "select * from (" + " union all ".join(
        f"select '{d}' as driver, round(corr(ln(1 + n_events_total), {d}), 6) + 0.0 as r from ({PANEL_SQL}) where year >= 1996" for d in ("wb_gdp", "wb_orders", "yield_mean", "cropland_ha")
    ) + ")",
)
def ranked_drivers(t: Tables):
    recent = panel(t).filter(F.col("year") >= 1996).withColumn("confl", F.log1p("n_events_total"))
    return stats.ranked_drivers(recent, "confl", ["wb_gdp", "wb_orders", "yield_mean", "cropland_ha"]).withColumn("r", F.round("r", 6) + 0.0)


@query(
    "panel_ols_clustered",
    "ANA-12 ANA-13",
    f"""with d as (select n_name as g, year(l_shipdate) as e, ln(1 + l_extendedprice) as y, l_quantity as x1, l_discount * 100 as x2
      from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey),
    w as (select g, e, y - avg(y) over (partition by e) as y, x1 - avg(x1) over (partition by e) as x1, x2 - avg(x2) over (partition by e) as x2 from d),
    s as (select sum(x1 * x1) as a, sum(x1 * x2) as b, sum(x2 * x2) as c, sum(x1 * y) as p, sum(x2 * y) as q, count(*) as n, count(distinct e) as ne, count(distinct g) as ng from w),
    k as (select *, (c * p - b * q) / (a * c - b * b) as b1, (a * q - b * p) / (a * c - b * b) as b2, a * c - b * b as det from s),
    u as (select g, sum(x1 * (y - b1 * x1 - b2 * x2)) as u1, sum(x2 * (y - b1 * x1 - b2 * x2)) as u2 from w, k group by 1),
    m as (select sum(u1 * u1) as m11, sum(u1 * u2) as m12, sum(u2 * u2) as m22 from u),
    v as (select *, ng / (ng - 1.0) * (n - 1.0) / (n - 2.0 - ne) as f,
      (c * c * m11 - 2 * b * c * m12 + b * b * m22) / (det * det) as v1, (b * b * m11 - 2 * a * b * m12 + a * a * m22) / (det * det) as v2 from k, m)
    select 'l_quantity' as term, round(b1, 8) as coef, round(sqrt(v1 * f), 8) as std_err, round(b1 / sqrt(v1 * f), 4) as t, n, ng as clusters from v
    union all select 'discount_pct', round(b2, 8), round(sqrt(v2 * f), 8), round(b2 / sqrt(v2 * f), 4), n, ng from v""",
)
def panel_ols_clustered(t: Tables):
    lines = t.read("lineitem").join(t.read("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(t.read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    data = lines.select(
        "n_name", F.year("l_shipdate").alias("year"), F.log1p("l_extendedprice").alias("log_price"), "l_quantity", (F.col("l_discount") * 100).alias("discount_pct")
    )
    out = stats.clustered_ols(data, "log_price", ["l_quantity", "discount_pct"], "year", "n_name")
    return out.withColumns({"coef": F.round("coef", 8), "std_err": F.round("std_err", 8), "t": F.round("t", 4)})


@query(
    "cross_source_gap",
    "ANA-14",
    f"select iso3, count(*) as n from ({PANEL_SQL}) where acled_events_total > 0 and n_events_total < 60 group by 1",
)
def cross_source_gap(t: Tables):
    return panel(t).filter((F.col("acled_events_total") > 0) & (F.col("n_events_total") < 60)).groupBy("iso3").agg(F.count(F.lit(1)).alias("n"))


@query(
    "source_disagreement",
    "ANA-15",
    """with a as (select l_orderkey as k, min(l_returnflag) as fa from lineitem group by 1)
    select o_orderkey, o_orderstatus, fa from orders join a on o_orderkey = k where o_orderstatus is not null and fa is not null
      and (case o_orderstatus when 'F' then 'A' when 'O' then 'N' else 'R' end) <> fa and fa <> 'N'""",
)
def source_disagreement(t: Tables):
    flags = t.read("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_returnflag").alias("fa"))
    said = F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "N").otherwise("R")
    both = t.read("orders").join(flags, "o_orderkey").filter(F.col("o_orderstatus").isNotNull() & F.col("fa").isNotNull())
    return both.filter((said != F.col("fa")) & (F.col("fa") != "N")).select("o_orderkey", "o_orderstatus", "fa")


@query(
    "value_tally",
    "AGG-26 ANA-11",
    "select * from (select 'l_returnflag' as column, l_returnflag as value, count(*) as n from lineitem group by 2 union all select 'l_linestatus', l_linestatus, count(*) from lineitem group by 2)",
)
def value_tally(t: Tables):
    return stats.tally(t.read("lineitem"), ["l_returnflag", "l_linestatus"])
