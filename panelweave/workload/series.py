"""Series queries: changes, anomalies, exposures, clocks, periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.functions import geo, numeric
from panelweave.operators import aggregate, frame, joins, select, series
from panelweave.workload.base import CROPS_SQL, FACTS_SQL, FIRST, FRAME_SQL, LAST, SEVERE_SQL, SPINE_SQL, Tables, YEARLY_SQL, query

# crop -> commodity: two of the six part types have no commodity
CROSSWALK = [("STANDARD", "c_std"), ("ECONOMY", "c_eco"), ("PROMO", "c_pro"), ("SMALL", "c_sml")]
XW_SQL = "(values " + ", ".join(f"('{a}', '{b}')" for a, b in CROSSWALK) + ") as xw(crop, commodity)"

PRICE_SQL = f"""select commodity, cast(year(l_shipdate) as integer) as year, avg(l_extendedprice / l_quantity) as price
  from lineitem join part on l_partkey = p_partkey join (select * from {XW_SQL}) x on p_type = x.crop group by 1, 2"""


def crosswalk(t: Tables):
    return t.spark.createDataFrame(CROSSWALK, "crop string, commodity string")


def prices(t: Tables):
    """World price per commodity and year: mean unit price of its part type."""
    lines = t.read("lineitem").join(t.read("part"), F.col("l_partkey") == F.col("p_partkey"))
    mean = lines.groupBy(F.col("p_type").alias("crop"), F.year("l_shipdate").alias("year")).agg(
        F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price")
    )
    return mean.join(crosswalk(t), "crop").select("commodity", "year", "price")


@query(
    "log_change",
    "WIN-4 FN-10",
    f"""select district_id, year, round(ln(value) - lag(ln(value)) over w, 6) as dlog,
      round(case when year - lag(year) over w = 1 then ln(value) - lag(ln(value)) over w end, 6) as dlog_strict
    from (select district_id, year, avg(l_extendedprice) as value from ({SEVERE_SQL}) group by 1, 2)
    window w as (partition by district_id order by year)""",
)
def log_change(t: Tables):
    sparse = t.severe.groupBy("district_id", "year").agg(F.avg("l_extendedprice").alias("value"))
    loose = series.log_change(sparse, ["district_id"], "value", "dlog")
    both = series.log_change(loose, ["district_id"], "value", "dlog_strict", strict=True)
    return both.select("district_id", "year", F.round("dlog", 6).alias("dlog"), F.round("dlog_strict", 6).alias("dlog_strict"))


@query(
    "lagged_mediator",
    "WIN-9",
    f"""select district_id, year, value, case when year - lag(year) over w = 1 then lag(value) over w end as value_lag1
    from (select f.district_id, f.year, y.value from ({FRAME_SQL}) f
      left join ({YEARLY_SQL}) y on f.district_id = y.district_id and f.year = y.year)
    window w as (partition by district_id order by year)""",
)
def lagged_mediator(t: Tables):
    base = frame.dense_frame(t.spine.select("district_id"), FIRST, LAST)
    panel = frame.attach(base, t.yearly, ["district_id", "year"], ["value"], checked=True)
    return series.lagged(panel, ["district_id"], ["value"])


@query(
    "standardised_anomaly",
    "AGG-34 WIN-5",
    f"""with y as ({YEARLY_SQL}),
    b as (select district_id, avg(value) as mu, stddev_samp(value) as sd, count(value) as n
          from y where year between 1995 and 1999 group by 1)
    select y.district_id, y.year, round(case when b.n >= 5 and b.sd >= 300 then (y.value - b.mu) / b.sd end, 6) as anomaly
    from y left join b on y.district_id = b.district_id""",
)
def standardised_anomaly(t: Tables):
    scored = series.standardised_anomaly(t.yearly, "district_id", "value", "anomaly", (1995, 1999), min_years=5, min_sd=300)
    return scored.select("district_id", "year", F.round("anomaly", 6).alias("anomaly"))


@query(
    "category_shares",
    "AGG-7 WIN-7",
    f"select district_id, crop, area, area / sum(area) over (partition by district_id) as share from ({CROPS_SQL})",
)
def category_shares(t: Tables):
    return aggregate.shares(t.crops, ["district_id"], "crop", "area", "share")


@query(
    "mapped_coverage",
    "AGG-8 DOM-2 JN-14",
    f"""select district_id, sum(area) as cropland,
      round(coalesce(sum(case when x.commodity is not null then area end), 0.0) / sum(area), 8) as coverage
    from ({CROPS_SQL}) c left join (select * from {XW_SQL}) x on c.crop = x.crop group by 1""",
)
def mapped_coverage(t: Tables):
    coded = t.crops.join(crosswalk(t), "crop", "left")
    return coded.groupBy("district_id").agg(
        F.sum("area").alias("cropland"),
        F.round(aggregate.share_where(F.col("commodity").isNotNull(), "area"), 8).alias("coverage"),
    )


@query(
    "shift_share_shock",
    "DOM-3 JN-12 WIN-4",
    f"""with p as ({PRICE_SQL}),
    d as (select commodity, year, ln(price) - lag(ln(price)) over (partition by commodity order by year) as dlog from p),
    c as (select district_id, crop, area, area / sum(area) over (partition by district_id) as share from ({CROPS_SQL})),
    st as (select district_id, sum(area) as cropland,
      coalesce(sum(case when x.commodity is not null then area end), 0.0) / sum(area) as coverage
      from c left join (select * from {XW_SQL}) x on c.crop = x.crop group by 1),
    sh as (select c.district_id, d.year, sum(c.share * d.dlog) as shock
      from c join (select * from {XW_SQL}) x on c.crop = x.crop join d on d.commodity = x.commodity
      where d.dlog is not null and d.year between {FIRST} and {LAST} group by 1, 2)
    select f.district_id, f.year, st.cropland, round(st.coverage, 6) as coverage,
      round(case when st.cropland is not null then coalesce(sh.shock, 0.0) end, 6) + 0.0 as shock
    from ({FRAME_SQL}) f left join st on f.district_id = st.district_id
    left join sh on f.district_id = sh.district_id and f.year = sh.year""",
)
def shift_share_shock(t: Tables):
    base = frame.dense_frame(t.spine.select("district_id"), FIRST, LAST)
    exposed = series.shift_share(base, t.crops, prices(t), crosswalk(t), "district_id", "crop", "commodity", "area", "price", FIRST, LAST)
    return exposed.select(
        "district_id", "year", "cropland", F.round("coverage", 6).alias("coverage"), (F.round("shock", 6) + 0.0).alias("shock")
    )


@query(
    "first_detection_clock",
    "AGG-5 PRJ-16 PRJ-17 DOM-7",
    f"""with d as (select district_id, year, sum(case when l_discount >= 0.09 then 1 else 0 end) as confirmed
      from ({SEVERE_SQL}) group by 1, 2),
    a as (select district_id, min(case when confirmed > 1 then year end) as first_year from d where year <= 2000 group by 1)
    select f.district_id, f.year, a.first_year::double as first_year, (f.year - a.first_year)::double as years_since,
      (f.year >= a.first_year)::integer::double as arrived
    from ({FRAME_SQL}) f left join a on f.district_id = a.district_id""",
)
def first_detection_clock(t: Tables):
    confirmed = t.severe.groupBy("district_id", "year").agg(F.count_if(F.col("l_discount") >= 0.09).alias("confirmed"))
    window = frame.cap_years(confirmed, FIRST, 2000)
    first = window.groupBy("district_id").agg(aggregate.first_year_where(F.col("confirmed") > 1).cast("double").alias("first_year"))
    named = frame.attach(t.spine.select("district_id"), first, ["district_id"], ["first_year"], checked=True)
    panel = frame.dense_frame(named, FIRST, LAST)
    return panel.withColumns({
        "years_since": series.clock("year", "first_year"),
        "arrived": numeric.known_flag(F.col("year") >= F.col("first_year")),
    })


@query(
    "period_explode_join",
    "JN-22 FN-12",
    f"""with per as (select o_orderkey, o_custkey, cast(year(o_orderdate) as integer) as a, cast(year(max(l_shipdate)) as integer) as b
      from orders join lineitem on o_orderkey = l_orderkey group by 1, 2, o_orderdate),
    ex as (select o_custkey, cast(unnest(generate_series(greatest(a, 1996), least(b, 2000))) as integer) as year
      from per where greatest(a, 1996) <= least(b, 2000))
    select c_nationkey as nation, year, count(*) as open_periods
    from ex join customer on o_custkey = c_custkey group by 1, 2""",
)
def period_explode_join(t: Tables):
    last = t.read("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.year(F.max("l_shipdate")).alias("b"))
    periods = t.read("orders").join(last, "o_orderkey").select("o_custkey", F.year("o_orderdate").alias("a"), "b")
    yearly = joins.expand_periods(periods, "a", "b", 1996, 2000)
    return (
        yearly.join(t.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("nation"), "year")
        .agg(F.count(F.lit(1)).alias("open_periods"))
    )


@query(
    "status_in_period",
    "JN-22 AGG-16",
    f"""with st as (select s_suppkey, 1995 + cast(s_suppkey % 3 as integer) as a, 1997 + cast(s_suppkey % 4 as integer) as b from supplier),
    y as (select district_id, year, sum(best) as best from ({FACTS_SQL}) group by 1, 2)
    select iso3, y.year, round(least(1.0, coalesce(sum(case when st.s_suppkey is not null then best end), 0.0) / sum(best)), 6) as share
    from y join ({SPINE_SQL}) s on y.district_id = s.district_id
    left join st on st.s_suppkey = y.district_id and y.year between st.a and st.b group by 1, 2""",
)
def status_in_period(t: Tables):
    key = F.col("s_suppkey")
    status = t.read("supplier").select(
        key.alias("district_id"), (1995 + key % 3).cast("int").alias("a"), (1997 + key % 4).cast("int").alias("b")
    )
    held = joins.expand_periods(status, "a", "b", FIRST, LAST).select("district_id", "year", F.lit(True).alias("held"))
    yearly = t.facts.groupBy("district_id", "year").agg(F.sum("best").alias("best"))
    joined = yearly.join(held, ["district_id", "year"], "left").join(t.spine.select("district_id", "iso3"), "district_id")
    share = F.coalesce(F.sum(F.when(F.col("held"), F.col("best"))), F.lit(0.0)) / F.sum("best")
    return joined.groupBy("iso3", "year").agg(F.round(F.least(F.lit(1.0), share), 6).alias("share"))


@query(
    "fractionalisation",
    "AGG-13 AGG-12",
    """with g as (select l_suppkey as district_id, cast(year(l_shipdate) as integer) as year, p_type as crop, sum(l_quantity) as a
      from lineitem join part on l_partkey = p_partkey group by 1, 2, 3)
    select district_id, year, count(distinct crop) as n_groups, 1 - sum(a * a) / (sum(a) * sum(a)) as frac from g group by 1, 2""",
)
def fractionalisation(t: Tables):
    lines = (
        t.read("lineitem").join(t.read("part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_suppkey").alias("district_id"), F.year("l_shipdate").alias("year"), F.col("p_type").alias("crop"))
        .agg(F.sum("l_quantity").alias("a"))
    )
    frac = aggregate.fractionalisation(lines, ["district_id", "year"], "crop", "a", "frac")
    groups = lines.groupBy("district_id", "year").agg(F.count_distinct("crop").alias("n_groups"))
    return groups.join(frac, ["district_id", "year"])


@query(
    "weighted_mode",
    "AGG-19 DOM-9",
    f"""with g as (select district_id, year, cast(round(l_tax * 100) as integer) as phase, sum(best) as a from ({FACTS_SQL}) group by 1, 2, 3)
    select district_id, year, phase as modal from (select *, row_number() over (partition by district_id, year order by a desc, phase desc) as rn from g) where rn = 1""",
)
def weighted_mode(t: Tables):
    phased = t.facts.withColumn("phase", F.round(F.col("l_tax") * 100).cast("int"))
    return aggregate.weighted_mode(phased, ["district_id", "year"], "phase", "best", "modal")


@query(
    "worst_category",
    "AGG-17 AGG-18 AGG-3 DOM-9",
    f"""select district_id, year, max(phase) as phase_max, count(*) as n_reports,
      round(coalesce(sum(case when phase >= 6 then best end), 0.0) / sum(best), 6) as crisis_share,
      (max(phase) >= 8)::integer as crisis_flag, 1 as covered
    from (select *, cast(round(l_tax * 100) as integer) as phase from ({FACTS_SQL})) group by 1, 2""",
)
def worst_category(t: Tables):
    phased = t.facts.withColumn("phase", F.round(F.col("l_tax") * 100).cast("int"))
    return phased.groupBy("district_id", "year").agg(
        F.max("phase").alias("phase_max"),
        F.count(F.lit(1)).alias("n_reports"),
        F.round(aggregate.share_where(F.col("phase") >= 6, "best"), 6).alias("crisis_share"),
        numeric.flag(F.max("phase") >= 8).alias("crisis_flag"),
        F.lit(1).alias("covered"),
    )


@query(
    "catch_rate",
    "AGG-4 AGG-3 AGG-2",
    f"""select district_id, year, count(*) as n_checks, sum(case when l_discount >= 0.05 then 1 else 0 end)::bigint as confirmed,
      (sum(case when l_discount >= 0.05 then 1 else 0 end) > 0)::integer as present,
      round(sum(case when l_discount >= 0.05 then 1 else 0 end)::double / count(*), 6) as catch_rate
    from ({FACTS_SQL}) group by 1, 2""",
)
def catch_rate(t: Tables):
    confirmed, checks = F.count_if(F.col("l_discount") >= 0.05), F.count(F.lit(1))
    return t.facts.groupBy("district_id", "year").agg(
        checks.alias("n_checks"),
        confirmed.alias("confirmed"),
        numeric.flag(confirmed > 0).alias("present"),
        F.round(numeric.ratio(confirmed, checks), 6).alias("catch_rate"),
    )


@query(
    "monthly_to_annual",
    "AGG-33",
    f"""select district_id, year, avg(m) as annual from (
      select district_id, year, cast(month(l_shipdate) as integer) as month, sum(case when l_discount < 0.08 then best end) as m
      from ({FACTS_SQL}) group by 1, 2, 3) group by 1, 2""",
)
def monthly_to_annual(t: Tables):
    value = F.when(F.col("l_discount") < 0.08, F.col("best"))
    monthly = t.facts.groupBy("district_id", "year", F.month("l_shipdate").alias("month")).agg(F.sum(value).alias("m"))
    return monthly.groupBy("district_id", "year").agg(F.avg("m").alias("annual"))


@query(
    "decade_totals",
    "AGG-29 AGG-31",
    f"select cast(floor(year / 10) * 10 as integer) as decade, count(*) as n, cast(sum(best) as bigint) as best from ({FACTS_SQL}) group by 1",
)
def decade_totals(t: Tables):
    return t.facts.groupBy(aggregate.decade().alias("decade")).agg(F.count(F.lit(1)).alias("n"), F.sum("best").cast("bigint").alias("best"))


@query(
    "equal_area_projection",
    "FN-14 FN-13",
    f"""with p as (select l_orderkey, l_linenumber, l_partkey, l_quantity, ((l_orderkey * 7.3) % 360.0) as lon0, (l_partkey * 1.7) % 160.0 - 80.0 as lat from lineitem),
    c as (select sqrt(f * (2 - f)) as e, f * (2 - f) as e2 from (select 1 / 298.257223563 as f)),
    q as (select p.*, e, e2, sin(radians(lat)) as s from p, c)
    select l_orderkey, l_linenumber, l_partkey, l_quantity,
      round(((lon0 + 180.0) % 360.0) - 180.0, 6) as lon,
      round(radians(((lon0 + 180.0) % 360.0) - 180.0) * 6378137.0 * cos(radians(30)) / sqrt(1 - e2 * pow(sin(radians(30)), 2)), 1) as x,
      round(6378137.0 * (1 - e2) * (s / (1 - e2 * s * s) - ln((1 - e * s) / (1 + e * s)) / (2 * e))
        / (2 * cos(radians(30)) / sqrt(1 - e2 * pow(sin(radians(30)), 2))), 1) + 0.0 as y
    from q""",
)
def equal_area_projection(t: Tables):
    lon = geo.wrap_longitude((F.col("l_orderkey") * 7.3) % 360.0)
    lat = (F.col("l_partkey") * 1.7) % 160.0 - 80.0
    return t.read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        F.round(lon, 6).alias("lon"),
        F.round(geo.equal_area_x(lon), 1).alias("x"),
        (F.round(geo.equal_area_y(lat), 1) + 0.0).alias("y"),
    )


@query(
    "never_known",
    "AGG-36",
    f"""select district_id from (select f.district_id, count(s.n) as k from ({FRAME_SQL}) f left join
      (select district_id, year, count(*) as n from ({SEVERE_SQL}) where kind = 'N' and l_tax >= 0.07 group by 1, 2) s
      on f.district_id = s.district_id and f.year = s.year group by 1) where k = 0""",
)
def never_known(t: Tables):
    rare = t.severe.filter((F.col("kind") == "N") & (F.col("l_tax") >= 0.07)).groupBy("district_id", "year").agg(F.count(F.lit(1)).alias("n"))
    base = frame.dense_frame(t.spine.select("district_id"), FIRST, LAST)
    return aggregate.never_known(frame.attach(base, rare, ["district_id", "year"], ["n"], checked=True), "district_id", "n")


@query(
    "filter_funnel",
    "ANA-16 FLT-1 VAL-24",
    f"""select 'all' as step, count(*) as n from ({FACTS_SQL})
    union all select 'precise', count(*) from ({FACTS_SQL}) where l_tax between 0.0 and 0.06
    union all select 'in window', count(*) from ({FACTS_SQL}) where l_tax between 0.0 and 0.06 and year between 1996 and 2000
    union all select 'deadly', count(*) from ({FACTS_SQL}) where l_tax between 0.0 and 0.06 and year between 1996 and 2000 and best >= 40""",
)
def filter_funnel(t: Tables):
    return select.funnel(t.facts, {
        "precise": F.col("l_tax").between(0.0, 0.06),
        "in window": F.col("year").between(1996, 2000),
        "deadly": F.col("best") >= 40,
    })
