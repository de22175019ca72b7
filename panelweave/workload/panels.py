"""Frame and absence-policy queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.operators import aggregate, frame, joins, reshape
from panelweave.workload.base import (
    FACTS_SQL, FIRST, FRAME_SQL, LAST, NATIONAL_SQL, SEVERE_SQL, SPINE_SQL, Tables, YEARLY_SQL, mean_cents, mean_cents_sql, query,
)

KINDS = {"A": "sb", "N": "ns", "R": "os"}
MEASURES = {
    "n_events": F.count,
    "deaths_best": F.sum,
    "deaths_low": F.sum,
    "deaths_high": F.sum,
}


def event_wide(facts):
    """District-year event columns by kind, with totals."""
    measures = {
        "n_events": F.sum("n"),
        "deaths_best": F.sum("best"),
        "deaths_low": F.sum("low"),
        "deaths_high": F.sum("high"),
    }
    return reshape.pivot_fixed(facts, ["district_id", "year"], "kind", KINDS, measures, absent_zero=True, totals=True)


def event_long(t: Tables):
    """Located events counted per district, year and kind."""
    located = t.facts.filter(F.col("l_tax").between(0.0, 0.06))
    return located.groupBy("district_id", "year", "kind").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("best", "low", "high")],
    )


_PIVOT_SQL = ", ".join(
    f"coalesce(sum({expr}) filter (where kind = '{k}'), 0)::bigint as {m}_{s}"
    for m, expr in (("n_events", "1"), ("deaths_best", "best"), ("deaths_low", "low"), ("deaths_high", "high"))
    for k, s in KINDS.items()
)
_TOTALS_SQL = ", ".join(
    f"coalesce(sum({expr}), 0)::bigint as {m}_total"
    for m, expr in (("n_events", "1"), ("deaths_best", "best"), ("deaths_low", "low"), ("deaths_high", "high"))
)
EVENT_COLUMNS = [f"{m}_{s}" for m in MEASURES for s in KINDS.values()] + [f"{m}_total" for m in MEASURES]


@query(
    "event_panel_zero_filled",
    "FLT-1 AGG-1 PRJ-6 PRJ-8 JN-1 JN-2 JN-3 ORD-2",
    f"""with wide as (select district_id, year, {_PIVOT_SQL}, {_TOTALS_SQL}
        from ({FACTS_SQL}) where l_tax between 0.0 and 0.06 group by 1, 2)
    select f.district_id, f.iso3, f.district_name, f.year,
      {", ".join(f"coalesce(w.{c}, 0) as {c}" for c in EVENT_COLUMNS)}
    from ({FRAME_SQL}) f left join wide w on f.district_id = w.district_id and f.year = w.year""",
)
def event_panel_zero_filled(t: Tables):
    base = frame.dense_frame(t.spine.select("district_id", "iso3", "district_name"), FIRST, LAST)
    wide = event_wide(event_long(t))
    joined = frame.attach(base, wide, ["district_id", "year"], EVENT_COLUMNS, "zero", checked=True)
    return joined.select("district_id", "iso3", "district_name", "year", *EVENT_COLUMNS)


@query(
    "dense_frame",
    "JN-1",
    f"select district_id, iso3, district_name, year from ({FRAME_SQL})",
)
def dense(t: Tables):
    return frame.dense_frame(t.spine.select("district_id", "iso3", "district_name"), FIRST, LAST)


@query(
    "coverage_masked_panel",
    "AGG-6 JN-5 VAL-11",
    f"""with sev as ({SEVERE_SQL}),
    agg as (select district_id, year, count(*)::double as unrest from sev group by 1, 2),
    span as (select iso3, min(year) as a, max(year) as b from sev join ({SPINE_SQL}) using (district_id) group by 1)
    select f.district_id, f.iso3, f.year,
      case when g.district_id is not null then g.unrest when f.year between s.a and s.b then 0.0 end as unrest
    from ({FRAME_SQL}) f left join agg g on f.district_id = g.district_id and f.year = g.year
    left join span s on f.iso3 = s.iso3""",
)
def coverage_masked_panel(t: Tables):
    base = frame.dense_frame(t.spine.select("district_id", "iso3"), FIRST, LAST)
    counts = t.severe.groupBy("district_id", "year").agg(F.count(F.lit(1)).alias("unrest"))
    named = t.severe.join(t.spine.select("district_id", "iso3"), "district_id")
    span = frame.observed_span(named, "iso3")
    return frame.attach(base, counts, ["district_id", "year"], ["unrest"], "mask", span, "iso3", checked=True).select(
        "district_id", "iso3", "year", "unrest"
    )


@query(
    "observed_span",
    "AGG-6",
    f"""select iso3, min(year) as first_year, max(year) as last_year
    from ({SEVERE_SQL}) join ({SPINE_SQL}) using (district_id) group by 1""",
)
def observed_span(t: Tables):
    return frame.observed_span(t.severe.join(t.spine, "district_id"), "iso3")


@query(
    "national_broadcast",
    "JN-4 JN-7",
    f"""select f.district_id, f.iso3, f.year, n.n_orders::double as n_orders, n.gdp
    from ({FRAME_SQL}) f left join ({NATIONAL_SQL}) n on f.iso3 = n.iso3 and f.year = n.year""",
)
def national_broadcast(t: Tables):
    base = frame.dense_frame(t.spine.select("district_id", "iso3"), FIRST, LAST)
    national = t.national.withColumn("n_orders", F.col("n_orders").cast("double"))
    return frame.attach(base, national, ["iso3", "year"], ["n_orders", "gdp"], "null", checked=True)


@query(
    "entity_constant_broadcast",
    "JN-8",
    f"""with k as (select l_suppkey as district_id, count(*) as n_lines, max(l_quantity) as peak from lineitem group by 1)
    select f.district_id, f.year, k.n_lines, k.peak from ({FRAME_SQL}) f left join k on f.district_id = k.district_id""",
)
def entity_constant_broadcast(t: Tables):
    constant = t.facts.groupBy("district_id").agg(F.count(F.lit(1)).alias("n_lines"), F.max("best").alias("peak"))
    # joined before the years are unfolded: one row per district, not per district-year
    named = frame.attach(t.spine.select("district_id"), constant, ["district_id"], ["n_lines", "peak"], checked=True)
    return frame.dense_frame(named, FIRST, LAST)


_CLASS_SQL = f"""select iso3, year, case when gdp >= 255000 then 'H' when gdp >= 250000 then 'UM' else 'L' end as income
    from ({NATIONAL_SQL}) where n_orders >= (select avg(n_orders) * 0.9 from ({NATIONAL_SQL}))"""


def income_classes(t: Tables):
    """A yearly class with gaps: only well-covered country-years are classified."""
    floor = t.national.agg((F.avg("n_orders") * 0.9).alias("floor")).first()["floor"]  # one number
    group = F.when(F.col("gdp") >= 255000, "H").when(F.col("gdp") >= 250000, "UM").otherwise("L")
    return t.national.filter(F.col("n_orders") >= floor).select("iso3", "year", group.alias("income"))


@query(
    "carry_forward_latest",
    "JN-6 DOM-8 WIN-6",
    f"""with c as ({_CLASS_SQL}), latest as (select iso3, arg_max(income, year) as income from c group by 1)
    select f.district_id, f.iso3, f.year, coalesce(c.income, l.income) as income,
      (c.income is null and l.income is not null) as income_carried
    from ({FRAME_SQL}) f left join c on f.iso3 = c.iso3 and f.year = c.year left join latest l on f.iso3 = l.iso3""",
)
def carry_forward_latest(t: Tables):
    base = frame.dense_frame(t.spine.select("district_id", "iso3"), FIRST, LAST)
    return frame.carry_class(base, income_classes(t), "iso3", "income", "latest")


@query(
    "carry_forward_asof",
    "JN-6 WIN-8",
    f"""with c as ({_CLASS_SQL}),
    filled as (select distinct f.iso3, f.year from ({FRAME_SQL}) f),
    known as (select f.iso3, f.year, c.income as direct,
      last_value(c.income ignore nulls) over (partition by f.iso3 order by f.year) as known
      from filled f left join c on f.iso3 = c.iso3 and f.year = c.year)
    select f.district_id, f.iso3, f.year, coalesce(a.direct, a.known) as income,
      (a.direct is null and a.known is not null) as income_carried
    from ({FRAME_SQL}) f left join known a on f.iso3 = a.iso3 and f.year = a.year""",
)
def carry_forward_asof(t: Tables):
    base = frame.dense_frame(t.spine.select("district_id", "iso3"), FIRST, LAST)
    return frame.carry_class(base, income_classes(t), "iso3", "income", "asof")


@query(
    "density_reindex",
    "JN-25",
    f"""with c as (select district_id, year, kind, {mean_cents_sql('l_extendedprice')} as price from ({SEVERE_SQL}) group by 1, 2, 3)
    select f.district_id, f.year, k.kind, c.price
    from ({FRAME_SQL}) f cross join (select unnest(['A', 'N', 'R']) as kind) k
    left join c on f.district_id = c.district_id and f.year = c.year and k.kind = c.kind""",
)
def density_reindex(t: Tables):
    long = t.severe.groupBy("district_id", "year", "kind").agg(mean_cents("l_extendedprice").alias("price"))
    return frame.densify(long, t.spine, "district_id", "kind", ["A", "N", "R"], FIRST, LAST, ["price"])


@query(
    "expected_broadcast_total",
    "JN-24",
    f"""select cast(sum(n_orders * d) as bigint) as expected
    from ({NATIONAL_SQL}) n join (select iso3, count(*) as d from ({SPINE_SQL}) group by 1) s on n.iso3 = s.iso3""",
)
def expected_broadcast_total(t: Tables):
    return joins.expected_broadcast_total(t.national, t.spine, "iso3", "n_orders")


@query(
    "window_cap",
    "FLT-6",
    f"""select cast(count(*) filter (where year > 2000) as bigint) as dropped, count(*) as seen from ({YEARLY_SQL})""",
)
def window_cap(t: Tables):
    return frame.dropped_beyond(t.yearly, 2000)


@query(
    "share_attached_zero",
    "JN-26 AGG-7",
    f"""with c as (select district_id, crop, area, area / sum(area) over (partition by district_id) as share
      from (select l_suppkey as district_id, p_type as crop, sum(l_quantity) as area
            from lineitem join part on l_partkey = p_partkey group by 1, 2))
    select f.district_id, f.year, coalesce(c.share, 0.0) as promo_share
    from ({FRAME_SQL}) f left join c on f.district_id = c.district_id and c.crop = 'PROMO'""",
)
def share_attached_zero(t: Tables):
    parts = aggregate.shares(t.crops, ["district_id"], "crop", "area", "share")
    promo = parts.filter(F.col("crop") == "PROMO").select("district_id", F.col("share").alias("promo_share"))
    named = frame.attach(t.spine.select("district_id"), promo, ["district_id"], ["promo_share"], "zero", checked=True)
    return frame.dense_frame(named, FIRST, LAST)
