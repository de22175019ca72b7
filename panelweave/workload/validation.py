"""Check queries. Every check is a row (grp, name, status, violations)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.operators import aggregate, checks, frame
from panelweave.session import stage
from panelweave.sources import contracts
from panelweave.workload.analytics import MEASURES, PANEL_SQL, panel
from panelweave.workload.base import FACTS_SQL, FIRST, LAST, NATIONAL_SQL, SEVERE_SQL, SPINE_SQL, Tables, YEARLY_SQL, query
from panelweave.workload.series import CROSSWALK, XW_SQL


def row(group: str, name: str, violations: str, source: str = "") -> str:
    """SQL for one check row; ``violations`` is a count expression."""
    return (
        f"select '{group}' as grp, '{name}' as name, case when v = 0 then 'PASS' else 'FAIL' end as status, v as violations "
        f"from (select cast({violations} as bigint) as v {source})"
    )


def rows(*parts: str) -> str:
    return "\nunion all ".join(parts)


_P = f"from ({PANEL_SQL})"


@query(
    "structure_checks",
    "VAL-1 VAL-2 VAL-3 VAL-4 VAL-30",
    rows(
        row("structure", "rows = districts x years", "abs(count(*) - (select count(*) from supplier) * 11)", _P),
        row("structure", "unique (district_id, year)", "count(*) filter (where n > 1)", f"from (select district_id, year, count(*) as n {_P} group by 1, 2)"),
        row("structure", "each district has every year", f"count(*) filter (where not (n = 11 and a = {FIRST} and b = {LAST}))", f"from (select district_id, count(distinct year) as n, min(year) as a, max(year) as b {_P} group by 1)"),
        row("structure", "district_id known", "count(*) filter (where district_id is null)", _P),
        row("structure", "iso3 known", "count(*) filter (where iso3 is null)", _P),
        row("structure", "line keys unique", "count(*) filter (where n > 1)", "from (select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2)"),
    ),
)
def structure_checks(t: Tables):
    p = stage(panel(t))  # built once for all the checks of the report
    size = t.spine.count() * (LAST - FIRST + 1)
    return checks.report(
        contracts.exact_rows(p, "structure", "rows = districts x years", size),
        checks.unique_key(p, "structure", "unique (district_id, year)", ["district_id", "year"]),
        checks.balanced(p, "structure", "each district has every year", "district_id", FIRST, LAST),
        checks.rows_hold(p, "structure", checks.known_keys(["district_id", "iso3"])),
        checks.unique_key(t.read("lineitem"), "structure", "line keys unique", ["l_orderkey", "l_linenumber"]),
    )


@query(
    "reconciliation_checks",
    "VAL-7 VAL-8 VAL-23 JN-23",
    rows(
        row("totals", "total of n_events_total", f"case when (select sum(n_events_total) {_P}) = (select count(*) from ({FACTS_SQL}) where l_tax <= 0.06) then 0 else 1 end"),
        row("totals", "total of deaths_best", f"case when (select sum(deaths_best) {_P}) = (select sum(best) from ({FACTS_SQL}) where l_tax <= 0.06) then 0 else 1 end"),
        row("totals", "known in wb_gdp", f"abs((select count(wb_gdp) {_P}) - (select sum(d) from ({NATIONAL_SQL}) n join (select iso3, count(*) as d from ({SPINE_SQL}) group by 1) s on n.iso3 = s.iso3))"),
        row("totals", "severe events land", "count(*) filter (where acled_events_total is null)", f"from (select distinct district_id, year from ({SEVERE_SQL})) s left join ({PANEL_SQL}) p using (district_id, year)"),
    ),
)
def reconciliation_checks(t: Tables):
    p = stage(panel(t))
    source = t.facts.filter(F.col("l_tax") <= 0.06).select(F.lit(1).alias("n_events_total"), F.col("best").alias("deaths_best"))
    spread = t.national.join(t.spine.select("iso3", "district_id"), "iso3").select(F.col("gdp").alias("wb_gdp"))
    return checks.report(
        checks.totals_match(p, source, "totals", ["n_events_total", "deaths_best"]),
        checks.counts_match(p, spread, "totals", ["wb_gdp"]),
        checks.landed(t.severe, p, "totals", "severe events land", ["district_id", "year"], "acled_events_total"),
    )


@query(
    "mask_checks",
    "VAL-9 VAL-10 VAL-11 VAL-16 VAL-17 VAL-18",
    rows(
        row("mask", "wb columns share a mask", "count(*) filter (where (wb_gdp is null) <> (wb_orders is null))", _P),
        row("mask", "wb_gdp never zero", "count(*) filter (where wb_gdp = 0)", _P),
        row("mask", "counts never negative", "count(*) filter (where n_events_total < 0)", _P),
        row("mask", "unknown only outside the window", "count(*) filter (where acled_events_total is null and p.year between a and b)", f"from ({PANEL_SQL}) p left join (select iso3, min(year) as a, max(year) as b from ({SEVERE_SQL}) join ({SPINE_SQL}) using (district_id) group by 1) s on p.iso3 = s.iso3"),
        row("mask", "deaths need events", "count(*) filter (where (n_events_total = 0) <> (deaths_best = 0))", _P),
        row("mask", "price above 50000", "count(*) filter (where not coalesce(yield_mean > 50000, false))", _P),
    ),
)
def mask_checks(t: Tables):
    p = panel(t)
    span = frame.observed_span(t.severe.join(t.spine, "district_id"), "iso3")
    spanned = p.join(span, "iso3", "left")
    outside = F.col("acled_events_total").isNotNull() | F.col("first_year").isNull() | ~F.col("year").between(F.col("first_year"), F.col("last_year"))
    return checks.report(
        checks.rows_hold(spanned, "mask", {
            "wb columns share a mask": checks.same_null_mask("wb_gdp", "wb_orders"),
            "wb_gdp never zero": F.col("wb_gdp").isNull() | (F.col("wb_gdp") != 0),
            "counts never negative": F.col("n_events_total") >= 0,
            "unknown only outside the window": outside,
            "deaths need events": (F.col("n_events_total") == 0) == (F.col("deaths_best") == 0),
            "price above 50000": F.col("yield_mean") > 50000,  # fails closed: unknown is a violation
        }),
    )


@query(
    "band_checks",
    "VAL-12 VAL-17 VAL-18 VAL-19 VAL-21 VAL-27 VAL-29",
    rows(
        row("bands", "mean events in 20..5000", "case when avg(n_events_total) between 20 and 5000 then 0 else 1 end", _P),
        row("bands", "all countries have gdp", "case when count(distinct case when wb_gdp is not null then iso3 end) = 25 then 0 else 1 end", _P),
        row("bands", "unrest has gaps", "case when count(*) filter (where acled_events_total is null) > 0 then 0 else 1 end", _P),
        row("bands", "1996 busier than 1994", "case when sum(case when year = 1996 then n_events_total end) > sum(case when year = 1994 then n_events_total end) then 0 else 1 end", _P),
        row("bands", "exposed above, others unknown", "case when avg(case when year between 1995 and 2001 then wb_gdp end) > 1000 and count(case when year > 2001 then wb_gdp end) = 0 then 0 else 1 end", _P),
        row("bands", "price ceiling", "case when max(yield_mean) <= 90000 then 0 else 1 end", _P),
    ),
)
def band_checks(t: Tables):
    events, year = F.col("n_events_total"), F.col("year")
    return checks.aggregates_hold(panel(t), "bands", {
        "mean events in 20..5000": F.avg(events).between(20, 5000),
        "all countries have gdp": F.count_distinct(F.when(F.col("wb_gdp").isNotNull(), F.col("iso3"))) == 25,
        "unrest has gaps": F.count_if(F.col("acled_events_total").isNull()) > 0,
        "1996 busier than 1994": F.sum(F.when(year == 1996, events)) > F.sum(F.when(year == 1994, events)),
        "exposed above, others unknown": (F.avg(F.when(year.between(1995, 2001), F.col("wb_gdp"))) > 1000) & (F.count(F.when(year > 2001, F.col("wb_gdp"))) == 0),
        "price ceiling": F.max("yield_mean") <= 90000,
    })


@query(
    "value_checks",
    "VAL-13 VAL-16 VAL-22 VAL-25 VAL-26 VAL-28 DOM-4 VAL-20",
    rows(
        row("values", "return flags", "count(*)", "from (select distinct l_returnflag as k from lineitem where l_returnflag not in ('A', 'N', 'R'))"),
        row("values", "crops mapped", "count(*)", f"from (select distinct p_type as crop from part where p_type not in (select crop from {XW_SQL}))"),
        row("values", "commodity used once", "count(*) filter (where n > 1)", f"from (select commodity, count(*) as n from {XW_SQL} group by 1)"),
        row("values", "shares sum to 1", "count(*) filter (where abs(s - 1) > 1e-6)", "from (select district_id, sum(share) as s from (select l_suppkey as district_id, sum(l_quantity) / sum(sum(l_quantity)) over (partition by l_suppkey) as share from lineitem join part on l_partkey = p_partkey group by l_suppkey, p_type) group by 1)"),
        row("values", "one nation per supplier", "count(*) filter (where a <> b or a is null)", "from (select s_suppkey, min(s_nationkey) as a, max(s_nationkey) as b from supplier group by 1)"),
        row("values", "gdp varies in a country", f"case when bool_or(a < b) then 0 else 1 end", f"from (select iso3, min(gdp) as a, max(gdp) as b from ({NATIONAL_SQL}) group by 1)"),
        row("values", "expected regions", "count(*) filter (where r_name is distinct from want)", "from (values (0, 'AFRICA'), (2, 'ASIA'), (9, 'NOWHERE')) w(k, want) left join region on r_regionkey = k"),
    ),
)
def value_checks(t: Tables):
    xw = t.spark.createDataFrame(CROSSWALK, "crop string, commodity string")
    allowed = t.spark.createDataFrame([("A",), ("N",), ("R",)], "l_returnflag string")
    shares = aggregate.shares(t.crops, ["district_id"], "crop", "area", "share")
    expected = t.spark.createDataFrame([(0, "AFRICA"), (2, "ASIA"), (9, "NOWHERE")], "r_regionkey int, r_name string")
    return checks.report(
        checks.subset_of(t.read("lineitem"), allowed, "values", "return flags", ["l_returnflag"]),
        checks.subset_of(t.read("part").select(F.col("p_type").alias("crop")), xw, "values", "crops mapped", ["crop"]),
        checks.unique_key(xw, "values", "commodity used once", ["commodity"]),
        checks.shares_sum_to_one(shares, "values", "shares sum to 1", ["district_id"], "share"),
        checks.constant_per(t.read("supplier"), "values", "one nation per supplier", ["s_suppkey"], "s_nationkey"),
        checks.varies_somewhere(t.national, "values", "gdp varies in a country", ["iso3"], "gdp"),
        checks.expected_values(t.read("region"), expected, "values", "expected regions", ["r_regionkey"], "r_name"),
    )


@query(
    "schema_checks",
    "VAL-5 VAL-15 VAL-1",
    rows(
        row("schema", "n_* is bigint", "0"),
        row("schema", "wb_* is double", "0"),
        row("schema", "yield_* is bigint", "1"),
        row("schema", "columns documented", "3"),
        row("schema", "year unlike the keys of the yearly table", "count(*)", f"from (select distinct year {_P} except select distinct year from ({YEARLY_SQL}))"),
    ),
)
def schema_checks(t: Tables):
    p = panel(t)
    listed = [c for c in ("district_id", "iso3", "region", "year", *MEASURES) if not c.startswith(("wb_", "yield_"))]
    words = t.spark.createDataFrame([(c,) for c in listed], "column string")
    return checks.report(
        checks.types_match(p, "schema", {"n_": "bigint", "wb_": "double", "yield_": "bigint"}),
        checks.documented(p, "schema", "columns documented", words),
        checks.key_set_equals(p, t.yearly, "schema", "year unlike the keys of the yearly table", ["year"]),
    )


@query(
    "source_contract",
    "SRC-16 FLT-2",
    rows(
        row("contract", "columns present", "1"),
        row("contract", "at least 1000 rows", "case when count(*) >= 1000 then 0 else 1 end", "from lineitem"),
        row("contract", "below the row cap", "case when count(*) < 100000000000 then 0 else 1 end", "from lineitem"),
        row("contract", "l_linestatus allowed", "count(*) filter (where l_linestatus not in ('F'))", "from lineitem"),
        row("contract", "l_linenumber in 1..7", "count(*) filter (where not l_linenumber between 1 and 7)", "from lineitem"),
    ),
)
def source_contract(t: Tables):
    return contracts.source_contract(
        t.read("lineitem"), "contract", required=["l_orderkey", "l_linenumber", "l_missing"], min_rows=1000, row_cap=100_000_000_000,
        allowed={"l_linestatus": ["F"]}, ranges={"l_linenumber": (1, 7)},
    )


@query(
    "load_manifest",
    "SRC-17",
    """select cast(year(l_shipdate) as integer) as year, count(*) as n_rows, min(l_shipdate) as first_date, max(l_shipdate) as last_date from lineitem group by 1""",
)
def load_manifest(t: Tables):
    lines = t.read("lineitem").select(F.year("l_shipdate").alias("year"), "l_shipdate")
    return contracts.manifest(lines, ["year"], "l_shipdate")


@query(
    "export_types",
    "SNK-3",
    "select * from (" + " union all ".join(
        f"select '{c}' as column, bool_and(coalesce({c} = floor({c}), true)) as whole from lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ) + ")",
)
def export_types(t: Tables):
    from panelweave.sources import sinks

    return sinks.whole_columns(t.read("lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
