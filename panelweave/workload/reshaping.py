"""Reshape, code-map, crosswalk, de-duplication and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelweave.functions import geo, numeric, text
from panelweave.operators import joins, reshape, select
from panelweave.session import stage
from panelweave.workload.base import FACTS_SQL, NATIONAL_SQL, SPINE_SQL, Tables, YEARLY_SQL, query
from panelweave.workload.series import CROSSWALK, XW_SQL

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "pivot_fixed",
    "PRJ-6 PRJ-7 PRJ-8",
    f"""select district_id, sum(best) filter (where kind = 'A') as fao_area_sb, sum(best) filter (where kind = 'N') as fao_area_ns,
      null::double as fao_area_xx,
      coalesce(sum(best) filter (where kind = 'A'), 0) + coalesce(sum(best) filter (where kind = 'N'), 0) as fao_area_total
    from ({FACTS_SQL}) where kind in ('A', 'N') group by 1""",
)
def pivot_fixed(t: Tables):
    names = {"A": "sb", "N": "ns", "X": "xx"}  # X never occurs: its column is still there
    chosen = t.facts.filter(F.col("kind").isin("A", "N"))
    wide = reshape.pivot_fixed(chosen, ["district_id"], "kind", names, {"area": F.sum("best")}, absent_zero=False, totals=True)
    return reshape.prefix_columns(wide, "fao_", ["district_id"])


@query(
    "unpivot_positive",
    "PRJ-5 AGG-37",
    "select p_brand, crop, sum(area) as area from (select p_brand, p_type as crop, l_quantity as area from lineitem join part on l_partkey = p_partkey) where area > 0 group by 1, 2",
)
def unpivot_positive(t: Tables):
    typed = t.read("lineitem").join(t.read("part"), F.col("l_partkey") == F.col("p_partkey"))
    wide = typed.groupBy("p_brand").agg(*[F.sum(F.when(F.col("p_type") == c, F.col("l_quantity")).otherwise(0.0)).alias(c) for c in TYPES])
    return reshape.melt_positive(wide, ["p_brand"], TYPES, "crop", "area")


@query(
    "dedup_priority",
    "WIN-1 WIN-2 JN-13",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice from (
      select *, row_number() over (partition by l_orderkey, l_linenumber
        order by l_quantity desc, l_partkey, l_suppkey, l_quantity, l_extendedprice) as rn from lineitem) where rn = 1""",
)
def dedup_priority(t: Tables):
    lines = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return select.keep_one(lines, ["l_orderkey", "l_linenumber"], [select.descending("l_quantity")])


@query(
    "collapse_duplicates",
    "AGG-32 VAL-2",
    "select l_orderkey, l_linenumber, count(*) as copies, sum(l_quantity) as quantity from lineitem group by 1, 2",
)
def collapse_duplicates(t: Tables):
    return t.read("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("copies"), F.sum("l_quantity").alias("quantity"))


@query(
    "coalesce_with_source",
    "PRJ-10",
    """with x as (select l_orderkey, l_linenumber, l_partkey, l_quantity, case when l_discount >= 0.05 then l_tax end as s,
        case when l_quantity >= 25 then l_discount end as a, case when l_returnflag = 'A' then l_quantity end as h from lineitem)
    select l_orderkey, l_linenumber, l_partkey, l_quantity, coalesce(s, a, h) + 0.0 as score,
      case when s is not null then 'S' when a is not null then 'A' when h is not null then 'H' end as source from x""",
)
def coalesce_with_source(t: Tables):
    scored = t.read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        F.when(F.col("l_discount") >= 0.05, F.col("l_tax")).alias("s"),
        F.when(F.col("l_quantity") >= 25, F.col("l_discount")).alias("a"),
        F.when(F.col("l_returnflag") == "A", F.col("l_quantity")).alias("h"),
    )
    value, source = reshape.first_known({"s": "S", "a": "A", "h": "H"})
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", (value + 0.0).alias("score"), source.alias("source"))


_SLOTS_SQL = """select o_orderkey, o_custkey, (o_orderstatus = 'F')::integer * 2 as s1, (o_orderpriority like '1%')::integer as s2,
  (o_totalprice > 300000)::integer * 2 as s3, (o_orderstatus = 'P')::integer as s4, o_orderpriority, o_orderstatus from orders"""


@query(
    "row_slots_count",
    "PRJ-9 DOM-13",
    f"""select o_orderkey, ((s1 <> 0)::integer + (s2 <> 0)::integer + (s3 <> 0)::integer + (s4 <> 0)::integer)::bigint as coups_total,
      ((s1 = 2)::integer + (s2 = 2)::integer + (s3 = 2)::integer + (s4 = 2)::integer)::bigint as coups_successful,
      ((s1 = 1)::integer + (s2 = 1)::integer + (s3 = 1)::integer + (s4 = 1)::integer)::bigint as coups_failed from ({_SLOTS_SQL})""",
)
def row_slots_count(t: Tables):
    slots = [
        (F.col("o_orderstatus") == "F").cast("int") * 2, F.col("o_orderpriority").like("1%").cast("int"),
        (F.col("o_totalprice") > 300000).cast("int") * 2, (F.col("o_orderstatus") == "P").cast("int"),
    ]
    return t.read("orders").select(
        "o_orderkey",
        reshape.row_count(slots, lambda x: x != 0).alias("coups_total"),
        reshape.row_count(slots, lambda x: x == 2).alias("coups_successful"),
        reshape.row_count(slots, lambda x: x == 1).alias("coups_failed"),
    )


@query(
    "row_any_match",
    "PRJ-11 PRJ-22 FLT-7",
    """select p_partkey, (lower(p_name) like '%widget%' or lower(p_brand) like '%widget%' or lower(p_type) like '%widget%') as has_widget,
      (p_name = 'ECONOMY' or p_brand = 'ECONOMY' or p_type = 'ECONOMY') as is_economy,
      (p_size > 45 or p_retailprice > 2000)::integer as caution from part""",
)
def row_any_match(t: Tables):
    names = ["p_name", "p_brand", "p_type"]
    over = t.read("part").withColumns({"over_size": F.greatest(F.col("p_size") - 45, F.lit(0)), "over_price": F.greatest(F.col("p_retailprice") - 2000, F.lit(0.0))})
    return over.select(
        "p_partkey",
        reshape.any_column(names, "Widget", whole=False, ignore_case=True).alias("has_widget"),
        reshape.any_column(names, "ECONOMY", whole=True).alias("is_economy"),
        reshape.any_positive(["over_size", "over_price"]).alias("caution"),
    )


@query(
    "repeated_group_extremes",
    "PRJ-12 DOM-12",
    """with o as (select o_custkey, o_orderpriority as p, count(*) as n, min(year(o_orderdate)) as a, max(year(o_orderdate)) as b from orders group by 1, 2),
    act as (select * from o where n >= 2),
    agg as (select o_custkey, arg_max(p, b * 10 + cast(left(p, 1) as integer)) as holder_last, count(*) as n_holders, min(a) as s, max(b) as e from act group by 1),
    everyone as (select distinct o_custkey from orders)
    select v.o_custkey, coalesce(holder_last, 'None') as holder_last, coalesce(n_holders, 0) as n_holders,
      s::double as start_year, e::double as end_year, (e - s)::double as duration_years
    from everyone v left join agg on v.o_custkey = agg.o_custkey""",
)
def repeated_group_extremes(t: Tables):
    powers = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    year = F.year("o_orderdate")
    aggs = []
    for i, p in enumerate(powers):
        mine = F.col("o_orderpriority") == p
        aggs += [
            (F.count_if(mine) >= 2).cast("int").alias(f"col.{i}"),
            F.min(F.when(mine, year)).alias(f"colstart.{i}_mean"),
            F.max(F.when(mine, year)).alias(f"colend.{i}_mean"),
        ]
    wide = t.read("orders").groupBy("o_custkey").agg(*aggs)
    groups = {p: (f"col.{i}", f"colstart.{i}_mean", f"colend.{i}_mean") for i, p in enumerate(powers)}
    facts = reshape.holders(groups)
    years = {c: F.col(c).cast("double") for c in ("start_year", "end_year", "duration_years")}
    return wide.select("o_custkey", *[v.alias(k) for k, v in facts.items()]).withColumns(years)


@query(
    "override_and_impute",
    "PRJ-13 PRJ-14 PRJ-15 PRJ-4 PRJ-23",
    f"""with x as (select district_id, iso3, case when s_acctbal < 2000 then null when s_acctbal < 6000 then 'civil' else 'common' end as origin,
        case when region in ('AFRICA', 'ASIA') then 'French' else 'British' end as power from ({SPINE_SQL})),
    o as (select district_id, iso3, power, case when iso3 = 'NATION_7' then 'common' when iso3 = 'NATION_3' then 'civil' else origin end as origin from x)
    select district_id, origin, (origin is null)::integer as origin_imputed,
      coalesce(origin, case power when 'French' then 'civil' when 'British' then 'common' end) as origin_filled,
      (power = 'British')::integer as col_british, case when power = 'French' then 'central' else 'other' end as level from o""",
)
def override_and_impute(t: Tables):
    raw = t.spine.select(
        "district_id", "iso3",
        F.when(F.col("s_acctbal") < 2000, None).when(F.col("s_acctbal") < 6000, "civil").otherwise("common").alias("origin"),
        F.when(F.col("region").isin("AFRICA", "ASIA"), "French").otherwise("British").alias("power"),
    )
    fixes = t.spark.createDataFrame([("NATION_7", "common"), ("NATION_3", "civil")], "iso3 string, origin string")
    fixed = joins.override_join(raw, fixes, ["iso3"], "origin")
    return fixed.withColumns(reshape.impute("origin", "power", {"French": "civil", "British": "common"})).select(
        "district_id", "origin", "origin_imputed", "origin_filled",
        numeric.flag(F.col("power") == "British").alias("col_british"),
        reshape.map_codes(F.col("power"), {"French": "central"}, F.lit("other")).alias("level"),
    )


@query(
    "outer_join_two_sources",
    "JN-9 JN-11",
    f"""with n as ({NATIONAL_SQL}), a as (select iso3, year, n_orders from n where n_orders >= (select avg(n_orders) from n)),
    l as (select s.iso3, y.year, count(*) as n_lines from ({FACTS_SQL}) y join ({SPINE_SQL}) s on y.district_id = s.district_id group by 1, 2),
    b as (select * from l where n_lines >= (select avg(n_lines) from l))
    select coalesce(a.iso3, b.iso3) as iso3, coalesce(a.year, b.year) as year, n_orders::double as n_orders, n_lines::double as n_lines
    from a full join b on a.iso3 = b.iso3 and a.year = b.year""",
)
def outer_join_two_sources(t: Tables):
    busy = F.col("n_orders") >= t.national.agg(F.avg("n_orders")).scalar()
    a = t.national.filter(busy).select("iso3", "year", F.col("n_orders").cast("double").alias("n_orders"))
    lines = stage(t.yearly.join(t.spine, "district_id").groupBy("iso3", "year").agg(F.sum("n").cast("double").alias("n_lines")))
    return joins.outer_merge(a, lines.filter(F.col("n_lines") >= lines.agg(F.avg("n_lines")).scalar()), ["iso3", "year"])


@query(
    "indicator_columns",
    "JN-10",
    f"""select iso3, year, max(v) filter (where k = 'orders') as orders, max(v) filter (where k = 'gdp') as gdp, max(v) filter (where k = 'lines') as lines from (
      select iso3, year, 'orders' as k, n_orders::double as v from ({NATIONAL_SQL})
      union all select iso3, year, 'gdp', gdp from ({NATIONAL_SQL}) where gdp > 240000
      union all select s.iso3, y.year, 'lines', count(*)::double from ({FACTS_SQL}) y join ({SPINE_SQL}) s on y.district_id = s.district_id group by 1, 2) group by 1, 2""",
)
def indicator_columns(t: Tables):
    keys = ["iso3", "year"]
    lines = t.facts.join(t.spine, "district_id").groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("v"))
    series = [
        ("orders", t.national.select(*keys, F.col("n_orders").cast("double").alias("v"))),
        ("gdp", t.national.filter(F.col("gdp") > 240000).select(*keys, F.col("gdp").alias("v"))),
        ("lines", lines),
    ]
    return joins.stack_indicators(series, keys, "v")


@query(
    "preferred_source",
    "SET-1 SET-3 WIN-1",
    f"""select district_id, year, n, source from (
      select *, row_number() over (partition by district_id, year order by rank) as rn from (
        select district_id, year, count(*) as n, 'A' as source, 0 as rank from ({FACTS_SQL}) where kind = 'A' group by 1, 2
        union all select district_id, year, count(*), 'N', 1 from ({FACTS_SQL}) where kind = 'N' group by 1, 2
        union all select district_id, year, n, 'all', 2 from ({YEARLY_SQL}))) where rn = 1""",
)
def preferred_source(t: Tables):
    def source(kind: str):
        return t.facts.filter(F.col("kind") == kind).groupBy("district_id", "year").agg(F.count(F.lit(1)).alias("n")).withColumn("source", F.lit(kind))

    rest = t.yearly.select("district_id", "year", "n", F.lit("all").alias("source"))
    return select.prefer([source("A"), source("N"), rest], ["district_id", "year"])


_V = "(o_totalprice + 0.003) * pow(10, o_orderkey % 11 - 9)"  # no value lies halfway between two roundings


@query(
    "human_numbers",
    "FN-16",
    f"""select o_orderkey, case when o_orderkey % 11 = 10 then '—' when v >= 1e6 then format('{{:,.2f}}', v / 1e6) || 'M' when v >= 1000 then format('{{:,.0f}}', v)
      when v >= 1 then format('{{:,.2f}}', v) when v < 1e-4 then printf('%.3e', v) else printf('%.4g', v) end as shown
    from (select o_orderkey, {_V} as v from orders)""",
)
def human_numbers(t: Tables):
    """Order values over eleven magnitudes, and unknown ones, as a reader sees them."""
    v = F.when(F.col("o_orderkey") % 11 != 10, F.expr(_V))
    return t.read("orders").select("o_orderkey", numeric.human(v).alias("shown"))


@query(
    "flat_points",
    "FN-18",
    "select c_custkey, c_nationkey::double as x, c_acctbal as y from customer",
)
def flat_points(t: Tables):
    """Customers as points with a height, which goes."""
    z = F.struct(F.col("c_nationkey").cast("double").alias("x"), F.col("c_acctbal").alias("y"), F.col("c_custkey").cast("double").alias("z"))
    return t.read("customer").select("c_custkey", geo.flat_point(z).alias("p")).select("c_custkey", "p.*")


@query(
    "union_missing_columns",
    "SET-2",
    """select src, count(*) as n, count(treated) as n_treated, round(sum(treated), 4) as treated from (
      select 'SWARM' as src, l_quantity as treated from lineitem where l_returnflag = 'A'
      union all select 'BAND', null from orders where o_orderstatus = 'P') group by 1""",
)
def union_missing_columns(t: Tables):
    swarms = t.read("lineitem").filter(F.col("l_returnflag") == "A").select(F.lit("SWARM").alias("src"), F.col("l_quantity").alias("treated"))
    bands = t.read("orders").filter(F.col("o_orderstatus") == "P").select(F.lit("BAND").alias("src"))
    both = swarms.unionByName(bands, allowMissingColumns=True)
    return both.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.count("treated").alias("n_treated"), F.round(F.sum("treated"), 4).alias("treated"))


@query(
    "crosswalk_unmapped",
    "JN-14 JN-15 VAL-26 SET-4",
    f"select p_type as crop from (select distinct p_type from lineitem join part on l_partkey = p_partkey) where p_type not in (select crop from {XW_SQL})",
)
def crosswalk_unmapped(t: Tables):
    lines = t.read("lineitem").join(t.read("part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_type").alias("crop"), "l_orderkey", "l_linenumber")
    xw = t.spark.createDataFrame(CROSSWALK, "crop string, commodity string")
    return joins.crosswalk_join(lines, xw, ["crop"], ["l_orderkey", "l_linenumber"])[1]


@query(
    "crosswalk_mapped",
    "JN-14 DOM-4",
    f"""select x.commodity, count(*) as n, cast(sum(l_quantity) as bigint) as quantity from lineitem join part on l_partkey = p_partkey
    left join (select * from {XW_SQL}) x on p_type = x.crop group by 1""",
)
def crosswalk_mapped(t: Tables):
    lines = t.read("lineitem").join(t.read("part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_type").alias("crop"), "l_orderkey", "l_quantity")
    xw = t.spark.createDataFrame(CROSSWALK, "crop string, commodity string")
    joined, _ = joins.crosswalk_join(lines, xw, ["crop"], ["l_orderkey"])
    return joined.groupBy("commodity").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))


@query(
    "salted_lookup",
    "JN-2",
    """select l_returnflag, p_type, count(*) as n, cast(sum(l_quantity) as bigint) as quantity
    from lineitem left join part on l_partkey = p_partkey group by 1, 2""",
)
def salted_lookup(t: Tables):
    lines = t.read("lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    parts = t.read("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    joined = joins.salted_join(lines, parts, ["l_partkey"], ["l_orderkey", "l_linenumber"])
    return joined.groupBy("l_returnflag", "p_type").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))


@query(
    "key_guards",
    "FLT-3 FLT-4 FLT-5 FLT-9 FLT-10 FLT-13",
    """select n_nationkey, n_name, lpad(cast(n_nationkey as varchar), 3, '0') as code,
      regexp_matches(upper(left(n_name, 3)), '^[A-Z]{3}$') as plain,
      case when n_nationkey = 3 then 'NATION_4' else n_name end as successor
    from nation where n_nationkey < 20 and n_name <> 'NATION_9' and n_nationkey is not null and n_name not in ('NATION_11', 'NATION_12')""",
)
def key_guards(t: Tables):
    nation = t.read("nation").select("n_nationkey", "n_name")
    aggregates = t.spark.createDataFrame([("NATION_11",), ("NATION_12",)], "n_name string")
    quarantine = t.spark.createDataFrame([("NATION_9",)], "n_name string")
    kept = select.exclude_rows(select.exclude_rows(nation, aggregates, ["n_name"]), quarantine, ["n_name"])
    code = text.bare_code(F.concat(F.lit("'"), text.title_code(F.col("n_nationkey"), 3)))
    return kept.filter(F.col("n_nationkey") < 20).na.drop(subset=["n_nationkey"]).select(
        "n_nationkey", "n_name", code.alias("code"),
        F.upper(F.substring("n_name", 1, 3)).rlike("^[A-Z]{3}$").alias("plain"),
        F.when(F.col("n_nationkey") == 3, "NATION_4").otherwise(F.col("n_name")).alias("successor"),
    )


@query(
    "prefix_codes",
    "FLT-4 FN-1 FN-5",
    """select p_brand, split_part(p_brand, '#', 2) as code, count(*) as n, concat_ws(' ', split_part(p_brand, '#', 2), min(p_type)) as label
    from part where p_brand like 'Brand#1%' group by 1""",
)
def prefix_codes(t: Tables):
    raw = t.read("part").withColumn("protected", F.concat(F.lit("'"), F.col("p_brand")))
    bare = raw.withColumn("brand", text.bare_code(F.col("protected"))).filter(F.startswith(F.col("brand"), F.lit("Brand#1")))
    code = F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2))
    return bare.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.min("p_type").alias("_t")).select(
        "p_brand", code.alias("code"), "n", text.label(code, F.col("_t")).alias("label")
    )


@query(
    "quarantined_suppliers",
    "FLT-9 JN-15",
    """select s_suppkey, s_name from supplier where s_nationkey not in (select n_nationkey from nation where n_regionkey = 2)""",
)
def quarantined_suppliers(t: Tables):
    out = t.read("nation").filter(F.col("n_regionkey") == 2).select(F.col("n_nationkey").alias("s_nationkey"))
    return select.exclude_rows(t.read("supplier"), out, ["s_nationkey"]).select("s_suppkey", "s_name")


@query(
    "study_members",
    "FLT-8 DOM-5 JN-15",
    f"""select district_id, case when region in ('AMERICA') then 'South' else region end as area, region in ('AFRICA', 'AMERICA') as kept
    from ({SPINE_SQL}) where iso3 in (select iso3 from (select iso3, sum(n_orders) as n, avg(sum(n_orders)) over () as m from ({NATIONAL_SQL}) group by 1) where n >= m)""",
)
def study_members(t: Tables):
    sizes = t.national.groupBy("iso3").agg(F.sum("n_orders").alias("n"))
    members = sizes.filter(F.col("n") >= sizes.agg(F.avg("n")).scalar())
    area = F.when(F.col("region") == "AMERICA", "South").otherwise(F.col("region"))
    return joins.keep_members(t.spine, members, ["iso3"]).select("district_id", area.alias("area"), F.col("region").isin("AFRICA", "AMERICA").alias("kept"))


@query(
    "masked_outside_region",
    "FLT-11 PRJ-16",
    f"select y.district_id, y.year, case when region = 'AFRICA' then n::double end as n, case when region = 'AFRICA' then value end as value from ({YEARLY_SQL}) y join ({SPINE_SQL}) s on y.district_id = s.district_id",
)
def masked_outside_region(t: Tables):
    named = t.yearly.withColumn("n", F.col("n").cast("double")).join(t.spine.select("district_id", "region"), "district_id")
    return select.mask_outside(named, F.col("region") == "AFRICA", ["n", "value"]).drop("region")


@query(
    "interactive_filter",
    "FLT-12 PRJ-21",
    f"select y.district_id, iso3, region, year, n from ({YEARLY_SQL}) y join ({SPINE_SQL}) s on y.district_id = s.district_id where region in ('AFRICA', 'ASIA') and year between 1996 and 1999",
)
def interactive_filter(t: Tables):
    named = t.yearly.join(t.spine, "district_id")
    layers = {"Keys": ["district_id", "iso3", "region", "year"], "Counts": ["n", "year"]}
    chosen = select.filter_panel(named, regions=["AFRICA", "ASIA"], years=(1996, 1999))
    return chosen.select(*reshape.columns_by_layer(layers, ["Counts"], layers["Keys"]))


@query(
    "display_labels",
    "PRJ-20 PRJ-19 PRJ-1",
    """select n_nationkey, coalesce(r_name || ' — ' || n_name, n_name) as label, trim(coalesce(case when r_name like 'A%' then ' ' || r_name || ' ' end, '')) as region_text
    from nation left join (select * from region where r_name <> 'ASIA') r on n_regionkey = r_regionkey""",
)
def display_labels(t: Tables):
    names = t.read("region").filter(F.col("r_name") != "ASIA")
    joined = t.read("nation").join(names, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    padded = F.when(F.startswith(F.col("r_name"), F.lit("A")), F.concat(F.lit(" "), "r_name", F.lit(" ")))
    return joined.select("n_nationkey", reshape.label_of(F.col("r_name"), F.col("n_name")).alias("label"), text.clean(padded).alias("region_text"))


@query(
    "json_measures",
    "FN-17 SRC-7",
    "select event_type, count(*) as n, sum(cast(json_extract_string(props, '$.k') as bigint))::bigint as k_sum, max(cast(json_extract_string(props, '$.k') as bigint)) as k_max from events group by 1",
)
def json_measures(t: Tables):
    k = F.from_json("props", "struct<k: bigint>")["k"]
    return t.read("events").withColumn("k", k).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("k_sum"), F.max("k").alias("k_max")
    )


@query(
    "lenient_numbers",
    "PRJ-2 PRJ-3 PRJ-18 FN-11",
    """select p_type, count(*) as n, count(try_cast(split_part(p_brand, '#', 2) as double)) as n_brand,
      round(sum(case when p_size <> 7 then p_size / 100.0 * 100.0 end), 4) as pct, count(try_cast(p_name as double)) as n_bad from part group by 1""",
)
def lenient_numbers(t: Tables):
    brand = numeric.number_or_null(F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)))
    size = numeric.number_or_null(F.col("p_size").cast("string"), ["7"])
    return t.read("part").groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(brand).alias("n_brand"),
        F.round(F.sum(numeric.finite(numeric.percent(size / 100.0))), 4).alias("pct"),
        F.count(numeric.number_or_null(F.col("p_name"))).alias("n_bad"),
    )


@query(
    "top_rows_per_group",
    "ORD-6",
    """select l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice from (
      select *, row_number() over (partition by l_suppkey order by l_extendedprice, l_orderkey) as rn from lineitem
      where l_suppkey in (select s_suppkey from supplier where s_acctbal > 5000)) where rn <= 100""",
)
def top_rows_per_group(t: Tables):
    lines = t.read("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    picks = t.read("supplier").filter(F.col("s_acctbal") > 5000).select(F.col("s_suppkey").alias("l_suppkey"))
    return select.picked_groups(lines, picks, ["l_suppkey"], 100, ["l_extendedprice", "l_orderkey"])


@query(
    "entity_sample",
    "ORD-4",
    f"""select district_id, year, n, value from ({YEARLY_SQL}) where district_id = 3 or district_id in (
      select s_suppkey from supplier order by md5('42|' || s_suppkey), s_suppkey limit 20)""",
)
def entity_sample(t: Tables):
    drawn = select.sample_entities(t.spine.select("district_id"), "district_id", 20, 42, always=[3])
    return joins.keep_members(t.yearly, drawn, ["district_id"])


@query(
    "row_sample",
    "ORD-5",
    f"select district_id, year, n, value from ({YEARLY_SQL}) order by md5('0|' || district_id || '|' || year), district_id, year limit 5000",
)
def row_sample(t: Tables):
    return select.sample_rows(t.yearly, 5000, 0, ["district_id", "year"])


@query(
    "ordered_preview",
    "ORD-1 ORD-3",
    f"select district_id, year, n, value from ({YEARLY_SQL}) order by n desc, district_id, year limit 500",
)
def ordered_preview(t: Tables):
    return select.preview(t.yearly, 500, [F.desc("n"), "district_id", "year"])
