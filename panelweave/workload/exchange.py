"""Round trips: a given table written out, read back through a source or sink, compared with the table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators import checks, select, spatial
from panelweave.plans import country_layers
from panelweave.session import run_folder, stage
from panelweave.sources import readers, refresh, sinks
from panelweave.workload.base import FACTS_SQL, LAST, NATIONAL_SQL, SPINE_SQL, YEARLY_SQL, Tables, query
from panelweave.workload.spatial import BOX, GRID, POINTS_SQL, WIDE, _ring, points


def scratch(t: Tables) -> str:
    """A folder of this run's own that all executors share."""
    return f"{run_folder(t.spark)}/exchange-{uuid.uuid4().hex}"


@query("csv_contract_roundtrip", "SRC-2 SNK-2", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def csv_contract_roundtrip(t: Tables):
    out, path = t.read("supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"), scratch(t)
    sinks.write_csv(out, path, ["s_suppkey"])
    return readers.read_csv(t.spark, path, out.schema)


@query(
    "long_csv_filtered",
    "SRC-3",
    "select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem where l_returnflag in ('A', 'R') and l_quantity >= 10",
)
def long_csv_filtered(t: Tables):
    out, path = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"), scratch(t)
    sinks.write_csv(out, path)
    return readers.read_long(t.spark, path, out.schema, [F.col("l_returnflag").isin("A", "R"), F.col("l_quantity") >= 10])


@query("latin1_table", "SRC-4 SRC-5", "select p_partkey::bigint as p_partkey, p_name || ' é' as p_name from part")
def latin1_table(t: Tables):
    path = scratch(t)
    out = t.read("part").select(F.col("p_partkey").alias(" p_partkey "), F.concat("p_name", F.lit(" é")).alias("p_name"))
    out.write.option("header", True).option("sep", "\t").option("encoding", "ISO-8859-1").option("quoteAll", True).csv(path)
    raw = readers.read_text_table(t.spark, path, ["p_partkey", "p_name"], encoding="ISO-8859-1")
    return raw.select(F.col("p_partkey").try_cast("bigint").alias("p_partkey"), "p_name")


def _named_files(t: Tables, df: DataFrame, by: str, folder: str) -> None:
    """One or more parquet files for each value of ``by``, which only the file's name carries."""
    df.write.partitionBy(by).parquet(f"{folder}/parts")
    path = t.spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(t.spark._jsc.hadoopConfiguration())
    system.mkdirs(path(f"{folder}/named"))
    for part in system.listStatus(path(f"{folder}/parts")):
        value = part.getPath().getName().partition("=")[2]
        for k, file in enumerate(system.listStatus(part.getPath()) if value else []):
            system.rename(file.getPath(), path(f"{folder}/named/orders_{value}_{k}.parquet"))


@query(
    "files_by_name",
    "SRC-6 SRC-8",
    "select year(o_orderdate)::integer as year, count(*) as n, sum(o_orderkey)::bigint as keys from orders group by 1",
)
def files_by_name(t: Tables):
    folder = scratch(t)
    orders = t.read("orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    _named_files(t, orders, "y", folder)
    orders.drop("y").limit(0).write.mode("append").parquet(f"{folder}/named")  # an empty file adds nothing
    year = readers.name_part(r"^orders_(\d+)_").cast("int")
    found = readers.read_many(t.spark, f"{folder}/named").withColumn("year", year)
    return found.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query(
    "indicator_records",
    "SRC-7",
    f"select 'ORD' as code, 'n_orders' as \"column\", iso3, year, n_orders::double as value from ({NATIONAL_SQL})",
)
def indicator_records(t: Tables):
    path = scratch(t)
    item = F.struct(F.col("iso3").alias("countryiso3code"), F.col("year").cast("string").alias("date"), F.col("n_orders").cast("string").alias("value"))
    dumps = t.national.groupBy("iso3").agg(F.to_json(F.struct(F.lit("ORD").alias("code"), F.lit("n_orders").alias("column"), F.collect_list(item).alias("data"))).alias("value"))
    dumps.write.partitionBy("iso3").text(path)  # a file a dump
    return readers.read_indicators(t.spark, f"{path}/*/*.txt")


FEATURES = 1000  # of a file, about


def feature_files(features: DataFrame, group: str, key: str) -> DataFrame:
    """(group, part, value): the features of each group in files of about ``FEATURES``, dealt by a hash of the key."""
    parts = features.groupBy(F.col(group).alias("of")).agg(F.ceil(F.count(F.lit(1)) / F.lit(FEATURES)).alias("parts"))
    # one row a group, that is a nation
    dealt = features.join(F.broadcast(parts), F.col(group).eqNullSafe(F.col("of"))).withColumn("part", F.pmod(F.xxhash64(key), F.col("parts")))
    return dealt.groupBy(group, "part").agg(F.to_json(F.struct(F.collect_list("feature").alias("features"))).alias("value"))


@query(
    "geojson_features",
    "SRC-9",
    f"""select s_suppkey as district_id, 4 as edges, round(s_suppkey % {WIDE} + {BOX[0][0]}, 6) as xmin, round(floor(s_suppkey / {WIDE}) + {BOX[0][1]}, 6) as ymin
    from supplier""",
)
def geojson_features(t: Tables):
    path = scratch(t)
    ring = F.transform(_ring("s_suppkey", BOX), lambda p: F.array(p["x"].cast("double"), p["y"].cast("double")))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    feature = F.struct(F.struct(F.col("s_suppkey").alias("district_id")).alias("properties"), shape.alias("geometry"))
    files = feature_files(t.read("supplier").select("s_nationkey", "s_suppkey", feature.alias("feature")), "s_nationkey", "s_suppkey")
    files.write.partitionBy("s_nationkey", "part").text(path)  # a file a part
    features = readers.read_features(t.spark, f"{path}/*/*/*.txt", "district_id bigint")
    geom = spatial.polygons(readers.feature_polygons(features, ["district_id"]), ["district_id"])
    return geom.select("district_id", F.size("edges").alias("edges"), F.round("xmin", 6).alias("xmin"), F.round("ymin", 6).alias("ymin"))


@query("lookup_lines", "SRC-10", "select n_nationkey::bigint as n_nationkey, n_name, n_regionkey::bigint as n_regionkey from nation")
def lookup_lines(t: Tables):
    path, nation = scratch(t), t.read("nation")
    lines = nation.select(F.format_string("  %d  %s (region %d)", "n_nationkey", "n_name", "n_regionkey").alias("value"))
    lines.union(t.spark.createDataFrame([("Codes and names:",), ("",)], "value string")).write.text(path)
    pattern = r"^\s*(\d+)\s+(\S.*?)\s+\(region (\d+)\)\s*$"
    found = readers.parse_lines(t.spark, path, pattern, ["n_nationkey", "n_name", "n_regionkey"], nation.count())
    return found.select(F.col("n_nationkey").cast("bigint"), "n_name", F.col("n_regionkey").cast("bigint"))


@query(
    "raster_cells",
    "SRC-13",
    f"""select floor(lon / {GRID})::bigint as cx, floor(lat / {GRID})::bigint as cy, count(*) as n, count(*) filter (best <> 50) as known,
      sum(best) filter (best <> 50) as total from ({POINTS_SQL}) group by 1, 2""",
)
def raster_cells(t: Tables):
    gridded = readers.cells_of(points(t).select("lon", "lat", "best"), "lon", "lat", "best", GRID, nodata=50)
    return gridded.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("known"), F.sum("value").alias("total"))


@query(
    "refreshed_years",
    "SRC-15",
    f"""with y as (select * from ({YEARLY_SQL}) where year < {LAST}), l as (select max(year) as last from y)
    select year, count(*) as n, case when year > last - 2 then 'new' else 'old' end as tag from y, l where year <> last group by year, last""",
)
def refreshed_years(t: Tables):
    """The trailing two years are loaded again; the last one has no rows any more and goes."""
    path, years = scratch(t), t.yearly.filter(F.col("year") < LAST)
    held = sorted(r["year"] for r in years.select("year").distinct().collect())  # calendar years
    refresh.refresh_years(years.withColumn("tag", F.lit("old")), path, held)
    again = years.filter(F.col("year") < held[-1]).withColumn("tag", F.lit("new"))
    refresh.refresh_trailing(again, path, held[-1], trailing=2)
    return t.spark.read.parquet(path).groupBy("year", "tag").agg(F.count(F.lit(1)).alias("n")).select("year", "n", "tag")


@query("sorted_parquet", "SNK-1", YEARLY_SQL)
def sorted_parquet(t: Tables):
    path = scratch(t)
    sinks.write_sorted(t.yearly, path, ["district_id", "year"])
    return t.spark.read.parquet(path)


@query("gated_export", "SNK-4", "select s_suppkey, s_name from supplier")
def gated_export(t: Tables):
    path = scratch(t)
    held = sinks.publishable(t.read("supplier").select("s_suppkey", "s_name", "s_acctbal"), ["s_acctbal"], drop=True)
    sinks.write_csv(held, path)
    return readers.read_csv(t.spark, path, held.schema)


@query(
    "bounded_slice",
    "SNK-7",
    """select o_orderkey, o_orderstatus from orders where o_orderdate > (select max(o_orderdate) - interval 7 day from orders)
    order by o_totalprice desc, o_orderkey limit 500""",
)
def bounded_slice(t: Tables):
    """The 500 dearest orders of the last week: a report that does not grow with the table."""
    path, orders = scratch(t), t.read("orders")
    recent = orders.filter(F.col("o_orderdate") > F.date_sub(orders.agg(F.max("o_orderdate")).scalar(), 7))
    chosen = recent.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(500).select("o_orderkey", "o_orderstatus")
    sinks.bounded_export(chosen, path)
    return readers.read_csv(t.spark, path, chosen.schema)


@query(
    "observed_filters",
    "FLT-1 FLT-9",
    f"""select * from (values (1, 'severe', (select count(*) from ({FACTS_SQL}) where best >= 40)),
      (2, 'discounted', (select count(*) from ({FACTS_SQL}) where best >= 40 and l_discount >= 0.05)),
      (3, 'precise', (select count(*) from ({FACTS_SQL}) where best >= 40 and l_discount >= 0.05 and l_tax <= 0.06))) as v(step, name, kept)
    join (select (select count(*) from ({FACTS_SQL}) where best >= 40 and l_discount >= 0.05 and l_tax <= 0.06)::bigint as written) on true""",
)
def observed_filters(t: Tables):
    """Rows that each filter keeps, counted by the job that writes what passes them all."""
    path = scratch(t)
    steps = {"severe": F.col("best") >= 40, "discounted": F.col("l_discount") >= 0.05, "precise": F.col("l_tax") <= 0.06}
    kept, told = select.observed(t.facts.select("district_id", "best", "l_discount", "l_tax"), steps)
    kept.write.parquet(path)
    tally = t.spark.createDataFrame([(k, name, told()[name]) for k, name in enumerate(steps, 1)], "step int, name string, kept bigint")
    return tally.withColumn("written", F.lit(t.spark.read.parquet(path).count()).cast("bigint"))


@query(
    "build_report",
    "SNK-5",
    f"""with y as ({YEARLY_SQL}), w as (select y.*, g.gdp from y join ({SPINE_SQL}) s on y.district_id = s.district_id left join ({NATIONAL_SQL}) g on s.iso3 = g.iso3 and y.year = g.year),
    k as (select 1 as line, 'columns: 5' as text
      union all select 2, format('{{:32s}} {{:10s}} known ', 'district_id', 'bigint') || lpad(format('{{:,}}', count(district_id)), 14, ' ') || format(' ({{:.2f}}%)', count(district_id) * 100.0 / count(*)) from w
      union all select 3, format('{{:32s}} {{:10s}} known ', 'year', 'int') || lpad(format('{{:,}}', count(year)), 14, ' ') || format(' ({{:.2f}}%)', count(year) * 100.0 / count(*)) from w
      union all select 4, format('{{:32s}} {{:10s}} known ', 'n', 'bigint') || lpad(format('{{:,}}', count(n)), 14, ' ') || format(' ({{:.2f}}%)', count(n) * 100.0 / count(*)) from w
      union all select 5, format('{{:32s}} {{:10s}} known ', 'value', 'double') || lpad(format('{{:,}}', count(value)), 14, ' ') || format(' ({{:.2f}}%)', count(value) * 100.0 / count(*)) from w
      union all select 6, format('{{:32s}} {{:10s}} known ', 'gdp', 'double') || lpad(format('{{:,}}', count(gdp)), 14, ' ') || format(' ({{:.2f}}%)', count(gdp) * 100.0 / count(*)) from w
      union all select 7, 'district-years: ' || format('{{:,}}', count(*)) from w
      union all select 8, 'with national figures: ' || format('{{:,}}', count(gdp)) from w
      union all select 9, 'n: min ' || format('{{:.2f}}', min(n)::double) || ', median ' || format('{{:.2f}}', quantile_cont(n::double, 0.5)) || ', max ' || format('{{:.2f}}', max(n)::double) from w)
    select * from k""",
)
def build_report(t: Tables):
    """The report of a build as its lines: columns, join tallies and the spread of one measure."""
    placed = t.yearly.join(t.spine.select("district_id", "iso3"), "district_id").join(t.national.select("iso3", "year", "gdp"), ["iso3", "year"], "left")
    wide = stage(placed.select("district_id", "year", "n", "value", "gdp"))
    met = wide.agg(F.count(F.lit(1)).alias("rows"), F.count("gdp").alias("known")).first()
    report = sinks.build_report(wide, {"district-years": met["rows"], "with national figures": met["known"]}, ["n"])
    return t.spark.createDataFrame(list(enumerate(report.split("\n"), 1)), "line int, text string")


@query("audit_crosswalk", "SNK-8", f"select distinct iso3, region from ({SPINE_SQL})")
def audit_crosswalk(t: Tables):
    path = scratch(t)
    sinks.write_csv(t.spine.select("iso3", "region").distinct(), path, ["iso3"])
    return readers.read_text_table(t.spark, path, ["iso3", "region"], sep=",")


@query(
    "validation_text",
    "SNK-6",
    f"""with v as (select count(*) filter (n > 1) as v from (select count(*) as n from ({YEARLY_SQL}) group by district_id, year)),
    w as (select count(*) filter (not (n > 3)) as v from ({YEARLY_SQL})), r as (select 'one row a year' as name, v from v union all select 'over three events', v from w)
    select '[' || case when v = 0 then 'PASS' else 'FAIL' end || '] yearly / ' || name || ' (violations: ' || v || ')' as line from r
    union all select count(*) filter (v = 0) || ' of ' || count(*) || ' checks passed' from r""",
)
def validation_text(t: Tables):
    found = checks.report(
        checks.unique_key(t.yearly, "yearly", "one row a year", ["district_id", "year"]), checks.rows_hold(t.yearly, "yearly", {"over three events": F.col("n") > 3})
    )
    return t.spark.createDataFrame([(line,) for line in checks.summary_text(found).splitlines()], "line string")


@query(
    "price_sheet",
    "SRC-11 SRC-12",
    """select case o_orderstatus when 'F' then 'finished_goods' else 'open_goods' end as commodity_code, case o_orderstatus when 'F' then 'Finished goods' else 'Open goods' end as commodity_name,
      case o_orderstatus when 'F' then '$/mt' else 'kg' end as unit, year(o_orderdate)::integer as year, count(*)::double as value
    from orders where o_orderstatus in ('F', 'O') group by o_orderstatus, year(o_orderdate)""",
)
def price_sheet(t: Tables):
    """A sheet whose first rows name its columns and their units."""
    path = scratch(t)
    counted = t.read("orders").groupBy(F.year("o_orderdate").cast("string").alias("year")).pivot("o_orderstatus", ["F", "O"]).agg(F.count(F.lit(1)).cast("string"))
    head = t.spark.createDataFrame([("name", "Finished  goods **", "Open goods"), ("unit", "($/mt)", "kg")], "year string, F string, O string")
    sinks.write_csv(head.union(counted), path)
    sheet = readers.read_text_table(t.spark, path, ["year", "F", "O"], sep=",")
    header, body = readers.split_header(sheet, "year", ["name", "unit"])
    return country_layers.price_sheet(body, header).select("commodity_code", "commodity_name", "unit", "year", "value")
