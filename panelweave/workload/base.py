"""Registry of queries and the binding of the given tables to panel roles.

district = supplier, country = nation, region = region, fatal events =
lineitem by return flag, national series = orders by the customer's nation,
crops = part types, observations = events.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.session import stage

FIRST, LAST = 1993, 2003  # panel years; the data covers 1995-2001, so both edges are uncovered


def mean_cents(c: str | Column) -> Column:
    """Mean of a money column from exact integer sums: the same bits in any order of rows."""
    x = F.col(c) if isinstance(c, str) else c
    return F.try_divide(F.sum(F.round(x * 100).cast("bigint")).cast("double"), F.count(x) * F.lit(100.0))


def mean_cents_sql(x: str) -> str:
    return f"cast(sum(cast(round(({x}) * 100) as bigint)) as double) / (100.0 * nullif(count({x}), 0))"


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` with the SQL that must give the same rows."""

    def wrap(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, covers, lambda spark, sf: fn(Tables(spark, sf)), sql)
        return fn

    return wrap


class Tables:
    """The given parquet tables, and their panel roles."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def spine(self) -> DataFrame:
        """district_id, iso3, district_name, region, s_acctbal."""
        nation = self.read("nation").join(self.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return (
            self.read("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("district_id"),
                F.col("n_name").alias("iso3"),
                F.col("s_name").alias("district_name"),
                F.col("r_name").alias("region"),
                "s_acctbal",
            )
        )

    @cached_property
    def facts(self) -> DataFrame:
        """Fatal events: one row per line, with location precision in l_tax."""
        return self.read("lineitem").select(
            F.col("l_suppkey").alias("district_id"),
            F.year("l_shipdate").alias("year"),
            F.col("l_returnflag").alias("kind"),
            F.col("l_quantity").alias("best"),
            (F.col("l_quantity") - 1).alias("low"),
            (F.col("l_quantity") + 5).alias("high"),
            "l_extendedprice",
            "l_discount",
            "l_tax",
            "l_orderkey",
            "l_partkey",
            "l_linenumber",
            "l_linestatus",
            "l_shipdate",
        )

    @cached_property
    def severe(self) -> DataFrame:
        """A sparse event source: the largest, most discounted lines."""
        return self.facts.filter((F.col("best") >= 49) & (F.col("l_discount") >= 0.09))

    @cached_property
    def district_years(self) -> DataFrame:
        """All layers of one key from one pass over the facts: located events, their prices, severe ones.

        Staged, as the panel, the observed span and each of its checks read it.
        """
        located, severe = F.col("l_tax") <= 0.06, (F.col("best") >= 49) & (F.col("l_discount") >= 0.09)
        return stage(self.facts.groupBy("district_id", "year").agg(
            F.count_if(located).alias("n_events_total"),
            F.sum(F.when(located, F.col("best"))).alias("deaths_best"),
            mean_cents(F.when(located & (F.col("l_discount") < 0.05), F.col("l_extendedprice"))).alias("yield_mean"),
            F.nullif(F.count_if(severe), F.lit(0)).alias("acled_events_total"),
        ))

    @cached_property
    def national(self) -> DataFrame:
        """Country-year series: orders by the customer's nation."""
        return (
            self.read("orders")
            .join(self.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("n_name").alias("iso3"), F.year("o_orderdate").alias("year"))
            .agg(F.count(F.lit(1)).alias("n_orders"), mean_cents("o_totalprice").alias("gdp"))
        )

    @cached_property
    def yearly(self) -> DataFrame:
        """District-year values: event count and mean price."""
        return self.facts.groupBy("district_id", "year").agg(
            F.count(F.lit(1)).alias("n"), mean_cents("l_extendedprice").alias("value")
        )

    @cached_property
    def crops(self) -> DataFrame:
        """District x part type: the area is the ordered quantity."""
        return (
            self.read("lineitem")
            .join(self.read("part"), F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(F.col("l_suppkey").alias("district_id"), F.col("p_type").alias("crop"))
            .agg(F.sum("l_quantity").alias("area"))
        )


SPINE_SQL = """select s_suppkey as district_id, n_name as iso3, s_name as district_name, r_name as region, s_acctbal
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""

FACTS_SQL = """select l_suppkey as district_id, cast(year(l_shipdate) as integer) as year, l_returnflag as kind,
  l_quantity as best, l_quantity - 1 as low, l_quantity + 5 as high, l_extendedprice, l_discount, l_tax,
  l_orderkey, l_partkey, l_linenumber, l_linestatus, l_shipdate from lineitem"""

SEVERE_SQL = f"select * from ({FACTS_SQL}) where best >= 49 and l_discount >= 0.09"

NATIONAL_SQL = f"""select n_name as iso3, cast(year(o_orderdate) as integer) as year, count(*) as n_orders,
  {mean_cents_sql("o_totalprice")} as gdp
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2"""

YEARLY_SQL = f"""select district_id, year, count(*) as n, {mean_cents_sql("l_extendedprice")} as value
  from ({FACTS_SQL}) group by 1, 2"""

CROPS_SQL = """select l_suppkey as district_id, p_type as crop, sum(l_quantity) as area
  from lineitem join part on l_partkey = p_partkey group by 1, 2"""

FRAME_SQL = f"""select s.*, cast(y as integer) as year from ({SPINE_SQL}) s
  cross join (select unnest(generate_series({FIRST}, {LAST})) as y)"""
