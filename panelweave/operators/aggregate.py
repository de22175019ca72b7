"""Group aggregates: shares, weighted statistics, exact quantiles, typed roll-ups."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.session import stage


# Weights, as shares of their group's largest, are added in this type: their sum does not depend on the order. Four digits
# are left free, as Spark takes decimals off a sum or difference that could need more than 38.
EXACT = "decimal(34,12)"


def sum_or_zero(c: str | Column) -> Column:
    """Sum where an all-null group is 0."""
    return F.coalesce(F.sum(c), F.lit(0))


def weighted_mean(value: str, weight: str | Column) -> Column:
    """Mean weighted over the rows where the value is known; null when none weighs."""
    x, w = F.col(value), F.coalesce(weight if isinstance(weight, Column) else F.col(weight), F.lit(0.0))
    mass = F.sum(F.when(x.isNotNull(), w))
    return F.sum(x * w) / F.when(mass != 0, mass)


def share_where(holds: Column, amount: str) -> Column:
    """Share of the group's amount on rows where ``holds``; 0 when none do, null when the group has no amount."""
    return F.try_divide(F.coalesce(F.sum(F.when(holds, F.col(amount))), F.lit(0.0)), F.sum(amount))


def clipped_sum(holds: Column, amount: str | Column) -> Column:
    """Conditional sum held inside [0, 1]; overlapping parts may exceed 1 before the clip."""
    x = F.col(amount) if isinstance(amount, str) else amount
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.sum(F.when(holds, x)), F.lit(0.0))))


def shares(df: DataFrame, keys: Sequence[str], category: str, amount: str, share: str) -> DataFrame:
    """Amount per (keys, category) and its share of the keys' total; null where that is 0.

    Rows are summed per category first, so the window that takes the total
    holds one row per category however many facts a key has.
    """
    parts = df.groupBy(*keys, category).agg(F.sum(amount).alias(amount))
    total = F.sum(amount).over(Window.partitionBy(*keys))
    return parts.withColumn(share, F.try_divide(F.col(amount), total))


def fractionalisation(df: DataFrame, keys: Sequence[str], group: str, area: str, name: str) -> DataFrame:
    """1 - sum of squared group shares, by two partial aggregations; null where the total is 0."""
    per_group = df.groupBy(*keys, group).agg(F.sum(area).alias("_a"))
    total = F.sum("_a")
    return per_group.groupBy(*keys).agg((1 - F.try_divide(F.sum(F.col("_a") * F.col("_a")), total * total)).alias(name))


def weighted_mode(df: DataFrame, keys: Sequence[str], category: str, area: str, name: str) -> DataFrame:
    """Category with the largest area; a tie goes to the higher category."""
    per = df.groupBy(*keys, category).agg(F.sum(area).alias("_a"))
    return per.groupBy(*keys).agg(F.max_by(category, F.struct("_a", category)).alias(name))


def first_year_where(holds: Column, year: str = "year") -> Column:
    """First year a predicate is true."""
    return F.min(F.when(holds, F.col(year)))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    weight: str | None = None,
    count: str | None = None,
    interpolate: bool = False,
) -> DataFrame:
    """Exact quantiles per group without putting a group into one task.

    Equal values collapse to one row, written once; the input is read no
    more after that. Those rows are dealt by ranges of (key, value), so a
    large group lies in many ranges, each ordered by itself; totals per range
    give the ranks that a range starts at.

    The result interpolates linearly between order statistics; ``count``
    names a column that says how often a row stands. With ``weight`` it is
    instead the lowest value at which the running weight reaches the fraction
    of the total, or, with ``interpolate``, a point on the line through the
    middles of the values' weights.
    """
    mass = F.sum(weight) if weight else F.sum(count) if count else F.count(F.lit(1))
    key = list(keys) or ["_all"]
    known = df.filter(F.col(value).isNotNull()).withColumnsRenamed({value: "_v"})
    known = known if keys else known.withColumn("_all", F.lit(0))
    tallied = stage(known.groupBy(*key, "_v").agg(mass.alias("_n")))
    result = tally_quantiles(tallied, key, quantiles, bool(weight), interpolate)
    return result if keys else result.drop("_all")


def tally_quantiles(tallied: DataFrame, key: Sequence[str], quantiles: Mapping[str, float], weighted: bool = False, interpolate: bool = False) -> DataFrame:
    """Quantiles from a written table of (key, _v, _n), one row per distinct value."""
    ranges = int(tallied.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if weighted:
        most = tallied.groupBy(*key).agg(F.max("_n").alias("_most"))
        share = F.coalesce(F.try_divide(F.col("_n"), F.col("_most")), F.lit(0.0))
        tallied = tallied.join(most, list(key)).withColumn("_n", _fixed(share)).drop("_most")
    # staged, as the range of a row must be the same wherever it is read
    placed = stage(tallied.repartitionByRange(ranges, *key, "_v").withColumn("_slice", F.spark_partition_id()))
    per_slice = placed.groupBy(*key, "_slice").agg(F.sum("_n").alias("_slice_n"))
    before = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    exact = (lambda c: c.cast(EXACT)) if weighted else (lambda c: c)  # sums come back ten digits wider
    base = (
        per_slice.withColumn("_base", exact(F.coalesce(F.sum("_slice_n").over(before), F.lit(0))))
        .withColumn("_total", exact(F.sum("_slice_n").over(Window.partitionBy(*key))))
        .drop("_slice_n")
    )
    inside = Window.partitionBy(*key, "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (
        placed.withColumn("_up_to", exact(F.sum("_n").over(inside)))
        .join(base, [*key, "_slice"])
        .withColumn("_hi", F.col("_base") + F.col("_up_to"))
        .withColumn("_lo", F.col("_hi") - F.col("_n"))
    )
    out = []
    for name, p in quantiles.items():
        if weighted and interpolate:
            out.append(_between_middles(p).alias(name))
            continue
        if weighted:
            reached = F.col("_hi").cast("double") >= F.col("_total").cast("double") * F.lit(p)
            out.append(F.min(F.when(reached, F.col("_v"))).alias(name))
            continue
        rank = (F.col("_total") - 1) * F.lit(p)
        low, high = F.floor(rank), F.ceil(rank)
        at_low = F.max(F.when((F.col("_lo") <= low) & (low < F.col("_hi")), F.col("_v")))
        at_high = F.max(F.when((F.col("_lo") <= high) & (high < F.col("_hi")), F.col("_v")))
        fraction = F.max(rank - low)
        out.append((at_low + (at_high - at_low) * fraction).alias(name))
    return ranked.groupBy(*key).agg(*out)


def _fixed(share: Column) -> Column:
    """A share in the exact type, scaled in binary and rounded half up; Spark's own cast rounds the printed digits instead."""
    units = F.floor(share * F.lit(1e12) + F.lit(0.5)).cast("decimal(20,0)") * F.lit("0.000000000001").cast("decimal(12,12)")
    return F.when(F.abs(share) <= 1, units.cast(EXACT)).otherwise(share.cast(EXACT))


def _between_middles(p: float) -> Column:
    """The value at which a line through the middles of the values' weights crosses the fraction; the ends are flat."""
    middle = (F.col("_lo").cast("double") + F.col("_hi").cast("double")) / 2
    target = F.col("_total").cast("double") * F.lit(p)
    under = F.max(F.when(middle <= target, F.struct(middle.alias("at"), F.col("_v").cast("double").alias("v"))))
    over = F.min(F.when(middle >= target, F.struct(middle.alias("at"), F.col("_v").cast("double").alias("v"))))
    along = F.coalesce(F.try_divide(F.max(target) - under["at"], over["at"] - under["at"]), F.lit(0.0))
    return F.coalesce(under["v"] + (over["v"] - under["v"]) * along, under["v"], over["v"])


def histogram(df: DataFrame, value: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over the observed range; the top edge falls in the last bin."""
    known = df.filter(F.col(value).isNotNull())
    bounds = known.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    if keys:
        ranged = known.join(bounds, list(keys))
    else:
        edge = bounds.first()  # one row of two numbers
        ranged = known.withColumns({"low": F.lit(edge["low"]), "high": F.lit(edge["high"])})
    width = F.try_divide(F.col("high") - F.col("low"), F.lit(bins))
    step = F.coalesce(F.floor(F.try_divide(F.col(value) - F.col("low"), width)).cast("bigint"), F.lit(0))
    binned = ranged.withColumn("bin", F.least(F.lit(bins - 1), step))
    return binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"), F.min("low").alias("low"), F.min("high").alias("high"))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """Most frequent values; ties go to the smaller value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
        .limit(n)
    )


def group_metric(df: DataFrame, by: str, metric: str, how: str) -> DataFrame:
    """One metric by one key (mean, sum, median, max); null keys dropped, highest first."""
    known = df.filter(F.col(by).isNotNull())
    if how == "median":
        groups = known.select(by).distinct()
        medians = exact_quantiles(known, [by], metric, {metric: 0.5})
        return groups.join(medians, by, "left").orderBy(F.desc(metric), by)
    fn = {"mean": F.avg, "sum": sum_or_zero, "max": F.max}[how]
    return known.groupBy(by).agg(fn(metric).alias(metric)).orderBy(F.desc(metric), by)


def constant_within(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Which columns hold at most one known value per key: rows (column, constant).

    min = max is a partial aggregate; distinct counts would shuffle every value.
    """
    same = [F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias(c) for c in columns]
    flags = df.groupBy(*keys).agg(*same).agg(*[F.bool_and(c).alias(c) for c in columns])
    return flags.unpivot([], list(columns), "column", "constant")


COUNT_PREFIXES = (
    "deaths_", "n_events_", "coups_", "acled_events_", "refugees_", "asylum_", "idp_", "returned_", "new_disp_",
    "n_diamond", "n_oil", "n_mineral", "faw_n_trap", "faw_confirmed", "faw_suspconf", "dl_swarm", "dl_band",
    "dl_gregarious",
)  # fixed values: the panel's count columns
COUNT_NAMES = ("acled_fatalities", "cropland_ha", "dl_area_treated_ha", "stateless")  # fixed values
COUNT_SUFFIXES = ("_prod_t", "_area_ha")  # fixed values


#: (what a column name must match, rule), read in order
ROLLUP_RULES = (
    (r"^(?:" + "|".join(COUNT_PREFIXES) + ")", "sum"),
    (r"^(?:" + "|".join(COUNT_NAMES) + ")$", "sum"),
    (r"(?:" + "|".join(COUNT_SUFFIXES) + ")$", "sum"),
)


def rollup_rule(column: str, national: Sequence[str]) -> str:
    """``mean`` for national columns, ``sum`` for district counts, else ``mean``."""
    table = () if column in national else ROLLUP_RULES
    return next((rule for pattern, rule in table if re.search(pattern, column)), "mean")


def rollup(df: DataFrame, keys: Sequence[str], rules: Mapping[str, str], order: str | None = None) -> DataFrame:
    """District rows to coarser rows by a rule per column.

    Rules: ``sum`` (an all-null group is 0), ``sum_known`` (an all-null group
    is null), ``mean``, ``max``, ``first`` (the first known value by
    ``order``), ``wmean:<weight>``.
    """
    out = []
    for column, rule in rules.items():
        if rule.startswith("wmean:"):
            expr = weighted_mean(column, rule.split(":", 1)[1])
        elif rule == "first":
            expr = F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order)))
        else:
            expr = {"sum": sum_or_zero, "sum_known": F.sum, "mean": F.avg, "max": F.max}[rule](column)
        out.append(expr.alias(column))
    return df.groupBy(*keys).agg(*out)


def era_missingness(df: DataFrame, columns: Sequence[str], origin: int, width: int, year: str = "year") -> DataFrame:
    """Percent known per column and era, one pass over the panel."""
    era = (F.floor((F.col(year) - F.lit(origin)) / F.lit(width)) * width + origin).cast("int")
    known = [(F.count(c) * 100.0 / F.count(F.lit(1))).alias(c) for c in columns]
    return df.groupBy(era.alias("era")).agg(*known).unpivot(["era"], list(columns), "column", "pct_known")


def decade(year: str = "year") -> Column:
    return (F.floor(F.col(year) / 10) * 10).cast("int")


def never_known(df: DataFrame, entity: str, column: str) -> DataFrame:
    """Entities whose column is null in every period."""
    return df.groupBy(entity).agg(F.count(column).alias("_k")).filter(F.col("_k") == 0).select(entity)
