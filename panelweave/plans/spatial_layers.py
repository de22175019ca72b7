"""Layers built from points, cells and polygons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.functions import geo, numeric
from panelweave.operators import aggregate, checks, reshape, spatial


def event_layers(
    points: DataFrame,
    geom: DataFrame,
    ident: str,
    x: str,
    y: str,
    size: float,
    category: str,
    names: Mapping[str, str],
    measures: Mapping[str, str],
    year: str = "year",
) -> tuple[DataFrame, DataFrame]:
    """Events to a long (district, year, category) and a wide (district, year) layer.

    ``measures`` maps an output stem to the summed column; ``n_events`` is
    always there. Filter imprecise points before this: the filter then sits
    below the spatial join.
    """
    located = spatial.points_to_polygons(points, geom, ident, x, y, size, "inner")
    long = located.groupBy(ident, year, category).agg(
        F.count(F.lit(1)).alias("n_events"), *[F.sum(c).alias(m) for m, c in measures.items()]
    )
    totals = {m: F.sum(m) for m in ("n_events", *measures)}
    wide = reshape.pivot_fixed(long, [ident, year], category, names, totals, absent_zero=True, totals=True)
    return long, wide


def deposit_census(
    hits: DataFrame,
    spine: DataFrame,
    ident: str,
    what: str,
    counts: Mapping[str, Column] | None = None,
    flags: Mapping[str, Column] | None = None,
    first_year: str | None = None,
) -> DataFrame:
    """Located deposits counted per district, zero over the whole spine."""
    counts, flags = counts or {}, flags or {}
    total = f"n_{what}"
    aggs = [F.count(F.lit(1)).alias(total)]
    aggs += [F.count_if(holds).alias(n) for n, holds in counts.items()]
    aggs += [F.bool_or(holds).cast("int").alias(n) for n, holds in flags.items()]
    if first_year:
        aggs.append(F.min(first_year).alias("first_year"))
    joined = spine.select(ident).join(hits.groupBy(ident).agg(*aggs), ident, "left")
    zero = {n: F.coalesce(F.col(n), F.lit(0)) for n in (total, *counts, *flags)}
    return joined.withColumns(zero).withColumn("has_any", numeric.flag(F.col(total) > 0))


def crop_mix(pixels: DataFrame, geom: DataFrame, ident: str, x: str, y: str, size: float, crops: Sequence[str]) -> DataFrame:
    """Wide pixel areas summed per district, melted, with each crop's share."""
    located = spatial.points_to_polygons(pixels, geom, ident, x, y, size, "inner")
    sums = located.groupBy(ident).agg(*[F.sum(c).alias(c) for c in crops])
    long = reshape.melt_positive(sums, [ident], crops, "crop", "area")
    return aggregate.shares(long, [ident], "crop", "area", "share")


def exclusion(parts: DataFrame, ident: str, group: str, area: str, whole: str, excluded: str, year: str = "year") -> DataFrame:
    """Group areas inside districts to yearly exclusion measures.

    The share is held inside [0, 1] as overlapping groups may exceed the
    district; the sum before that is kept as ``share_excluded_raw``.
    """
    share = F.when(F.col(excluded), F.col(area) / F.col(whole))
    # one pass over the parts: everything else follows from a row for each group
    groups = parts.groupBy(ident, year, group).agg(F.sum(area).alias("_a"), F.sum(share).alias("_s"))
    total, raw = F.sum("_a"), F.coalesce(F.sum("_s"), F.lit(0.0))
    layer = groups.groupBy(ident, year).agg(
        F.count(group).alias("n_groups"),
        aggregate.clipped_sum(F.lit(True), "_s").alias("share_excluded"),
        raw.alias("share_excluded_raw"),
        (1 - F.try_divide(F.sum(F.col("_a") * F.col("_a")), total * total)).alias("fractionalisation"),
    )
    return layer.withColumn("any_excluded", numeric.flag(F.col("share_excluded") > 0))


def food_phase(parts: DataFrame, ident: str, phase: str, area: str, crisis: int, year: str = "year") -> DataFrame:
    """Phase polygons inside districts: worst, modal and crisis share of the monitored area."""
    base = parts.groupBy(ident, year).agg(
        F.max(phase).alias("phase_max"),
        F.count(F.lit(1)).alias("n_reports"),
        aggregate.share_where(F.col(phase) >= crisis, area).alias("crisis_share"),
    )
    modal = aggregate.weighted_mode(parts, [ident, year], phase, area, "phase_modal")
    flagged = {"crisis_flag": numeric.flag(F.col("phase_max") >= crisis), "covered": F.lit(1)}
    return base.join(modal, [ident, year]).withColumns(flagged)


def two_source_presence(spine: DataFrame, hits: DataFrame, source: str, first: str, second: str, ident: str, use_first: Column, what: str) -> DataFrame:
    """Counts from the source that fits the region, presence from either.

    ``hits`` holds the located sites of both sources, so one spatial join and
    one aggregation serve both.
    """
    of = F.col(source)
    sums = hits.groupBy(ident).agg(F.count_if(of == first).alias("_u"), F.count_if(of == second).alias("_m"))
    n_u, n_m = F.coalesce("_u", F.lit(0)), F.coalesce("_m", F.lit(0))
    return (
        spine.join(sums, ident, "left")
        .withColumns({f"n_{what}": F.when(use_first, n_u).otherwise(n_m), f"has_{what}": numeric.flag((n_u > 0) | (n_m > 0))})
        .drop("_u", "_m")
    )


def market_access(cells: DataFrame, weights: DataFrame, spine: DataFrame, ident: str, value: str, year: int) -> DataFrame:
    """Median, mean and log of travel time per district; null where no cell is covered."""
    stats = spatial.zonal_stats(cells, weights, ident, value, (), spine)
    median = spatial.zonal_quantile(cells, weights, ident, value, 0.5, "travel_time_median")
    joined = stats.join(median, ident, "left")
    return joined.select(
        ident,
        "travel_time_median",
        numeric.covered_only(F.col("mean"), F.col("count")).alias("travel_time_mean"),
        F.log1p("travel_time_median").alias("travel_time_log1p"),
        F.lit(year).alias("snapshot_year"),
    )


def coverage_guard(stats: DataFrame, name: str) -> DataFrame:
    """A zonal mean must be unknown exactly where nothing was covered."""
    return checks.rows_hold(stats, "zonal", {name: F.col("mean").isNull() == (F.col("count") == 0)})


def alignment(cells: DataFrame, value: str, size: float, box: tuple[float, float, float, float], band: tuple[float, float]) -> DataFrame:
    """Mean over a known area and whether it lies in its expected band."""
    x, y = (F.col("cx") + 0.5) * size, (F.col("cy") + 0.5) * size
    inside = cells.filter(geo.in_box(x, y, *box))
    return inside.agg(F.avg(value).alias("mean")).withColumn("ok", F.col("mean").between(*band))
