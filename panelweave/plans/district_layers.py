"""District-year layers from events, rasters and observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.functions import dates, numeric
from panelweave.operators import aggregate, frame, reshape, select, series, spatial
from panelweave.plans import spatial_layers
from panelweave.sources import contracts

# fixed values: event vocabularies and precision limits
VIOLENCE = {"1": "sb", "2": "ns", "3": "os"}
UNREST = {
    "Battles": "battles", "Protests": "protests", "Riots": "riots", "Violence against civilians": "vac",
    "Explosions/Remote violence": "explosions", "Strategic developments": "strategic",
}
FATAL_PRECISION, UNREST_PRECISION = 3, 2
YIELD_CROPS = ("maize", "rice", "wheat", "soybean")
EXCLUDED = ("POWERLESS", "DISCRIMINATED", "SELF-EXCLUSION")
LOW_PRECISION_SITES = ("D1", "D2", "E1", "E2", "F", "G")


def fatal_events(events: DataFrame, geom: DataFrame, size: float) -> tuple[DataFrame, DataFrame]:
    """Precise fatal events to the long and the zero-fillable wide layer (20 columns)."""
    kind = F.col("type_of_violence").cast("string")
    precise = events.filter(F.col("where_prec").between(1, FATAL_PRECISION)).withColumn("kind", kind)
    coded = contracts.require_values(precise, "kind", list(VIOLENCE))
    measures = {"deaths_best": "best", "deaths_low": "low", "deaths_high": "high", "deaths_civilians": "deaths_civilians"}
    return spatial_layers.event_layers(coded, geom, "district_id", "longitude", "latitude", size, "kind", VIOLENCE, measures)


def tidy_unrest(raw: DataFrame) -> DataFrame:
    """Unrest rows with numbers out of text, one row per event id."""
    typed = raw.select(
        "event_id_cnty", "event_type", "iso", F.year(F.to_date("event_date")).alias("year"),
        *[F.col(c).cast("string").try_cast(k).alias(c) for c, k in (("latitude", "double"), ("longitude", "double"), ("geo_precision", "bigint"), ("fatalities", "bigint"))],
    )
    return select.keep_one(contracts.require_values(typed, "event_type", list(UNREST)), ["event_id_cnty"], [])


def unrest_events(events: DataFrame, geom: DataFrame, size: float) -> tuple[DataFrame, DataFrame]:
    """Unrest counts per district-year, and each country's observed span.

    The span comes from the source's own country code and every precision,
    not from the polygon a point fell in.
    """
    span = frame.observed_span(events, "iso")
    precise = events.filter(F.col("geo_precision").between(1, UNREST_PRECISION))
    located = spatial.points_to_polygons(precise, geom, "district_id", "longitude", "latitude", size, "inner")
    wide = reshape.pivot_fixed(located, ["district_id", "year"], "event_type", UNREST, {"acled_events": F.count(F.lit(1)), "_f": F.sum("fatalities")}, absent_zero=True, totals=True)
    columns = [f"acled_events_{s}" for s in ("total", *UNREST.values())]
    return wide.select("district_id", "year", *columns, F.col("_f_total").alias("acled_fatalities")), span


def traps(raw: DataFrame, geom: DataFrame, size: float) -> DataFrame:
    """Trap checks to district-year counts, presence and catch rate."""
    counts = {c: F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0)) for c in ("faw_confirmed_count", "faw_suspected_plus_confirmed_count")}
    place = {c: F.col(c).cast("string").try_cast("double") for c in ("lat", "long")}
    dated = raw.withColumns({**counts, **place, "year": dates.year_of(F.col("date").cast("string"))}).na.drop(subset=["lat", "long", "year"])
    located = spatial.points_to_polygons(dated, geom, "district_id", "long", "lat", size, "inner")
    grouped = located.groupBy("district_id", "year").agg(
        F.count("id").alias("faw_n_trap_checks"), F.sum("faw_confirmed_count").alias("faw_confirmed_sum"),
        F.sum("faw_suspected_plus_confirmed_count").alias("faw_suspconf_sum"),
    )
    return grouped.withColumns({
        "faw_present": numeric.flag(F.col("faw_confirmed_sum") > 0),
        "faw_catch_rate": numeric.ratio(F.col("faw_confirmed_sum"), F.col("faw_n_trap_checks")),
    })


def swarms(raw: Sequence[DataFrame], geom: DataFrame, size: float) -> DataFrame:
    """Swarm and band sightings to district-year counts; columns may differ by file."""
    both = raw[0]
    for df in raw[1:]:
        both = both.unionByName(df, allowMissingColumns=True)
    place = {c: F.col(c).cast("string").try_cast("double") for c in ("lat", "lon")}
    treated = F.coalesce(F.col("area_treated_in_ha").cast("string").try_cast("double"), F.lit(0.0))
    dated = both.withColumns({**place, "area_treated_in_ha": treated, "year": dates.year_of(F.col("start_date").cast("string"))}).na.drop(subset=["lat", "lon", "year"])
    located = spatial.points_to_polygons(dated, geom, "district_id", "lon", "lat", size, "inner")
    grouped = located.groupBy("district_id", "year").agg(
        F.count_if(F.col("category") == "SWARM").alias("dl_swarm_obs"), F.count_if(F.col("category") == "BAND").alias("dl_band_obs"),
        F.sum("area_treated_in_ha").alias("dl_area_treated_ha"),
    )
    return grouped.withColumns({"dl_gregarious_obs": F.col("dl_swarm_obs") + F.col("dl_band_obs"), "dl_present_flag": F.lit(1)})


def rain(cells: DataFrame, weights: DataFrame) -> DataFrame:
    stats = spatial.zonal_stats(cells, weights, "district_id", "value", ["year"])
    return stats.select("district_id", "year", F.col("mean").alias("precip_mm"))


def yields(cells: DataFrame, weights: DataFrame, ceiling: float) -> DataFrame:
    """Crop yield cells to wide ``yield_<crop>``; an implausible mean fails the job."""
    stats = spatial.zonal_stats(cells, weights, "district_id", "value", ["year", "crop"])
    sane = F.when(F.col("mean") > ceiling, F.raise_error(F.lit("yield above the plausible ceiling")).cast("double")).otherwise(F.col("mean"))
    return reshape.pivot_fixed(stats.withColumn("mean", sane), ["district_id", "year"], "crop", {c: c for c in YIELD_CROPS}, {"yield": F.avg("mean")}, absent_zero=False)


def temperature(cells: DataFrame, weights: DataFrame, baseline: tuple[int, int]) -> DataFrame:
    """Monthly cells to yearly district means and their anomaly."""
    annual = cells.groupBy("cx", "cy", "year").agg(F.avg("value").alias("value"))
    stats = spatial.zonal_stats(annual, weights, "district_id", "value", ["year"])
    named = stats.select("district_id", "year", F.col("mean").alias("temp_mean"))
    return series.standardised_anomaly(named, "district_id", "temp_mean", "temp_anomaly", baseline)


def excluded_groups(overlay: DataFrame, status: DataFrame, first: int, last: int) -> DataFrame:
    """Group areas and yearly status to exclusion measures per district-year.

    ``overlay`` has (district_id, district_area, gwgroupid, from, to, area).
    The status of a group in a year must be unique.
    """
    from panelweave.operators import joins

    yearly = joins.expand_periods(overlay, "from", "to", first, last)
    held = joins.expand_periods(status, "from", "to", first, last).select("gwgroupid", "year", F.upper(F.trim("status")).alias("status"))
    joined = yearly.join(joins.one_row_per(held, ["gwgroupid", "year"]), ["gwgroupid", "year"], "left")
    flagged = joined.withColumn("excluded", F.coalesce(F.col("status").isin(list(EXCLUDED)), F.lit(False)))
    out = spatial_layers.exclusion(flagged, "district_id", "gwgroupid", "area", "district_area", "excluded")
    return out.withColumnsRenamed({"n_groups": "n_groups_overlap", "share_excluded": "share_area_excluded", "fractionalisation": "ethnic_fractionalization"})


def oil_and_gas(fields: DataFrame) -> dict[str, Column]:
    """Flags of a located field by its resource text."""
    kind = F.lower(F.col("RESINFO"))
    return {"has_oil": kind.isin("oil", "oil and gas"), "has_gas": kind.isin("gas", "oil and gas")}


def precise_sites(sites: DataFrame, code: str = "LOCDER") -> DataFrame:
    """Sites none of whose location codes is a coarse one."""
    return sites.filter(~reshape.any_part_in(code, "[;,]", LOW_PRECISION_SITES))


def gold_sites(sites: DataFrame, columns: Sequence[str], whole: bool) -> DataFrame:
    """Sites naming gold in any commodity column, one per location of about 100 m when ``whole``."""
    gold = sites.filter(reshape.any_column(columns, "Gold", whole=whole, ignore_case=not whole))
    return select.near_duplicates(gold, "longitude", "latitude", 3) if whole else gold


def crop_statics(mix: DataFrame, mapped: Column) -> DataFrame:
    """Cropland and the share of it under mapped crops."""
    return mix.groupBy("district_id").agg(F.sum("area").alias("cropland_ha"), aggregate.share_where(mapped, "area").alias("price_shock_coverage"))
