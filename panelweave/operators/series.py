"""Ordered series over (entity, year): changes, lags, anomalies, exposures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.session import stage


def _ordered(series: Sequence[str], year: str) -> Window:
    # one row per (series, year): a partition holds a span of years, never facts
    return Window.partitionBy(*series).orderBy(year)


def log_positive(c: str | Column) -> Column:
    """Natural log, null for non-positive input."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x > 0, F.ln(x))


def log_change(df: DataFrame, series: Sequence[str], value: str, name: str, strict: bool = False, year: str = "year") -> DataFrame:
    """Log difference to the previous row; ``strict`` demands the previous year."""
    w = _ordered(series, year)
    change = log_positive(value) - F.lag(log_positive(value)).over(w)
    if strict:
        change = F.when(F.col(year) - F.lag(year).over(w) == 1, change)
    return df.withColumn(name, change)


def lagged(df: DataFrame, series: Sequence[str], columns: Sequence[str], suffix: str = "_lag1", year: str = "year") -> DataFrame:
    """Last year's values; null where last year has no row."""
    w = _ordered(series, year)
    adjacent = F.col(year) - F.lag(year).over(w) == 1
    return df.withColumns({c + suffix: F.when(adjacent, F.lag(c).over(w)) for c in columns})


def standardised_anomaly(
    df: DataFrame,
    entity: str,
    value: str,
    name: str,
    baseline: tuple[int, int],
    min_years: int = 5,
    min_sd: float = 0.05,
    year: str = "year",
) -> DataFrame:
    """Distance from the entity's own baseline in baseline standard deviations.

    Null where the baseline is too short or nearly constant: a tiny sd would
    blow ordinary variation up.
    """
    inside = F.when(F.col(year).between(*baseline), F.col(value))
    whole = Window.partitionBy(entity)
    stats = {
        "_mu": F.avg(inside).over(whole),
        "_sd": F.stddev_samp(inside).over(whole),
        "_n": F.count(inside).over(whole),
    }
    sound = (F.col("_n") >= min_years) & (F.col("_sd") >= min_sd)
    score = F.when(sound, (F.col(value) - F.col("_mu")) / F.col("_sd"))
    return df.withColumns(stats).withColumn(name, score).drop(*stats)


def clock(year: str, anchor: str) -> Column:
    """Years since an anchor year, null where it is unknown."""
    return F.col(year) - F.col(anchor)


def shift_share(
    frame: DataFrame,
    areas: DataFrame,
    prices: DataFrame,
    crosswalk: DataFrame,
    entity: str,
    crop: str,
    commodity: str,
    area: str,
    price: str,
    first: int,
    last: int,
    year: str = "year",
) -> DataFrame:
    """Local crop shares times world log price changes, on every frame row.

    Adds ``cropland``, ``coverage`` (mapped share of area) and ``shock``. Crops
    without a commodity add 0 and shares are not rescaled; a missing price
    change adds 0; the shock is null only where an entity has no cropland.
    """
    crops = areas.groupBy(entity, crop).agg(F.sum(area).alias("_a"))
    mapped = F.col(commodity).isNotNull()
    # one row per crop of the entity, so the window is as wide as the crop list
    coded = stage(crops.join(crosswalk.select(crop, commodity), crop, "left").withColumn(
        "_share", F.col("_a") / F.sum("_a").over(Window.partitionBy(entity))
    ))  # read for the statics and for the terms
    statics = coded.groupBy(entity).agg(
        F.sum("_a").alias("cropland"),
        (F.coalesce(F.sum(F.when(mapped, F.col("_a"))), F.lit(0.0)) / F.sum("_a")).alias("coverage"),
    )
    changes = (
        log_change(prices, [commodity], price, "_dlog", year=year)
        .filter(F.col(year).between(first, last) & F.col("_dlog").isNotNull())
        .select(commodity, year, "_dlog")
    )
    terms = (
        coded.filter(mapped)
        .join(changes, commodity)
        .groupBy(entity, year)
        .agg(F.sum(F.col("_share") * F.col("_dlog")).alias("shock"))
    )
    joined = frame.join(statics, entity, "left").join(terms, [entity, year], "left")
    return joined.withColumn(
        "shock", F.when(F.col("cropland").isNotNull(), F.coalesce(F.col("shock"), F.lit(0.0)))
    )
