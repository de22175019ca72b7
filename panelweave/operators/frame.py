"""The dense entity x time frame and the rules for what an absent row means.

``zero``  the source is complete, so absent is 0
``null``  the source is partial, so absent stays unknown
``mask``  absent is 0 inside an entity's observed window and unknown outside
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.operators.joins import one_row_per

POLICIES = ("zero", "null", "mask")


def dense_frame(spine: DataFrame, first: int, last: int, year: str = "year") -> DataFrame:
    """Every spine row in every year: a row-local explode, not a join."""
    if first > last:
        raise ValueError(f"empty year range {first}..{last}")
    return spine.withColumn(year, F.explode(F.sequence(F.lit(first), F.lit(last))))


def observed_span(events: DataFrame, entity: str, year: str = "year") -> DataFrame:
    """First and last year each entity appears in a source."""
    return events.groupBy(entity).agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"))


def masked(value: Column, matched: Column, year: Column, first: Column, last: Column) -> Column:
    """The mask rule for one column."""
    return F.when(matched, value).when(year.between(first, last), F.lit(0.0))


def attach(
    frame: DataFrame,
    layer: DataFrame,
    on: Sequence[str],
    columns: Sequence[str],
    policy: str = "null",
    span: DataFrame | None = None,
    span_key: str | None = None,
    checked: bool = False,
    year: str = "year",
) -> DataFrame:
    """Left join a keyed layer m:1 and apply its absence policy.

    ``checked=True`` says the layer is unique on ``on`` by construction (it
    is the output of a groupBy on those keys); otherwise the job fails on
    a duplicate. The frame's row count never changes.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    right = layer.select(*on, *columns)
    right = right if checked else one_row_per(right, on)
    if policy == "null":
        return frame.join(right, list(on), "left")
    if policy == "zero":
        filled = {c: F.coalesce(F.col(c), F.lit(0)).cast(layer.schema[c].dataType) for c in columns}
        return frame.join(right, list(on), "left").withColumns(filled)
    joined = frame.join(right.withColumn("_matched", F.lit(True)), list(on), "left").join(
        span.select(span_key, "first_year", "last_year"), span_key, "left"
    )
    matched = F.coalesce(F.col("_matched"), F.lit(False))
    ruled = {
        c: masked(F.col(c).cast("double"), matched, F.col(year), F.col("first_year"), F.col("last_year"))
        for c in columns
    }
    return joined.withColumns(ruled).drop("_matched", "first_year", "last_year")


def carry_class(
    frame: DataFrame,
    series: DataFrame,
    entity: str,
    value: str,
    mode: str = "latest",
    year: str = "year",
    keep: Sequence[str] = (),
) -> DataFrame:
    """A yearly class with gaps filled and flagged ``<value>_carried``.

    ``latest`` fills every gap with the entity's latest class. ``asof``
    uses only what was known at or before the year. The work is done on the
    (entity, year) rows of the frame, not on all its districts.
    """
    years = frame.select(entity, year).distinct()
    direct = one_row_per(series.select(entity, year, value), [entity, year])
    if mode == "latest":
        latest = direct.filter(F.col(value).isNotNull()).groupBy(entity).agg(F.max_by(value, year).alias("_fill"))
        filled = years.join(direct, [entity, year], "left").join(latest, entity, "left")
    elif mode == "asof":
        # one row per year of the entity, so the window holds a span of years at most
        past = Window.partitionBy(entity).orderBy(year).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        filled = years.join(direct, [entity, year], "full_outer").withColumn("_fill", F.last(value, ignorenulls=True).over(past))
    else:
        raise ValueError("mode must be 'latest' or 'asof'")
    flag = F.col(value).isNull() & F.col("_fill").isNotNull()
    filled = filled.select(entity, year, flag.alias(f"{value}_carried"), F.coalesce(value, "_fill").alias(value))
    return frame.join(filled, [entity, year], "left").select(*frame.columns, value, f"{value}_carried")


def densify(long: DataFrame, spine: DataFrame, entity: str, category: str, categories: Sequence[str], first: int, last: int, values: Sequence[str], year: str = "year") -> DataFrame:
    """A sparse long table on the full entity x year x category grid, missing = null."""
    grid = dense_frame(spine.select(entity), first, last, year).withColumn(
        category, F.explode(F.array(*[F.lit(c) for c in categories]))
    )
    return attach(grid, long, [entity, year, category], values)


def cap_years(df: DataFrame, first: int, last: int, year: str = "year") -> DataFrame:
    """Rows inside the panel window."""
    return df.filter(F.col(year).between(first, last))


def dropped_beyond(df: DataFrame, last: int, year: str = "year") -> DataFrame:
    """How many rows the window filter removes, for the build log."""
    return df.agg(F.count_if(F.col(year) > last).alias("dropped"), F.count(F.lit(1)).alias("seen"))
