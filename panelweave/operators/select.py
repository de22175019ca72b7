"""Choosing rows: one per key, filters with a tally, ordered samples."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

SLICES = 64


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the lowest by ``order`` and then by all columns.

    An aggregate, not a window: each task sorts its rows by key and keeps only
    the best of each, so a key with very many copies sends one row a task.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.min(ranked).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in rest]).select(*df.columns)


def descending(c: str | Column) -> Column:
    """A numeric sort key that puts high values first in ``keep_one``."""
    x = F.col(c) if isinstance(c, str) else c
    return -x


def near_duplicates(df: DataFrame, x: str, y: str, digits: int = 3) -> DataFrame:
    """One row per location rounded to ``digits`` decimals (about 100 m at 3)."""
    rounded = df.withColumns({"_rx": F.round(x, digits), "_ry": F.round(y, digits)})
    return keep_one(rounded, ["_rx", "_ry"], [F.col(x), F.col(y)]).select(*df.columns)


def prefer(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Union of sources where an earlier source wins a shared key."""
    stacked = None
    for rank, df in enumerate(sources):
        part = df.withColumn("_rank", F.lit(rank))
        stacked = part if stacked is None else stacked.unionByName(part)
    return keep_one(stacked, keys, [F.col("_rank")]).drop("_rank")


def funnel(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows left after each step of a filter chain, in one pass."""
    counts, reached = [F.count(F.lit(1)).alias("all")], F.lit(True)
    for name, holds in steps.items():
        reached = reached & F.coalesce(holds, F.lit(False))
        counts.append(F.count_if(reached).alias(name))
    return df.agg(*counts).unpivot([], ["all", *steps], "step", "n")


def observed(df: DataFrame, steps: Mapping[str, Column]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """Rows that pass all steps, and what each step left (``all``, then by name), told once a job has read them.

    The counts ride on that job, so they are those of the rows it wrote and
    cost no further pass. Asking before any job has run waits for one.
    """
    seen = Observation()
    counts, reached = [F.count(F.lit(1)).alias("all")], F.lit(True)
    for name, holds in steps.items():
        reached = reached & F.coalesce(holds, F.lit(False))
        counts.append(F.count_if(reached).alias(name))
    return df.observe(seen, *counts).filter(reached), lambda: seen.get


def exclude_rows(df: DataFrame, quarantine: DataFrame, on: Sequence[str]) -> DataFrame:
    """Drop the rows a quarantine table names."""
    return df.join(quarantine.select(*on), list(on), "left_anti")


def filter_panel(df: DataFrame, regions: Sequence[str] = (), isos: Sequence[str] = (), years: tuple[int, int] | None = None) -> DataFrame:
    """Optional predicates; an empty choice means all."""
    out = df
    if regions:
        out = out.filter(F.col("region").isin(list(regions)))
    if isos:
        out = out.filter(F.col("iso3").isin(list(isos)))
    if years:
        out = out.filter(F.col("year").between(*years))
    return out


def mask_outside(df: DataFrame, holds: Column, columns: Sequence[str]) -> DataFrame:
    """Null the columns on rows where ``holds`` is not true."""
    return df.withColumns({c: F.when(holds, F.col(c)) for c in columns})


def seeded(seed: int, by: Sequence[str]) -> Column:
    """A draw that any engine can repeat: the md5 of the seed and the key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by]))


def sample_entities(df: DataFrame, entity: str, n: int, seed: int, always: Sequence = ()) -> DataFrame:
    """All rows of ``n`` entities picked by a seeded hash, plus the named ones."""
    drawn = df.select(entity).distinct().orderBy(seeded(seed, [entity]), entity).limit(n)
    if always:
        named = df.filter(F.col(entity).isin(list(always))).select(entity)
        drawn = drawn.union(named).distinct()
    return df.join(drawn, entity, "left_semi")


def sample_rows(df: DataFrame, n: int, seed: int, by: Sequence[str]) -> DataFrame:
    """At most ``n`` rows, the lowest by a seeded hash of ``by``; a top-n, not a sort."""
    return df.orderBy(seeded(seed, by), *by).limit(n)


def preview(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows by an explicit order."""
    return df.orderBy(*order).limit(n)


def picked_groups(df: DataFrame, picks: DataFrame, keys: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of each picked group.

    Ranked per hash slice first, so no task orders a whole large group; at
    most ``n`` rows per slice reach the final rank.
    """
    slices = F.pmod(F.xxhash64(*order), F.lit(SLICES))
    chosen = df.join(picks.select(*keys), list(keys), "left_semi").withColumn("_slice", slices)
    for group in ([*keys, "_slice"], list(keys)):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        chosen = chosen.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
    return chosen.drop("_slice")
