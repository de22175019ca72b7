"""Joins with a stated cardinality, a checked broadcast and a way out of key skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from panelweave.session import stage

BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20
HOT_SHARE = 0.005
TRACKED = 10_000  # keys a frequent-items sketch follows: its error is far below the share


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, weight: Column | None = None) -> tuple[DataFrame, bool]:
    """Mark ``df`` for broadcast only if it was measured to be small, in rows and in bytes.

    The table is staged, so it is made once whichever way the join goes, and
    its written size is known. ``weight`` counts more than one unit per row
    (array lengths, say).
    """
    held = stage(df)
    units = F.sum(weight if weight is not None else F.lit(1))
    seen = held.agg(F.count(F.lit(1)).alias("rows"), units.alias("units")).first()
    size = int(str(held._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    fits = seen["rows"] <= max_rows and (seen["units"] or 0) <= max_rows and size <= BROADCAST_BYTES
    return (F.broadcast(held) if fits else held), fits


def one_row_per(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged when ``keys`` is unique; the job fails where it is not.

    The check rides on an aggregation over the keys, the same shuffle the
    following join needs, so no separate job runs.
    """
    values = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in values])
    message = F.concat(F.lit(f"duplicate key {tuple(keys)}: "), F.to_json(F.struct(*keys)))
    guarded = [F.when(F.col("_n") == 1, F.col(c)).otherwise(F.raise_error(message)).alias(c) for c in values]
    return counted.select(*keys, *guarded)


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys holding more than ``share`` of all rows, counted exactly: never more than ``1/share`` of them."""
    total = df.count()
    return df.groupBy(*on).count().filter(F.col("count") > F.lit(share * total)).select(*on)


def staged_with_hot(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> tuple[DataFrame, list[int]]:
    """``df`` staged, and the hashes of the keys that hold more than ``share`` of its rows.

    A frequent-items sketch of the keys' hashes rides on the pass that writes
    the table; tasks keep ``TRACKED`` items each and merge. No key beyond the
    share escapes it, and one just below may come along, which costs copies
    of its partners but changes no row.
    """
    seen = Observation()
    most = int(2 / share)
    sketch = F.expr(f"approx_top_k(_key, {most}, {max(TRACKED, 4 * most)})")
    # the key's hash only exists for the sketch; a metric must not change what is written
    keyed = df.withColumn("_key", F.xxhash64(*on)).observe(seen, F.count(F.lit(1)).alias("rows"), sketch.alias("top"))
    held = stage(keyed.drop("_key"))
    found = seen.get
    return held, [r["item"] for r in found["top"] or [] if r["count"] > share * found["rows"]]


def _join_where(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, where: Column | None) -> DataFrame:
    """Equi-join on same-named keys with an optional further condition."""
    if where is None:
        return left.join(right, list(on), how)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    condition = where
    for k in on:
        condition = condition & (F.col(k) == F.col(f"_r_{k}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in on])


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    salts: int = 64,
    share: float = HOT_SHARE,
    where: Column | None = None,
) -> DataFrame:
    """Shuffle join whose hot left keys are spread over ``salts`` buckets.

    The left side is read once: it is staged while its hot keys are found. Only rows of ``right`` under a hot key are repeated; every other key
    keeps one copy. The salt is a hash of ``spread_by``, so a retried task
    sends each row to the same bucket.
    """
    left, hot = staged_with_hot(left, on, share)
    is_hot = F.xxhash64(*on).isin(hot) if hot else F.lit(False)
    bucket = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_left = left.withColumn("_salt", F.when(is_hot, bucket).otherwise(F.lit(0)))
    salted_right = right.withColumn("_salt", F.explode(copies))
    return _join_where(salted_left, salted_right, [*on, "_salt"], how, where).drop("_salt")


def lookup(
    facts: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    weight: Column | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Join of a large fact table to a lookup of unknown size.

    Broadcast when the lookup is measured to be small, salted shuffle join
    beyond that.
    """
    small, fits = bounded_broadcast(table, max_rows, weight)
    if fits:
        return _join_where(facts, small, on, how, where)
    return salted_join(facts, small, on, spread_by, how, where=where)


def crosswalk_join(facts: DataFrame, crosswalk: DataFrame, on: Sequence[str], spread_by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Facts with the crosswalk's columns, and the distinct keys it does not map."""
    joined = lookup(facts, crosswalk, on, spread_by)
    unmapped = facts.select(*on).distinct().join(crosswalk.select(*on), list(on), "left_anti")
    return joined, unmapped


def guard_mapped(joined: DataFrame, target: str, must_map: Column, label: str) -> DataFrame:
    """Fail the job if a row matching ``must_map`` came out of a crosswalk unmapped."""
    lost = F.col(target).isNull() & F.coalesce(must_map, F.lit(False))
    return joined.withColumn(target, F.when(lost, F.raise_error(F.lit(f"unmapped row in {label}"))).otherwise(F.col(target)))


def successor_codes(df: DataFrame, successors: DataFrame, code: str, period: str) -> DataFrame:
    """Former codes renamed to their successor's; the job fails where both report the same period.

    ``successors`` is (code, successor), one row for each former code.
    """
    renamed = successors.select(F.col(code), F.col("successor").alias("_to"))
    moved = df.join(one_row_per(renamed, [code]), code, "left").withColumn("_was", F.col(code)).withColumn(code, F.coalesce("_to", code))
    heirs = moved.groupBy(code, period).agg(F.min("_was").alias("_a"), F.max("_was").alias("_b")).filter(F.col("_a") != F.col("_b"))
    clash = F.concat(F.lit("two codes report "), F.concat_ws(" ", F.col(code).cast("string"), F.col(period).cast("string")))
    guarded = moved.join(heirs.select(code, period, F.lit(True).alias("_clash")), [code, period], "left")
    return guarded.withColumn(code, F.when(F.col("_clash"), F.raise_error(clash).cast(df.schema[code].dataType)).otherwise(F.col(code))).select(*df.columns)


def override_join(df: DataFrame, overrides: DataFrame, on: Sequence[str], column: str, only_null: bool = False) -> DataFrame:
    """Replace ``column`` by the override table's value for the keys it names."""
    fix = overrides.select(*on, F.col(column).alias("_fix"))
    value, repaired = F.col(column), F.col("_fix")
    chosen = F.coalesce(value, repaired) if only_null else F.coalesce(repaired, value)
    return df.join(fix, list(on), "left").withColumn(column, chosen).drop("_fix")


def outer_merge(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join, one row per key asserted on both sides."""
    return one_row_per(left, on).join(one_row_per(right, on), list(on), "full_outer")


def stack_indicators(series: Sequence[tuple[str, DataFrame]], on: Sequence[str], value: str) -> DataFrame:
    """Many (key, value) series side by side: one union and one pivot, not N full joins."""
    stacked = None
    for name, df in series:
        part = df.select(*on, F.lit(name).alias("_name"), F.col(value).alias("_value"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(*on).pivot("_name", [n for n, _ in series]).agg(F.first("_value", ignorenulls=True))


def expand_periods(df: DataFrame, start: str, end: str, first: int, last: int, year: str = "year") -> DataFrame:
    """One row per year of each [start, end] period, clipped to [first, last]."""
    low, high = F.greatest(F.col(start), F.lit(first)), F.least(F.col(end), F.lit(last))
    # sequence() counts downwards when low > high, so empty periods go first
    return df.filter(low <= high).withColumn(year, F.explode(F.sequence(low.cast("int"), high.cast("int"))))


def missing_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not hold."""
    return left.select(*on).distinct().join(right.select(*on), list(on), "left_anti")


def keep_members(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key belongs to the study set."""
    return df.join(members.select(*on), list(on), "left_semi")


def expected_broadcast_total(layer: DataFrame, spine: DataFrame, on: str, value: str) -> DataFrame:
    """What a country-level value must sum to after being given to every district."""
    size = spine.groupBy(on).agg(F.count(F.lit(1)).alias("_districts"))
    return layer.join(size, on).agg(F.sum(F.col(value) * F.col("_districts")).alias("expected"))
