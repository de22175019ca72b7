"""Declarative checks. Each is a frame of rows (grp, name, status, violations)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.functions import text

COLUMNS = ["grp", "name", "status", "violations"]


class CheckFailed(Exception):
    """A gate found failing checks."""


def _judged(df: DataFrame, group: str, violations: Mapping[str, Column]) -> DataFrame:
    """One check row per aggregate that counts violations, all in one pass."""
    counted = [F.struct(F.lit(n).alias("name"), F.coalesce(v, F.lit(0)).cast("bigint").alias("violations")) for n, v in violations.items()]
    long = df.agg(F.array(*counted).alias("_c")).select(F.inline("_c"))
    status = F.when(F.col("violations") == 0, "PASS").otherwise("FAIL")
    return long.select(F.lit(group).alias("grp"), "name", status.alias("status"), "violations")


def rows_hold(df: DataFrame, group: str, rules: Mapping[str, Column]) -> DataFrame:
    """Row rules, all in one pass. An unknown predicate is a violation."""
    return _judged(df, group, {name: F.count_if(~F.coalesce(rule, F.lit(False))) for name, rule in rules.items()})


def aggregates_hold(df: DataFrame, group: str, rules: Mapping[str, Column]) -> DataFrame:
    """Rules over aggregates (bands, totals, orderings), all in one pass."""
    return _judged(df, group, {name: F.when(F.coalesce(rule, F.lit(False)), 0).otherwise(1) for name, rule in rules.items()})


def unique_key(df: DataFrame, group: str, name: str, keys: Sequence[str]) -> DataFrame:
    """How many keys occur more than once."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _judged(counts, group, {name: F.count_if(F.col("_n") > 1)})


def balanced(df: DataFrame, group: str, name: str, entity: str, first: int, last: int, year: str = "year") -> DataFrame:
    """Entities that do not have each year of the span exactly once."""
    per = df.groupBy(entity).agg(F.count_distinct(year).alias("_d"), F.count(F.lit(1)).alias("_n"), F.min(year).alias("_a"), F.max(year).alias("_b"))
    size = last - first + 1
    good = (F.col("_d") == size) & (F.col("_n") == size) & (F.col("_a") == first) & (F.col("_b") == last)
    return _judged(per, group, {name: F.count_if(~F.coalesce(good, F.lit(False)))})


def known_keys(keys: Sequence[str]) -> dict[str, Column]:
    return {f"{k} known": F.col(k).isNotNull() for k in keys}


def same_null_mask(a: str, b: str) -> Column:
    """Both null or both known."""
    return F.col(a).isNull() == F.col(b).isNull()


def types_match(df: DataFrame, group: str, families: Mapping[str, str]) -> DataFrame:
    """Columns of a prefix family that do not have the stated type."""
    spark = df.sparkSession
    rows = []
    for prefix, kind in families.items():
        wrong = sum(1 for f in df.schema if f.name.startswith(prefix) and f.dataType.simpleString() != kind)
        rows.append((group, f"{prefix}* is {kind}", "PASS" if wrong == 0 else "FAIL", wrong))
    return spark.createDataFrame(rows, "grp string, name string, status string, violations bigint")


def documented(df: DataFrame, group: str, name: str, dictionary: DataFrame) -> DataFrame:
    """Columns the dictionary does not list; ``fao_{a,b}_t`` there stands for a family."""
    columns = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column string")
    listed = dictionary.select(F.explode(text.brace_names(F.col("column"))).alias("column"))
    undocumented = columns.join(listed, "column", "left_anti")
    return _judged(undocumented, group, {name: F.count(F.lit(1))})


def some_known(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Columns that hold no value at all, one pass."""
    return aggregates_hold(df, group, {f"{c} has values": F.count(c) > 0 for c in columns})


def gaps_documented(df: DataFrame, group: str, columns: Sequence[str], origin: int, width: int, gaps: DataFrame, year: str = "year") -> DataFrame:
    """Eras where a column has no value although no gap is documented, and documented gaps that have values.

    ``gaps`` is (column, era).
    """
    from panelweave.operators.aggregate import era_missingness

    empty = era_missingness(df, columns, origin, width, year).withColumn("_empty", F.col("pct_known") == 0)
    told = gaps.select("column", F.col("era").cast("int").alias("era")).distinct().withColumn("_told", F.lit(True))
    both = empty.join(told, ["column", "era"], "left").withColumn("_told", F.coalesce("_told", F.lit(False)))
    return rows_hold(both, group, {"every empty era is documented": F.col("_told") | ~F.col("_empty"), "every documented gap is empty": F.col("_empty") | ~F.col("_told")})


def totals_match(panel: DataFrame, source: DataFrame, group: str, columns: Sequence[str], tolerance: float = 1e-6) -> DataFrame:
    """Grand totals of the panel against those of the source layer, one pass each."""
    def totals(df: DataFrame, value: str) -> DataFrame:
        return df.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", value)

    both = totals(panel, "_p").join(totals(source, "_s"), "column")
    off = (F.abs(F.col("_p") - F.col("_s")) > tolerance * F.greatest(F.lit(1.0), F.abs(F.col("_s")))).cast("bigint")
    status = F.when(off == 0, "PASS").otherwise("FAIL")
    return both.select(F.lit(group).alias("grp"), F.concat(F.lit("total of "), "column").alias("name"), status.alias("status"), off.alias("violations"))


def counts_match(panel: DataFrame, source: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Known-value counts of the panel against those of the source layer."""
    def known(df: DataFrame, value: str) -> DataFrame:
        return df.agg(*[F.count(c).alias(c) for c in columns]).unpivot([], list(columns), "column", value)

    both = known(panel, "_p").join(known(source, "_s"), "column")
    off = F.abs(F.col("_p") - F.col("_s"))
    status = F.when(off == 0, "PASS").otherwise("FAIL")
    return both.select(F.lit(group).alias("grp"), F.concat(F.lit("known in "), "column").alias("name"), status.alias("status"), off.alias("violations"))


def key_set_equals(left: DataFrame, right: DataFrame, group: str, name: str, keys: Sequence[str]) -> DataFrame:
    """Keys found on one side only."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    odd = a.subtract(b).unionByName(b.subtract(a))
    return _judged(odd, group, {name: F.count(F.lit(1))})


def subset_of(left: DataFrame, right: DataFrame, group: str, name: str, keys: Sequence[str]) -> DataFrame:
    """Keys of ``left`` that ``right`` lacks."""
    lost = left.select(*keys).distinct().join(right.select(*keys), list(keys), "left_anti")
    return _judged(lost, group, {name: F.count(F.lit(1))})


def constant_per(df: DataFrame, group: str, name: str, keys: Sequence[str], column: str) -> DataFrame:
    """Keys where the column takes more than one value or is never known."""
    per = df.groupBy(*keys).agg(F.min(column).alias("_a"), F.max(column).alias("_b"))
    good = F.coalesce(F.col("_a") == F.col("_b"), F.lit(False))
    return _judged(per, group, {name: F.count_if(~good)})


def varies_somewhere(df: DataFrame, group: str, name: str, keys: Sequence[str], column: str) -> DataFrame:
    """Fails when no key shows two different values."""
    per = df.groupBy(*keys).agg((F.min(column) < F.max(column)).alias("_v"))
    return aggregates_hold(per, group, {name: F.bool_or("_v")})


def shares_sum_to_one(df: DataFrame, group: str, name: str, keys: Sequence[str], share: str, tolerance: float = 1e-6) -> DataFrame:
    per = df.groupBy(*keys).agg(F.sum(share).alias("_s"))
    return rows_hold(per, group, {name: F.abs(F.col("_s") - 1) <= tolerance})


def expected_values(df: DataFrame, expected: DataFrame, group: str, name: str, keys: Sequence[str], column: str) -> DataFrame:
    """Rows of an expected-value table the data contradicts or lacks."""
    want = expected.select(*keys, F.col(column).alias("_want"))
    both = want.join(df.select(*keys, column), list(keys), "left")
    return rows_hold(both, group, {name: F.col(column).eqNullSafe(F.col("_want"))})


def landed(observed: DataFrame, panel: DataFrame, group: str, name: str, keys: Sequence[str], flag: str) -> DataFrame:
    """Observation keys that do not appear in the panel with a known flag."""
    found = observed.select(*keys).distinct().join(panel.select(*keys, flag), list(keys), "left")
    return rows_hold(found, group, {name: F.col(flag).isNotNull()})


def report(*parts: DataFrame) -> DataFrame:
    """All check rows in one frame."""
    return reduce(DataFrame.unionByName, [p.select(*COLUMNS) for p in parts])


def gate(checks: DataFrame) -> DataFrame:
    """Raise if any check fails. Check rows are few by construction: one per rule."""
    failed = checks.filter(F.col("status") != "PASS").orderBy("grp", "name").collect()
    if failed:
        raise CheckFailed("; ".join(f"{r['grp']}/{r['name']}: {r['violations']}" for r in failed))
    return checks


def summary_text(checks: DataFrame) -> str:
    """A plain-text report: a line per check and the totals."""
    rows = checks.orderBy("grp", "name").collect()
    lines = [f"[{r['status']}] {r['grp']} / {r['name']} (violations: {r['violations']})" for r in rows]
    passed = sum(r["status"] == "PASS" for r in rows)
    return "\n".join([*lines, f"{passed} of {len(rows)} checks passed"])
