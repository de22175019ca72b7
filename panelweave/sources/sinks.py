"""Writing panels: sorted parquet, rounded CSV, gated and size-limited exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLOATS = {"float", "double"}


class ExportRefused(Exception):
    """An export was asked for that is not allowed."""


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.dataType.simpleString() in FLOATS]


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], partitions: int | None = None) -> None:
    """Parquet in key order across and within files, without one task sorting all."""
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Float columns rounded half-even, as the export format has it."""
    floats = float_columns(df)
    return df.select(*[F.bround(c, digits).alias(c) if c in floats else F.col(c) for c in df.columns])


def write_csv(df: DataFrame, path: str, keys: Sequence[str] = (), digits: int = 4) -> None:
    """Gzip CSV with a header. Null is the empty cell, so the text ``NA`` survives."""
    out = rounded(df, digits)
    if keys:
        out = out.repartitionByRange(*keys).sortWithinPartitions(*keys)
    out.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", '""').option("compression", "gzip").csv(path)


def whole_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Which float columns hold only whole numbers: rows (column, whole), one pass."""
    flags = [F.bool_and(F.coalesce(F.col(c) == F.floor(c), F.lit(True))).alias(c) for c in columns]
    return df.agg(*flags).unpivot([], list(columns), "column", "whole")


def shrink_types(df: DataFrame, digits: int = 3) -> DataFrame:
    """Whole-number float columns become integers, the rest are rounded."""
    floats = float_columns(df)
    if not floats:
        return df
    whole = {r["column"] for r in whole_columns(df, floats).filter("whole").collect()}  # one row per column
    return df.select(*[
        F.col(c).cast("bigint").alias(c) if c in whole else F.bround(c, digits).alias(c) if c in floats else F.col(c) for c in df.columns
    ])


def publishable(df: DataFrame, restricted: Sequence[str], confirm_private: bool = False, drop: bool = False) -> DataFrame:
    """Hold back columns whose licence forbids publishing unless confirmed."""
    held = [c for c in restricted if c in df.columns]
    if not held or confirm_private:
        return df
    if drop:
        return df.drop(*held)
    raise ExportRefused(f"restricted columns {held}; confirm_private=True to export them")


def bounded_export(df: DataFrame, path: str, max_rows: int = 200_000) -> int:
    """CSV of a slice, refused when it is larger than ``max_rows``."""
    size = df.limit(max_rows + 1).count()
    if size > max_rows:
        raise ExportRefused(f"more than {max_rows} rows selected; narrow the filter")
    write_csv(df, path)
    return size


def build_report(df: DataFrame, tallies: Mapping[str, int], spread: Sequence[str] = ()) -> str:
    """Plain-text build report: shape, schema, known counts, join tallies, and least, median and largest of ``spread``."""
    from panelweave.operators.stats import coverage, distribution

    known = {r["column"]: r for r in coverage(df, df.columns).collect()}  # one row per column
    lines = [f"columns: {len(df.columns)}"]
    for f in df.schema:
        lines.append(f"{f.name:32s} {f.dataType.simpleString():10s} known {known[f.name]['known']:>14,} ({known[f.name]['pct']:.2f}%)")
    lines += [f"{name}: {n:,}" for name, n in tallies.items()]
    for c in spread:
        row = distribution(df, c).first()
        shown = ["unknown" if row[k] is None else f"{float(row[k]):.2f}" for k in ("min", "p50", "max")]
        lines.append(f"{c}: min {shown[0]}, median {shown[1]}, max {shown[2]}")
    return "\n".join(lines)
