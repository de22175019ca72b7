"""What a source must look like before it is used, and the record of a load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.operators import checks


def exact_rows(df: DataFrame, group: str, name: str, expected: int) -> DataFrame:
    """How far the row count is from the expected one."""
    off = F.abs(F.count(F.lit(1)) - F.lit(expected)).alias("violations")
    status = F.when(F.col("violations") == 0, "PASS").otherwise("FAIL")
    return df.agg(off).select(F.lit(group).alias("grp"), F.lit(name).alias("name"), status.alias("status"), "violations")


def columns_present(df: DataFrame, group: str, required: Sequence[str]) -> DataFrame:
    """Required columns the source lacks; answered from the schema alone."""
    lost = sum(c not in df.columns for c in required)
    return df.sparkSession.createDataFrame(
        [(group, "columns present", "PASS" if lost == 0 else "FAIL", lost)], "grp string, name string, status string, violations bigint"
    )


def source_contract(
    df: DataFrame,
    group: str,
    required: Sequence[str],
    min_rows: int = 1,
    row_cap: int | None = None,
    allowed: Mapping[str, Sequence] | None = None,
    ranges: Mapping[str, tuple] | None = None,
) -> DataFrame:
    """Header, size, vocabulary and range checks of a raw table, one pass.

    Reaching ``row_cap`` means the source cut the download short.
    """
    rules = {f"at least {min_rows} rows": F.count(F.lit(1)) >= min_rows}
    if row_cap is not None:
        rules["below the row cap"] = F.count(F.lit(1)) < row_cap
    parts = [columns_present(df, group, required), checks.aggregates_hold(df, group, rules)]
    vocab = {f"{c} allowed": F.col(c).isNull() | F.col(c).isin(list(v)) for c, v in (allowed or {}).items()}
    spans = {f"{c} in {lo}..{hi}": F.col(c).isNull() | F.col(c).between(lo, hi) for c, (lo, hi) in (ranges or {}).items()}
    if vocab or spans:
        parts.append(checks.rows_hold(df, group, {**vocab, **spans}))
    return checks.report(*parts)


def require_values(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Fail the job on any value outside the allowed set, as the rows stream through."""
    bad = F.col(column).isNotNull() & ~F.col(column).isin(list(allowed))
    message = F.concat(F.lit(f"unexpected {column}: "), F.col(column).cast("string"))
    kind = df.schema[column].dataType
    return df.withColumn(column, F.when(bad, F.raise_error(message).cast(kind)).otherwise(F.col(column)))


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    lost = [c for c in required if c not in df.columns]
    if lost:
        raise ValueError(f"source lacks columns {lost}")
    return df


def manifest(df: DataFrame, partition: Sequence[str], date: str) -> DataFrame:
    """Rows and date range per partition of a load."""
    return df.groupBy(*partition).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date")
    )


def file_manifest(df: DataFrame, date: str) -> DataFrame:
    """The same per source file, with the time it was written."""
    named = df.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("written"), date)
    return manifest(named, ["file", "written"], date)
