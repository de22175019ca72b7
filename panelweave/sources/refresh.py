"""Yearly partitions that settle: only the trailing years are written again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def due_years(first: int, last: int, present: Sequence[int], trailing: int) -> list[int]:
    """Years to load: those never loaded and the last ``trailing`` ones."""
    done = set(present)
    return [y for y in range(first, last + 1) if y not in done or y > last - trailing]


def refresh_years(incoming: DataFrame, path: str, years: Sequence[int], year: str = "year") -> None:
    """Overwrite just these year partitions; one without rows now goes, settled ones keep their files."""
    due = incoming.filter(F.col(year).isin(list(years)))
    # rows of one year spread over tasks by all columns, so a heavy year is not one file
    spread = due.repartition(F.col(year), F.pmod(F.xxhash64(*[c for c in due.columns if c != year]), F.lit(16)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(path)
    spark = incoming.sparkSession
    held = {r[year] for r in due.select(year).distinct().collect()}  # calendar years
    for empty in sorted(set(years) - held):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{year}={empty}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def refresh_trailing(incoming: DataFrame, path: str, last: int, trailing: int = 2, year: str = "year") -> None:
    """The usual refresh: the trailing years were revised at the source."""
    refresh_years(incoming, path, range(last - trailing + 1, last + 1), year)
