"""Years out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fiscal_year(label: Column, pivot: int = 89) -> Column:
    """``FY89`` -> 1989, ``FY05`` -> 2005; any other label fails the job."""
    yy = F.regexp_extract(F.trim(label), r"^FY(\d{2})$", 1).try_cast("int")
    bad = F.raise_error(F.concat(F.lit("not a fiscal year: "), label)).cast("int")
    return F.when(yy.isNull(), bad).when(yy >= pivot, 1900 + yy).otherwise(2000 + yy)


def year_of(text: Column) -> Column:
    """Year of a parsed date; text that is no date gives null."""
    return F.year(F.try_to_timestamp(text))


def first_date(*texts: str) -> Column:
    """Year of the first date column that is present."""
    return year_of(F.coalesce(*texts))
