"""Scalar number rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """NaN and infinities become null."""
    x = c.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def without_nodata(c: Column, sentinel: float) -> Column:
    """The raster nodata sentinel becomes null."""
    return F.nullif(c, F.lit(sentinel).cast("double"))


def covered_only(value: Column, coverage: Column) -> Column:
    """Null where nothing was covered."""
    return F.when(coverage > 0, value)


def number_or_null(c: Column, sentinels: Sequence[str] = ()) -> Column:
    """Lenient cast: unreadable text and the sentinels become null."""
    text = F.trim(c.cast("string"))
    return F.when(~text.isin(["", *sentinels]), text.try_cast("double"))


def strict_number(c: Column, kind: str = "double") -> Column:
    """Strict cast: unreadable text fails the job."""
    return F.when(c.cast("string").rlike(r"^\s*$"), None).otherwise(
        F.coalesce(c.try_cast(kind), F.when(c.isNotNull(), F.raise_error(F.concat(F.lit("not a number: "), c.cast("string"))).cast(kind)))
    )


def clip(c: Column, low: float, high: float) -> Column:
    return F.when(c.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), c)))


def percent(c: Column) -> Column:
    return c * 100.0


def ratio(part: Column, whole: Column) -> Column:
    """Null on a zero denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def flag(holds: Column) -> Column:
    """1/0; an unknown predicate is 0."""
    return F.coalesce(holds, F.lit(False)).cast("int")


def known_flag(holds: Column) -> Column:
    """1.0/0.0, null where the predicate is unknown."""
    return holds.cast("int").cast("double")


def round_even(c: Column, digits: int) -> Column:
    """Half-even rounding."""
    return F.bround(c, digits)


def human(c: Column) -> Column:
    """Short text for a number: millions, whole thousands, two decimals, or four digits."""
    size = F.abs(c)
    unit = F.pow(F.lit(10.0), 3 - F.floor(F.log10(size)))
    four = F.format_number(F.round(c * unit) / unit, 8)
    small = F.regexp_replace(F.regexp_replace(four, r"0+$", ""), r"\.$", "")
    return (
        F.when(c.isNull(), "—")
        .when(size >= 1e6, F.concat(F.format_number(c / 1e6, 2), F.lit("M")))
        .when(size >= 1000, F.format_number(c, 0))
        .when((size >= 1) | (c == 0), F.format_number(c, 2))
        .when(size < 1e-4, F.format_string("%.3e", c))
        .otherwise(small)
    )
