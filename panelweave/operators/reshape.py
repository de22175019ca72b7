"""Long/wide reshaping, code maps and row-wise column rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.sources.contracts import require_values


def melt_positive(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide to long, keeping cells above zero."""
    return df.unpivot(list(ids), list(columns), name, value).filter(F.col(value) > 0)


def pivot_fixed(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    names: Mapping[str, str],
    measures: Mapping[str, Column],
    absent_zero: bool,
    totals: bool = False,
) -> DataFrame:
    """Long to wide with a fixed category list, columns ``<measure>_<name>``.

    ``names`` maps category value to column suffix. A category that never
    occurs still gets its columns: 0 when ``absent_zero``, else null.
    With ``totals`` a category outside the list fails the job, as a total
    would lack it.
    """
    if totals:
        df = require_values(df, category, list(names))
    coded = df.filter(F.col(category).isin(list(names)))
    wide = coded.groupBy(*keys).pivot(category, list(names)).agg(*[m.alias(n) for n, m in measures.items()])
    single = len(measures) == 1
    out = list(keys)
    for measure in measures:
        parts = []
        for value, suffix in names.items():
            raw = F.col(f"`{value}`") if single else F.col(f"`{value}_{measure}`")
            parts.append((F.coalesce(raw, F.lit(0)) if absent_zero else raw).alias(f"{measure}_{suffix}"))
        out.extend(parts)
    wide = wide.select(*out)
    if totals:
        wide = wide.withColumns(
            {f"{m}_total": row_total([f"{m}_{s}" for s in names.values()]) for m in measures}
        )
    return wide


def prefix_columns(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    """Prefix everything but the keys."""
    return df.select(*keys, *[F.col(c).alias(prefix + c) for c in df.columns if c not in keys])


def row_total(columns: Sequence[str | Column]) -> Column:
    """Sum across columns, null counted as 0."""
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))
    return total


def row_count(columns: Sequence[str], holds) -> Column:
    """How many of the columns satisfy ``holds`` in this row."""
    return F.size(F.filter(F.array(*columns), lambda x: F.coalesce(holds(x), F.lit(False)))).cast("bigint")


def any_column(columns: Sequence[str], text: str, whole: bool, ignore_case: bool = False) -> Column:
    """Whether any column equals (or contains) ``text``."""
    fold = F.lower if ignore_case else (lambda x: x)
    wanted = text.lower() if ignore_case else text

    def holds(x: Column) -> Column:
        cell = fold(x)
        return F.coalesce(cell == wanted if whole else F.contains(cell, F.lit(wanted)), F.lit(False))

    return F.exists(F.array(*columns), holds)


def any_part_in(column: str, separators: str, codes: Sequence[str]) -> Column:
    """Whether any component of a compound code like ``"D2; F"`` is in ``codes``."""
    parts = F.split(F.upper(F.coalesce(F.col(column), F.lit(""))), separators)
    return F.exists(parts, lambda p: F.trim(p).isin(list(codes)))


def any_positive(columns: Sequence[str]) -> Column:
    """1 where any caution column holds a positive number; unreadable text counts as 0."""
    cells = F.array(*[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in columns])
    return F.exists(cells, lambda x: x > 0).cast("int")


def first_known(sources: Mapping[str, str]) -> tuple[Column, Column]:
    """The first non-null column and the label of the source that gave it."""
    origin = None
    for column, label in sources.items():
        known = F.col(column).isNotNull()
        origin = F.when(known, label) if origin is None else origin.when(known, label)
    return F.coalesce(*sources), origin


def map_codes(code: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """A small code map; codes it does not name become null (or ``default``)."""
    out = None
    for key, value in mapping.items():
        out = F.when(code == key, F.lit(value)) if out is None else out.when(code == key, F.lit(value))
    return out if default is None else out.otherwise(default)


def impute(raw: str, source: str, mapping: Mapping[str, str]) -> dict[str, Column]:
    """Fill a null from another column's map; keep the raw value and flag the fill."""
    return {
        f"{raw}_imputed": F.col(raw).isNull().cast("int"),
        f"{raw}_filled": F.coalesce(F.col(raw), map_codes(F.col(source), mapping)),
    }


def holders(groups: Mapping[str, tuple[str, str, str]]) -> dict[str, Column]:
    """Facts about repeated (active, start, end) column groups in one row.

    ``groups`` maps a holder's name to its three columns. Returns the number
    of active holders, earliest start, latest end, the holder with the latest
    end (a tie goes to the larger name) and the duration.
    """
    active = F.filter(
        F.array(*[
            F.struct(F.col(f"`{e}`").alias("end"), F.lit(name).alias("name"), F.col(f"`{s}`").alias("start"), F.col(f"`{a}`").alias("on"))
            for name, (a, s, e) in groups.items()
        ]),
        lambda g: F.coalesce(g["on"] == 1, F.lit(False)),
    )
    starts = F.filter(F.transform(active, lambda g: g["start"]), lambda x: x.isNotNull())
    ended = F.filter(active, lambda g: g["end"].isNotNull())
    start, end = F.array_min(starts), F.array_max(F.transform(ended, lambda g: g["end"]))
    # structs compare field by field: end first, then name
    last = F.array_max(F.transform(ended, lambda g: F.struct(g["end"].alias("end"), g["name"].alias("name"))))["name"]
    return {
        "holder_last": F.when(F.size(active) == 0, F.lit("None")).otherwise(last),
        "n_holders": F.size(active).cast("bigint"),
        "start_year": start,
        "end_year": end,
        "duration_years": end - start,
    }


def label_of(name: Column, code: Column) -> Column:
    """Display label ``name — code``; the bare code where no name is known."""
    return F.coalesce(F.concat(name, F.lit(" — "), code), code)


def columns_by_layer(dictionary: Mapping[str, Sequence[str]], chosen: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Keys plus the columns of the chosen layers, first mention wins."""
    wanted = list(keys)
    for layer in chosen:
        wanted += dictionary[layer]
    return list(dict.fromkeys(wanted))
