"""Column profiles, correlations and a fixed-effects regression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.operators.aggregate import exact_quantiles, tally_quantiles
from panelweave.session import stage

BLOCK = 512  # columns on a side of a block of pairs
FLAT = 1e-24  # variance, relative to the squared mean, that is only rounding


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Known values and their percentage per column, one pass."""
    n = F.count(F.lit(1))
    known = df.agg(n.alias("_n"), *[F.count(c).alias(c) for c in columns])
    long = known.unpivot(["_n"], list(columns), "column", "known")
    return long.select("column", "known", (F.col("known") * 100.0 / F.col("_n")).alias("pct"))


def families(coverages: DataFrame, rules: Mapping[str, Sequence[str]], rest: str = "Other") -> DataFrame:
    """Column count and mean coverage per family; the first matching prefix rule wins."""
    return coverages.groupBy(layer_of(F.col("column"), rules, rest).alias("family")).agg(
        F.count(F.lit(1)).alias("n_columns"), F.avg("pct").alias("mean_pct")
    )


def layer_of(column: Column, rules: Mapping[str, Sequence[str]], rest: str = "Other") -> Column:
    """Layer of a column name by ordered prefix rules."""
    out = None
    for layer, prefixes in rules.items():
        holds = F.lit(False)
        for p in prefixes:
            holds = holds | F.startswith(column, F.lit(p))
        out = F.when(holds, layer) if out is None else out.when(holds, layer)
    return out.otherwise(rest)


def tally(df: DataFrame, columns: Sequence[str], kind: str = "string") -> DataFrame:
    """(column, value, n): every distinct known value counted, values cast to ``kind``."""
    alike = df.select(*[F.col(c).cast(kind).alias(c) for c in columns])
    long = alike.unpivot([], list(columns), "column", "value").filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(counted: DataFrame) -> DataFrame:
    """Distinct known values per column, from a tally."""
    return counted.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"), F.sum("n").alias("known"))


def summary(df: DataFrame, columns: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """(column, known, pct, min, max, mean, sd), one pass; the moments of numeric columns only."""
    n, parts = F.count(F.lit(1)), []
    for c in columns:
        x = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        parts.append(F.struct(
            F.lit(c).alias("column"), F.count(c).alias("known"), (F.count(c) * 100.0 / n).alias("pct"),
            F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd"),
        ))
    return df.agg(F.array(*parts).alias("_p")).select(F.inline("_p"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """n, mean, sd, min, p5, p50, p95, max of one column."""
    base = df.agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("sd"), F.min(column).alias("min"), F.max(column).alias("max"))
    marks = exact_quantiles(df, [], column, {"p5": 0.05, "p50": 0.5, "p95": 0.95})
    # two one-row tables side by side: each column is known in one of them
    both = base.unionByName(marks, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def kinds(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Columns by the type their values are tallied in; text for all but plain numbers."""
    of = {c: df.schema[c].dataType.simpleString() for c in columns}
    return {
        "bigint": [c for c, k in of.items() if k in ("tinyint", "smallint", "int", "bigint")],
        "double": [c for c, k in of.items() if k in ("float", "double")],
        "string": [c for c, k in of.items() if k not in ("tinyint", "smallint", "int", "bigint", "float", "double")],
    }


def profile(df: DataFrame, columns: Sequence[str], numeric_over: int = 12) -> DataFrame:
    """Kind, coverage, distinct count and range per column.

    Numeric means a number type with more than ``numeric_over`` values. The
    moments come from one pass; distinct counts and medians from one tally
    of values per type, so numbers are never turned into text.
    """
    typed = {kind: names for kind, names in kinds(df, columns).items() if names}
    numeric = [c for kind in ("bigint", "double") for c in typed.get(kind, [])]
    seen, medians = None, None
    for kind, names in typed.items():
        counted = stage(tally(df, names, kind).withColumnsRenamed({"value": "_v", "n": "_n"}))
        part = counted.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
        seen = part if seen is None else seen.unionByName(part)
        if kind != "string":
            half = tally_quantiles(counted, ["column"], {"median": 0.5}).withColumn("median", F.col("median").cast("double"))
            medians = half if medians is None else medians.unionByName(half)
    table = summary(df, columns, numeric).join(seen, "column", "left").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))
    table = table.join(medians, "column", "left") if numeric else table.withColumn("median", F.lit(None).cast("double"))
    is_number = F.col("column").isin(numeric) & (F.col("n_distinct") > numeric_over)
    shown = {c: F.when(is_number, F.col(c)) for c in ("min", "max", "mean", "sd", "median")}
    return table.withColumns({"kind": F.when(is_number, "numeric").otherwise("categorical"), **shown})


def dictionary(profiled: DataFrame, definitions: DataFrame, rules: Mapping[str, Sequence[str]], search: str = "") -> DataFrame:
    """Column, layer, definition, coverage and distinct count, searchable by text."""
    named = profiled.join(definitions, "column", "left").select(
        "column", layer_of(F.col("column"), rules).alias("layer"), F.coalesce("definition", F.lit("—")).alias("definition"), "pct", "n_distinct"
    )
    if not search:
        return named
    wanted = F.lit(search.lower())
    return named.filter(F.contains(F.lower("column"), wanted) | F.contains(F.lower("definition"), wanted))


def _pair_moments(wide: DataFrame, left: Sequence[int], right: Sequence[int], names: Sequence[str], centre: Sequence[float]) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy, odd) for columns ``left`` by ``right``: sums over rows where both are known, summed per task by matrix products."""
    used = sorted({*left, *right})
    at = {c: k for k, c in enumerate(used)}
    li, ri = [at[c] for c in left], [at[c] for c in right]
    shift = np.array([centre[c] for c in used])

    def sums(batches):
        total = np.zeros((7, len(left), len(right)))
        for batch in batches:
            x = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(used))])
            # a null arrives as NaN; which values are known is told apart by the validity of the column
            known = np.column_stack([batch.column(k).is_valid().to_numpy(zero_copy_only=False) for k in range(len(used))])
            fine = known & np.isfinite(x)
            x = np.where(fine, x - shift, 0.0)
            m, f = known.astype("f8"), fine.astype("f8")
            odd = m - f
            a, b, fa, fb = x[:, li], x[:, ri], f[:, li], f[:, ri]
            part = fa.T @ fb, a.T @ fb, fa.T @ b, (a * a).T @ fb, fa.T @ (b * b), a.T @ b, odd[:, li].T @ m[:, ri] + f[:, li].T @ odd[:, ri]
            total += np.stack(part)
        i, j = (g.ravel() for g in np.meshgrid(left, right, indexing="ij"))
        once = i <= j
        yield pa.RecordBatch.from_arrays(
            [pa.array(i[once], pa.int32()), pa.array(j[once], pa.int32()), *(pa.array(t.ravel()[once]) for t in total)],
            ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy", "odd"],
        )

    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double, odd double"
    return wide.select(*[F.col(f"`{names[c]}`") for c in used]).mapInArrow(sums, schema)


def correlation_matrix(df: DataFrame, columns: Sequence[str], block: int = BLOCK) -> DataFrame:
    """Pairwise-complete Pearson correlations as rows (x, y, r).

    One pass finds a centre for every column, the next sums the moments of all
    pairs about them by matrix products, ``block`` columns by ``block`` at a
    time, so a task holds seven such blocks and one pass serves up to ``block``
    columns. A pair is null with fewer than two common rows or where a side
    does not vary there, NaN where a common value is NaN or infinite.
    """
    names = list(columns)
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(F.col(c)) < float("inf")), F.col(c))
    first = wide.agg(*[F.avg(finite(c)).alias(c) for c in names]).first()
    centre = [0.0 if v is None or not np.isfinite(v) else v for v in first]
    blocks = [range(k, min(k + block, len(names))) for k in range(0, len(names), block)]
    parts = [_pair_moments(wide, a, b, names, centre) for k, a in enumerate(blocks) for b in blocks[k:]]
    moments = parts[0]
    for more in parts[1:]:
        moments = moments.unionByName(more)
    sums = moments.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy", "odd")])
    vx, vy = F.col("sxx") - F.col("sx") ** 2 / F.col("n"), F.col("syy") - F.col("sy") ** 2 / F.col("n")
    away = F.array(*[F.lit(c) for c in centre])
    # what rounding leaves of a column that does not vary, measured by its distance from zero
    flat = lambda v, s, k: v <= F.col("n") * FLAT * (F.col(s) / F.col("n") + F.element_at(away, F.col(k) + 1)) ** 2
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / F.sqrt(vx * vy)))
    known = F.when(F.col("odd") > 0, F.lit(float("nan"))).when((F.col("n") >= 2) & ~flat(vx, "sx", "i") & ~flat(vy, "sy", "j") & (vx > 0) & (vy > 0), r)
    label = lambda k: F.element_at(F.array(*[F.lit(c) for c in names]), F.col(k) + 1)
    half = sums.select(label("i").alias("x"), label("j").alias("y"), known.alias("r"))
    sides = F.when(F.col("x") == F.col("y"), F.array(F.struct("x", "y"))).otherwise(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))
    return half.select("r", F.explode(sides).alias("_s")).select("_s.x", "_s.y", "r")


def ranked_drivers(df: DataFrame, target: str, drivers: Sequence[str]) -> DataFrame:
    """Correlation of one target with each driver, highest first."""
    cells = [F.struct(F.lit(d).alias("driver"), F.corr(F.col(target).cast("double"), F.col(d).cast("double")).alias("r")) for d in drivers]
    return df.agg(F.array(*cells).alias("_c")).select(F.inline("_c")).orderBy(F.desc("r"), "driver")


def clustered_ols(df: DataFrame, y: str, xs: Sequence[str], effect: str, cluster: str) -> DataFrame:
    """Least squares with one set of fixed effects and clustered standard errors.

    The data is read for means and once more for cross products per (cluster,
    effect) cell; everything after works on those cells. Only k x k sums reach
    the driver. The small-sample factor is G/(G-1) * (n-1)/(n-p) with p
    counting the effect dummies. Returns (term, coef, std_err, t, n, clusters).
    """
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in (y, *xs)], F.col(effect).alias("_e"), F.col(cluster).alias("_g")).na.drop()
    names = [y, *xs]
    k = len(xs)
    centre = complete.agg(*[F.avg(c).alias(c) for c in names]).first()
    z = [F.col(c) - F.lit(centre[c]) for c in names]  # centred: cross products keep their digits
    pairs = list(combinations_with_replacement(range(k + 1), 2))
    cells = stage(complete.groupBy("_g", "_e").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(z[i]).alias(f"s{i}") for i in range(k + 1)],
        *[F.sum(z[i] * z[j]).alias(f"q{i}_{j}") for i, j in pairs],
    ))
    by_effect = cells.groupBy("_e").agg(F.sum("_n").alias("_N"), *[F.sum(f"s{i}").alias(f"S{i}t") for i in range(k + 1)])
    means = by_effect.select("_e", *[(F.col(f"S{i}t") / F.col("_N")).alias(f"m{i}") for i in range(k + 1)])

    def within(i: int, j: int) -> Column:
        """Cell sum of products of effect-demeaned columns."""
        q = F.col(f"q{min(i, j)}_{max(i, j)}")
        mi, mj = F.col(f"m{i}"), F.col(f"m{j}")
        return q - mi * F.col(f"s{j}") - mj * F.col(f"s{i}") + F.col("_n") * mi * mj

    centred = cells.join(means, "_e").select("_g", "_n", "_e", *[within(i, j).alias(f"w{i}_{j}") for i, j in pairs])
    total = centred.agg(
        F.sum("_n").alias("n"), F.count_distinct("_e").alias("effects"), F.count_distinct("_g").alias("clusters"),
        *[F.sum(f"w{i}_{j}").alias(f"w{i}_{j}") for i, j in pairs],
    ).first()
    xx = np.array([[total[f"w{min(i, j)}_{max(i, j)}"] for j in range(1, k + 1)] for i in range(1, k + 1)])
    xy = np.array([total[f"w0_{i}"] for i in range(1, k + 1)])
    if np.linalg.matrix_rank(xx) < k:
        raise ValueError(f"regressors {list(xs)} are collinear within the effects, or one does not vary there")
    beta = np.linalg.solve(xx, xy)
    scores = centred.groupBy("_g").agg(*[
        F.sum(F.col(f"w0_{i}") - sum(F.col(f"w{min(i, j)}_{max(i, j)}") * F.lit(float(beta[j - 1])) for j in range(1, k + 1))).alias(f"u{i}")
        for i in range(1, k + 1)
    ])
    meat_row = scores.agg(*[F.sum(F.col(f"u{i}") * F.col(f"u{j}")).alias(f"b{i}_{j}") for i in range(1, k + 1) for j in range(1, k + 1)]).first()
    meat = np.array([[meat_row[f"b{i}_{j}"] for j in range(1, k + 1)] for i in range(1, k + 1)])
    n, g, p = total["n"], total["clusters"], k + total["effects"]
    bread = np.linalg.inv(xx)
    factor = g / (g - 1) * (n - 1) / (n - p)
    errors = np.sqrt(np.diag(bread @ meat @ bread) * factor)
    rows = [(x, float(b), float(e), float(b / e), n, g) for x, b, e in zip(xs, beta, errors)]
    return df.sparkSession.createDataFrame(rows, "term string, coef double, std_err double, t double, n bigint, clusters bigint")
