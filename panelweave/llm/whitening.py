"""Embedding whitening by polarisation: covariances out of variances of sums.

A component becomes the integer ``floor(SCALE * c) + OFFSET``. One pass sums every
dimension. A second squares the centred values ``n * x - S`` of every dimension
and of every sum of two dimensions. As the variance of a sum is both variances
and twice the covariance, what is over after the variances is the covariance.
All of it is whole-number work of any width, so neither order nor rounding
decides anything before ``eigh``. Tasks hold d * (d + 1) / 2 totals, the driver
one d x d matrix, however many rows there are.

Rows whose vector is null or empty, or holds a null or non-finite entry (also
one that is not finite any more after scaling), take no part, nor do those of
another length than most (of equally many, the longest length counts). Rows
without ``vec_id`` and repeated rows take part as often as they stand there.
Very large entries are worked out in wide integers; a deviation beyond a long is
null. Equal eigenvalues leave their eigenvectors free. A component along which
nothing varies cannot be scaled: its ``whitened`` is null and it does not count
in ``identity_error``. Extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.session import stage

SCALE, OFFSET, COMPONENTS = 1024.0, 100_000, 8
CHUNK = 1024  # vectors worked out at a time
LIMB = 21  # bits of a piece: the products of two, summed over a chunk, stay in 64 bits
WORD = 40  # bits of a piece of a total, so that Spark sums over 8 million tasks stay in 64 bits
FLAT = 1e-12  # eigenvalues below this share of the trace are rounding

TOTALS = "i int, j int, place int, piece bigint"
ROWS = "vec_id bigint, deviation bigint, whitened array<double>"


def usable(v: Column) -> Column:
    """A vector with entries, each of them a finite number before and after scaling."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < float("inf"))
    return F.coalesce((F.size(v) > 0) & F.forall(v, fine), F.lit(False))


def integers(column: pa.Array, d: int) -> np.ndarray:
    """Vectors of length ``d`` as whole numbers: 64-bit where they fit, else of any width."""
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype("f8") * SCALE).reshape(-1, d)
    if np.abs(values).max(initial=0) < 1 << 52:
        return values.astype("i8") + OFFSET
    return np.array([[int(x) + OFFSET for x in row] for row in values], object).reshape(-1, d)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, by way of the whole part of the mean to keep the numbers short."""
    whole, rest = zip(*(divmod(s, n) for s in sums))
    if x.dtype != object and max(abs(w) for w in whole) < 1 << 62:
        near = x - np.array(whole, "i8")
        if (int(np.abs(near).max(initial=0)) + 1) * n < 1 << 61:
            return near * n - np.array(rest, "i8")
    return (x.astype(object) - np.array(whole, object)) * n - np.array(rest, object)


def square_sums(w: np.ndarray) -> np.ndarray:
    """Exact column sums of ``w * w``, as Python integers."""
    w, pieces, mask = abs(w), [], (1 << LIMB) - 1
    while w.any():
        pieces.append(w & mask)
        w = w >> LIMB
    total = np.zeros(w.shape[1], object)
    for p, a in enumerate(pieces):
        for q, b in enumerate(pieces[p:], p):
            part = (a * b).sum(0).astype(object)
            total += (part << (LIMB * (p + q))) * (1 if p == q else 2)
    return total


def _chunks(batches, d: int):
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            piece = batch.slice(at, CHUNK)
            yield piece, integers(piece.column("embedding"), d)


def _emit(totals: dict[tuple[int, int], int]) -> pa.RecordBatch:
    """Totals of any width, cut into signed pieces of ``WORD`` bits that Spark can add up."""
    out = []
    for (i, j), total in totals.items():
        sign, left, place = (-1 if total < 0 else 1), abs(total), 0
        while left:
            out.append((i, j, place, sign * (left & ((1 << WORD) - 1))))
            left, place = left >> WORD, place + 1
    columns = list(zip(*out)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["i", "j", "place", "piece"])


def _added(pieces: DataFrame) -> dict[tuple[int, int], int]:
    """Totals by (i, j): at most d * (d + 1) / 2 of them reach the driver."""
    out: dict[tuple[int, int], int] = {}
    rows = pieces.groupBy("i", "j", "place").agg(F.sum("piece").alias("piece")).toArrow()
    for i, j, place, piece in zip(*(c.to_pylist() for c in rows.columns)):
        out[i, j] = out.get((i, j), 0) + (piece << (WORD * place))
    return out


def dimension_sums(vectors: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors, and the exact sum of every dimension."""

    def sums(batches):
        count, total = 0, np.zeros(d, object)
        for _, x in _chunks(batches, d):
            count, total = count + len(x), total + x.sum(0).astype(object)
        yield _emit({(-1, -1): count} | {(i, i): int(t) for i, t in enumerate(total)})

    found = _added(vectors.select("embedding").mapInArrow(sums, TOTALS))
    return found.get((-1, -1), 0), [found.get((i, i), 0) for i in range(d)]


def squared_sums(vectors: DataFrame, d: int, n: int, sums: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums of squares: (i, i) of dimension i, (i, j) of dimensions i and j together, both centred and times ``n``."""

    def squares(batches):
        alone, paired = np.zeros(d, object), [np.zeros(d - i - 1, object) for i in range(d)]
        for _, x in _chunks(batches, d):
            u = centred(x, n, sums)
            alone = alone + square_sums(u)
            for i in range(d - 1):
                paired[i] = paired[i] + square_sums(u[:, i : i + 1] + u[:, i + 1 :])
        yield _emit({(i, i): int(t) for i, t in enumerate(alone)} | {(i, i + 1 + k): int(t) for i, row in enumerate(paired) for k, t in enumerate(row)})

    return _added(vectors.select("embedding").mapInArrow(squares, TOTALS))


def covariance(squares: dict[tuple[int, int], int], d: int, n: int) -> np.ndarray:
    """Polarisation: half of what a pair's square sum has beyond its two own; each entry rounded once."""
    out, over = np.zeros((d, d)), n * n * n
    for i in range(d):
        for j in range(i, d):
            a, b = squares.get((i, i), 0), squares.get((j, j), 0)
            out[i, j] = out[j, i] = a / over if i == j else (squares.get((i, j), 0) - a - b) / (2 * over)
    return out


@dataclass
class Whitening:
    """What was fitted: ``n`` vectors, exact ``sums``, axes (columns) with their variances, and the whole variance."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def varies(self) -> np.ndarray:
        return self.variances > FLAT * max(self.trace, 0.0)

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace > 0 else 0.0 for e in self.variances]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening over all rows of ``embedding``, which holds usable vectors of one length; None without any."""
    first = vectors.select(F.size("embedding").alias("d")).first()
    if first is None:
        return None
    d = first["d"]
    n, sums = dimension_sums(vectors, d)
    v = covariance(squared_sums(vectors, d, n, sums), d, n)
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    axes = axes[:, order]
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    return Whitening(n, sums, axes, np.maximum(values[order], 0.0), float(np.trace(v)))


def apply(vectors: DataFrame, w: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened): one row for each row of ``vectors``."""
    d, n, sums = len(w.sums), w.n, w.sums
    varies = w.varies
    scaled = w.axes[:, varies] / np.sqrt(w.variances[varies])

    def project(batches):
        for piece, x in _chunks(batches, d):
            u = centred(x, n, sums)
            away = [int(t) for t in square_sums(u.T)]
            out = np.full((len(u), len(varies)), None, object)
            out[:, varies] = (u.astype("f8") / n) @ scaled
            yield pa.RecordBatch.from_arrays(
                [piece.column("vec_id"), pa.array([t if t < 1 << 63 else None for t in away], pa.int64()), pa.array(out.tolist(), pa.list_(pa.float64()))],
                ["vec_id", "deviation", "whitened"],
            )

    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").mapInArrow(project, ROWS)


def identity_error(whitened: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the measured covariance of ``whitened`` less the identity."""
    live = [k for k, ok in enumerate(w.varies) if ok]
    pairs = [(a, b) for at, a in enumerate(live) for b in live[at:]]
    if not pairs:
        return 0.0
    entry = lambda k: F.col("whitened")[k]
    row = whitened.agg(*[F.abs(F.covar_pop(entry(a), entry(b)) - (1.0 if a == b else 0.0)).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(row)


def vectors_of(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part: usable, and as long as most."""
    fine = embeddings.select("vec_id", "embedding").filter(usable(F.col("embedding")))
    sizes = fine.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return fine.filter(F.size("embedding") == (most["d"] if most else 0))


def digest(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """The query's columns: one row for each row that takes part and each component."""
    spark = embeddings.sparkSession
    vectors = vectors_of(embeddings)
    w = fit(vectors, components)
    if w is None:
        return spark.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    rows = stage(apply(vectors, w))
    shares = F.array(*[F.lit(x) for x in w.explained])
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("_k", "whitened")).select(
        "vec_id", (F.col("_k") + 1).cast("int").alias("component"), F.lit(w.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("_k") + 1).alias("explained"), F.lit(identity_error(rows, w)).alias("identity_error"),
    )
