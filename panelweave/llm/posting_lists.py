"""Approximate nearest neighbours over balanced posting lists.

Vectors are clustered; one near a boundary goes to the lists of several
clusters. Centroids are searched by an in-memory neighbour graph, and a query
probes the lists whose centroid is at most a ratio farther than its nearest.
The ratio is measured on ``PROBES`` vectors, so that ``RECALL`` of their true
neighbours, found among all vectors, lie in a probed list. Every vector is indexed; what is found is scored again, exactly, on the
original vectors.

No table holds a row for each query and list. A query carries how far it looks,
and a task that holds pieces of lists runs through all queries; the lists come
in rounds, each ``GROWTH`` times the last, and a query leaves a task with what
beats the best it has from the sample and earlier rounds. So what is written and shuffled is a
few times the vectors, whatever share of the lists has to be probed.

Nearness is the inner product, found as distance after one more coordinate
makes all vectors equally long. Vectors that are null, empty, zero or hold a
null or non-finite component take no part, nor do those of another length than
most, nor rows without ``vec_id``. Rows of one ``vec_id`` count once, with the
least vector. Equal vectors are searched once. Ties go to the smaller
``vec_id``. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.llm.shared import hash128, partitions, small_batches
from panelweave.llm.token_files import place
from panelweave.session import shuffles_freed, stage, unstage

TOP, EVERY = 20, 20
LIST = 512  # vectors a list holds on average, and a block of a list at most
MOST_LISTS = 16_384  # centroids, so what every task holds of the index is bounded; beyond 8 million vectors lists get longer, in blocks
SAMPLE, SAMPLE_VALUES, PROBES = 16_384, 1 << 22, 256  # vectors, numbers and queries of the sample at most
RECALL, BOUNDARY, COPIES = 0.97, 1.03, 3  # a vector joins lists up to that ratio farther than its nearest, and so many
DEGREE, WIDTH, ROUNDS, SEED = 16, 8, 8, 42
POOL, OPENED = 24, 4  # centroids that a walk keeps for a row, and opens at once
FIRST, GROWTH = 1 << 22, 4  # numbers in the lists of the first round, and of the rounds up to the next to those up to the last
TASK, PIECES, ASKED = 1 << 20, 1 << 22, 1 << 20  # numbers of a task's lists, and at once in a worker: of lists and of queries
PAIRS = 1 << 21  # of query and vector, or query and list, that a worker compares at once


def valid(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


@dataclass
class Centroids:
    """Cluster centres, their neighbour graph, and what a search needs."""

    points: np.ndarray
    longest: float  # squared length that all vectors are raised to
    ratio: float = 1.0
    least: float = 0.0  # a nearest centroid that is nearer, as of a vector that is one itself, counts as so far
    sizes: np.ndarray | None = None  # vectors in each list

    def __post_init__(self):
        k = len(self.points)
        self.squares = (self.points**2).sum(1)
        near = np.empty((k, min(DEGREE, k)), "i8")
        for at in range(0, k, 256):
            d = self.squares - 2 * self.points[at : at + 256] @ self.points.T
            near[at : at + 256] = np.argpartition(d, near.shape[1] - 1, 1)[:, : near.shape[1]]
        far = np.random.default_rng(SEED).integers(0, k, (k, 2))  # ways out of a tight group of centroids
        self.graph = np.column_stack([near, far])
        self.entries = np.unique(np.linspace(0, k - 1, min(k, 4 + 16 * int(k**0.5))).astype("i8"))

    def raised(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        extra = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0, self.longest - (vectors**2).sum(1)))
        return np.column_stack([vectors, extra])

    def distances(self, x: np.ndarray, to: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Distance of each row to each of those centroids."""
        return np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] + self.squares[to] - 2 * x @ self.points[to].T))

    def walk(self, x: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``POOL`` centroids near each row, nearest first, and their distances; infinite where there are fewer.

        All rows walk the graph together: each opens its nearest unopened
        centroids while these are among its ``WIDTH`` nearest or within
        ``ratio`` of the nearest.
        """
        n, k = len(x), len(self.points)
        width, own = min(POOL, k), (x**2).sum(1)
        entered = self.squares[self.entries] - 2 * x @ self.points[self.entries].T
        order = np.argpartition(entered, min(width, len(self.entries)) - 1, 1)[:, :width]
        order = np.take_along_axis(order, np.argsort(np.take_along_axis(entered, order, 1), 1), 1)
        ids, d = np.zeros((n, width), "i8"), np.full((n, width), np.inf)
        ids[:, : order.shape[1]], d[:, : order.shape[1]] = self.entries[order], np.take_along_axis(entered, order, 1) + own[:, None]
        opened, seen, rows = np.zeros((n, width), bool), np.zeros((n, k), bool), np.arange(n)
        seen[:, self.entries] = True
        while True:
            part = d[rows]
            closed = np.where(opened[rows], np.inf, part)
            best = np.argsort(closed, 1)[:, :OPENED]
            value = np.take_along_axis(closed, best, 1)
            bound = np.maximum(part[:, min(WIDTH, width) - 1], np.maximum(part[:, 0], 0) * ratio**2)
            go = np.isfinite(value) & (value <= bound[:, None])
            some = go.any(1)
            rows, best, go, part = rows[some], best[some], go[some], part[some]
            if not len(rows):
                break
            opened[rows[:, None], best] |= go
            reached = self.graph[np.take_along_axis(ids[rows], best, 1)]
            reached = np.sort(np.where(go[:, :, None], reached, k).reshape(len(rows), -1), 1)  # k: none
            new = reached < k
            new[:, 1:] &= reached[:, 1:] != reached[:, :-1]
            at, column = np.nonzero(new)
            to = reached[at, column]
            fresh = ~seen[rows[at], to]
            at, column, to = at[fresh], column[fresh], to[fresh]
            seen[rows[at], to] = True
            more = np.full(reached.shape, np.inf)
            more[at, column] = own[rows[at]] + self.squares[to] - 2 * np.einsum("ij,ij->i", x[rows[at]], self.points[to])
            both = np.concatenate([part, more], 1)
            order = np.argsort(both, 1)[:, :width]
            d[rows] = np.take_along_axis(both, order, 1)
            ids[rows] = np.take_along_axis(np.concatenate([ids[rows], reached], 1), order, 1)
            opened[rows] = np.take_along_axis(np.concatenate([opened[rows], np.zeros(reached.shape, bool)], 1), order, 1)
        return ids, np.sqrt(np.maximum(d, 0))

    def lists(self, x: np.ndarray) -> list[np.ndarray]:
        """The lists that each vector goes to."""
        ids, d = self.walk(self.raised(x), BOUNDARY)
        return [o[m] for o, m in zip(ids[:, :COPIES], np.isfinite(d[:, :COPIES]) & (d[:, :COPIES] <= d[:, :1] * BOUNDARY))]

    def reach(self, x: np.ndarray) -> np.ndarray:
        """How far each query looks: within the ratio, and far enough for lists that hold more than ``TOP`` vectors, each in up to ``COPIES``."""
        ids, d = self.walk(self.raised(x, query=True), 1.0)
        held = np.cumsum(np.where(np.isfinite(d), self.sizes[np.where(np.isfinite(d), ids, 0)], 0), 1)
        enough = held >= COPIES * (TOP + 1)
        needed = np.where(enough.any(1), d[np.arange(len(d)), enough.argmax(1)], np.inf)
        return np.maximum(np.maximum(d[:, 0], self.least) * self.ratio, needed) * (1 + 1e-9)


def fitted(sample: np.ndarray, lists: int, longest: float) -> Centroids:
    """k-means on the sample."""
    rng = np.random.default_rng(SEED)
    x = Centroids(np.zeros((1, sample.shape[1] + 1)), longest).raised(sample)
    points = x[rng.choice(len(x), lists, replace=False)]
    own = np.empty(len(x), "i8")
    for _ in range(ROUNDS):
        squares = (points**2).sum(1)
        for at in range(0, len(x), 256):
            own[at : at + 256] = (squares - 2 * x[at : at + 256] @ points.T).argmin(1)
        sums = np.zeros_like(points)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=lists)
        points = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], points)
    return Centroids(points, longest)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), "f8").reshape(len(column), -1)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of 512 rows, and their vectors."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield part, _matrix(part.column("v"))


def _placing(centroids: Centroids):
    """(id, v, asked) rows with the lists that the vector goes to."""

    def rows(batches):
        for part, x in _parts(batches):
            lists = pa.array([o.astype("i4") for o in centroids.lists(x)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "v", "asked")), lists], ["id", "v", "asked", "lists"])

    return rows


def _reaching(centroids: Centroids):
    """(id, v) rows with how far the query looks."""

    def rows(batches):
        for part, x in _parts(batches):
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), pa.array(centroids.reach(x))], ["id", "v", "reach"])

    return rows


def _best(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Places of the ``TOP`` + 1 highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[: TOP + 1]


def _closest(probes: np.ndarray):
    """(probe, id, score, lists): each probe's best of a task's vectors."""

    def rows(batches):
        none = [np.empty(0, "i8"), np.empty(0), np.empty(0, object)]
        best = [none] * len(probes)
        for part, x in _parts(batches):
            ids, lists = part.column("id").to_numpy(), part.column("lists").to_numpy(zero_copy_only=False)
            for k, scores in enumerate(probes @ x.T):
                if len(best[k][0]) > TOP:
                    hit = np.flatnonzero(scores >= best[k][1][-1])
                    if not len(hit):
                        continue
                else:
                    hit = np.arange(len(scores))
                both = [np.concatenate(b) for b in zip(best[k], (ids[hit], scores[hit], lists[hit]))]
                order = _best(*both[:2])
                best[k] = [b[order] for b in both]
        for k, (ids, scores, lists) in enumerate(best):
            arrays = [pa.array(np.full(len(ids), k, "i4")), pa.array(ids), pa.array(scores), pa.array(list(lists), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["probe", "id", "score", "lists"])

    return rows


def measured(centroids: Centroids, placed: DataFrame, probes: np.ndarray, own: np.ndarray) -> tuple[float, float]:
    """The probes' least distance to a centroid but for few, and the ratio within which their true neighbours among all vectors have a list.

    ``RECALL`` of them do with half of the misses to spare, for the queries are not the probes.
    """
    first = Window.partitionBy("probe").orderBy(F.desc("score"), "id")
    found = placed.select("id", "v", "lists").mapInArrow(_closest(probes), "probe int, id bigint, score double, lists array<int>")
    found = found.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= TOP + 1).select("probe", "id", "lists").toArrow()
    x = centroids.raised(probes, query=True)
    near, d = centroids.walk(x, 1.0)[1][:, 0], centroids.distances(x)
    least = max(float(np.quantile(near, 1 - RECALL)), 1e-12)
    ratio = [
        d[p, lists].min() / max(near[p], least)
        for p, i, lists in zip(found["probe"].to_numpy(), found["id"].to_numpy(), found["lists"].to_pylist())
        if i != own[p]
    ]
    return least, max(1.0, float(np.quantile(ratio, (1 + RECALL) / 2))) + 1e-9 if ratio else 1.0


@dataclass
class Asked:
    """Queries from files under the shared folder, a block at a time."""

    files: list[str]
    rows: int

    def __iter__(self) -> Iterator[pa.Table]:
        kept, n = [], 0
        for name in self.files:
            system, path = place(name)
            with system.open_input_file(path) as file:
                for batch in pq.ParquetFile(file).iter_batches(self.rows):
                    kept, n = [*kept, batch], n + batch.num_rows
                    if n >= self.rows:
                        yield pa.Table.from_batches(kept)
                        kept, n = [], 0
        if n:
            yield pa.Table.from_batches(kept)


def _exact(q: np.ndarray, x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of column a[i] of ``q`` and b[i] of ``x``, summed from the first component on."""
    out = np.zeros(len(a))
    for one, other in zip(q, x):
        out += one[a] * other[b]
    return out


def _chosen(a: np.ndarray, ids: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs of query and id the ``TOP`` + 1 best of each query, best first; one met in several lists counts once."""
    order = np.lexsort((ids, -score, a))
    a, ids, score = a[order], ids[order], score[order]
    once = np.ones(len(a), bool)
    once[1:] = (a[1:] != a[:-1]) | (ids[1:] != ids[:-1])
    a, ids, score = a[once], ids[once], score[once]
    first = np.flatnonzero(np.diff(a, prepend=-1))
    few = np.arange(len(a)) - np.repeat(first, np.diff([*first, len(a)])) <= TOP
    return a[few], ids[few], score[few]


def _scored(query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query), pa.array(ids), pa.array(score)], ["query", "id", "score"])


def _short(vectors: np.ndarray, lengths: np.ndarray | float) -> tuple[np.ndarray, np.float32]:
    """Vectors in short floats and of length 1 at most, and by how much their scores may be wrong."""
    return (vectors / lengths).astype("f4"), np.float32((vectors.shape[1] + 4) * 2.0**-23)


def _first(ids: np.ndarray, x: np.ndarray, length: float):
    """(id, v) rows of queries: each one's best of the sample."""
    small, slack = _short(x, length)
    columns = np.ascontiguousarray(x.T)

    def rows(batches):
        for part, q in _parts(batches):
            scores = _short(q, np.sqrt((q**2).sum(1))[:, None])[0] @ small.T
            at = max(0, len(ids) - TOP - 1)
            row, column = np.divmod(np.flatnonzero(scores >= np.partition(scores, at, axis=1)[:, at, None] - 2 * slack), len(ids))
            a, i, score = _chosen(row, ids[column], _exact(np.ascontiguousarray(q.T), columns, row, column))
            yield _scored(part.column("id").to_numpy()[a], i, score)

    return rows


def _search(centroids: Centroids, asked: Asked):
    """(list, id, v) rows against all queries that look that far: each query's best of what a worker holds at once."""

    def hits(unit, q, sizes, cut, rows, small, x, slack) -> np.ndarray:
        """Which vectors of a piece may be among the best of which queries; raises what those with many must reach."""
        scores = unit @ small.T
        hit, at = scores >= cut[rows, None], len(small) - TOP - 1
        crowded = np.flatnonzero(np.count_nonzero(hit, axis=1) > TOP + 1)
        if len(crowded):
            last = np.partition(scores[crowded], at, axis=1)[:, at]
            cut[rows[crowded]] = np.maximum(cut[rows[crowded]], last - 2 * slack)
            hit[crowded] = scores[crowded] >= cut[rows[crowded], None]
            alike = crowded[np.count_nonzero(hit[crowded], axis=1) > 4 * TOP]  # for short floats
            if len(alike):
                scores = q[alike] @ x.T / sizes[alike, None]
                hit[alike] &= scores >= np.partition(scores, at, axis=1)[:, at, None] - (x.shape[1] + 4) * 2.0**-51
        return hit

    def better(best, met, q, x, ids, least):
        a, b = (np.concatenate(m) for m in zip(*met)) if met else (np.empty(0, "i8"), np.empty(0, "i8"))
        score = _exact(q, x, a, b)
        fine = score >= least[a]
        return _chosen(*(np.concatenate(c) for c in zip(best, (a[fine], ids[b[fine]], score[fine]))))

    def against(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches).combine_chunks()
        held = held.take(pa.array(np.argsort(held["list"].to_numpy(), kind="stable")))
        ids, x = held["id"].to_numpy(), _matrix(held["v"].combine_chunks())
        lists, starts = np.unique(held["list"].to_numpy(), return_index=True)
        ends = [*starts[1:], len(ids)]
        length = centroids.longest**0.5
        small, slack = _short(x, length)
        columns = np.ascontiguousarray(x.T)
        for block in asked:
            q, least = _matrix(block["v"].combine_chunks()), block["least"].to_numpy()
            far, query = block["reach"].to_numpy(), block["id"].to_numpy()
            sizes = np.sqrt((q**2).sum(1)) * length
            unit = _short(q, sizes[:, None] / length)[0]
            cut = (least / sizes).astype("f4") - 2 * slack
            step = max(1, PAIRS // len(lists))
            raised = centroids.raised(q, query=True)
            near = np.concatenate([centroids.distances(raised[at : at + step], lists) <= far[at : at + step, None] for at in range(0, len(q), step)])
            across, best, met, n = np.ascontiguousarray(q.T), (np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0)), [], 0
            for k, (start, end) in enumerate(zip(starts, ends)):
                looking = np.flatnonzero(near[:, k])
                for at, some in product(range(start, end, LIST), range(0, len(looking), PAIRS // LIST)):
                    to, rows = min(at + LIST, end), looking[some : some + PAIRS // LIST]
                    row, column = np.divmod(np.flatnonzero(hits(unit[rows], q[rows], sizes[rows], cut, rows, small[at:to], x[at:to], slack)), to - at)
                    met, n = [*met, (rows[row], at + column)], n + len(row)
                    if n > PAIRS:
                        best, met, n = better(best, met, across, columns, ids, least), [], 0
                        full = np.flatnonzero(np.bincount(best[0], minlength=len(q)) > TOP)
                        last = best[2][np.searchsorted(best[0], full, side="right") - 1]
                        cut[full] = np.maximum(cut[full], (last / sizes[full]).astype("f4") - 2 * slack)
            best = better(best, met, across, columns, ids, least)
            yield _scored(query[best[0]], best[1], best[2])

    def rows(batches):
        kept, n = [], 0
        for batch in batches:
            kept, n = [*kept, batch], n + len(batch.column("v").flatten())
            if n >= PIECES:
                yield from against(kept)
                kept, n = [], 0
        if n:
            yield from against(kept)

    return rows


def classes_of(vectors: DataFrame, every: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vectors (vec_id, v), their keys (vec_id, h1, h2), and (vec_id, id, asked) of those with equal vectors.

    ``id`` is the smallest ``vec_id`` of equal vectors; ``asked`` is whether any of them is a query.
    """
    rows = stage(vectors.filter(F.col("vec_id").isNotNull() & valid(F.col("embedding"))).groupBy("vec_id").agg(F.min("embedding").alias("v")))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("v") == (length["n"] if length else 0))
    h1, h2 = hash128(F.col("v"))
    keyed = stage(rows.select("vec_id", h1.alias("h1"), h2.alias("h2")))
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    alike = keyed.groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.max(is_query).alias("asked"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows, keyed, stage(keyed.join(alike, ["h1", "h2"]).select("vec_id", "id", "asked"))


def sampled(vectors: DataFrame, ids: DataFrame, n: int, size: int, hashed: Column) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of the ``size`` classes first by hash; far fewer rows than all are sorted."""
    below = min(1.0, (1.1 * size + 1000) / n)
    few = ids.filter(hashed <= int(-(1 << 63) + below * ((1 << 64) - 1)) if below < 1 else F.lit(True))
    first = few.select("id", hashed.alias("h")).orderBy("h", "id").limit(size)
    got = vectors.join(F.broadcast(first), "id").select("id", "h", "v").toArrow()
    order = np.lexsort((got["id"].to_numpy(), got["h"].to_numpy()))
    return got["id"].to_numpy()[order], _matrix(got["v"].combine_chunks())[order]


def searched(centroids: Centroids, placed: DataFrame, looking: DataFrame, best: DataFrame) -> DataFrame:
    """(query, id, score): the ``TOP`` + 1 best of each query in ``best`` and in the lists it looks in, by rounds of lists.

    A round's lists hold a few times the vectors of all before, so a query meets
    a few times ``TOP`` there that beat its best so far: little is moved, and
    every list is read once. Centroids have no order, so a round's lists lie anywhere.
    """
    spark = placed.sparkSession
    dim = centroids.points.shape[1] - 1
    held = np.cumsum(centroids.sizes) * dim
    ends = {int(np.searchsorted(held, FIRST * GROWTH**k)) + 1 for k in range(32)}
    ends = sorted({min(end, len(held)) for end in ends})
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "id")  # a vector found in several lists has one place
    best = stage(best.withColumn("place", F.dense_rank().over(ranked)))
    for start, end in zip([0, *ends], ends):
        least = best.filter(F.col("place") == TOP + 1).select(F.col("query").alias("id"), F.col("score").alias("least"))
        asked = stage(looking.join(least, "id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf")))))
        search = _search(centroids, Asked(sorted(asked.inputFiles()), max(256, ASKED // dim)))
        blocks = [(k, int(-(-centroids.sizes[k] // LIST))) for k in range(start, end)]
        dealt = F.broadcast(spark.createDataFrame(blocks, "list int, _blocks int"))  # at most MOST_LISTS rows
        some = F.explode(F.filter("lists", lambda k: (k >= start) & (k < end))).alias("list")
        pieces = placed.select("id", "v", some).join(dealt, "list").withColumn("_block", F.pmod(F.xxhash64("id"), F.col("_blocks")))
        numbers = int(centroids.sizes[start:end].sum()) * dim
        pieces = pieces.repartition(min(partitions(spark), numbers // TASK + 1), "list", "_block").select("list", "id", "v")
        found = pieces.mapInArrow(search, "query bigint, id bigint, score double").unionByName(best.drop("place"))
        better = stage(found.withColumn("place", F.dense_rank().over(ranked)).filter(F.col("place") <= TOP + 1).dropDuplicates(["query", "id"]))
        unstage(asked)
        unstage(best)
        best = better
    return best.drop("place")


def nearest(vectors: DataFrame, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose ``vec_id`` is divisible by ``every``."""
    spark = vectors.sparkSession
    small_batches(spark)
    with shuffles_freed(spark):
        rows, keyed, alike = classes_of(vectors, every)
        is_query = F.pmod("vec_id", F.lit(every)) == 0
        squared = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
        about = rows.agg(F.max(F.size("v")).alias("length"), F.max(squared).alias("longest")).first()
        if not about["length"]:
            return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
        n = keyed.count() - alike.filter("vec_id <> id").count()
        size = min(SAMPLE, max(TOP, SAMPLE_VALUES // about["length"]))
        ids = keyed.select("vec_id").join(alike.filter("vec_id <> id"), "vec_id", "left_anti").select(F.col("vec_id").alias("id"))
        known, x = sampled(rows.withColumnRenamed("vec_id", "id"), ids, n, size, F.xxhash64("id"))
        centroids = fitted(x, min(-(-n // LIST), MOST_LISTS, len(x)), about["longest"])

        firsts = rows.join(alike, "vec_id", "left").filter("id is null or id = vec_id")
        classes = firsts.select(F.col("vec_id").alias("id"), "v", F.coalesce("asked", is_query).alias("asked"))
        schema = f"id bigint, v {dict(rows.dtypes)['v']}"
        placed = stage(classes.mapInArrow(_placing(centroids), f"{schema}, asked boolean, lists array<int>"))
        unstage(rows)
        count = placed.select(F.explode("lists").alias("list")).groupBy("list").count().toArrow()
        centroids.sizes = np.zeros(len(centroids.points), "i8")
        centroids.sizes[count["list"].to_numpy()] = count["count"].to_numpy()
        if len(centroids.points) > 1:
            own, probes = sampled(placed, ids, n, PROBES, F.xxhash64(F.lit(SEED), "id"))  # of all, so in the fit as rarely as queries are
            centroids.least, centroids.ratio = measured(centroids, placed, probes, own)
        looking = stage(placed.filter("asked").select("id", "v").mapInArrow(_reaching(centroids), f"{schema}, reach double"))
        first = looking.select("id", "v").mapInArrow(_first(known, x, centroids.longest**0.5), "query bigint, id bigint, score double")
        best = searched(centroids, placed, looking, first)

        place = F.row_number().over(Window.partitionBy("id").orderBy("vec_id"))
        few = alike.withColumn("place", place).filter(F.col("place") <= TOP + 1)  # no larger one can be among the TOP nearest of any query
        members = few.groupBy("id").agg(F.collect_list("vec_id").alias("members"))
        scored = best.join(members, "id", "left").select("query", "score", F.explode(F.coalesce("members", F.array("id"))).alias("vec_id"))
        ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        short = stage(scored.withColumn("place", F.row_number().over(ranked)).filter(F.col("place") <= TOP + 1))
        asked = stage(keyed.filter(is_query).select("vec_id").join(alike, "vec_id", "left").select(F.col("vec_id").alias("query_id"), F.coalesce("id", "vec_id").alias("id")))
    each = asked.join(short, F.col("id") == F.col("query")).filter("vec_id <> query_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= TOP).select("query_id", "rank", "vec_id", "score")
