"""Mixing sources to target weights by pivotal dependent rounding.

A document's expected copies are its source's target over its source's size,
3 at most; the whole part is given and the fraction is rounded. Units pair up:
word mass moves between the two until one of them is whole, in a direction
drawn so that neither's expectation changes. The pair's mass stays, so a
source misses its target by less than one document's words.

A null text has size 0, takes nothing and is decided without a draw. A null
source is a source, last in order. Rows alike in id, source and size are one
unit: together they expect a number of further copies, of which the whole part
is given to so many of them and only the rest is rounded, so a unit never
weighs more than one row in the draw. Texts are only counted, however long.
Equal sizes go by id. Extra columns are ignored. An empty table gives an empty
result. Draws are seeded by what they decide, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.llm.shared import hash128, numbered, small_batches, word_count
from panelweave.session import stage

WEIGHTS = (1, 2, 3)  # of the sources by code point, repeating
MOST = 3  # copies of a document
LEAF = 1024  # units that one leaf of the tree takes, and remainders that one inner node takes
SEED = 42

UNIT = "doc_id bigint, source string, size bigint, rows bigint, source_size bigint, target double, bucket bigint, whole bigint, extra bigint, fraction double"


def source_targets(units: DataFrame) -> DataFrame:
    """(source, source_size, n_units, target): shares by weight, held at ``MOST`` times the source, the excess reshared."""
    sums = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("n_units"))
    placed = numbered(sums.withColumn("_null", F.col("source").isNull()), ["_null", "source"])
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    weighted = stage(placed.withColumn("weight", weights[F.pmod("rank", F.lit(len(WEIGHTS))).cast("int")]).drop("_null", "rank"))
    ceiling = F.lit(MOST) * F.col("source_size")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, -1
    while True:  # ends, as a source once held stays held
        full = ceiling < F.col("weight") * F.lit(level)
        row = weighted.agg(
            F.sum(F.when(full, 1).otherwise(0)).alias("held"),
            F.sum(F.when(full, ceiling).otherwise(F.lit(0))).alias("fixed"),
            F.sum(F.when(full, F.lit(0)).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if row["held"] in (held, None) or not row["free"]:
            break
        held, level = row["held"], (total - row["fixed"]) / row["free"]
    target = F.least(ceiling.cast("double"), F.col("weight") * F.lit(float(level)))
    return weighted.select("source", "source_size", "n_units", target.alias("target"))


def pivot(fractions: np.ndarray, masses: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """Fractions rounded to 0 or 1 but for one at most, whose place is returned (else -1)."""
    out = fractions.copy()
    draws = rng.random(len(out))
    at = -1
    for k in range(len(out)):
        f = out[k]
        if f <= 0 or f >= 1:
            continue
        if at < 0:
            at = k
            continue
        g, a, b = out[at], masses[at], masses[k]
        up, down = min((1 - g) * a, f * b), min(g * a, (1 - f) * b)  # mass that can move to the one held, and from it
        if draws[k] * (up + down) < down:
            g, f = (1.0, f - up / b) if up == (1 - g) * a else (g + up / a, 0.0)
        else:
            g, f = (0.0, f + down / b) if down == g * a else (g - down / a, 1.0)
        out[at], out[k] = (round(x) if min(abs(x), abs(1 - x)) < 1e-9 else x for x in (g, f))
        if not 0 < out[at] < 1:
            at = k if 0 < out[k] < 1 else -1
    return out, at


def _node(last: bool) -> Callable[[pa.Table], pa.Table]:
    """One node of the tree: large units first, so that what is left over is small."""

    def settle(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending"), ("rows", "descending"), ("doc_id", "ascending")])
        first = group.slice(0, 1).to_pylist()[0]
        name = f"{SEED}|{first['source']!r}|{first['bucket']}|{len(group)}|{first['doc_id']}|{first['size']}"
        rng = np.random.default_rng(xxhash.xxh64_intdigest(name))
        masses = group["size"].to_numpy().astype("f8")
        fractions, at = pivot(group["fraction"].to_numpy(), masses, rng)
        if last and at >= 0:
            fractions[at] = float(rng.random() < fractions[at])
        return group.set_column(group.schema.get_field_index("fraction"), "fraction", pa.array(fractions))

    return settle


def copies(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, rows, source_size, target, whole, extra): one row for each unit of alike rows.

    Each row of a unit has ``whole`` copies, and ``extra`` of them one more.

    ``docs`` has doc_id, source and size. Leaves of about ``LEAF`` units each
    settle all their units but one; what is left over meets at the next level,
    ``LEAF`` to a node, until one node a source settles the last. A large
    source has many leaves, so no task sees a whole source.
    """
    units = stage(docs.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")))
    targets = stage(source_targets(units))
    leaves = F.ceil(F.col("n_units") / F.lit(LEAF))
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    dealt = (
        units.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .withColumns({"bucket": F.pmod(F.xxhash64("doc_id", "size"), leaves), "_wanted": wanted})
        .withColumn("whole", F.floor("_wanted"))
        .withColumn("_more", F.when(F.col("size") > 0, F.col("rows") * (F.col("_wanted") - F.col("whole"))).otherwise(0.0))
        .withColumn("extra", F.floor("_more"))
        .withColumn("fraction", F.col("_more") - F.col("extra"))
    )
    fields = [f.split()[0] for f in UNIT.split(", ")]
    nodes = dealt.select(*fields)
    count = targets.agg(F.max(F.ceil(F.col("n_units") / F.lit(LEAF)))).first()[0] or 0
    settled = []
    while True:
        last = count <= 1
        level = stage(nodes.groupBy("source", "bucket").applyInArrow(_node(last), UNIT))
        open_ = (F.col("fraction") > 0) & (F.col("fraction") < 1)
        settled.append(level.filter(~open_))
        if last:
            break
        nodes = level.filter(open_).withColumn("bucket", F.floor(F.col("bucket") / F.lit(LEAF)))
        count = -(-count // LEAF)
    out = settled[0]
    for part in settled[1:]:
        out = out.union(part)
    extra = (F.col("extra") + F.col("fraction").cast("bigint")).alias("extra")
    return out.select("doc_id", "source", "size", "rows", "source_size", "target", "whole", extra)


def sized(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns: doc_id, size, source_size, target, taken; a row for each row of ``docs``."""
    each = copies(sized(docs)).withColumn("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))))
    taken = (F.col("whole") + (F.col("_row") <= F.col("extra")).cast("bigint")) * F.col("size")
    return each.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of the mix: each document as often as its copies say, with its columns as they were.

    Alike rows are put in order by their contents, as one sequence over all
    of them, to tell which have the further copy.
    """
    h1, h2 = hash128(F.col("doc_id"), F.col("source"), F.col("size"))
    drawn = stage(copies(sized(docs)).filter("whole + extra > 0").select(h1.alias("h1"), h2.alias("h2"), "rows", "whole", "extra"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", word_count(F.col("text")).alias("size"))
    many = rows.select("row", h1.alias("h1"), h2.alias("h2")).join(drawn, ["h1", "h2"])
    repeated = many.filter("rows > 1").select("row", "h1", "h2", "whole", "extra", F.xxhash64(F.to_json("row")).alias("t"))
    placed = numbered(repeated, ["h1", "h2", "t"])
    starts = placed.groupBy("h1", "h2").agg(F.min("rank").alias("start"))
    further = placed.join(starts, ["h1", "h2"]).select("row", (F.col("whole") + (F.col("rank") - F.col("start") < F.col("extra")).cast("bigint")).alias("n"))
    each = many.filter("rows = 1").select("row", (F.col("whole") + F.col("extra")).alias("n")).union(further)
    return each.filter("n > 0").select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))).select("row.*")
