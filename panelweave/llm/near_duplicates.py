"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified Hamming links, components.

Null and empty texts, and texts without a word, have fingerprint zero and link
like any other. A null ``doc_id`` never is a component's name; a component of
nulls only has a null name. Repeated rows each give a row. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.llm.graph import components
from panelweave.llm.shared import LOWER, UPPER, encoded, hash128, small_batches
from panelweave.session import stage

WORDS, SEED, BITS = 3, 42, 3
BLOCKS = 6  # cut the 64 bits in six: a link leaves three of them alone, about 32 bits
INNER = 8  # the bits left over in a crowded block are cut in eight: a link leaves five of them alone
CROWD = 2048  # fingerprints that one comparison takes at once; a crowded block is cut anew
SLICE = 1 << 16  # hashes unpacked to bits at a time

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def simhash(text: bytes | None) -> int:
    """64-bit fingerprint: each bit set in over half of the shingles' hashes."""
    words = (text or b"").translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < WORDS:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - WORDS + 1].tolist(), ends[WORDS - 1 :].tolist())], "<u8")
    ones = np.zeros(64, "i8")
    for at in range(0, len(hashes), SLICE):
        part = hashes[at : at + SLICE]
        ones += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    return pa.array(np.array([simhash(t) for t in encoded(texts)], "u8").view("i8"), pa.int64())


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    return [list(x) for x in np.array_split(bits, parts)]


def _signed(bits) -> int:
    return int(np.array(sum(1 << int(b) for b in bits), "u8").view("i8"))


def block_masks() -> list[tuple[int, list[int]]]:
    """For each choice of blocks that a link leaves alone: the bits kept, and the masks of the second cut."""
    out, blocks = [], _cut(list(range(64)), BLOCKS)
    for kept in combinations(range(BLOCKS), BLOCKS - BITS):
        held = [b for k in kept for b in blocks[k]]
        inner = _cut([b for k, block in enumerate(blocks) if k not in kept for b in block], INNER)
        again = [_signed([*held, *(b for k in more for b in inner[k])]) for more in combinations(range(INNER), INNER - BITS)]
        out.append((_signed(held), again))
    return out


def forest(members: np.ndarray) -> list[tuple[int, int]]:
    """Links that tie together exactly those members which links within the set connect."""
    left, found = np.unique(members).view("u8"), []  # unsigned: of a negative number the bits of its size would be counted
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            here = queue.pop()
            near = np.bitwise_count(here ^ left) <= BITS
            if near.any():
                found += [(int(a), int(b)) for a, b in zip(np.full(near.sum(), here).view("i8"), left[near].view("i8"))]
                queue += list(left[near])
                left = left[~near]
    return found


def _forests(batches):
    for batch in batches:
        pairs = [p for group in batch.column("members").to_pylist() for p in forest(np.array(group, "i8"))]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect all within ``BITS`` bits of each other.

    Fingerprints meet on the blocks that a link must leave alone. A meeting of
    up to ``CROWD`` is compared in one piece. A larger one is cut by the bits
    left, so that a piece differs in 13 bits at most and so has 8,192 members
    at most. Pieces give spanning links, never all their pairs.
    """
    masks = block_masks()
    blocks = F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, (m, _) in enumerate(masks)])
    keyed = prints.select("fp", F.explode(blocks).alias("at")).select("fp", "at.c", "at.k")
    sizes = stage(keyed.groupBy("c", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    met = keyed.join(sizes, ["c", "k"])
    plain = met.filter(F.col("n") <= CROWD).groupBy("c", "k").agg(F.collect_list("fp").alias("members")).select("members")
    inner = F.array(*[F.lit(again) for _, again in masks])
    cut = met.filter(F.col("n") > CROWD).select("fp", "c", F.posexplode(inner[F.col("c")]).alias("d", "m"))
    crowded = cut.select("fp", "c", "d", F.col("fp").bitwiseAND(F.col("m")).alias("q"))
    pieces = crowded.groupBy("c", "d", "q").agg(F.collect_list("fp").alias("members")).filter(F.size("members") > 1).select("members")
    return plain.union(pieces).mapInArrow(_forests, "a bigint, b bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, h1, h2, root, component_id): one row for each row of ``docs``.

    ``root`` is the least fingerprint of the component, ``h1`` and ``h2`` key the
    row's id and text. Copies share a fingerprint and enter the search once.
    """
    small_batches(docs.sparkSession)
    h1, h2 = hash128(F.col("doc_id"), F.col("text"))
    rows = stage(docs.select("doc_id", h1.alias("h1"), h2.alias("h2"), fingerprint(F.col("text")).alias("fp")))
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(prints.select("fp"))).withColumnRenamed("node", "fp")
    classes = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(stage(classes.join(named, "root").select("fp", "root", "component_id")), "fp")


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns: doc_id, fingerprint, component_id."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents of ``docs`` that stay: the smallest ``doc_id`` of each component (nulls last), and one row of it."""
    found = near_duplicates(docs)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("h1").alias("h1"), F.col("h2").alias("h2"))).alias("w")
    winners = found.groupBy("root").agg(best).select(F.col("w.h1").alias("_h1"), F.col("w.h2").alias("_h2"))
    h1, h2 = hash128(F.col("doc_id"), F.col("text"))
    rows = docs.select(F.struct("*").alias("row"), h1.alias("_h1"), h2.alias("_h2"))
    return rows.join(winners, ["_h1", "_h2"], "left_semi").dropDuplicates(["_h1", "_h2"]).select("row.*")
