"""N-gram Jaccard self-join with token-combination prefixes.

A text is the set of its distinct word shingles, known by 64-bit hashes; equal
sets are one set. Two sets link from ``percent`` per cent of Jaccard on. A set
of n shingles can miss ``misses(n)`` of them in a partner, so of its rarest
shingles a prefix is indexed: rare shingles alone, more frequent ones in pairs
and the most frequent in threes. A class of k-combinations is worth nothing for
its first k - 1 shingles, and the prefix is extended until its worth passes the
misses; then partners share an indexed shingle or combination. To keep
combinations few, frequent shingles are dealt to buckets, each a class of its
own, whose number follows the size band (n to 2n); a set near a band's end is
indexed in the next band too.

Before that a screen drops sets without a chance: those with more than
``misses(n)`` shingles, of a fixed part of all hashes, that no other set has.
Sets that share a key never meet all at once: in each round a key's hubs, which
are marked members, meet its other members and then leave the key. A pair goes
on if it lies in two components and a parity sketch does not rule it out (what
two sketches differ in, the sets differ in too); it is then verified exactly on
whole sets. Keys whose members lie in one component, or whose marked members
have all been hubs, are done. Each round has up to ``GROWTH`` times the hubs of
the one before, so every pair that could join two components is judged in the
end; none is capped or dropped.

Null texts and texts without a word have an empty set and link with nothing;
shorter ones are one shingle. Very long texts are hashed piece by piece; a task
holds eight bytes a shingle of one. Copies and repeated rows share a set; each
row gives a row. A null ``doc_id`` never names a component; one of nulls only
has a null name. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.llm.graph import components
from panelweave.llm.shared import LOWER, UPPER, encoded, hash128, small_batches
from panelweave.session import shuffles_freed, stage

WORDS, PERCENT = 3, 90
SCREEN = 6  # one hash in so many takes part in the screen
RARE, COMMON = 16, 512  # sets a shingle is in, up to which it is indexed alone, or in pairs; beyond in threes
PLAIN = 64  # sets of up to so many shingles have all indexed alone
GROWTH = 64  # times as many hubs in each round
SLOW_GROWTH = 8  # the same after a round that found many links
SKETCH = 8  # longs of a parity sketch
PIECE = 1 << 20  # bytes of a long text hashed at a time

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], "u8")
LEAST_PERCENT = 80  # below, a prefix of combinations need not fit into its set


def misses(n: int, percent: int = PERCENT) -> int:
    """Shingles of a set of ``n`` that a partner may lack: it shares ``percent`` per cent of the larger set at least."""
    return n - (percent * n + 99) // 100


def misses_as_smaller(n: int, percent: int = PERCENT) -> int:
    """The same towards partners that are not smaller: two sets share ``percent / (100 + percent)`` of their sizes' sum."""
    return n - (2 * percent * n + 99 + percent) // (100 + percent)


def lonely(n: int, percent: int = PERCENT) -> bool:
    """A set so small that only an equal one could link."""
    return 100 * n < percent * (n + 1)


def mixed(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit hash of several, in their order."""
    h = np.full(len(parts[0]), len(parts), "u8")
    for p in parts:
        h = (h ^ p) * _ODD[0]
        h = (h ^ (h >> np.uint64(29))) * _ODD[1]
        h ^= h >> np.uint64(32)
    return h * _ODD[2] ^ (h >> np.uint64(31))


def _pieces(text: bytes) -> Iterator[bytes]:
    """``text`` cut at white space into pieces of about ``PIECE`` bytes."""
    at = 0
    while len(text) - at > PIECE:
        cut = _BLANK.search(text, at + PIECE)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of lower-cased words."""
    hashes = []
    for piece in _pieces(text or b""):
        found = piece.translate(_FOLD).split()
        hashes.append(np.fromiter(map(xxhash.xxh64_intdigest, found), "u8", len(found)))
    h = np.concatenate(hashes)
    if not len(h):
        return h
    k = min(words, len(h))
    return np.unique(mixed(*(h[i : len(h) - k + 1 + i] for i in range(k))))


def _key(tokens: np.ndarray) -> int:
    return int(np.array(xxhash.xxh64_intdigest(tokens.tobytes()), "u8").view("i8"))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype("i4")
    flat = np.concatenate(arrays) if arrays else np.array([], "u8")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view("i8"), pa.int64()))


def sketched(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, k1, k2, s, n, sample): key of the row, key and size of its set, and the set's hashes that the screen looks at."""
    top = np.uint64((1 << 64) // SCREEN)

    def sketch(batches):
        for batch in batches:
            s, n, sample = [], [], []
            for text in encoded(batch.column("text")):
                found = shingles(text, words)
                s.append(_key(found))
                n.append(len(found))
                sample.append(found[found < top])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "k1", "k2")), pa.array(s, pa.int64()), pa.array(n, pa.int64()), _lists(sample)],
                ["doc_id", "k1", "k2", "s", "n", "sample"],
            )

    small_batches(docs.sparkSession)
    return _keyed(docs).mapInArrow(sketch, "doc_id bigint, k1 bigint, k2 bigint, s bigint, n bigint, sample array<bigint>")


def _keyed(docs: DataFrame) -> DataFrame:
    k1, k2 = hash128(F.col("doc_id"), F.col("text"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), k1.alias("k1"), k2.alias("k2"), "text")


def screened(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(k1, k2): one row of each set that may have a partner."""
    large = rows.filter(100 * F.col("n") >= percent * (F.col("n") + 1))
    # copies share ``s``: a hash is lonely when all its holders are one set
    alone = large.select("s", F.explode("sample").alias("h")).groupBy("h").agg(F.min("s").alias("s"), F.max("s").alias("t"))
    lonely_hashes = alone.filter("s = t").groupBy("s").agg(F.count(F.lit(1)).alias("u"))
    sets = large.groupBy("s").agg(F.min("n").alias("n"))
    allowed = F.col("n") - F.floor((percent * F.col("n") + 99) / 100)
    able = sets.join(lonely_hashes, "s", "left").filter(F.coalesce("u", F.lit(0)) <= allowed)
    one = F.min(F.struct("k1", "k2")).alias("k")
    return rows.join(able.select("s"), "s", "left_semi").groupBy("s").agg(one).select("k.k1", "k.k2")


def parity(tokens: np.ndarray) -> np.ndarray:
    """A bit for each remainder of the hashes, set if an odd number of them has it."""
    bits = np.bincount((tokens & np.uint64(64 * SKETCH - 1)).astype("i8"), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype("u1"), bitorder="little").view("<i8")


def sets_of(docs: DataFrame, chosen: DataFrame, words: int = WORDS) -> DataFrame:
    """(s, n, tokens, sketch) of the chosen rows of ``docs``."""

    def whole(batches):
        for batch in batches:
            for text in encoded(batch.column("text")):
                found = shingles(text, words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_key(found)], pa.int64()), pa.array([len(found)], pa.int64()), _lists([found]), _lists([parity(found)])],
                    ["s", "n", "tokens", "sketch"],
                )

    texts = _keyed(docs).join(chosen, ["k1", "k2"]).select("text")
    return texts.mapInArrow(whole, "s bigint, n bigint, tokens array<bigint>, sketch array<bigint>")


def bands(n: int, percent: int = PERCENT) -> list[int]:
    """Size bands (n in [2^b, 2^(b+1))) under which a set is indexed: its own, and the next if a partner may lie there."""
    own = n.bit_length() - 1
    return [own, own + 1] if 100 * n // percent >= 2 << own else [own]


def signatures(n: int, holders: np.ndarray, tokens: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set of ``n`` shingles, of which ``tokens`` are in several sets, ``holders`` in number, and which of them are marked."""
    order = np.lexsort((tokens, holders))
    tokens, holders = tokens[order], holders[order]
    alone = n - len(tokens)  # shingles that no other set has come first, and are worth one each
    need, first_need = misses(n, percent) + 1 - alone, misses_as_smaller(n, percent) + 1 - alone
    keys, marks = [np.array([], "u8")], [np.array([], bool)]
    for band in bands(n, percent) if need > 0 else []:
        most = misses(2 << band, percent)
        k = np.ones(len(tokens), "i8") if 2 << band <= PLAIN else 1 + (holders > RARE) + (holders > COMMON)
        dealt = np.array([1, max(1, most // 3), max(1, most // 4)], "u8")
        bucket = np.where(k == 1, 0, (tokens >> np.uint64(17)) % dealt[k - 1]).astype("i8") * 4 + k
        place = np.argsort(bucket, kind="stable")
        seat = np.empty(len(tokens), "i8")  # the shingle's place among those before it in its bucket
        starts = np.flatnonzero(np.concatenate(([True], np.diff(bucket[place]) != 0)))
        seat[place] = np.arange(len(tokens)) - np.repeat(starts, np.diff(np.append(starts, len(tokens))))
        worth = np.cumsum(seat + 1 >= k)
        end = int(np.searchsorted(worth, need)) + 1
        marked = int(np.searchsorted(worth, first_need)) + 1 if first_need > 0 else 0
        mark = np.array([band], "u8")
        single = np.flatnonzero(k[:end] == 1)
        keys.append(mixed(np.repeat(mark, len(single)), tokens[single]))
        marks.append(single < marked)
        groups: dict[int, list[int]] = {}
        for at in np.flatnonzero(k[:end] > 1).tolist():
            groups.setdefault(int(bucket[at]), []).append(at)
        for size in (2, 3):
            chosen = [c for b, members in groups.items() if b % 4 == size for c in combinations(members, size)]
            if chosen:
                at = np.array(chosen)
                picked = np.sort(tokens[at], axis=1)
                keys.append(mixed(np.repeat(mark, len(picked)), *picked.T))
                marks.append(at.max(1) < marked)
    return np.concatenate(keys), np.concatenate(marks)


def postings(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(g, s, marked): the keys of every set."""

    def index(batches):
        for batch in batches:
            for s, n, found in zip(batch.column("s").to_pylist(), batch.column("n").to_pylist(), batch.column("found")):
                holders = found.values.field("holders").to_numpy()
                tokens = found.values.field("h").to_numpy().view("u8")
                keys, marks = signatures(n, holders, tokens, percent)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view("i8"), pa.int64()), pa.array(np.full(len(keys), s), pa.int64()), pa.array(marks)], ["g", "s", "marked"])

    each = sets.select("s", "n", F.explode("tokens").alias("h"))
    shared = each.groupBy("h").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    found = each.join(shared, "h").groupBy("s", "n").agg(F.collect_list(F.struct("holders", "h")).alias("found"))
    return found.mapInArrow(index, "g bigint, s bigint, marked boolean")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar enough, on whole sets."""
    side = lambda name: sets.select(F.col("s").alias(name), F.col("n").alias(f"n{name}"), F.col("tokens").alias(f"t{name}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    near = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    common = F.size(F.array_intersect("ta", "tb"))
    return both.filter(near).withColumn("c", common).filter(100 * F.col("c") >= percent * (F.col("na") + F.col("nb") - F.col("c"))).select("a", "b")


def _open(live: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of the keys that still have a marked member and members in several components; ``main``: in the key's largest one."""
    rows = live.select("g", "s", "marked").join(known.select("s", "root", "size"), "s")
    keys = rows.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("marked").alias("left"), F.max(F.struct("size", "root")).alias("top"))
    keys = keys.filter("lo < hi and left").select("g", F.col("top.root").alias("top"))
    return stage(rows.join(keys, "g").select("g", "s", "marked", "root", (F.col("root") == F.col("top")).alias("main")))


def _named(sets: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(s, root, size) of every set: its component and how many sets that has."""
    if roots is None:
        return sets.select("s", F.col("s").alias("root"), F.lit(1).cast("bigint").alias("size"))
    sized = roots.join(roots.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "root").select(F.col("node").alias("s"), "root", "size")
    return stage(sets.select("s").join(sized, "s", "left").select("s", F.coalesce("root", "s").alias("root"), F.coalesce("size", F.lit(1)).alias("size")))


def linked(postings: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame | None:
    """(node, root) of every set that links with another, by rounds of hubs over the keys; None without any.

    A hub meets all members of its key in other components, larger and smaller,
    and then leaves the key. Hubs are the sets whose keys have most members:
    what a group has in common, not one of its outliers, so the first round ties
    most of it. Components are taken after that round, after each other one
    that finds many links, and at the end over all links.
    """
    traits = sets.select("s", "n", *[F.col("sketch")[k].alias(f"b{k}") for k in range(SKETCH)])
    live, roots, later, hubs_each = _open(postings, _named(sets, None)), None, None, 1
    known = None
    members = live.groupBy("g").agg(F.count(F.lit(1)).alias("members"))
    central = stage(live.join(members, "g").groupBy("s").agg(F.sum("members").alias("score")))
    while there := live.count():
        part = F.pmod(F.xxhash64("s", F.lit(hubs_each)), F.lit(hubs_each))
        best = F.max(F.struct("score", "s", "root", "main")).alias("x")
        hubs = stage(live.filter("marked").join(central, "s").groupBy("g", part.alias("p")).agg(best).select("g", "x.s", "x.root", "x.main"))
        # members of a key's largest component need not meet each other
        sides = F.when(F.col("main"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
        hub = hubs.join(traits, "s").select("g", F.explode(sides).alias("main"), *[F.col(c).alias(f"x_{c}") for c in ("root", *traits.columns)])
        both = F.col("x_n") + F.col("n")
        apart = sum((F.bit_count(F.col(f"x_b{k}").bitwiseXOR(F.col(f"b{k}"))) for k in range(SKETCH)), F.lit(0))
        # the sets differ in both - 2 * common, and common is at least percent / (100 + percent) of both
        near = (100 * F.least("x_n", "n") >= percent * F.greatest("x_n", "n")) & ((100 + percent) * apart <= (100 - percent) * both)
        met = live.join(traits, "s").join(hub, ["g", "main"]).filter(near & (F.col("x_root") != F.col("root")))
        pairs = stage(met.select(F.least("x_s", "s").alias("a"), F.greatest("x_s", "s").alias("b")).distinct())
        links = stage(verified(pairs, sets, percent))
        found = links.count()
        if found:
            later = links if later is None else later.union(links)
        many = hubs_each == 1 or GROWTH * found > there
        if many and later is not None:
            roots, later = _joined(later, roots), None
        if many:
            known = _named(sets, roots)
        live = _open(live.join(hubs.select("g", "s"), ["g", "s"], "left_anti"), known)
        hubs_each *= SLOW_GROWTH if many else GROWTH
    return roots if later is None else _joined(later, roots)


def _joined(links: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Components of ``links`` (a, b) and of those found before."""
    if roots is not None:
        links = links.union(roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    return components(links)


def jaccard_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, s, component_id): one row for each row of ``docs``; ``s`` is the key of its set."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent is {LEAST_PERCENT} to 100")
    with shuffles_freed(docs.sparkSession):
        rows = stage(sketched(docs, words))
        sets = stage(sets_of(docs, screened(rows, percent), words).dropDuplicates(["s"]))
        roots = linked(stage(postings(sets, percent)), sets, percent)
        firsts = rows.groupBy("s").agg(F.min("doc_id").alias("first"))
        if roots is not None:
            firsts = stage(firsts.join(roots.withColumnRenamed("node", "s"), "s", "left"))
            named = firsts.filter("root is not null").groupBy("root").agg(F.min("first").alias("least"))
            firsts = firsts.join(named, "root", "left").select("s", F.coalesce("least", "first").alias("first"))
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("first")).alias("component_id")
    return rows.select("doc_id", "n", "s").join(firsts, "s").select("doc_id", F.col("n").alias("n_shingles"), "s", component)


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns: doc_id, n_shingles, component_id."""
    return jaccard_classes(docs).select("doc_id", "n_shingles", "component_id")


SQL = rf"""
with recursive texts as (
    select doc_id, case when text is null then [] else
        list_filter(string_split_regex(translate(text, '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') end as w
    from documents
), sets as (
    select distinct doc_id, unnest(case when len(w) >= {WORDS} then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g
    from texts
), sizes as (
    select doc_id, count(*) as n from sets group by doc_id
), meetings as (
    select a.doc_id as a, b.doc_id as b, count(*) as i from sets a join sets b on a.g = b.g and a.doc_id < b.doc_id group by all
), links as (
    select a, b from meetings join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * i >= {PERCENT} * (x.n + y.n - i)
), edges as (
    select a, b from links union all select b, a from links
), reach as (
    select a, b from edges union select r.a, e.b from reach r join edges e on e.a = r.b
), least_of as (
    select a as doc_id, min(b) as m from reach group by a
)
select t.doc_id, coalesce(n, 0) as n_shingles, least(t.doc_id, coalesce(m, t.doc_id)) as component_id
from texts t left join sizes using (doc_id) left join least_of using (doc_id)
"""
