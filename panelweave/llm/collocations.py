"""Phrase collocations counted in a HAT-trie: hash containers under a shallow trie of word ids.

A task keeps one trie a language. A first word leads to a hash container of
phrase ends; a container that grows beyond ``BURST`` bursts into one for each
second word. Once a task's tries hold ``HELD`` phrases, whole subtrees, largest
first, leave as sorted runs until half is free. A run goes to the partition of
its phrases' prefix (language and first two words, a hot prefix salted by the
third), where the runs of all tasks are merged and rare phrases end. Only
phrases of at least ``LEAST`` occurrences are joined, scored and ranked.

A text is cut at punctuation and line ends into pieces and those at blanks into
words; phrases stay inside pieces, A-Z count as a-z. Null texts are empty, a
null language is ``und``. Very long texts pass piece by piece. Repeated rows
count as often as they stand there. Equal scores go by count, then by phrase in
byte order. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelweave.llm.shared import LOWER, UPPER, encoded, partitions, small_batches
from panelweave.session import stage

LEAST, COVER, TOP = 10, 50, 2000  # occurrences of a phrase; per cent of them in a longer one that drop it; phrases a language
BURST = 4096  # phrase ends in a container before it bursts
HELD = 1 << 19  # trie leaves a task holds before it spills
WORDS = 3 << 17  # word ids a task gives out before it spills all and begins anew
GATHER = 1 << 19  # word positions counted at a time
PART = 1 << 20  # bytes of a long text taken at a time
BLOCK = 1 << 16  # words of a longer piece taken at a time
PARTS, SALT = 8, 16  # prefix partitions for each shuffle partition; pieces of a hot prefix
SHARDS = 64  # pieces of a language that are ranked apart before its first phrases meet

ID = 21  # bits of a word id and the mark for none
_NONE = 0
_MASK = (1 << ID) - 1
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], "u8")
_BREAKS = b".,;:!?\x0b\x0c\r"
_FOLD = bytes.maketrans(UPPER.encode() + _BREAKS, LOWER.encode() + b"\n" * len(_BREAKS))  # pieces end at line ends then
_END = b" A "  # no word is an upper-case letter after that
_WORD = re.compile(rb"[^ \t]+")
RUN = "part int, lang string, phrases binary, counts binary"


class HatTrie:
    """Counts of word positions by the three word ids from there on; ids begin at 1, fewer words end in none.

    ``roots`` maps a first word to its container, a dict from the packed rest
    (second id, third id) to a count, or, once burst, to a dict from the second
    word to such a container. Shorter phrases are prefixes: their counts are
    the sums of their leaves, taken when these leave.
    """

    def __init__(self) -> None:
        self.roots: dict[int, dict] = {}
        self.burst: set[int] = set()
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Packed phrases in ascending order, so those of one first word stand together."""
        firsts = keys >> (2 * ID)
        starts = np.flatnonzero(np.concatenate(([True], firsts[1:] != firsts[:-1]))) if len(keys) else []
        rest = (keys & ((1 << 2 * ID) - 1)).tolist()
        counts, ends = counts.tolist(), [*starts[1:], len(keys)]
        roots, burst = self.roots, self.burst
        for first, a, b in zip(firsts[starts].tolist(), starts.tolist() if len(keys) else [], ends):
            root = roots.get(first)
            if root is None:
                root = roots[first] = dict(zip(rest[a:b], counts[a:b]))
                self.size += b - a
                if len(root) > BURST:
                    self._burst(first)
            elif first in burst:
                for r, c in zip(rest[a:b], counts[a:b]):
                    leaf = root.setdefault(r >> ID, {})
                    before = len(leaf)
                    leaf[r] = leaf.get(r, 0) + c
                    self.size += len(leaf) - before
            else:
                before, get = len(root), root.get
                for k in range(a, b):
                    root[rest[k]] = get(rest[k], 0) + counts[k]
                self.size += len(root) - before
                if len(root) > BURST:
                    self._burst(first)

    def _burst(self, first: int) -> None:
        leaves: dict[int, dict[int, int]] = {}
        for r, c in self.roots[first].items():
            leaves.setdefault(r >> ID, {})[r] = c
        self.roots[first] = leaves
        self.burst.add(first)

    def subtrees(self) -> list[tuple[int, int, int | None]]:
        """(size, first word, second word) of every container."""
        sizes = [(len(root), first, None) for first, root in self.roots.items() if first not in self.burst]
        return sizes + [(len(leaf), first, second) for first in self.burst for second, leaf in self.roots[first].items()]

    def take(self, first: int, second: int | None) -> dict[int, int]:
        """Remove a container and return what it counted."""
        leaf = self.roots.pop(first) if second is None else self.roots[first].pop(second)
        self.size -= len(leaf)
        if second is not None and not self.roots[first]:
            del self.roots[first]
            self.burst.discard(first)
        return leaf


class WordIds(dict):
    """Word to id; a new word gets the next one."""

    def __init__(self) -> None:
        self.words: list[bytes] = [b""]
        self[_END.strip()] = _NONE

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self.words)
        self.words.append(word)
        return at


class Counting:
    """One task's tries, its word ids, and the runs that leave it."""

    def __init__(self, parts: int) -> None:
        self.parts = parts
        self._clear()

    def _clear(self) -> None:
        self.ids = WordIds()
        self.words = self.ids.words
        self.tries: dict[str, HatTrie] = {}
        self.waiting: dict[str, list[int]] = {}
        self.gathered = 0

    def text(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        """Count a text; what has to leave is yielded."""
        waiting, ids = self.waiting.setdefault(lang, []), self.ids.__getitem__
        for found, beyond in _tokens(text):
            waiting.extend(map(ids, found))
            for k in range(len(found) - beyond, len(found)):
                waiting[k - len(found)] *= -1
            waiting.append(_NONE)
            self.gathered += len(found) + 1
            if self.gathered >= GATHER or len(self.words) >= WORDS:
                yield from self._settle()
                waiting, ids = self.waiting.setdefault(lang, []), self.ids.__getitem__

    def _settle(self) -> Iterator[pa.RecordBatch]:
        """Move the gathered positions into the tries, then spill what is too much."""
        for lang, ids in self.waiting.items():
            trie = self.tries.setdefault(lang, HatTrie())
            a = np.array([*ids, _NONE, _NONE], "i8")
            one, two, three = a[:-2], np.abs(a[1:-1]), np.abs(a[2:])
            three = np.where(two == _NONE, _NONE, three)
            live = one > _NONE  # a negative id only continues phrases: they begin in the next block
            trie.add(*np.unique((one << 2 * ID | two << ID | three)[live], return_counts=True))
        self.waiting, self.gathered = {}, 0
        if len(self.words) >= WORDS:
            yield from self.rest()
        elif (held := sum(t.size for t in self.tries.values())) > HELD:
            each = [(size, lang, first, second) for lang, t in self.tries.items() for size, first, second in t.subtrees()]
            sizes = np.sort(np.array([e[0] for e in each]))[::-1]
            least = sizes[min(np.searchsorted(np.cumsum(sizes), held // 2), len(sizes) - 1)]  # the largest, down to this, hold half
            out = [(lang, first, self.tries[lang].take(first, second)) for size, lang, first, second in each if size >= least]
            yield from self._runs(out)

    def rest(self) -> Iterator[pa.RecordBatch]:
        """Everything left, as runs."""
        if self.waiting:
            yield from self._settle()
        out = [(lang, first, t.take(first, second)) for lang, t in self.tries.items() for _, first, second in t.subtrees()]
        yield from self._runs(out)
        self._clear()

    def _runs(self, subtrees: list[tuple[str, int, dict[int, int]]]) -> Iterator[pa.RecordBatch]:
        """Sorted runs of whole subtrees, one for each prefix partition and language."""
        if not subtrees:
            return
        words = pa.array(self.words, pa.binary())
        codes = np.fromiter(map(crc32, self.words), "u8", len(self.words))
        rank = np.empty(len(self.words), "i8")
        rank[pc.sort_indices(words).to_numpy()] = np.arange(len(self.words))
        for lang in sorted({t[0] for t in subtrees}):
            own = [(first, leaf) for at, first, leaf in subtrees if at == lang]
            sizes = [len(leaf) for _, leaf in own]
            rest = np.fromiter(chain.from_iterable(leaf.keys() for _, leaf in own), "i8", sum(sizes))
            counts = np.fromiter(chain.from_iterable(leaf.values() for _, leaf in own), "i8", sum(sizes))
            first = np.repeat([f for f, _ in own], sizes)
            first, second, third, counts = _with_prefixes(first << 2 * ID | rest, counts)
            part = prefix_parts(lang, codes[first], codes[second], codes[third], self.parts)
            order = np.lexsort((rank[first] << 2 * ID | rank[second] << ID | rank[third], part))
            first, second, third, part, counts = (x[order] for x in (first, second, third, part, counts))
            taken = [words.take(pa.array(ids, mask=ids == _NONE)) for ids in (first, second, third)]
            phrases = pc.binary_join_element_wise(*taken, b" ", null_handling="skip")
            starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            ends = np.append(starts[1:], len(part))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(starts, len(part)), pa.int32()), phrases), b"\n")
            values = [counts[a:b].tobytes() for a, b in zip(starts, ends)]
            yield _run_rows(part[starts].astype("i4"), lang, joined, values)
            total = counts[second == _NONE].sum()  # all occurrences of a language's words are counted as those of the empty phrase
            none = np.zeros(1, "u8")
            yield _run_rows(prefix_parts(lang, none, none, none, self.parts).astype("i4"), lang, pa.array([b""], pa.binary()), [total.tobytes()])


def _with_prefixes(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First, second and third words and counts of all phrases of a trie's leaves: a prefix occurs as often as its leaves together."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    phrases, sums = [keys[keys & _MASK != _NONE]], [counts[keys & _MASK != _NONE]]
    for cut in (ID, 2 * ID):
        heads = keys >> cut
        starts = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1])))
        whole = heads[starts] & _MASK != _NONE
        phrases.append(heads[starts][whole] << cut)
        sums.append(np.add.reduceat(counts, starts)[whole])
    keys = np.concatenate(phrases)
    return keys >> 2 * ID, keys >> ID & _MASK, keys & _MASK, np.concatenate(sums)


def _run_rows(parts: np.ndarray, lang: str, phrases: pa.Array, counts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([lang] * len(parts), pa.string()), phrases, pa.array(counts, pa.binary())], ["part", "lang", "phrases", "counts"])


def _tokens(text: bytes) -> Iterator[tuple[list[bytes], int]]:
    """Lower-cased words, with ``_END`` after each piece but the last, and how many of them at the end only continue phrases.

    Long texts come in parts cut between pieces, a long piece in blocks that
    each end with the first two words of the next, which are counted there.
    """
    text, at = text.translate(_FOLD), 0
    while len(text) - at > PART:
        cut = text.rfind(b"\n", at, at + PART)
        if cut < 0:
            cut = text.find(b"\n", at + PART)
            cut = len(text) if cut < 0 else cut
            words = (m.group() for m in _WORD.finditer(text, at, cut))
            block = list(islice(words, BLOCK))
            while block:
                more = list(islice(words, BLOCK))
                yield block + more[:2], len(more[:2])
                block = more
        else:
            yield text[at:cut].replace(b"\n", _END).split(), 0
        at = cut + 1
    yield text[at:].replace(b"\n", _END).split(), 0


def prefix_parts(lang: str, first: np.ndarray, second: np.ndarray, third: np.ndarray, parts: int) -> np.ndarray:
    """Partitions of phrases by their prefixes, from the words' hashes; of one prefix, third words go to ``SALT`` neighbours."""
    head = ((first ^ np.uint64(crc32(lang.encode()))) * _ODD[0] + second) * _ODD[1]
    return ((head >> np.uint64(32)) + third % np.uint64(SALT)) % np.uint64(parts)


def counted(docs: DataFrame, parts: int) -> DataFrame:
    """(part, lang, phrases, counts): every task's sorted runs, a run's phrases in lines and its counts beside them."""

    def count(batches):
        tries = Counting(parts)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), encoded(batch.column("text"))):
                yield from tries.text(lang, text)
        yield from tries.rest()

    small_batches(docs.sparkSession)
    texts = docs.filter("text is not null").select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    return texts.mapInArrow(count, RUN)


def merge(phrases: list[bytes], counts: list[bytes], least: int) -> tuple[pa.Array, np.ndarray]:
    """Phrases of several runs of one partition in order, with the sums of their counts: the empty phrase and those from ``least`` on."""
    entries = pa.array(b"\n".join(phrases).split(b"\n"), pa.binary())
    order = pc.sort_indices(entries)
    entries, each = entries.take(order), np.frombuffer(b"".join(counts), "i8")[order.to_numpy()]
    starts = np.flatnonzero(np.concatenate(([True], pc.not_equal(entries[1:], entries[:-1]).to_numpy(zero_copy_only=False))))
    sums = np.add.reduceat(each, starts)
    kept = (sums >= least) | (pc.binary_length(entries).to_numpy()[starts] == 0)
    return entries.take(pa.array(starts[kept])), sums[kept]


def frequencies(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, f): phrases of up to three words found ``least`` times or more; of the empty phrase, all words."""
    parts = partitions(docs.sparkSession) * PARTS

    def out(key, phrases, counts):
        found, sums = merge(phrases, counts, least)
        return pa.RecordBatch.from_arrays([pa.array([key[1]] * len(sums), pa.string()), found.cast(pa.string()), pa.array(sums)], ["lang", "phrase", "f"])

    def merged(batches):
        phrases, counts, key = [], [], None
        for batch in batches:
            for part, lang, phrase, count in zip(*(batch.column(c) for c in ("part", "lang", "phrases", "counts"))):
                here = part.as_py(), lang.as_py()
                if here != key and phrases:
                    yield out(key, phrases, counts)
                    phrases, counts = [], []
                key = here
                phrases.append(phrase.as_py())
                counts.append(count.as_py())
        if phrases:
            yield out(key, phrases, counts)

    runs = counted(docs, parts).repartition(partitions(docs.sparkSession), "part").sortWithinPartitions("part", "lang")
    return runs.mapInArrow(merged, "lang string, phrase string, f bigint")


def scored(found: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, a, l, r, score, words): phrases of two and three words with their worst cut."""
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    words = F.split("phrase", " ", -1)
    phrases = found.filter(f"f >= {least}").select("lang", "phrase", F.col("f").alias("a"), words.alias("w")).filter(F.size("w") > 1)
    cut = F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")
    halves = phrases.select("*", cut).select(
        "*", F.concat_ws(" ", F.slice("w", 1, F.col("k"))).alias("left"), F.concat_ws(" ", F.expr("slice(w, k + 1, size(w) - k)")).alias("right"),
    )
    part = lambda side, f: found.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    pairs = halves.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    score = F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    worst = F.min(F.struct(F.col("score"), F.col("k"), F.col("l"), F.col("r"))).alias("x")
    each = pairs.withColumn("score", score).groupBy("lang", "phrase", "a", F.size("w").alias("words")).agg(worst)
    return each.select("lang", "phrase", "a", "x.l", "x.r", "x.score", "words")


def uncovered(phrases: DataFrame, cover: int = COVER) -> DataFrame:
    """``phrases`` without those that stand inside a longer one with at least ``cover`` per cent of their occurrences."""
    w = F.split("phrase", " ", -1)
    inside = F.array(F.concat_ws(" ", F.slice(w, 1, 2)), F.concat_ws(" ", F.slice(w, 2, 2)))
    longest = phrases.filter("words = 3").select("lang", F.explode(inside).alias("phrase"), F.col("a").alias("b"))
    most = longest.groupBy("lang", "phrase").agg(F.max("b").alias("b"))
    return phrases.join(most, ["lang", "phrase"], "left").filter(f"b is null or 100 * b < {cover} * a").drop("b")


def collocations(docs: DataFrame, least: int = LEAST, cover: int = COVER) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): all candidates that stay."""
    found = stage(frequencies(docs, least))
    totals = found.filter("phrase = ''").groupBy("lang").agg(F.sum("f").alias("n"))
    return uncovered(scored(found.filter("phrase <> ''"), least), cover).join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def digest(docs: DataFrame, top: int = TOP) -> DataFrame:
    """The query's columns: each language's first ``top`` phrases, ranked."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shard = F.pmod(F.xxhash64("phrase"), F.lit(SHARDS))
    near = collocations(docs).withColumn("_at", F.row_number().over(Window.partitionBy("lang", shard).orderBy(*order))).filter(F.col("_at") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(text, '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) as p
    from documents where text is not null
), lists as (
    select lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') as w from pieces
), grams as (
    select lang, unnest(w) as phrase, 1 as words from lists
    union all select lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 2 from lists
    union all select lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])), 3 from lists
), f as (
    select lang, phrase, words, count(*) as f from grams group by all
), totals as (
    select lang, sum(f)::bigint as n from f where words = 1 group by lang
), candidates as (
    select lang, phrase, words, f as a, string_split(phrase, ' ') as w from f where words > 1 and f >= {LEAST}
), cuts as (
    select *, unnest(range(1, words)) as k from candidates
), halves as (
    select lang, phrase, words, a, k, array_to_string(w[1:k], ' ') as lft, array_to_string(w[k + 1:], ' ') as rgt from cuts
), marks as (
    select h.lang, h.phrase, h.words, h.a, h.k, x.f as l, y.f as r, ((1000000::hugeint * h.a * h.a) // (x.f::hugeint * y.f))::bigint as score
    from halves h join f x on x.lang = h.lang and x.phrase = h.lft join f y on y.lang = h.lang and y.phrase = h.rgt
), worst as (
    select * from marks qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inner_phrases as (
    select lang, a as b, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase from candidates where words = 3
), dropped as (
    select lang, phrase, max(b) as b from inner_phrases group by lang, phrase
), kept as (
    select w.* from worst w left join dropped d on d.lang = w.lang and d.phrase = w.phrase where d.b is null or 100 * d.b < {COVER} * w.a
)
select k.lang, row_number() over (partition by k.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept k join totals t on t.lang = k.lang
qualify rank <= {TOP}
"""
