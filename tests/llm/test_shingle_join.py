"""The Jaccard join against all pairs, and the promise of its prefixes on made sets."""

import random
from collections import Counter

import numpy as np
import pytest

from panelweave.llm import shingle_join


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def brute(rows, percent=90, words=3):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                label[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids else None))
    return Counter(out)


def result(spark, rows, **how):
    df = spark.createDataFrame([(d, t, "x", "y", 0) for d, t in rows], "doc_id long, text string, s string, n string, k1 int")
    return Counter(tuple(r) for r in shingle_join.jaccard_classes(df, **how).select("doc_id", "n_shingles", "component_id").collect())


def corpus(seed, groups=(700, 40, 9, 3, 2, 2), singles=40):
    """Groups of near copies at all distances, texts with a shared passage, and chains."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    out = []
    for size in groups:
        base = [word() for _ in range(rng.choice([20, 90, 200]))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = word()
            out.append(" ".join(own))
    for _ in range(singles):
        out.append(" ".join([word() for _ in range(rng.randrange(2, 9))] + passage + [word() for _ in range(rng.randrange(2, 9))]))
    chain = [word() for _ in range(150)]
    for _ in range(12):
        chain[rng.randrange(len(chain))] = word()
        out.append(" ".join(chain))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed, percent, words", [(1, 90, 3), (2, 80, 5)])
def test_against_all_pairs(spark, seed, percent, words):
    rows = corpus(seed)
    assert result(spark, rows, words=words, percent=percent) == brute(rows, percent, words)


def test_nulls_short_texts_and_repeated_rows(spark):
    long = " ".join(f"u{k}" for k in range(50))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (None, "A b"), (4, "a B"), (4, "a B"), (5, "a"), (6, "a b c"), (7, "a b c d"), (8, "a b c d e f g h i j k"),
        (9, "x a b c d e f g h i j k"), (10, "é É"), (11, "É é"), (None, "only null"), (None, "only null"), (12, long), (12, long + " more"), (None, long),
        (13, " ".join(["la"] * 40)),
    ]
    assert result(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert result(spark, []) == Counter()


def test_long_texts_hash_alike_in_pieces(monkeypatch):
    text = " ".join(f"Wort{k * k % 977}" for k in range(3000)).encode() + b"\n\nend"
    whole = shingle_join.shingles(text)
    monkeypatch.setattr(shingle_join, "PIECE", 37)
    assert (shingle_join.shingles(text) == whole).all()
    assert len(shingle_join.shingles(b"x" * 200 + b" a b")) == 1


@pytest.mark.parametrize("percent", [80, 90, 100])
def test_partners_share_a_key(monkeypatch, percent):
    """Sets of common, mixed and rare shingles, at every overlap from the least one on."""
    monkeypatch.setattr(shingle_join, "RARE", 2)
    monkeypatch.setattr(shingle_join, "COMMON", 6)
    monkeypatch.setattr(shingle_join, "PLAIN", 16)
    rng = np.random.default_rng(percent)
    universe = rng.integers(0, 1 << 63, 6000, dtype="u8")
    kept = met = 0
    for _ in range(400):
        n = int(rng.integers(9, 400))
        a = set(rng.choice(6000, n, replace=False).tolist())
        gone = int(rng.integers(0, shingle_join.misses(n, percent) + 1))
        b = set(a) - set(rng.choice(sorted(a), gone, replace=False).tolist())
        b |= set(rng.choice(sorted(set(range(6000)) - a), int(rng.integers(0, max(1, n // 8))), replace=False).tolist())
        if a == b or 100 * len(a & b) < percent * len(a | b):
            continue
        kind = rng.integers(0, 3)
        holders = np.where(kind == 0, rng.integers(2, 12, 6000), np.where(kind == 1, 9, rng.integers(2, 5, 6000)))
        alone = rng.random(6000) < 0.03
        keys = []
        for s in sorted((a, b), key=len):
            several = np.array(sorted(x for x in s if not alone[x] or (x in a and x in b)), int)
            found, marks = shingle_join.signatures(len(s), holders[several], universe[several], percent)
            keys.append(set(found[marks].tolist() if not keys else found.tolist()))
        kept, met = kept + 1, met + bool(keys[0] & keys[1])
    assert met == kept and (kept > 40 or percent == 100)


def test_keys_stay_few():
    rng = np.random.default_rng(1)
    for n in (100, 1000, 20_000):
        tokens = rng.integers(0, 1 << 63, n, dtype="u8")
        for holders in (3, 100, 5000):
            assert len(shingle_join.signatures(n, np.full(n, holders), tokens)[0]) < 2 * n


def test_outliers_are_no_hubs(spark, monkeypatch):
    """A group whose smallest members link with none of it is not compared pair by pair."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for k in range(300):
        own = base if k >= 40 else base[:-1]
        texts.append(" ".join(w if e else f"x{rng.random()}" for w, e in zip(own, _kept(rng, len(own), 1 if k >= 40 else 9))))
    judged, verified = [], shingle_join.verified

    def counted(pairs, *rest):
        judged.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(shingle_join, "verified", counted)
    rows = list(enumerate(texts))
    assert result(spark, rows) == brute(rows)
    assert sum(judged) < 6 * len(rows), judged


def _kept(rng, n, edits):
    gone = set(rng.sample(range(n), edits))
    return [k not in gone for k in range(n)]
