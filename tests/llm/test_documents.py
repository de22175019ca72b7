"""Host quality, line runs, packing and mixing: against plain versions, and on odd input."""

import hashlib
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.llm import host_quality, line_runs, mixing, packing

SPACE = " \t\n\x0b\x0c\r"
ODD = [
    (1, None, "a"), (2, "", "a"), (3, "one two three " * 30, None), (4, "w " * 60 + "#*$", "b"), (4, "w " * 60 + "#*$", "b"), (None, "a b\na b\nÉé x", "b"),
    (6, " ".join(f"w{k}" for k in range(70)), None), (7, "x y z q x y z r", "c"), (8, " ".join(map(str, range(60_000))), "c"), (9, "tab\tand\x1cfs nbsp\u00a0x", "c"),
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def counted(text):
    ws = words(text)
    windows = Counter(zip(ws, ws[1:], ws[2:]))
    marked = {k + d for k in range(len(ws) - 2) if windows[tuple(ws[k : k + 3])] > 1 for d in range(3)}
    full = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    n_dup = len(full) - len(set(full))
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), n_dup, len(marked)


@pytest.mark.parametrize("table", ["odd", "given"])
def test_quality_counts(documents, given, table):
    docs = documents(*ODD).withColumn("n_words", F.lit("clash")).withColumn("strict", F.lit(1)) if table == "odd" else given("documents")
    want = [(r["doc_id"], *counted(r["text"])) for r in docs.collect()]
    got = host_quality.digest(docs).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:6]) for r in got)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert host_quality.keep(docs).columns == docs.columns and host_quality.keep(docs).count() == sum(r["kept"] for r in got)
    assert host_quality.digest(docs.filter("false")).count() == 0


def test_strict_hosts_keep_their_clean_documents(documents):
    clean = " ".join(f"word{k}" for k in range(80))
    marked = " ".join(f"word{k}#" for k in range(80))
    rows = [(k, marked, "bad") for k in range(400)] + [(1000 + k, clean, "bad") for k in range(20)]
    for h in range(12):
        rows += [(2000 + 100 * h + k, marked if k < 2 else clean, f"good{h}") for k in range(50)]
    kept = {r["doc_id"] for r in host_quality.digest(documents(*rows)).filter("kept").collect()}
    assert not kept & set(range(400)) and set(range(1000, 1020)) < kept  # a clean document stays on any host
    assert all(2000 + 100 * h + k in kept for h in range(12) for k in range(50))  # and a marked one on a good host


def plain_lines(rows):
    """(n_lines, n_dropped, sha256) of each row."""
    key = [[re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(SPACE)) for x in (t or "").split("\n")] for _, t in rows]
    docs, top = Counter(), {}
    for (i, _), ks in zip(rows, key):
        for k in set(ks):
            docs[k] += 1
            if i is not None:
                top[k] = max(i, top.get(k, i))
    out = []
    for (i, t), ks in zip(rows, key):
        lines = (t or "").split("\n")
        stay = [x for x, k in zip(lines, ks) if not (len(k) >= 20 and docs[k] >= 3 and i != top.get(k, "none"))]
        out.append(str((i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest())))
    return sorted(out)


@pytest.mark.parametrize("batches", [1, 2, 4, 9])
def test_lines(documents, batches):
    common, accent = "A line that many documents share", "ÉÀ Línea que muchos DOCUMENTOS comparten İ"
    texts = ["", None, common, f" {common.upper()}\t\nown {'x' * 30}", f"{common}\n{common}\nshort", accent, accent.replace("DOC", "doc"), accent + "\r", "short\nshort", f"{common}\n\n\nend"]
    rows = [(k * 7 % 11, t, "a") for k, t in enumerate(texts * 2)] + [(None, common, "a"), (None, "only null " * 5, "b"), (3, "only null " * 5, "b"), (3, "only null " * 5, "b"), (4, "\n".join(f"line number {k:020d}" for k in range(5000)), "c")]
    docs = documents(*rows).withColumn("h1", F.lit("clash")).withColumn("of", F.lit(1))
    got = sorted(str(tuple(r)) for r in line_runs.digest(docs, batches).collect())
    assert got == plain_lines([r[:2] for r in rows])
    assert line_runs.thinned(docs, batches).columns == docs.columns
    assert all(r["n_chars"] == len(r["text"]) for r in line_runs.thinned(docs, batches).collect())


def test_lines_of_given_documents(given):
    docs = given("documents")
    got = sorted(str(tuple(r)) for r in line_runs.digest(docs).collect())
    assert got == plain_lines([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert line_runs.digest(docs.filter("false")).count() == 0


def padding(cuts, lengths):
    return sum(min(c for c in cuts if c >= n) - n for n in lengths)


def test_cuts_are_optimal():
    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = rng.integers(0, 40, int(rng.integers(1, 30))).tolist()
        tally = sorted(Counter(lengths).items())
        buckets = int(rng.integers(1, 5))
        cuts = packing.best_cuts([n for n, _ in tally], [c for _, c in tally], [n * c for n, c in tally], buckets)
        best = min(padding([*cut, max(lengths)], lengths) for k in range(buckets) for cut in combinations(sorted(set(lengths) - {max(lengths)}), min(k, len(tally) - 1)))
        assert padding(cuts, lengths) == best and len(cuts) <= buckets and cuts == sorted(set(cuts))
    assert packing.best_cuts([], [], []) == []


@pytest.mark.parametrize("budget", [100, packing.BUDGET])
def test_batches(documents, budget):
    rng = np.random.default_rng(2)
    docs = documents(*ODD, *[(100 + k, "w " * int(rng.integers(1, 300)), "a") for k in range(300)]).withColumn("bucket", F.lit("clash"))
    rows = packing.packed(docs, budget=budget).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(words(r["text"])) for r in docs.collect())
    held = {}
    for r in rows:
        assert r["n_tokens"] <= r["padded_to"]
        held.setdefault((r["bucket"], r["padded_to"], r["batch"]), []).append(r["slot"])
    for (_, width, _), slots in held.items():
        assert sorted(slots) == list(range(len(slots))) and (len(slots) == 1 or len(slots) * max(width, 1) <= budget)
    for bucket in {b for b, _, _ in held}:
        batches = sorted(b for k, _, b in held if k == bucket)
        assert batches == list(range(len(batches)))
    assert packing.packed(docs.filter("false")).count() == 0


def targets(sizes):
    """Shares by weight, held at three times the source."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    full, out = set(), {}
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        out = {s: 3 * sizes[s] if s in full else rest * weight[s] / free for s in names}
        more = {s for s in names if s not in full and out[s] > 3 * sizes[s]}
        if not more:
            return out
        full |= more


def test_mixing_of_repeated_rows(documents):
    """Alike rows share their copies: 600 of them land within one row of the target, in the digest and in the mix."""
    docs = documents(*[(1, "w " * 10, "a")] * 600, *[(None, "v " * 10, "b")] * 150, *[(k, "u " * 10, "b") for k in range(50)])
    rows = mixing.digest(docs).collect()
    assert len(rows) == 800
    for size in (6000, 2000):
        part = [r for r in rows if r["source_size"] == size]
        assert len(part) == size // 10 and abs(sum(r["taken"] for r in part) - part[0]["target"]) <= 10 and all(r["taken"] <= 30 for r in part)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.digest(docs.repartition(5)).collect()))
    assert mixing.mix(docs).count() * 10 == sum(r["taken"] for r in rows)


@pytest.mark.parametrize("table", ["odd", "given", "many"])
def test_mixing(documents, given, table, monkeypatch):
    rng = np.random.default_rng(4)
    if table == "many":
        monkeypatch.setattr(mixing, "LEAF", 8)
    many = [(k, "w " * int(rng.integers(0, 50)), ["a", "b", "b", "b", "ä", None][k % 6]) for k in range(700)]
    docs = given("documents") if table == "given" else documents(*(ODD if table == "odd" else many)).withColumn("size", F.lit("clash"))
    rows = mixing.digest(docs).collect()
    source = {}
    for r in docs.collect():
        source.setdefault(r["source"], []).append((r["doc_id"], len(words(r["text"]))))
    sizes = {s: sum(n for _, n in own) for s, own in source.items()}
    want = targets(sizes)
    assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == sorted((str(i), n) for own in source.values() for i, n in own)
    for s, own in source.items():
        mine = [r for r in rows if abs(r["target"] - want[s]) < 1e-6 * max(1, want[s]) and r["source_size"] == sizes[s]]
        assert len(mine) >= len(own)
        if sum(sizes[t] == sizes[s] for t in sizes) == 1:
            largest = max(n * sum(i == j and n == m for j, m in own) for i, n in own)
            assert abs(sum(r["taken"] for r in mine) - want[s]) <= largest
    assert all(r["taken"] in {k * r["size"] for k in range(4)} for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.digest(docs.repartition(3)).collect()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter()
    for r in mixed.collect():
        got[r["doc_id"]] += len(words(r["text"]))
    taken = Counter()
    for r in rows:
        taken[r["doc_id"]] += r["taken"]
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in taken.items() if v}
    assert mixing.digest(docs.filter("false")).count() == 0 and mixing.mix(docs.filter("false")).count() == 0


def test_pivot_keeps_mass_and_expectation():
    rng = np.random.default_rng(0)
    masses = rng.integers(1, 100, 40).astype("f8")
    total = np.zeros(40)
    for seed in range(4000):
        out, at = mixing.pivot(np.full(40, 0.3), masses, np.random.default_rng(seed))
        assert abs(out @ masses - 0.3 * masses.sum()) < 1e-6
        assert ((out == 0) | (out == 1)).sum() >= 39 and (at < 0 or 0 < out[at] < 1)
        total += out
    assert abs(total / 4000 - 0.3).max() < 0.05
