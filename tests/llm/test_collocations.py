"""Collocations against a plain count, also where the tries burst, spill and begin anew."""

import random
import re
from collections import Counter, defaultdict

import pytest

from panelweave.llm import collocations


def brute(rows, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = []
        for p, a in c.items():
            if len(p) == 1 or a < 10:
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            longer = [q for q in c if len(q) == 3 > len(p) and c[q] >= 10 and p in (q[:2], q[1:])]
            if not any(100 * c[q] >= 50 * a for q in longer):
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(k, t, l, "x", "y") for k, (t, l) in enumerate(rows)], "doc_id long, text string, lang string, run string, f string")


def result(spark, rows):
    return sorted(tuple(r) for r in collocations.digest(table(spark, rows)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed, count=60, words=120):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "BETA", "gamma", "deÉ", "中文", "\U0001f600", "x\x00y", "eta", " ", "theta"]
    join = [" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "\r\n", "!"]
    return [("".join(rng.choice(vocabulary) + rng.choice(join) for _ in range(words)), rng.choice(["en", "de", None, "und"])) for _ in range(count)]


def test_against_brute_force(spark):
    rows = texts(1) + [(None, "en"), ("", "fr"), (" \t\n.,", "fr"), ("one two", "fr")]
    assert result(spark, rows) == brute(rows)


def test_repeated_rows_and_ties(spark):
    rows = [("a b c. d e f. c a", "en")] * 12 + [("b c", "en")] * 30
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("setting", [{"BURST": 3}, {"HELD": 20}, {"WORDS": 5}, {"GATHER": 7}, {"BLOCK": 2, "PART": 9}, {"PART": 40}, {"BURST": 2, "HELD": 9, "GATHER": 5, "BLOCK": 3, "PART": 20}])
def test_bursting_spilling_and_blocks_change_nothing(setting, monkeypatch):
    for name, value in setting.items():
        monkeypatch.setattr(collocations, name, value)
    rows = texts(2, 25)
    tries, runs = collocations.Counting(7), defaultdict(list)
    batches = [b for text, lang in rows for b in tries.text(lang or "und", text.encode())] + list(tries.rest())
    for b in batches:
        for r in b.to_pylist():
            assert r["phrases"].split(b"\n") == sorted(r["phrases"].split(b"\n"), key=lambda p: p.split(b" "))
            runs[r["part"], r["lang"]].append((r["phrases"], r["counts"]))
    got, totals = defaultdict(Counter), Counter()
    for (_, lang), held in runs.items():
        for phrase, f in zip(*(x.tolist() for x in collocations.merge(*map(list, zip(*held)), 1))):
            if phrase:
                assert phrase.decode() not in got[lang]
                got[lang][phrase.decode()] = f
            else:
                totals[lang] += f
    for lang in got:
        own = [r for r in rows if (r[1] or "und") == lang]
        plain = Counter()
        for text, _ in own:
            for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
                w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in re.split("[ \t]+", piece) if x]
                for k in (1, 2, 3):
                    plain.update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
        assert got[lang] == plain and totals[lang] == sum(v for p, v in plain.items() if " " not in p)


def test_a_very_long_piece(spark):
    rows = [("red green blue " * 70_000 + "end", "en")]
    assert result(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert result(spark, []) == []
