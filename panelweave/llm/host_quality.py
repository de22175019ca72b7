"""Quality rules by host: rule failures per source, shrunk by an empirical beta prior, joined back to the documents.

A document that fails a base rule goes. A host whose shrunk rate of any rule
passes ``HOST_LIMIT`` is strict: of its documents only those that pass every
rule stay, so a clean document stays wherever it comes from. A null text is an
empty one. Documents of a null source have no host and meet the base rules
only. Repeated rows count and come back each. Extra columns are ignored, or
pass through ``keep`` inside a struct. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.llm.shared import encoded, small_batches
from panelweave.session import stage

MIN_WORDS, REPEAT_PCT = 50, 50
HOST_LIMIT = 0.5
PRIOR_LEAST, PRIOR_MOST = 2.0, 10_000.0  # documents that the prior can weigh as much as

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_full_lines"]
_SPACE, _SYMBOLS, _REST = b" \t\n\x0b\x0c\r", b"#*$%&|<>", bytes(range(0x80, 0xC0))


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a window of three found twice or more."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), "i8", len(words))
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    _, window, n = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice = n[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def counts_of(text: bytes | None) -> tuple[int, ...]:
    text = text or b""
    words = text.split()
    full = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, _REST + _SPACE)),  # a code point is a byte that continues none
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(full) - len(set(full)),
        _repeated(words),
        len(full),
    )


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def counts(texts: pa.Array) -> pa.Array:
    rows = np.array([counts_of(t) for t in encoded(texts)], "i8").reshape(-1, len(COUNTS))
    return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(COUNTS))], COUNTS)


def rules() -> dict[str, Column]:
    """What fails each rule, over the counts."""
    n = F.col("n_words")
    return {
        "few_words": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > REPEAT_PCT * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_full_lines"),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 12 * n),
    }


BASE = ["few_words", "repeats"]


def host_verdicts(measured: DataFrame) -> DataFrame:
    """(host, strict): failures by host, each rule's rate drawn to the mean of all hosts.

    The beta prior of a rule has the mean and the variance of the hosts' rates.
    Only two numbers a rule come to the driver.
    """
    failed = rules()
    hosts = stage(
        measured.filter(F.col("source").isNotNull())
        .groupBy(F.col("source").alias("host"))
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(bad.cast("bigint")).alias(name) for name, bad in failed.items()])
    )
    rate = {name: F.col(name) / F.col("n") for name in failed}
    moments = hosts.agg(*[f(rate[name]).alias(f"{k}_{name}") for name in failed for k, f in (("m", F.avg), ("v", F.var_pop))]).first()
    strict = F.lit(False)
    for name in failed:
        mean, spread = moments[f"m_{name}"] or 0.0, moments[f"v_{name}"] or 0.0
        weight = min(PRIOR_MOST, max(PRIOR_LEAST, mean * (1 - mean) / spread - 1)) if spread > 0 else PRIOR_MOST
        strict = strict | ((F.col(name) + F.lit(mean * weight)) / (F.col("n") + F.lit(weight)) > HOST_LIMIT)
    return hosts.select("host", strict.alias("strict"))


def judged(measured: DataFrame, hosts: DataFrame) -> DataFrame:
    """``measured`` with base_failed and kept; a source with a third of all rows is split by the join at run time."""
    failed = rules()
    base = failed[BASE[0]]
    for name in BASE[1:]:
        base = base | failed[name]
    any_rule = base
    for name in failed:
        any_rule = any_rule | failed[name]
    strict = F.coalesce(F.col("strict"), F.lit(False))
    out = measured.join(hosts, F.col("source") == F.col("host"), "left")
    return out.withColumns({"base_failed": base, "kept": ~base & ~(strict & any_rule)}).drop("host", "strict")


def measured(docs: DataFrame, *keep: str | Column) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(*keep, "source", counts(F.col("text")).alias("c")).select("*", "c.*").drop("c")


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns: doc_id, the counts, base_failed, kept."""
    rows = stage(measured(docs, "doc_id"))
    return judged(rows, host_verdicts(rows)).select("doc_id", *COUNTS[:5], "base_failed", "kept")


def keep(docs: DataFrame) -> DataFrame:
    """The documents that stay, as they were. Texts are measured twice rather than dealt out."""
    verdicts = host_verdicts(measured(docs))
    return judged(measured(docs, F.struct("*").alias("row")), verdicts).filter("kept").select("row.*")


SQL = rf"""
with docs as (select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents),
words as (select r, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws from docs),
pos as (select r, unnest(ws) as w, generate_subscripts(ws, 1) as i from words),
win as (select r, i, w, lead(w, 1) over o as w2, lead(w, 2) over o as w3 from pos window o as (partition by r order by i)),
twice as (select r, i from (select r, i, count(*) over (partition by r, w, w2, w3) as n from win where w3 is not null) where n > 1),
rep as (select r, count(distinct i + k) as n_repeat_words from twice, (values (0), (1), (2)) s(k) group by r),
lines as (select r, unnest(string_split(text, chr(10))) as line from docs),
dup as (select r, count(*) - count(distinct line) as n_dup_lines, count(*) as n_full_lines from lines
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
m as (select r, doc_id, source, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_full_lines, 0) as n_full_lines
  from words left join rep using (r) left join dup using (r)),
f as (select *, n_words < {MIN_WORDS} as few_words, 100 * n_repeat_words > {REPEAT_PCT} * n_words as repeats, 10 * n_symbols > n_words as symbols,
    10 * n_dup_lines > 3 * n_full_lines as dup_lines, word_chars < 2 * n_words or word_chars > 12 * n_words as word_length from m),
rates as (select source, rule, count(*) as n, sum(bad::int) as bad from (unpivot f on few_words, repeats, symbols, dup_lines, word_length into name rule value bad)
  where source is not null group by all),
prior as (select rule, avg(bad / n) as mu, var_pop(bad / n) as v from rates group by rule),
weighed as (select rule, mu, case when v > 0 then least({PRIOR_MOST}, greatest({PRIOR_LEAST}, mu * (1 - mu) / v - 1)) else {PRIOR_MOST} end as s from prior),
strict as (select source, bool_or((bad + mu * s) / (n + s) > {HOST_LIMIT}) as strict from rates join weighed using (rule) group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words or repeats as base_failed,
  not (few_words or repeats) and not (coalesce(strict, false) and (symbols or dup_lines or word_length)) as kept
from f left join strict using (source)
"""
