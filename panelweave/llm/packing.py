"""Length buckets of least padding, and token-budget batches inside each.

Every length is counted (global histogram); a dynamic program over the counts
cuts it into at most ``BUCKETS`` buckets so that padding each document to its
bucket's longest costs least. Inside a bucket documents are shuffled by a hash
and dealt into batches of ``BUDGET`` padded tokens; one longer than that is a
batch of its own. Length is the number of words unless a column is given. A
null or empty text has length 0 and goes to the first bucket. Repeated rows
are packed each; extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.llm.shared import WORD, numbered, small_batches, word_count
from panelweave.session import stage

BUCKETS, BUDGET = 8, 16_384
FINE = 10  # lengths keep this many leading bits in the histogram: exact below 1,024, within 0.2 % above


def histogram(lengths: DataFrame) -> DataFrame:
    """(longest, n, total) by bin, in the order of length: at most 512 bins for each doubling, however many rows."""
    shift = F.greatest(F.length(F.bin("n_tokens")) - FINE, F.lit(0))
    bin_ = F.call_function("shiftright", F.col("n_tokens") + F.call_function("shiftleft", F.lit(1).cast("bigint"), shift) - 1, shift)
    tally = lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("rows"))
    binned = tally.groupBy(shift.alias("s"), bin_.alias("b")).agg(
        F.max("n_tokens").alias("longest"), F.sum("rows").alias("n"), F.sum(F.col("n_tokens") * F.col("rows")).alias("total")
    )
    return binned.select("longest", "n", "total")


def best_cuts(longest: list[int], n: list[int], total: list[int], buckets: int = BUCKETS) -> list[int]:
    """The longest length of each bucket, ascending, with the least padding in all; of equals the fewest, then the lowest cuts."""
    edge = np.array(longest, "i8")
    rows, sums = (np.concatenate(([0], np.cumsum(np.array(x, "i8")))) for x in (n, total))
    bins = len(edge)
    cost = np.full(bins + 1, np.iinfo("i8").max // 4)
    cost[0] = 0
    came, best = [], []
    for _ in range(min(buckets, bins)):
        after, back = np.full(bins + 1, np.iinfo("i8").max // 4), np.zeros(bins + 1, "i8")
        for j in range(1, bins + 1):
            options = cost[:j] + edge[j - 1] * (rows[j] - rows[:j]) - (sums[j] - sums[:j])
            back[j] = options.argmin()
            after[j] = options[back[j]]
        cost = after
        came.append(back)
        best.append(int(cost[bins]))
    cuts, at = [], bins
    for back in reversed(came[: best.index(min(best)) + 1] if best else []):
        cuts.append(int(edge[at - 1]))
        at = int(back[at])
    return cuts[::-1]


def packed(docs: DataFrame, length: Column | None = None, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """(doc_id, n_tokens, bucket, padded_to, batch, slot): where each document goes."""
    small_batches(docs.sparkSession)
    n = F.coalesce(length if length is not None else word_count(F.col("text")), F.lit(0)).cast("bigint")
    lengths = stage(docs.select("doc_id", n.alias("n_tokens")))
    bins = histogram(lengths).orderBy("longest").collect()  # bounded by the bins, not by the rows
    cuts = best_cuts(*([r[c] for r in bins] for c in ("longest", "n", "total")), buckets)
    bucket = F.lit(0)
    for cut in cuts[:-1]:
        bucket = bucket + F.when(F.col("n_tokens") > cut, 1).otherwise(0)
    edges = F.array(*[F.lit(c).cast("bigint") for c in cuts or [0]])
    shuffled = lengths.withColumns({"bucket": bucket, "_mix": F.md5(F.col("doc_id").cast("string"))})
    placed = numbered(shuffled, ["bucket", "_mix", "doc_id", "n_tokens"])
    starts = placed.groupBy("bucket").agg(F.min("rank").alias("_start"))  # one row a bucket
    held = placed.join(F.broadcast(starts), "bucket").withColumn("padded_to", edges[F.col("bucket")])
    size = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("padded_to"), F.lit(1))))
    place = F.col("rank") - F.col("_start")
    return held.select("doc_id", "n_tokens", "bucket", "padded_to", F.floor(place / size).alias("batch"), F.pmod(place, size).alias("slot"))


def _sql() -> str:
    layers = ["d0 as (select 0 as j, 0::hugeint as c, 0 as i)"]
    for k in range(1, BUCKETS + 1):
        layers.append(
            f"d{k} as (select b.j, min(a.c + b.longest * (b.cn - coalesce(p.cn, 0)) - (b.ct - coalesce(p.ct, 0))) as c, "
            f"arg_min(a.j, (a.c + b.longest * (b.cn - coalesce(p.cn, 0)) - (b.ct - coalesce(p.ct, 0))) * 1000000 + a.j) as i "
            f"from d{k - 1} a join bins b on a.j < b.j left join bins p on p.j = a.j group by b.j)"
        )
    totals = " union all ".join(f"select {k} as k, c from d{k} where j = (select max(j) from bins)" for k in range(1, BUCKETS + 1))
    steps = ["s0 as (select k, (select max(j) from bins) as j from best)"]
    for t in range(BUCKETS):  # walk back from layer k to the first
        case = " ".join(f"when {k} then (select i from d{k} where d{k}.j = s.j)" for k in range(1, BUCKETS + 1))
        steps.append(f"s{t + 1} as (select k - 1 as k, case k {case} end as j from s{t} s where k > 0)")
    cuts = " union ".join(f"select j from s{t} where k > 0" for t in range(BUCKETS + 1))
    return rf"""
with docs as (select doc_id, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as n_tokens from documents),
shifted as (select n_tokens, greatest(length(bin(n_tokens)) - {FINE}, 0)::int as s from docs),
hist as (select max(n_tokens) as longest, count(*)::hugeint as n, sum(n_tokens)::hugeint as t from shifted
  group by s, (n_tokens + (1::bigint << s) - 1) >> s),
bins as (select longest::hugeint as longest, row_number() over (order by longest) as j, sum(n) over (order by longest) as cn, sum(t) over (order by longest) as ct from hist),
{", ".join(layers)},
totals as ({totals}),
best as (select min(k) as k from totals where c = (select min(c) from totals)),
{", ".join(steps)},
cuts as (select longest::bigint as padded_to, row_number() over (order by longest) - 1 as bucket from bins where j in ({cuts})),
held as (select doc_id, n_tokens, min(padded_to) as padded_to, min(bucket) as bucket, r from
  (select *, row_number() over () as r from docs) join cuts on n_tokens <= padded_to group by all_keys),
placed as (select *, row_number() over (partition by bucket order by md5(doc_id::varchar) nulls first, doc_id nulls first, n_tokens) - 1 as place,
  greatest(1, {BUDGET} // greatest(padded_to, 1)) as size from held)
select doc_id, n_tokens, bucket::int as bucket, padded_to, place // size as batch, place % size as slot from placed
""".replace("group by all_keys", "group by doc_id, n_tokens, r")


SQL = _sql()
