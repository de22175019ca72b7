"""URL filter: fixed host and path rules first, then association rules mined from labelled pages. DataFrame functions and Spark ML only.

A rule list judges the URLs it fits, the longest rule winning. FP-growth over
the labelled pages finds token combinations that go with bad labels; those
with enough support and confidence block every other URL that holds all their
tokens. Tokens that stand in too few bad pages are left out first, as no rule can
hold them; tokens that stand in the same labelled pages are one class, of which
a rule takes any. Each mined rule is indexed under its rarest class, so a URL
meets only rules it shares such a token with.

A null URL, or one without ``://``, has an empty host and path and fits no
rule; its verdict is the method's, allow. Labels are bad if quality is 0 or
toxic is 1; a page with several labels is bad if one of them is. Repeated rows
are judged each; extra columns are ignored. Empty tables give an empty result
or no mined rules.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.llm.shared import LOWER, UPPER, hash128
from panelweave.session import stage

#: (verdict, host, path prefix)
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
MIN_SHARE, MIN_PAGES, MIN_CONFIDENCE = 0.002, 8, 0.6  # of the labelled pages; pages; share of a rule's pages that are bad
BAD = "bad label"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the last that fits wins
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, act).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: domain, host labels, path segments, extension, names of query parameters."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    asked = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(asked, "&"), lambda x: F.element_at(F.split(x, "="), 1)), lambda x: x != "")
    domain = F.when(F.size(labels) >= 2, F.array(F.concat(F.lit("domain "), F.array_join(F.slice(labels, -2, 2), "."))))
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)

    def named(kind: str, xs: Column) -> Column:
        return F.transform(xs, lambda x: F.concat(F.lit(kind + " "), x))

    none = F.array().cast("array<string>")
    parts = [F.coalesce(domain, none), named("host", labels), named("path", segments), F.when(ending != "", F.array(F.concat(F.lit("ending "), ending))).otherwise(none), named("query", names)]
    return F.array_distinct(F.coalesce(F.concat(*parts), none))


def fitted(urls: DataFrame, labels: DataFrame) -> DataFrame:
    """(parts, rarest): combinations that mean a bad page, each part a class of tokens of which any one will do, and the rarest of them.

    ``urls`` has page_id and tokens; labels meet pages on their id. A rule's
    tokens stand together in enough bad pages, so each of them does.
    """
    bad = F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False)))
    verdicts = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("page_id")).agg(bad.alias("bad"))
    baskets = stage(urls.join(verdicts, "page_id").select(F.monotonically_increasing_id().alias("b"), "bad", "tokens"))
    n = baskets.count()
    least = max(MIN_PAGES, -(-n * int(MIN_SHARE * 1000) // 1000))
    held = baskets.select("b", "bad", F.explode("tokens").alias("token"))
    h1, h2 = hash128(F.col("b"))
    counted = held.groupBy("token").agg(F.count(F.lit(1)).alias("freq"), F.count_if("bad").alias("wrong"), F.bit_xor(h1).alias("h1"), F.bit_xor(h2).alias("h2"))
    alike = counted.filter(F.col("wrong") >= least).groupBy("freq", "h1", "h2")
    classes = stage(alike.agg(F.min("token").alias("name"), F.collect_list("token").alias("members")).select("freq", "name", "members"))
    # each has 0.2 % of the labelled pages, so there are 500 for each token of a mean URL at most
    names = F.broadcast(classes.select(F.col("name").alias("token")))
    kept = held.join(names, "token").groupBy("b", "bad").agg(F.collect_list("token").alias("items"))
    fit = stage(kept.select(F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items")))
    m = fit.count()
    if m < least:
        return baskets.sparkSession.createDataFrame([], "parts array<array<string>>, rarest array<string>")
    # half a page below, as FP-growth rounds the count up from a share
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / m, minConfidence=MIN_CONFIDENCE).fit(fit)
    rules = model.associationRules.filter(F.array_contains("consequent", BAD)).select(F.col("antecedent").alias("names"))
    parted = rules.withColumn("name", F.explode("names")).join(classes, "name").groupBy("names")
    return stage(parted.agg(F.collect_list("members").alias("parts"), F.min(F.struct("freq", "name", "members")).alias("least")).select("parts", F.col("least.members").alias("rarest")))


def mined(urls: DataFrame, labels: DataFrame) -> DataFrame:
    """(items): every combination of tokens that means a bad page, for reading; their number doubles with each token of a class."""
    none = F.array(F.array().cast("array<string>"))

    def some(xs: Column) -> Column:
        return F.filter(F.aggregate(xs, none, lambda acc, x: F.concat(acc, F.transform(acc, lambda a: F.array_append(a, x)))), lambda a: F.size(a) > 0)

    spread = F.aggregate("parts", none, lambda acc, p: F.flatten(F.transform(acc, lambda a: F.transform(some(p), lambda b: F.concat(a, b)))))
    return fitted(urls, labels).select(F.explode(spread).alias("items"))


def digest(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns: page_id, host, path, rule, verdict. Only the rule index and the URLs it blocks are joined, never the pages' text."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    judged = stage(parsed.select("*", rule.alias("rule"), verdict.alias("listed"), tokens_of(F.col("url"), F.col("host"), F.col("path")).alias("tokens")))
    index = fitted(judged.select("page_id", "tokens"), labels).select("parts", F.explode("rarest").alias("token"))
    met = judged.filter("rule is null").select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    blocked = met.filter(F.forall("parts", lambda p: F.arrays_overlap(p, F.col("tokens")))).select("url").distinct().withColumn("blocked", F.lit(True))
    found = judged.join(blocked, "url", "left")
    own = F.when(F.col("blocked"), "block").otherwise("allow")
    return found.select("page_id", "host", "path", "rule", F.coalesce("listed", own).alias("verdict"))


SQL = rf"""
with recursive parsed as (select page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
rules(verdict, h, p) as (values {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}),
listed as (select *, (select max(struct_pack(n := length(h || p), rule := h || p, verdict := r.verdict)) from rules r
    where (host = h or ends_with(host, '.' || h)) and starts_with(path, p)) as hit from parsed),
split as (select *, list_filter(string_split(host, '.'), lambda x: x <> '') as ls,
    regexp_extract(path, '\.([A-Za-z0-9]{{1,8}})$', 1) as ending,
    coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '') as asked from listed),
parts as (select page_id, url, host, path, hit, row_number() over () as r,
    case when len(ls) >= 2 then ['domain ' || array_to_string(ls[-2:], '.')] else [] end
    || list_transform(ls, lambda x: 'host ' || x)
    || list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'path ' || x)
    || case when ending <> '' then ['ending ' || ending] else [] end
    || list_transform(list_filter(list_transform(string_split(asked, '&'), lambda x: string_split(x, '=')[1]), lambda x: x <> ''), lambda x: 'query ' || x) as ts from split),
tokens as (select *, list_distinct(ts) as token_set from parts),
verdicts as (select doc_id as page_id, bool_or(coalesce(quality = 0 or toxic = 1, false)) as bad from labels where doc_id is not null group by 1),
baskets as (select r, token_set, bad from tokens join verdicts using (page_id)),
least as (select greatest({MIN_PAGES}, ceil(count(*) * {int(MIN_SHARE * 1000)} / 1000.0)) as n from baskets),
common as (select t, row_number() over (order by t) as i from (select unnest(token_set) as t, r from baskets) group by t having count(*) >= (select n from least)),
held as (select r, bad, t, i from (select r, bad, unnest(token_set) as t from baskets) join common using (t)),
sets as (select r, bad, [t] as items, i from held union all
    select s.r, s.bad, list_append(s.items, h.t), h.i from sets s join held h on h.r = s.r and h.i > s.i),
mined as (select items from sets group by items
    having count(*) filter (bad) >= (select n from least) and count(*) filter (bad) / count(*) >= {MIN_CONFIDENCE}),
hits as (select distinct r from tokens, mined where hit is null and list_has_all(token_set, items))
select page_id, host, path, hit.rule as rule, coalesce(hit.verdict, case when r in (select r from hits) then 'block' else 'allow' end) as verdict from tokens
"""
