from collections import Counter
from itertools import chain, combinations

from pyspark.sql import functions as F

from panelweave.llm import url_rules as U

URLS = [
    "https://www.example.com/en/1", "https://blog.example.com/en/1", "HTTP://Example.COM/en", "http://notexample.com/en/1", "http://a.net/es/x", "http://a.net/fr/?q#f",
    "http://net/es/", "http://a.org/en/", None, "", "no scheme", "http://x.com", "http://x.com?a://b/c", "://h/p", "http://É.COM/ß", "http://a.org/" + "x" * 100_000, "http://a.org/b\nc?d#e",
]


def test_fixed_rules(spark):
    pages = spark.createDataFrame([(k, u, "<p>") for k, u in enumerate(URLS)] + [(None, URLS[0], None)], "page_id bigint, url string, html string").withColumn("host", F.lit(1))
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = {r["page_id"]: tuple(r)[1:] for r in U.digest(pages, labels).collect()}
    assert out[0] == out[None] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert out[1] == ("blog.example.com", "/en/1", "example.com/en/", "block")
    assert out[2] == ("example.com", "/en", "com/", "allow") and out[3] == ("notexample.com", "/en/1", "com/", "allow")
    assert out[4][2:] == ("net/es/", "block") and out[5] == ("a.net", "/fr/", "net/fr/", "block") and out[6][2:] == ("net/es/", "block")
    assert out[7] == ("a.org", "/en/", None, "allow")
    assert out[8] == out[9] == out[10] == ("", "", None, "allow")
    assert out[11] == ("x.com", "", None, "allow") and out[12] == ("x.com", "", None, "allow") and out[13] == ("h", "/p", None, "allow")
    assert out[14] == ("É.com".replace("É", "É"), "/ß", "com/", "allow") and out[15][1] == "/" + "x" * 100_000 and out[16] == ("a.org", "/b\nc", None, "allow")
    assert U.digest(pages.filter("false"), labels).count() == 0


def test_mined_rules(spark):
    """The mined combinations, and what they block, against all subsets of all labelled URLs."""
    urls = [f"http://{['ads', 'm', 'www'][k % 3]}.site{k % 4}.org/{['en', 'shop'][k % 2]}/{k}?{['ref', 'page'][k % 5 == 0]}=1" for k in range(240)]
    pages = spark.createDataFrame([(k, u, "") for k, u in enumerate(urls)] + [(k, urls[k], "") for k in range(3)], "page_id bigint, url string, html string")
    bad = [k for k in range(200) if (k % 3 == 0 and k % 2 == 1) or k % 17 == 0]
    labels = spark.createDataFrame([(k, int(k not in bad), 0) for k in range(200)] + [(None, 0, 1), (5, None, None), (900, 0, 0)], "doc_id bigint, quality int, toxic int")
    tokens = {r["page_id"]: frozenset(r["t"]) for r in pages.select("page_id", U.tokens_of(F.col("url"), U.host_of(F.col("url")), U.path_of(F.col("url"))).alias("t")).collect()}
    every, wrong = Counter(), Counter()
    for k in [*range(200), *range(3)]:
        for items in chain.from_iterable(combinations(sorted(tokens[k]), n) for n in range(1, len(tokens[k]) + 1)):
            every[items] += 1
            wrong[items] += k in bad
    rules = {frozenset(i) for i, n in wrong.items() if n >= U.MIN_PAGES and n / every[i] >= U.MIN_CONFIDENCE}
    assert rules
    got = U.mined(pages.select("page_id", U.tokens_of(F.col("url"), U.host_of(F.col("url")), U.path_of(F.col("url"))).alias("tokens")), labels)
    assert {frozenset(r["items"]) for r in got.collect()} == rules
    blocked = {k for k, t in tokens.items() if any(r <= t for r in rules)}
    out = U.digest(pages, labels).collect()
    assert len(out) == 243 and {r["page_id"] for r in out if r["verdict"] == "block"} == blocked


def test_late_tokens_count(spark):
    """Bad pages told by a query name behind a long shared path only: at place 40, with thousands of millions of combinations before it."""
    deep = "/".join(f"s{k}" for k in range(36))
    pages = spark.createDataFrame([(k, f"http://a.site.org/{deep}/{k}?{['fine', 'evil'][k % 2]}=1", "") for k in range(60)] + [(60, "http://b.org/?evil", "")], "page_id bigint, url string, html string")
    labels = spark.createDataFrame([(k, 1 - k % 2, 0) for k in range(40)], "doc_id bigint, quality int, toxic int")
    out = {r["page_id"]: r["verdict"] for r in U.digest(pages, labels).collect()}
    assert out == {k: "block" if k % 2 or k == 60 else "allow" for k in range(61)}
