import numpy as np
import xxhash
from pyspark.sql import functions as F

from panelweave.llm import near_duplicates as N
from panelweave.llm.graph import components


def plain(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(ids, prints):
    """component_id by brute force over all pairs."""
    parent = list(range(len(ids)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(ids)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= 3:
                parent[root(a)] = root(b)
    names = {}
    for k, i in enumerate(ids):
        if i is not None:
            names[root(k)] = min(i, names.get(root(k), i))
    return [names.get(root(k)) for k in range(len(ids))]


def same(df, source):
    rows = source.select("doc_id", "text").collect()
    prints = [plain(r["text"]) for r in rows]
    want = sorted(map(str, zip([r["doc_id"] for r in rows], [f"{p:016x}" for p in prints], grouped([r["doc_id"] for r in rows], prints))))
    assert sorted(str(tuple(r)) for r in df.select("doc_id", "fingerprint", "component_id").collect()) == want


def test_all_given_documents(given):
    same(N.digest(given("documents")), given("documents"))


def test_edges(documents):
    docs = documents(
        (3, None, "a"), (1, "", "a"), (9, " \n\t", None), (4, "one", "a"), (5, "ONE", "a"), (6, "one two", "a"), (2, "Éa b c d e f", "a"),
        (7, "Éa B c d e f", "b"), (7, "Éa B c d e f", "b"), (None, "x y z w", "b"), (None, "x y z w", "b"), (8, "éa b c d e f", "b"), (10, "a b " * 40_000, "a"),
    ).withColumn("fp", F.lit(1)).withColumn("root", F.lit("x"))
    same(N.digest(docs), docs)
    kept = [r["doc_id"] for r in N.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([1, 4, 6, 2, None, 8, 10], key=str)
    assert N.keep_one(docs).columns == docs.columns


def test_empty(documents):
    docs = documents("x").filter("false")
    assert N.digest(docs).count() == 0 and N.keep_one(docs).count() == 0


def test_spark_hash_is_the_same(spark):
    row = spark.sql("select xxhash64('a b c') as h").first()
    assert row["h"] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_crowded_blocks(spark, monkeypatch):
    """Blocks beyond CROWD are cut anew and lose no link."""
    monkeypatch.setattr(N, "CROWD", 4)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 6, dtype="u8")
    prints = {int(b) for b in base}
    for b in base:
        here = int(b)
        for _ in range(40):  # chains of small steps, and small steps from the middle
            near = here
            for bit in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                near ^= 1 << int(bit)
            prints.add(near)
            here = near if rng.random() < 0.3 else int(b)
    signed = [int(np.array(p, "u8").view("i8")) for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    found = {r["node"]: r["root"] for r in components(N.links(df)).collect()}
    want = grouped(signed, [p % 2**64 for p in signed])
    assert {p: found.get(p, p) for p in signed} == dict(zip(signed, want))


def test_components(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(1, 2), (5, 2), (7, 7), (900, 1000), (1000, 950)] + [(0, k) for k in range(2000, 2050)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[k] for k in range(100, 161)} == {100}
    assert found[5] == found[1] == 1 and found[950] == found[1000] == 900 and found[2049] == 0 and 7 not in found
