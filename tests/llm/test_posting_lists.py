import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.llm import posting_lists as P

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def exact(ids, vectors, every=20, top=20):
    v = np.array(vectors, "f4").astype("f8")
    out = {}
    for k, i in enumerate(ids):
        if i % every == 0:
            score = [float(sum(a * b for a, b in zip(v[k], w))) for w in v]
            order = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-score[j], ids[j]))[:top]
            out[i] = [(ids[j], score[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in best}) / len(best) for q, best in want.items()])


@pytest.mark.parametrize("small_lists", [False, True])
def test_given_embeddings(spark, monkeypatch, small_lists):
    if small_lists:
        monkeypatch.setattr(P, "LIST", 32)
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = df.collect()
    want = exact([r["vec_id"] for r in rows], [r["embedding"] for r in rows])
    got = found(P.nearest(df))
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    assert recall(got, want) >= 0.9
    for q, near in got.items():
        scores = dict(want[q])
        assert all(scores[i] == s for i, s in near if i in scores)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))


def test_unequal_lengths_of_vectors_and_clusters(spark, monkeypatch):
    monkeypatch.setattr(P, "LIST", 40)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16)) * 4
    v = centres[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 16)) * rng.choice([0.2, 2], (1500, 1))
    rows = [(k, [float(x) for x in w], 0) for k, w in enumerate(v)]
    got = found(P.nearest(spark.createDataFrame(rows, SCHEMA)))
    assert recall(got, exact(range(1500), [r[1] for r in rows])) >= 0.9


def test_copies_ties_and_bad_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [1.0, 2.0], 0) for k in range(100)] + [(k, [2.0, 1.0], 0) for k in range(100, 110)]
    bad = [(200, None, 0), (220, [], 0), (240, [0.0, -0.0], 0), (260, [nan, 1.0], 0), (280, [inf, 1.0], 0), (300, [None, 1.0], 0), (320, [1.0], 0), (None, [1.0, 1.0], 0)]
    df = spark.createDataFrame(rows + bad + rows[:3], SCHEMA).withColumn("query_id", F.lit("x")).withColumn("id", F.lit(1))
    assert found(P.nearest(df)) == exact([r[0] for r in rows], [r[1] for r in rows])


def test_no_row_for_each_query_and_list(spark, monkeypatch):
    for name, value in {"LIST": 8, "SAMPLE": 256, "FIRST": 1 << 10, "TASK": 1 << 12, "PIECES": 1 << 11}.items():
        monkeypatch.setattr(P, name, value, raising=False)
    written = []
    stage = P.stage

    def counted(df):
        out = stage(df)
        written.append(out.count() if "v" in out.columns else 0)
        return out

    monkeypatch.setattr(P, "stage", counted)
    v = np.random.default_rng(2).normal(size=(1500, 16))
    rows = [(k, [float(x) for x in w], 0) for k, w in enumerate(v)]
    got = found(P.nearest(spark.createDataFrame(rows, SCHEMA)))
    want = exact(range(1500), [r[1] for r in rows])
    assert all(len(got[q]) == 20 for q in want) and recall(got, want) >= 0.9
    assert sum(written) <= 4 * len(rows)


def test_vectors_alike_in_short_floats_and_no_queries(spark, monkeypatch):
    for name, value in {"LIST": 128, "SAMPLE": 64, "PAIRS": 1 << 12}.items():
        monkeypatch.setattr(P, name, value, raising=False)
    v = 1 + np.random.default_rng(3).normal(size=(600, 8)) * 1e-6
    rows = [(k, [float(x) for x in w], 0) for k, w in enumerate(v)]
    wide = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = found(P.nearest(wide))
    for q, near in got.items():
        scores = sorted(((float(sum(a * b for a, b in zip(v[q], w))), -k) for k, w in enumerate(v) if k != q), reverse=True)[:20]
        assert [i for i, _ in near] == [-k for _, k in scores]
    assert len(got) == 30
    assert P.nearest(wide.filter("vec_id % 20 <> 0")).count() == 0


def test_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (20, [0.0, 3.0], 0)], SCHEMA)
    assert found(P.nearest(few)) == {0: [(1, 0.5), (20, 0.0)], 20: [(1, 1.5), (0, 0.0)]}
    assert P.nearest(few.filter("false")).count() == 0
    assert P.nearest(few.filter("vec_id = 0")).count() == 0
