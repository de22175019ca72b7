"""Connected components of an undirected graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.session import stage

ROUNDS = 60


def _hook(edges: DataFrame, keep) -> DataFrame:
    """Every neighbour that ``keep`` takes is tied to the least node of its star."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return edges.join(least, "a").filter(keep).select(F.col("b").alias("x"), F.col("m").alias("y"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _downward(pairs: DataFrame) -> DataFrame:
    """Distinct (a, b) with a > b."""
    return pairs.filter("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the component's least node.

    Alternates large stars (larger neighbours move to the least) and small
    stars (smaller neighbours do) until every component is one star. Stars are
    reduced by a minimum before they meet their edges, and the join splits at
    run time where one node has very many edges. Each round is staged.
    """
    current = stage(_downward(edges.select(F.col("a").alias("x"), F.col("b").alias("y"))))
    mark = None
    for _ in range(ROUNDS):
        large = _downward(_hook(_both(current), F.col("b") > F.col("a")))
        own = large.groupBy("a").agg(F.min("b").alias("y")).select(F.col("a").alias("x"), "y")
        small = _downward(_hook(large, F.col("b") > F.col("m")).union(own))
        current = stage(small)
        seen = current.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if seen == mark:
            roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
        mark = seen
    raise RuntimeError(f"components not settled after {ROUNDS} rounds")
