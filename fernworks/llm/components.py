"""Connected components of an edge table, by alternating stars, with every round's table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import passing, written

MAX_ROUNDS = 100
#: Neighbours from which a node is a hub; there are at most (twice the edges) / HUB of them.
HUB = 512


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges (a, b) with m from least (a, m, n), n being how many edges a has."""
    hubs = written(least.filter(F.col("n") > HUB).select("a", F.col("m").alias("hub_m")), "hubs")  # its size is known: Spark sends it to the edges where it is small
    rows = edges.join(hubs, "a", "left")
    far = rows.filter("hub_m is not null").select("a", "b", F.col("hub_m").alias("m"))
    near = rows.filter("hub_m is null").select("a", "b").join(least.filter(F.col("n") <= HUB).select("a", "m"), "a")
    return far.unionByName(near.select("a", "b", "m"))


def _round(now: DataFrame) -> DataFrame:
    """One large star and one small star."""
    both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select("a", F.least("a", "m").alias("m"), "n")
    large = _with_least(both, least).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
    large = written(large, "large")  # all point down: a > b
    small = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    moved = _with_least(large, small).filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return written(moved.union(small.select("a", F.col("m").alias("b"))).distinct(), "edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the smallest node of its component.

    Nodes are of any type that can be ordered. A node's smallest neighbour is found by a partial aggregation and joined
    back to its edges; the edges of hubs take it from a small table of their own, and are not brought together by the
    hub for it, so no task has all edges of a node with very many neighbours. The rounds grow as the
    logarithm of the longest path; MAX_ROUNDS only guards against a fault. Repeated edges and loops have no effect.
    """
    edges = written(edges.filter("a is not null and b is not null"), "edges")  # read twice, and maybe dear to make
    nodes = written(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct(), "nodes")
    now = written(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())
    before = mark(now)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        with passing(now.sparkSession) as keep:
            now = keep(_round(now))
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.groupBy("a").agg(F.min("b").alias("root"))
    return nodes.join(roots, nodes["node"] == roots["a"], "left").select("node", F.coalesce("root", "node").alias("root"))
