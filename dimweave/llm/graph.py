"""Connected components as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import checkpoint

#: Rounds after which something must be wrong: the number needed grows with
#: the logarithm of the longest path.
MAX_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of the
    undirected ``edges`` (a, b: long).

    Alternates two steps until no edge moves: every neighbour above a node is
    hung on the node's smallest neighbour, then every node and its neighbours
    below are.  Minima are partial aggregates, so a hub is cut down before the
    shuffle; each round is checkpointed.
    """
    now = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Here every a has only smaller neighbours b.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(low, "a")
        now = checkpoint(hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m")).where("a <> b").distinct())
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    # Now every edge leads from a node to its component.
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
