"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakestrata.llm.common import stored


def _measure(edges: DataFrame) -> tuple[int, int]:
    """Count and order-free digest of an edge set (wrapping sum of hashes kept in 31 bits each)."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").bitwiseAND(0x7FFFFFFF)).alias("h")).first()
    return row["n"], row["h"] or 0


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge list; a component is its smallest node.

    Alternating large-star and small-star passes: every pass links a node's larger
    neighbours, then its smaller ones, to the smallest node it sees, until all hang on
    their component's smallest node. Rows stay at most the number of edges, minima are
    combined before the shuffle, and each pass is checkpointed, so the number of passes
    (logarithmic) is all that a long chain costs. Self links and nulls are dropped;
    repeated edges count once; an empty list gives an empty result.
    """
    now = stored(
        edges.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
        .where("a <> b and a is not null and b is not null").distinct()
    )
    state = _measure(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        reached = _measure(after)
        now = after
        if reached == state:
            break
        state = reached
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
