"""Connected components of a graph given as an edge table, by large-star and small-star rounds.

Each round is two grouped minima and joins on the node, so that no group is ever held as a whole; the edge
table of a round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcost.llm.store import drop, save


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node that it reaches."""
    now = save(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = save(large.where(F.col("a") != F.col("b")), "edges")  # every edge points from a node to a smaller one
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        after = save(small.where(F.col("a") != F.col("b")).distinct(), "edges")
        drop(now)
        drop(down)
        now, was, state = after, state, _state(after)
        if state == was:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
