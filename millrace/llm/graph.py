"""Connected components of a graph that lives in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut

ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: for each node of an edge the least node it is connected with.

    Alternates large and small stars until the edges no longer change, which takes
    a number of rounds that grows with the logarithm of the graph. Minima are
    added up before the shuffle and joined back, so a node of many edges is never
    gathered in one task. Edges from a node to itself add nothing; without edges
    there are no rows.
    """
    now = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    before = None
    for _ in range(ROUNDS):
        # Large star: every greater neighbour of a node is tied to the least node around it.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: a node and its lesser neighbours are tied to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        now = cut(tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(tied.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
