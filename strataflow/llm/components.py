"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge table (a, b) of any orderable type; the root is the smallest node it reaches.

    Alternates two star operations: every node points its larger neighbours to its smallest neighbour, then its smaller ones.
    The number of rounds grows with the logarithm of the longest path.  Smallest neighbours are partial minima, and joined
    back, so that a node with many neighbours can be split between tasks.  Every round is a stored table.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        # (u, v): both directions for the large star, edges from larger to smaller nodes for the small one.
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if larger:
            both = both.union(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).select(F.col("u").alias("w"), "m")
        joined = both.join(least, F.col("u") == F.col("w"))
        if larger:
            out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.explode(F.array(F.col("u"), F.col("v"))).alias("a"), F.col("m").alias("b"))
        return out.where(F.col("a") > F.col("b")).distinct()

    now = stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "edges")
    seen = state(now)
    for _ in range(most_rounds):
        now = stored(star(star(now, True), False), "edges")
        fresh = state(now)
        if fresh == seen:
            break
        seen = fresh
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())
