"""Connected components of an edge list by alternating stars, entirely in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.session import cut, discard


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 100) -> DataFrame:
    """node, root for every node of the undirected ``edges``; root is the smallest node reachable.

    Each round hangs larger neighbours on the smallest one (large star), then smaller ones (small
    star); the number of rounds grows with the logarithm of the longest path. Every round is written
    to the shared folder, so neither lineage nor lost executors matter. Null ends and loops are
    ignored; repeated edges are harmless. An empty edge list has no nodes.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    e = cut(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(most_rounds):
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large.filter("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        last, e = e, cut(small.distinct())
        discard(last)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
