"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) edges to (node, component): component is the smallest node reachable.

    Each half round is a group-by with a join back on the same key: no neighbour
    list is ever held in one row, and minima are pre-aggregated before the
    shuffle. Ends when a round changes nothing; self-loops and repeated edges are
    harmless. Nodes without an edge are absent from the result.
    """
    edges = edges.select("u", "v").filter("u <> v").distinct()
    edges = stored(edges)
    sign = _sign(edges)
    for _ in range(max_rounds):
        if sign[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
        edges = stored(small.filter("u <> v").distinct())
        now = _sign(edges)
        if now == sign:
            break
        sign = now
    else:
        raise RuntimeError("components did not settle")
    # Settled: every edge leads from a node to its component's smallest.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
