"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.session import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of ``edges`` that has an
    edge to another node.  Edges are undirected; self loops, repeated edges and edges with a
    null end are ignored, and an empty table gives no row.

    Each round is two aggregations with partial minima and joins back to the edges, written
    to the shared folder; the number of rounds grows with the logarithm of the component's
    size.  A hot node's edges are split by the engine's skew handling."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        "u <> v").distinct()  # a null end makes the comparison null
    e = materialize(e)
    state = None
    while True:
        now = e.agg(F.count(F.lit(1)).alias("n"),
                    F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if now == state or not now["n"]:
            break
        state = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
