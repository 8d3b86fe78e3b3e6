"""Connected components of a link table, by alternating star contraction.

Every step is a grouped minimum and a join back on the node; no neighbour
list is ever gathered, so a node with any number of links is fine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flurry.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v) with u > v. Points nodes at the least neighbour."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = both.join(least, "u")
    if large:
        out = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): smallest node reachable, for every node with a link to a smaller one."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges, mark = cut_lineage(edges), None
    while True:
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now
        edges = cut_lineage(_star(_star(edges, True), False))
