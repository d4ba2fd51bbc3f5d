"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: A node with more edges than this is a hub: its edges are not shuffled to one task.
HUB = 1 << 20


def _with_least(edges: DataFrame, hub: int) -> DataFrame:
    """``edges`` (u, v) with ``m``, the least of u's neighbours and u itself.

    A hub's minimum goes to its edges by broadcast; there are at most ``count(edges) / hub`` hubs.
    All other nodes' edges meet it in a join on the node.
    """
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    marked = edges.join(F.broadcast(least.where(F.col("n") > hub).select("u", F.col("m").alias("hub_m"))), "u", "left")
    cold = marked.where("hub_m is null").select("u", "v").join(least.where(F.col("n") <= hub).select("u", "m"), "u").select("u", "v", "m")
    return cold.union(marked.where("hub_m is not null").select("u", "v", F.col("hub_m").alias("m")))


def connected_components(edges: DataFrame, hub: int = HUB) -> DataFrame:
    """``node``, ``root`` (smallest node of its component) for every node of ``src``, ``dst``.

    Nodes are of any type that Spark orders.  Large-star and small-star steps (Kiveris et al. 2014)
    go on until nothing changes: each step is a grouped minimum and a join on the node, so that no
    group is ever gathered.  Null ends and loops are ignored.
    """
    edges = edges.where("src is not null and dst is not null and src <> dst")
    both = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()
    state = materialise(both, "components")
    seen = None
    while True:
        # large star: each larger neighbour is hung on the smallest one
        around = state.select("u", "v").union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(around, hub).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: each smaller neighbour, and the node itself, is hung on the smallest one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_least(large, hub).select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        state = materialise(small.where("u <> v").distinct(), "components")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
    roots = state.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.union(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
