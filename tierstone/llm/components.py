"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.sources.shared import cut_lineage


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Hang each node's neighbours (large: the greater ones, small: the lesser ones and itself) on its least one."""
    if large:
        seen = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hung = seen.join(seen.groupBy("u").agg(F.min("v").alias("least")), "u").where("v > u")
        pairs = hung.select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("least"))
        pairs = links.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        pairs = pairs.union(least.select("u", F.col("least").alias("v")))
    return pairs.where("u > v").distinct()


def components(links: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component) for each node with a link; a component is named by its least node.

    Each round makes, for all nodes at once, stars around the least neighbour, and is stored in the shared folder,
    so that neither lineage nor a lost executor undoes it. Minima are combined before the shuffle and joins on a
    node with many links can be split, so a hub is no bottleneck. It ends when a round changes nothing.
    """
    pairs = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u > v").distinct()
    now = cut_lineage(pairs)
    before = None
    while True:
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(row) == before:
            break
        before = tuple(row)
        now = cut_lineage(_stars(_stars(now, large=True), large=False))
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
