"""Connected components of a graph of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (u, v): link neighbours to the smallest of them and the node.

    Large star: from each node, its larger neighbours. Small star: from each node, its smaller ones
    and itself.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.filter("v < u")
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = near.join(least.withColumnRenamed("u", "of"), F.col("u") == F.col("of"))
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id reachable, itself included.

    Each round is written to the shared folder; the number of rounds grows with the logarithm of the number
    of ids. A node of many links is aggregated before the shuffle, and its join is split by AQE.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()
    edges = saved(edges, "links")
    before = None
    while True:
        # All edges meet at a node without smaller neighbours: every u has one v, and no v is a u.
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        edges = saved(_star(_star(edges, large=True), large=False), "stars")
    labelled = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = labelled.select("component").distinct().select(F.col("component").alias("id"), "component")
    return labelled.unionByName(roots)
