"""Connected components of a graph of links, by alternating star steps; nothing comes to the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _stars(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Hang the neighbours in ``pairs`` (u, v) on the smallest node among u and its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = pairs.join(least, "u")
    hung = joined.where(F.col("v") > F.col("u")) if larger_only else joined.where(F.col("v") != F.col("m"))
    out = hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not larger_only:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """node and component (smallest node reachable) of every node that has a link to another.

    Large-star and small-star steps in turn; the edges become stars in few rounds, about the logarithm of the
    longest path. Each round is a minimum per node, combined before the shuffle, and a join, whose hot nodes the
    adaptive planner can split. Links to null or to oneself are ignored; an empty table gives no rows.
    """
    edges = links.select(
        F.greatest(left, right).cast("long").alias("u"), F.least(left, right).cast("long").alias("v")
    )
    edges = written(edges.where("u is not null and v is not null and u != v").distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, larger_only=True)
        edges = written(_stars(large, larger_only=False), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
