"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekin.staging import stage_table


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the least node reached.

    Alternates large-star and small-star steps (a logarithmic number of rounds) on
    written tables of links from a larger node u to a smaller one v.  A node's least
    neighbour is among its v, so each step sums up by u alone, in part before the shuffle.
    Nothing is collected and a node with many links is only summed up and joined.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges = stage_table(edges, "links")
    state = None
    while True:
        # large star: u goes to the least neighbour of its v
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        large = edges.join(least.withColumnRenamed("u", "v"), "v", "left").select("u", F.coalesce("m", "v").alias("v"))
        # small star: u and all its v go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.explode(F.array("u", "v")).alias("u")
        small = large.join(least, "u").select(ends, F.col("m").alias("v")).where("u != v").distinct()
        edges = stage_table(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
