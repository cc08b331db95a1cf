"""Connected components of links, by alternating large and small stars.

Each round is an aggregation (minimum neighbour of a node, combined before the shuffle) and an
equality join; a node with very many links is only ever reduced to a minimum. Rounds are written to
the shared folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msglog.sources.store import saved


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) of every linked node but the roots; ``links(node, root)`` are long pairs in
    any direction, repeats and self-links allowed. The root is the component's smallest node."""
    links = links.where("node is not null and root is not null and node <> root").select(
        F.greatest("node", "root").alias("node"), F.least("node", "root").alias("root"))
    edges, mark = _round(links.distinct())
    while True:
        edges, now = _round(_small(_large(edges)))
        if now == mark:
            return edges
        mark = now


def _round(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = saved(edges, "links")
    mark = edges.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
    return edges, tuple(mark)


def _large(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    low = both.groupBy("node").agg(F.min("root").alias("low")).select(
        F.col("node").alias("root"), F.least("low", "node").alias("low"))
    # (node > root): the larger end meets what the smaller end knows.
    return edges.join(low, "root").select("node", F.col("low").alias("root")).where("node <> root").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    low = edges.groupBy("node").agg(F.min("root").alias("low"))
    others = edges.join(low, "node").where("root <> low").select(
        F.col("root").alias("node"), F.col("low").alias("root"))
    return others.union(low.select("node", F.col("low").alias("root"))).distinct()
