"""Connected components of a link table, by alternating large and small stars.

Only joins and sums of links are used: no component is gathered anywhere, and a node with very many links
is a skewed join key that adaptive execution splits. Every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlake.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``); the root is the component's smallest node.

    Links from a node to itself, repeated links and NULLs are ignored. No links give no rows.
    """
    links = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            # Every node now points at its root.
            roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state
        links = stage(_small_star(stage(_large_star(links), "links")), "links")


def _large_star(links: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to its smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return (
        both.where("b > a").join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
