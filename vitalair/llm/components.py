"""Connected components of a large link table: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalair.llm.common import materialise


def _star(pairs: DataFrame) -> DataFrame:
    """For rows (u, v): v and u hang on u's least neighbour or u itself, as (node, root) with node > root."""
    least = materialise(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    hung = pairs.join(least, "u").select(F.explode(F.array("u", "v")).alias("node"), F.col("m").alias("root"))
    return hung.where("node > root").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that is not the least of its component; nodes without links don't appear.

    Each round writes the links that are left to the shared folder; rounds grow
    with the logarithm of the longest chain. No node's neighbours are gathered in
    memory, so a hub only costs rows that a join can split.
    """
    edges = links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).where("node != root").distinct()
    edges = materialise(edges, "links")
    seen = None
    while True:
        n, check = edges.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if not n or (n, check) == seen:
            return edges
        seen = (n, check)
        both = edges.select(F.col("node").alias("u"), F.col("root").alias("v")).union(edges.select(F.col("root").alias("u"), F.col("node").alias("v")))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = materialise(both.join(least, "u").where("v > u").select(F.col("v").alias("node"), F.col("m").alias("root")).distinct(), "large")
        edges = materialise(_star(large.select(F.col("node").alias("u"), F.col("root").alias("v"))), "small")
