"""Connected components of a graph of links, by alternating large-star and small-star steps.

Each step is a grouping by node and a join with the group's smallest neighbour;
no component is ever gathered in one place. A node with very many neighbours
is aggregated before the shuffle, and the join's hot key is split by adaptive
execution. The links shrink towards stars around each component's smallest
node, in a number of rounds logarithmic in the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")).collect()[0]
    return row["n"], row["h"]


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link to another node; root is the smallest node it reaches."""
    edges = cut(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = _checksum(edges)
    while before[0]:
        # Large star: the neighbours larger than a node are linked to the smallest node near it.
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        after = _checksum(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
