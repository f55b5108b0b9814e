"""Connected components of a table of links, by stars that contract round by round.

Every round joins each node's neighbours to the smallest of them, larger neighbours first, then
smaller ones, until every component is one star; each round is written to the shared folder, so a lost executor
costs one round at most. The number of rounds grows with the logarithm of the longest chain.
Links with a null end, and of a node with itself, are left out; repeated links count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressure.sources.scratch import keep


def _joined(links: DataFrame, node: str, other: str) -> DataFrame:
    """node, other and the smallest of node and its others; a node with very many links is split by adaptive execution."""
    least = links.groupBy(node).agg(F.min(other).alias("least"))
    return links.join(least, node).withColumn("least", F.least("least", node))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _joined(both, "u", "v").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")
    joined = _joined(down, "u", "v")
    to_least = joined.select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = joined.select("u", F.col("least").alias("v"))
    return to_least.unionAll(own).where("u != v").distinct()


def _settled(stars: DataFrame) -> bool:
    """Whether every node has one link to a smaller one at most, and none if a larger one links to it."""
    ends = stars.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        stars.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): the smallest node that each linked node can reach; nodes without links are absent."""
    named = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    stars = keep(_small_star(named.distinct()), "stars")
    while not _settled(stars):
        stars = keep(_small_star(_large_star(stars)), "stars")
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
