"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialise


def _to_least(links: DataFrame) -> DataFrame:
    """Each node's neighbours with the least node among them and itself."""
    least = links.groupBy("u").agg(F.min("v").alias("_least"))
    return links.join(least, "u").select("u", "v", F.least("u", "_least").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """For links that lead from the larger to the smaller node."""
    near = _to_least(links)
    moved = near.filter("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(near.select("u", F.col("least").alias("v"))).filter("u != v").distinct()


def connected(links: DataFrame) -> DataFrame:
    """``node, root``: the least node of the component of every node that has a link to another one.

    ``links`` has two columns of whole numbers, in any direction, repeated or not; null
    ends and links of a node to itself are left out.  Alternates large and small stars
    until nothing changes; the rounds grow with the logarithm of the longest chain.  Each
    round is written to the shared folder, so lost executors cost one round at most.
    """
    a, b = links.columns
    fresh = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).isNull() | F.col(b).isNull())
    fresh = fresh.filter("u != v").filter(~fresh[fresh.columns[2]]).select("u", "v").distinct()
    seen = None
    while True:
        fresh = materialise(_small_star(_large_star(fresh)), "links")
        state = fresh.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return fresh.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
