"""Connected components of a table of links, by alternating large-star and small-star rounds.

Each round is two joins of the links with one minimum per node; its links are written to the
shared folder.  Links turn into stars around each component's smallest node in a number of
rounds that grows with the logarithm of the longest path.  Nothing but a count and a checksum
reaches the driver; a hub's links are aggregated before they are shuffled.  The minimum of every node is
dealt anew before it is joined, so that both sides of the join are plain exchanges: then a hub's links are split over
tasks (AQE's skew join, which does not see through an aggregate)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, written


def _large(links: DataFrame, n: int) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).repartition(n)
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame, n: int) -> DataFrame:
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    over = links.join(low.repartition(n), "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return over.union(low.select("u", F.col("m").alias("v")))


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(node, component) for every node of links (u, v): the smallest node it reaches."""
    links = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    n, mark = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions")), None
    for _ in range(most):
        before, links = links, written(_small(_large(links, n), n).where("u <> v").distinct(), "links")
        removed(before)
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components not settled after {most} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
