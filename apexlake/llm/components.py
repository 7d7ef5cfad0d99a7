"""Connected components of a link table, as Spark jobs on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apexlake.session import write_once


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest one."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_least")).withColumn("_least", F.least("u", "_least"))
    least = write_once(least, "least")
    return both.where("v > u").join(least, "u").select(F.col("_least").alias("u"), "v").where("u < v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.col("v").alias("node"), F.col("u").alias("lower"))
    least = write_once(down.groupBy("node").agg(F.min("lower").alias("_least")), "least")
    lower = down.join(least, "node").where("lower > _least").select(F.col("_least").alias("u"), F.col("lower").alias("v"))
    own = least.select(F.col("_least").alias("u"), F.col("node").alias("v"))
    return lower.unionByName(own).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(u, v)``; the root is the smallest node reachable.

    Alternates large-star and small-star until every component is a star
    around its smallest node, which takes a number of rounds that grows with
    the logarithm of its size. Each round is a written table, so no lineage
    builds up and a lost executor costs one round. The joins are inner ones on
    a node, and the aggregate they look up is written before: AQE splits a node
    with very many links only if both sides come straight from a shuffle. Links to itself and null
    ends are dropped; repeated links count once; no links give no rows.
    """
    known = links.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    stars = write_once(known, "links")
    state = _fingerprint(stars)
    while state[0]:
        stars = write_once(_small_star(_large_star(stars)), "stars")
        now = _fingerprint(stars)
        if now == state:
            break
        state = now
    nodes = stars.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return nodes.unionByName(stars.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
