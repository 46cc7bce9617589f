"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_out


def _star(near: DataFrame) -> DataFrame:
    """``u, v`` with ``low``, the smallest of u and its given neighbours. The minimum is aggregated before
    the join, so a node with most of the links is one row of it and the join's other side may be split."""
    low = near.groupBy("u").agg(F.min("v").alias("low"))
    return near.join(low, "u").withColumn("low", F.least("low", "u"))


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest one."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    starred = _star(links)
    moved = starred.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(starred.select("u", F.col("low").alias("v")))
    return moved.filter("u > v").distinct()


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """``node, component`` of every linked node; the component is its smallest node.

    ``links`` has ``u, v``; order, repetition and loops don't matter. Each round is written, so a lost
    executor costs one round; the number of rounds grows with the logarithm of the number of nodes.
    """
    now = write_out(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "links")
    for _ in range(most):
        # connectivity is kept throughout, so it is done once every node links only to its smallest one
        if now.join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty() and now.groupBy("u").count().filter("count > 1").isEmpty():
            break
        now = write_out(small_star(large_star(now)), "links")
    else:
        raise RuntimeError(f"no end after {most} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
