"""Connected components of links, by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, F.col("a") == F.col("c")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least.withColumnRenamed("a", "c"), F.col("a") == F.col("c")).filter("b <> m")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.withColumnRenamed("m", "b"))


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    `links` has the columns a and b. Stars halve distances, so rounds grow with the
    logarithm of a component's diameter; no node's links are gathered in one place.
    """
    current = staged(links.select("a", "b").filter("a <> b").distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        current = staged(_small_star(_large_star(current).distinct()).distinct(), "links")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
            roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return members.unionByName(roots)
        seen = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
