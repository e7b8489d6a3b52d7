"""Connected components of links by alternating star steps.

Each step replaces the links of a node by links to its smallest neighbour, with one grouping
and one join; links never grow in number, and the steps needed grow with the logarithm of the
longest chain.  Each step is a written table, so lost executors cost one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_folder, materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are linked to the smallest one."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b), two columns of whole numbers; the
    component is the smallest node reachable.  Loops and repeated links are harmless; links with
    a null end are left out; no links give no rows."""
    spark = links.sparkSession
    now = materialise(links.where("a != b").select("a", "b").distinct(), "links")
    mark = _mark(now)
    while True:
        wide = materialise(_large_star(now), "links")
        new = materialise(_small_star(wide), "links")
        drop_folder(spark, wide)
        drop_folder(spark, now)
        now, old, mark = new, mark, _mark(new)
        if mark == old:
            break
    # Every link now goes from a node to the smallest one of its component.
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()
