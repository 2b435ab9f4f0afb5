"""Connected components of a link table by alternating stars.

Each round is two aggregations over the links. All links of a node go to its smallest
neighbour (large star), then links among smaller ones are hung below the smallest
(small star); the number of rounds grows with the logarithm of the longest chain.
No side of a join is broadcast: Spark would size links by their files, and both directions as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwatch.session import store


def _both_ways(links: DataFrame) -> DataFrame:
    pair = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return links.select(pair.alias("x")).select("x.a", "x.b")


def connected_components(links: DataFrame) -> DataFrame:
    """``a, b`` -> ``node, component``: each node that has a link, with the smallest node it reaches.

    Links from a node to itself give a component of that node alone; links with a null
    end are left out; repeated links change nothing. No links give an empty table.
    """
    current = store(
        links.filter("a is not null and b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "components",
    )
    loops = current.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    seen = None
    while True:
        # Large star: a node's larger neighbours are linked to the smallest of it and its neighbours.
        around = _both_ways(current.filter("a < b"))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = around.filter("b > a").join(least.hint("merge"), "a").select(F.col("m").alias("a"), "b").distinct()
        # Small star: of a node's smaller neighbours the smallest gets the node and the others.
        below = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(below.hint("merge"), "b").select(
            F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b")
        )
        current = store(small.filter("a < b").distinct(), "components")
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    stars = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    centres = current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return stars.unionByName(centres).unionByName(loops).groupBy("node").agg(F.min("component").alias("component"))
