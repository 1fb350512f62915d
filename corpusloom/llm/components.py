"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a pair of aggregations and joins over the links, so no component is gathered in a task or on the driver; the
links shrink to stars around each component's least node in a number of rounds logarithmic in its size. Each round's links
are written to the shared folder. Only two numbers a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import stash


def _large_star(links: DataFrame) -> DataFrame:
    """Joins each node's larger neighbours to the least of the node and its neighbours."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Joins each node and its smaller neighbours to the least of these. Links point from the larger node to the smaller."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
    moved = links.join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct()


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the least node reachable, for every node that has a link to another."""
    now = stash(links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct())
    state = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = state(now)
    while before[0]:
        now = stash(_small_star(_large_star(now)))
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
