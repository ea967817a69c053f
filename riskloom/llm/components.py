"""Connected components of an edge table by alternating stars, without collecting edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's neighbours to the least of them: the larger ones (large), or itself and the smaller."""
    if large:
        links = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        links = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = links.groupBy("u").agg(F.min("v").alias("low"))
    joined = links.join(least, "u").withColumn("low", F.least("u", "low"))
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("low").alias("v"))
        moved = moved.union(least.select("u", F.col("low").alias("v"))).distinct()
    return moved.filter("u <> v")


def _all_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge up, to a node that has none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up = 1 AND down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of the edges (u, v); component is the least node that links reach.

    Repeats rounds of stars until only stars are left; their number grows with the logarithm of the
    nodes. Empty edges give an empty table.
    """
    now = edges.filter("u <> v").select("u", "v")
    while True:
        now = stored(_stars(_stars(now, True), False), "stars")
        if _all_stars(now):
            break
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("v", "v"))
