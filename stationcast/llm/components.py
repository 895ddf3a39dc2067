"""Connected components of an edge table by alternating stars (Kiveris and others, 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.support import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are tied to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are tied to the smallest of them. Edges run from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u")
    own = least.select("u", F.col("m").alias("v"))
    return tied.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) for every node of the edges (u, v: long). Nodes of a few hops
    from each other meet in a few rounds; each round is written, and the driver sees two numbers of it."""
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = written(edges, "components"), None
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
        edges = written(_small_star(_large_star(edges)), "components")
    # a finished forest holds stars: every other node points to the smallest
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
