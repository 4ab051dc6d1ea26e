"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so a vertex with very many links is reduced
before the shuffle and split by adaptive execution after it. The driver sees two numbers
per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """`v, c` for every vertex of `links` (columns a and b, longs): its component's least vertex."""
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    last = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    roots = edges.select(F.col("v").alias("v"), F.col("v").alias("c")).distinct()
    return edges.select(F.col("u").alias("v"), F.col("v").alias("c")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex hands its least neighbour to its greater neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex joins its lesser neighbours and itself to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
