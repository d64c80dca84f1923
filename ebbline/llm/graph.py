"""Connected components of an edge list, in rounds that halve the paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.session import settle


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge, the component being its smallest node.

    Alternates large and small stars: each round ties a node's larger neighbours, then its smaller ones, to the
    smallest it knows.  A node of many edges is only ever aggregated and joined, never gathered.  Rounds are written,
    so that no plan grows.  Null ends and loops are left out.
    """
    current = settle(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct())
    while not _done(current):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        current = settle(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())


def _done(edges: DataFrame) -> bool:
    """Whether the edges are stars: every larger end has one edge, and no smaller end is another's larger end."""
    both = [F.struct(F.col(n).alias("node"), F.lit(k).alias("larger")) for n, k in (("u", 1), ("v", 0))]
    ends = edges.select(F.explode(F.array(*both)).alias("end")).select("end.*").groupBy("node")
    ends = ends.agg(F.sum("larger").alias("n"), F.min("larger").alias("also"))
    return ends.where("n > 1 or n = 1 and also = 0").isEmpty()
