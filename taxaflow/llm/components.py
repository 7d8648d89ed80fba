"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaflow.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u and all its v; the least is aggregated before it is joined, so hubs do no harm."""
    least = pairs.groupBy(F.col("u").alias("w")).agg(F.least(F.col("w"), F.min("v")).alias("m"))
    return pairs.join(least, pairs["u"] == least["w"]).select("u", "v", "m")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge (u, v): the smallest node reachable.

    Large-star and small-star steps in turn; every round is a written table, the rounds grow with the logarithm
    of the longest path.
    """
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        seen = tuple(mark)
        large = _with_least(_both_ways(edges)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _with_least(large)
        edges = stored(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
