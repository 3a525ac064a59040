"""Connected components by alternating stars: every step is a minimum per node and a join, so a node
with many neighbours is never gathered, and a path of n nodes takes about log n rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lychgate.llm.common import written


def _with_least(edges: DataFrame) -> DataFrame:
    """edges (u, v) with m, the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): the smallest node reachable. Null ends are left out."""
    flat = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    now, before = written(flat, "edges"), None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _with_least(large)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v")))
        now = written(small.where("u > v").distinct(), "edges")
        told = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if told == before:
            break
        before = told
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))
