"""Connected components by alternating large-star and small-star steps.

Each step is a minimum per node (partially aggregated) and a join of the
edges with it, so a node with very many edges is never gathered; edges stay
in tables and the driver only sees their count and checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import forget, store_at


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
    least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
    return (both.filter("u > v").join(least, "v")
            .select(F.col("u").alias("v"), F.col("m").alias("u")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    moved = edges.join(least, "v").filter("u > m").select(F.col("u").alias("v"), F.col("m").alias("u"))
    return moved.unionByName(least.withColumnRenamed("m", "u")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns);
    component is the smallest node reachable. Loops, repeats and either
    direction are fine; a row with a null end is no edge. No edges, no rows."""
    a, b = (F.col(c) for c in edges.columns)
    edges = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).filter(a.isNotNull() & b.isNotNull() & (a != b)).distinct()
    edges, path = store_at(edges, "edges")
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == seen:
            break
        seen = mark
        edges, newer = store_at(_small_star(_large_star(edges)), "edges")
        forget(edges.sparkSession, path)
        path = newer
    stars = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return stars.unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
