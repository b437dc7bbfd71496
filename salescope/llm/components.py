"""Connected components of an edge table, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the least of u and all its neighbours. The
    join has one row per node on one side, so AQE splits a node of many edges."""
    least = staged(edges.groupBy("u").agg(F.min("v").alias("least")).withColumn("m", F.least("u", "least")).select(F.col("u").alias("_u"), "m"), "cc-least")
    return edges.join(least, edges["u"] == least["_u"]).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v): the least node of its
    component. Each step is written to the shared folder; the edges of a step
    are stars in the end, and it ends when a step changes nothing."""
    e = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = staged(_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "cc-large")
        small = _least(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        e = staged(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "cc-edges")
        now = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == mark or not now[0]:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
