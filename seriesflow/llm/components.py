"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, join_counted, new_path, scratch


def _with_least(edges: DataFrame) -> DataFrame:
    """edges(a, b) with m, the least b of a. The centre of a large star is one key of many rows."""
    least = cut(edges.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("m")), "least")
    return join_counted(edges, least, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both).filter("b > a").select(F.col("b").alias("a"), F.least("least", "a").alias("b")).filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    told = _with_least(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    moved = told.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(told.filter("b = least").select("a", "b")).filter("a <> b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each a has one b, and no b is an a: then every b is the least of its component."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("center")).unionByName(edges.select(F.col("b").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("center")))
    return ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("center").alias("center")).filter("out > 1 or (out = 1 and center = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) of longs -> (node, component), a written table: the smallest node reachable; a row for each node of an edge with a <> b."""
    spark, path = edges.sparkSession, new_path(edges.sparkSession, "components")
    with scratch(spark):
        now = cut(edges.filter("a <> b").select("a", "b"), "edges")
        while True:
            # Small steps first: they direct every edge and drop repeated ones.
            now = cut(_small_star(now), "edges")
            if _are_stars(now):
                break
            now = cut(_large_star(now), "edges")
        leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()).write.parquet(path)
    return spark.read.schema("node long, component long").parquet(path)
