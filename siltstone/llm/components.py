"""Connected components of an edge table by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove_folder, shared_folder, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the (a, b) edges; the label is the component's least node.

    Minima combine on the map side and rejoin by key, so no task gathers a component. Each round is
    written to the shared folder.
    """
    spark = edges.sparkSession
    folder = shared_folder(spark)
    now = written(edges.filter("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")), folder, "edges")
    seen = None
    while True:
        after = written(_small_star(_large_star(now)), folder, "round")
        mark = tuple(after.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(pmod(xxhash64(v, u), 1000003))")).first())
        if mark == seen:
            break
        now, seen = after, mark
    labels = after.union(after.select(F.col("v").alias("u"), "v")).groupBy("u").agg(F.min("v").alias("label"))
    result = written(labels.withColumnRenamed("u", "node"))
    remove_folder(spark, folder)
    return result
