"""Connected components by alternating large and small stars.

Every step is an aggregation with partial sums and an equi-join on the edges, so no node's
neighbours are ever gathered in one place. Each round's edges are written to the shared
folder, which cuts the lineage and lets a lost task be redone from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (a, b) with a > b: every node's neighbours move to its smallest one."""
    both = edges.select("a", "b")
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if large:  # neighbours above the node
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:      # neighbours below the node, and the node itself
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            joined.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, root: str) -> DataFrame:
    """(node, component): for every node with an edge, the smallest node that it reaches.

    Edges (a, b) are undirected; loops and repeated edges change nothing."""
    spark = edges.sparkSession
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before, step = None, 0
    while True:
        path = f"{root}/stars-{step}"
        now.write.parquet(path)
        now = spark.read.schema("a long, b long").parquet(path)
        mark = _mark(now)
        if mark == before or not mark[0]:
            break
        before = mark
        now = _star(_star(now, large=True), large=False)
        step += 1
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
