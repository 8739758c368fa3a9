"""Places in a sorted order, group by group, without a group in one task: rows are written, dealt by
range and sorted; a row's number within its file comes with the file, and one narrow row for each
(group, file) tells where the group begins there."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sort_files(rows: DataFrame, keys: list[str], path: str) -> DataFrame:
    """``rows``, written once and then as files sorted by ``keys``, with ``at``: number of the file and of
    the row in it. Nulls come first. A group with most of the rows is spread over many files."""
    spark = rows.sparkSession
    rows.write.parquet(f"{path}/rows")      # so that what the rows are made from is read once
    rows = spark.read.parquet(f"{path}/rows")
    parts = max(rows.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    (rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
     .write.parquet(f"{path}/sorted"))
    return spark.read.parquet(f"{path}/sorted")


def rank(sorted_rows: DataFrame, group: str) -> DataFrame:
    """Files of ``sort_files`` by (``group``, ...) with ``rank``, from 0 in each group, and ``n``, the rows of the
    group. ``group`` has no nulls."""
    placed = sorted_rows.withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy(group, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    own = Window.partitionBy(group)
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select(group, "part", "first", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("begin"),
                          F.sum("held").over(own).alias("n"))
    return (placed.join(begins, [group, "part"])
            .withColumn("rank", F.col("begin") + F.col("at") - F.col("first")).drop("at", "part", "first", "begin"))
