"""Adapters that present the benchmark tables as quote streams.

``events``  -> symbol = event_type, price = value, volume = props.k, quote_time = ts,
               day_volume = running sum of volume per (symbol, UTC day) in (ts, event_id) order.
``lineitem`` -> symbol = supplier key, price = extended price / quantity (unit price),
               volume = quantity, quote_time = ship date (midnights: many time ties),
               day_volume = running sum per (symbol, day) in (orderkey, linenumber, other columns) order.

Both keep the canonical QUOTE columns; timestamps become TIMESTAMP (UTC session).
The running day volume is an ``ordered_scan`` over a symbol's day; ``block`` (a unit of time)
splits that further.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotebars.operators.sequence import ordered_scan
from quotebars.schemas import DECIMAL
from quotebars.session import configure

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quotes_from_events(spark: SparkSession, sf_dir: str, with_day_volume: bool = True,
                       block: str | None = None) -> DataFrame:
    configure(spark)
    ev = read_table(spark, sf_dir, "events")
    # the running day volume is computed on narrow primitive columns (cheap to move
    # through Arrow); decimals and strings are derived afterwards
    base = ev.select(
        F.col("event_type").alias("symbol"),
        F.col("value"),
        F.get_json_object(F.col("props"), "$.k").try_cast("bigint").alias("_units"),
        F.col("ts"),
        F.to_date(F.col("ts")).alias("_day"),
        F.col("event_id"),
    )
    if with_day_volume:
        base = ordered_scan(base, ["symbol", "_day"], ["ts", "event_id"], "_units", running_sum="day_volume",
                            block=F.date_trunc(block, "ts") if block else None)
    else:
        base = base.withColumn("day_volume", F.lit(None).cast("bigint"))
    return base.select(
        "symbol",
        F.col("value").try_cast(DECIMAL).alias("price"),
        F.col("_units").cast(DECIMAL).alias("volume"),
        F.col("day_volume").cast("bigint").alias("day_volume"),
        F.col("ts").cast("timestamp").alias("quote_time"),
        F.col("ts").cast("timestamp").alias("ingest_time"),
        F.lit("events").alias("source"),
    )


_LINEITEM_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
                   "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def quotes_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    li = read_table(spark, sf_dir, "lineitem")
    base = li.select("l_suppkey", "l_shipdate", F.to_date("l_shipdate").alias("_day"),
                     F.col("l_quantity").cast("bigint").alias("_units"), *_LINEITEM_ORDER)
    # every remaining column breaks ties, so only fully identical rows can swap places
    base = ordered_scan(base, ["l_suppkey", "_day"], ["l_shipdate", *_LINEITEM_ORDER], "_units",
                        running_sum="day_volume")
    return base.select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        (F.col("l_extendedprice") / F.col("l_quantity")).cast(DECIMAL).alias("price"),
        F.col("l_quantity").cast(DECIMAL).alias("volume"),
        F.col("day_volume").cast("bigint").alias("day_volume"),
        F.col("l_shipdate").cast("timestamp").alias("quote_time"),
        F.col("l_shipdate").cast("timestamp").alias("ingest_time"),
        F.lit("lineitem").alias("source"),
    )
