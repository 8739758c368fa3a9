"""Fixture cases from FIXTURES.md: publish outcomes, end-to-end smoke, replay layout."""

import datetime as dt
import json

from pyspark.sql import functions as F

from quotebars.operators.quality import publish_counters, validate_quotes
from quotebars.operators.reconcile import reconcile_counts
from quotebars.operators.rollup import aggregate_ohlcv
from quotebars.sources.ingest import normalize_quote, src_kafka
from quotebars.sources.replay import build_replay_snapshot, sink_replay_snapshot, src_replay_snapshot
from quotebars.sources.tables import BarStore, read_raw
from quotebars.sources.wire import avro_encode_frame, read_framed_quotes
from quotebars.streaming.app import multi_query_app

RAW = "symbol string, price double, volume long, day_volume long, quote_time_ms long"


def test_publish_outcomes(spark):
    # a record with only a symbol cannot be encoded: dropped; a full record is sent, key = symbol
    rows = [("BAD", None, None, None, None), ("AAPL", 190.42, 1250, 5000000, 1700000000000)]
    wire = normalize_quote(spark.createDataFrame(rows, RAW))
    framed = avro_encode_frame(wire)
    got = {bytes(r.key): r.value for r in framed.collect()}
    assert got[b"BAD"] is None and got[b"AAPL"] is not None
    counts = {r.status: r.n for r in publish_counters(validate_quotes(read_framed_quotes(framed))).collect()}
    assert counts == {"valid": 1, "null_value": 1}


def test_end_to_end_smoke(spark, scratch):
    """50 quotes of TEST, 1 ms apart, increments 1..100, cumulative day volume:
    raw rows >= 50, bars >= 1, every timed raw row inside a bar."""
    root = scratch("smoke")
    t0 = 1_750_000_000_000
    cum, rows = 0, []
    for i in range(50):
        inc = 1 + (i * 37) % 100
        cum += inc
        rows.append(("TEST", 100.0 + i / 100, inc, cum, t0 + i))
    framed = avro_encode_frame(normalize_quote(spark.createDataFrame(rows, RAW)), keep=["quote_time"])
    framed.select("key", "value", F.lit("market.quotes").alias("topic"), F.lit(0).alias("partition"),
                  F.lit(0).cast("bigint").alias("offset"), F.col("quote_time").alias("timestamp")) \
        .coalesce(1).write.parquet(f"{root}/topic")
    store = BarStore(spark, f"{root}/ohlcv")
    multi_query_app(spark, lambda: src_kafka(spark, path=f"{root}/topic"), f"{root}/raw", store, f"{root}/ck",
                    trigger={"availableNow": True})
    raw = read_raw(spark, f"{root}/raw").drop("quote_day")
    rc = reconcile_counts(raw, store.read(), min_raw_rows=50).collect()
    assert len(rc) == 1 and rc[0].ok and rc[0].raw_rows == 50 and rc[0].bars >= 1
    assert sum(r.volume for r in raw.collect()) == cum


def test_replay_layout_and_missing_file(spark, scratch):
    root = scratch("replay")
    base = dt.datetime(2026, 6, 20, 12, 0, 0)
    rows = [(s, 100 + i, 1 + i % 3, i, base + dt.timedelta(seconds=20 * i)) for s in ("AAPL", "MSFT") for i in range(40)]
    q = spark.createDataFrame(rows, "symbol string, price int, volume int, day_volume long, quote_time timestamp") \
        .select("symbol", F.col("price").cast("decimal(38,8)").alias("price"),
                F.col("volume").cast("decimal(38,8)").alias("volume"), "day_volume", "quote_time")
    bars = aggregate_ohlcv(q)
    at = {"generated_at": "2026-06-20T12:00:00Z"}
    doc = build_replay_snapshot(bars, q, ["AAPL", "MSFT", "NONE"], 12, **at).collect()[0]
    assert doc.symbols == ["AAPL", "MSFT"]
    # 40 ticks over 14 windows: the last 12 windows hold 34 of them, uncut
    assert [t.t for t in doc.ticks["AAPL"]] == sorted(t.t for t in doc.ticks["AAPL"]) and len(doc.ticks["AAPL"]) == 34
    assert len(doc.ohlcv["MSFT"]) == 12 and doc.ohlcv["MSFT"][-1].close == 139.0
    sink_replay_snapshot(bars, q, f"{root}/replay", ["AAPL", "MSFT"], **at)
    text = [json.loads(x) for x in spark.read.text(f"{root}/replay").collect()[0]]
    assert set(text[0]) == {"generated_at", "symbols", "ticks", "ohlcv"}
    sink_replay_snapshot(bars, q, f"{root}/lines", **at)
    assert sorted(json.loads(r.value)["symbol"] for r in spark.read.text(f"{root}/lines").collect()) == ["AAPL", "MSFT"]
    for found in (src_replay_snapshot(spark, f"{root}/replay", document=True), src_replay_snapshot(spark, f"{root}/lines")):
        assert found[0].count() == 68 and found[1].count() == 24
    t2, b2 = src_replay_snapshot(spark, f"{root}/does-not-exist")
    assert t2.count() == 0 and b2.count() == 0


def test_a_busy_symbol_has_several_replay_lines(spark):
    from quotebars.sources.replay import replay_rows
    base = dt.datetime(2026, 6, 20, 12, 0, 0)
    rows = [(s, 100 + i % 9, 1, i, base + dt.timedelta(milliseconds=300 * i)) for s, n in (("HOT", 900), ("COLD", 5), (None, 40)) for i in range(n)]
    q = spark.createDataFrame(rows, "symbol string, price int, volume int, day_volume long, quote_time timestamp") \
        .select("symbol", F.col("price").cast("decimal(38,8)").alias("price"), F.col("volume").cast("decimal(38,8)").alias("volume"),
                "day_volume", "quote_time")
    bars = aggregate_ohlcv(q).unionByName(aggregate_ohlcv(q.where("symbol = 'COLD'")).withColumn("symbol", F.lit("BARS ONLY")))
    lines = replay_rows(bars, q, 12, "x", line_ticks=100).collect()
    assert len([r for r in lines if r.symbol == "HOT"]) == 9 and max(len(r.ticks) for r in lines) <= 104
    assert sorted(len(r.ohlcv) for r in lines if r.symbol == "HOT") == [0] * 8 + [5]
    whole = {r.symbol: r for r in replay_rows(bars, q, 12, "x", line_ticks=None).collect()}
    assert set(whole) == {"HOT", "COLD", None, "BARS ONLY"} and whole["BARS ONLY"].ticks == []
    for symbol, one in whole.items():
        parts = sorted((r for r in lines if r.symbol == symbol), key=lambda r: r.ticks[0].t if r.ticks else 0)
        assert [t for r in parts for t in r.ticks] == one.ticks and [b for r in parts for b in r.ohlcv] == one.ohlcv
