"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the
whole benchmark tables. Outputs use the read shape (epoch millis + doubles) so they
compare cleanly with the DuckDB oracle in ``plans/oracle.py``.

Streaming and table scenarios write to a fresh folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebars.functions.scalar import ms_to_ts, normalize_symbols, ts_to_ms
from quotebars.operators import serving as S
from quotebars.operators.increments import volume_increments
from quotebars.operators.quality import publish_counters, split_valid, tag_allowed, validate_quotes
from quotebars.operators.reconcile import (backfill_bars, count_rows, late_rows_report,
                                           reconcile_counts)
from quotebars.operators.rollup import aggregate_ohlcv
from quotebars.schemas import KAFKA_ROW, OHLCV_AVRO
from quotebars.session import configure, scratch_dir
from quotebars.sources.driver_tables import quotes_from_events, quotes_from_lineitem, read_table
from quotebars.sources.folders import batch_name, file_system, names, put_batch, read_batches
from quotebars.sources.ingest import cast_quote_columns, normalize_quote, src_chart_json, src_kafka, to_quotes
from quotebars.sources.replay import sink_replay_snapshot, src_replay_snapshot
from quotebars.sources.tables import BarStore, ddl_namespace, ddl_tables, read_raw, sink_batch_append, sink_raw_append
from quotebars.sources.topic import publish_files, read_topic, sink_bars_topic, sink_keyed_topic, write_in_time_order
from quotebars.sources.wire import avro_decode, avro_encode_frame, read_framed_quotes, wire_unframe
from quotebars.streaming.app import decoded_quotes, multi_query_app, read_quarantine, start_bars_query, state_partitions
from quotebars.streaming.increments_state import increments_stateful
from quotebars.streaming.serving import TopBars, read_counters, start_counters_query
from quotebars.streaming.state import open_windows, reconcile_open_windows

FLAGSHIP_SYMBOL = "click"
ALLOWLIST = "click, VIEW,purchase,click"

_cache: dict = {}     # scenario outputs already written in this application: paths only


def forget() -> None:
    """Let every scenario build its inputs anew (for cold timings)."""
    _cache.clear()


def _app(spark) -> str:
    return spark.sparkContext.applicationId


def _events(spark, sf_dir) -> DataFrame:
    return quotes_from_events(spark, sf_dir)


def _bars_1m(spark, sf_dir) -> DataFrame:
    return aggregate_ohlcv(_events(spark, sf_dir), "1 minute")


# ------------------------------------------------------------------ rollups
def ohlcv(width: str, adapter=quotes_from_events) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return S.bars_as_doubles(aggregate_ohlcv(adapter(spark, sf_dir), width))
    return run


def q_ohlcv_exact(spark, sf_dir):
    return S.bars_as_doubles(aggregate_ohlcv(_events(spark, sf_dir), "1 minute", exact=True))


# ------------------------------------------------------------------ ingest / wire
def q_normalize_quotes(spark, sf_dir):
    ev = _events(spark, sf_dir)
    raw = ev.select("symbol", F.col("price").cast("double").alias("price"),
                    F.col("volume").cast("bigint").alias("volume"), "day_volume",
                    ts_to_ms("quote_time").alias("quote_time_ms"))
    wire = normalize_quote(raw)
    return wire.select("symbol", "price", "volume", "day_volume",
                       ts_to_ms("quote_time").alias("quote_time_ms"),
                       ts_to_ms("ingest_time").alias("ingest_time_ms"), "source")


def _wire_quotes(ev: DataFrame, extra=()) -> DataFrame:
    """Canonical quotes -> the wire record (exact decimal strings), plus ``extra`` columns."""
    return ev.select("symbol", F.col("price").cast("string").alias("price"),
                     F.col("volume").cast("string").alias("volume"), "day_volume",
                     "quote_time", "ingest_time", "source", *extra)


def q_wire_roundtrip(spark, sf_dir):
    frames = avro_encode_frame(_wire_quotes(_events(spark, sf_dir)), schema_id=1)
    decoded = read_framed_quotes(frames).where(F.col("decode_error").isNull())
    quotes = to_quotes(decoded, keep=["magic", "schema_id"])
    return quotes.select(
        "symbol", F.col("price").cast("double").alias("price"), F.col("volume").cast("double").alias("volume"),
        "day_volume", ts_to_ms("quote_time").alias("quote_time_ms"),
        ts_to_ms("ingest_time").alias("ingest_time_ms"), "source", "magic", "schema_id")


def q_bars_wire_roundtrip(spark, sf_dir):
    bars = _bars_1m(spark, sf_dir)
    frames = avro_encode_frame(bars, schema_id=2, contract=OHLCV_AVRO)
    decoded = avro_decode(wire_unframe(frames), OHLCV_AVRO).where(F.col("decode_error").isNull())
    return S.bars_as_doubles(decoded)


# Fixed corruption rules of the quarantine scenario, keyed on the event's k value.
def _corrupt(ev: DataFrame) -> DataFrame:
    u = F.col("volume").cast("bigint")
    sym = F.when((F.col("symbol") == "signup") & (u >= 98), F.lit(None).cast("string")).otherwise(F.col("symbol"))
    price = F.when(u <= 2, F.lit("n/a")).otherwise(F.col("price").cast("string"))
    vol = (F.when(u.isin(3, 4), F.concat(F.lit("-"), u.cast("string")))
            .when(u == 5, F.lit("five")).otherwise(F.col("volume").cast("string")))
    return ev.select(sym.alias("symbol"), price.alias("price"), vol.alias("volume"), "day_volume",
                     "quote_time", "ingest_time", "source", u.alias("_u"))


def _mangle_frames(frames: DataFrame) -> DataFrame:
    v = F.col("value")
    u = F.col("_u")
    bad = (F.when(u == 6, F.substring(v, 1, 3))
            .when(u == 7, F.concat(F.unhex(F.lit("01")), F.expr("substring(value, 2)")))
            .when(u == 8, F.expr("substring(value, 1, length(value) - 2)"))
            .otherwise(v))
    return frames.withColumn("value", bad)


def q_quarantine_counts(spark, sf_dir):
    bad = _corrupt(_events(spark, sf_dir))
    frames = _mangle_frames(avro_encode_frame(bad, schema_id=1, keep=["_u"]))
    return publish_counters(validate_quotes(read_framed_quotes(frames))).select("status", "n")


def _chart_payloads(spark, sf_dir, units: str | None = None) -> DataFrame:
    ev = quotes_from_events(spark, sf_dir, with_day_volume=False)
    price = F.col("price").cast("double")
    u = F.col("volume").cast("bigint")
    payload = F.to_json(F.struct(F.struct(F.array(F.struct(
        F.struct(F.when(F.col("symbol") == "error", F.lit(None).cast("double")).otherwise(price)
                 .alias("regularMarketPrice")).alias("meta"),
        F.struct(F.array(F.struct(
            F.array(F.when(u > 10, price + F.lit(1.0)), F.when(u > 50, price), F.lit(None).cast("double"))
             .alias("close"),
            F.array(u, F.lit(None).cast("bigint"), u * 2).alias("volume"))).alias("quote")).alias("indicators")
    )).alias("result")).alias("chart")))
    return ev.select("symbol", ts_to_ms("quote_time").alias("quote_time_ms"), payload.alias("payload"), *([u.alias(units)] if units else []))


def q_chart_json(spark, sf_dir):
    found = src_chart_json(_chart_payloads(spark, sf_dir))
    return found.select("symbol", "quote_time_ms", "price", "day_volume", "reject_reason")


def _odd_payloads(chart: DataFrame) -> DataFrame:
    """Payloads of mixed shapes, by the event's k: text for a price, a close or a volume, text for an
    object, no result, no JSON."""
    whole, kind = F.col("payload"), F.col("units") % 10
    odd = (F.when(kind == 0, F.regexp_replace(whole, r'"regularMarketPrice":[^}]*', '"regularMarketPrice":"n/a"'))
           .when(kind == 1, F.regexp_replace(whole, r'"close":\[', '"close":["odd",'))
           .when(kind == 2, F.regexp_replace(whole, r'"volume":\[', '"volume":["7",true,'))
           .when(kind == 3, F.regexp_replace(whole, r'"indicators":\{"quote":\[\{.*?\}\]\}', '"indicators":"none"'))
           .when(kind == 4, F.lit('{"chart":{"result":[]}}'))
           .when(kind == 5, F.expr("substring(payload, 1, length(payload) - 3)")).otherwise(whole))
    return chart.withColumn("payload", odd).drop("units")


def q_chart_json_odd(spark, sf_dir):
    found = src_chart_json(_odd_payloads(_chart_payloads(spark, sf_dir, "units")))
    return found.select("symbol", "quote_time_ms", "price", "day_volume", "reject_reason")


def q_volume_increments(spark, sf_dir):
    inc = volume_increments(_events(spark, sf_dir))
    return inc.select("symbol", ts_to_ms("quote_time").alias("quote_time_ms"), "day_volume", "volume")


def q_volume_increments_split(spark, sf_dir):
    """Same result with both scans cut into hours: the day volume and the increments."""
    ev = quotes_from_events(spark, sf_dir, block="hour")
    inc = volume_increments(ev, block=F.date_trunc("hour", "quote_time"))
    return inc.select("symbol", ts_to_ms("quote_time").alias("quote_time_ms"), "day_volume", "volume")


def q_ohlcv_1m_split(spark, sf_dir):
    """1-minute bars with the day volume scanned in blocks of an hour."""
    return S.bars_as_doubles(aggregate_ohlcv(quotes_from_events(spark, sf_dir, block="hour"), "1 minute"))


def q_keyed_topic_roundtrip(spark, sf_dir):
    """Events published through the keyed-topic file sink, read back and decoded."""
    root = scratch_dir(spark, "topic")
    frames = avro_encode_frame(_wire_quotes(_events(spark, sf_dir)), schema_id=1, keep=["quote_time"])
    sink_keyed_topic(frames.withColumnRenamed("quote_time", "timestamp"), path=f"{root}/topic")
    decoded = read_framed_quotes(read_topic(spark, f"{root}/topic")).where(F.col("decode_error").isNull())
    return to_quotes(decoded).select(
        "symbol", F.col("price").cast("double").alias("price"), F.col("volume").cast("double").alias("volume"),
        "day_volume", ts_to_ms("quote_time").alias("quote_time_ms"), "source")


# ------------------------------------------------------------------ serving
def q_latest_bars(spark, sf_dir):
    return S.latest_bars(_bars_1m(spark, sf_dir), FLAGSHIP_SYMBOL, S.DEFAULT_BARS)


def q_latest_ticks(spark, sf_dir):
    return S.latest_ticks(_events(spark, sf_dir), FLAGSHIP_SYMBOL, S.DEFAULT_TICKS)


def q_latest_bars_all(spark, sf_dir):
    return S.latest_bars_all(_bars_1m(spark, sf_dir), S.DEFAULT_ALL_BARS)


def q_topn_per_symbol(spark, sf_dir):
    return S.topn_bars(_bars_1m(spark, sf_dir), S.DEFAULT_BARS)


def q_recent_bars(spark, sf_dir):
    return S.recent_bars(_bars_1m(spark, sf_dir), S.RECENT_BARS)


def q_latest_price(spark, sf_dir):
    return S.latest_price(_events(spark, sf_dir))


def q_tick_direction(spark, sf_dir):
    return S.tick_direction(_events(spark, sf_dir), S.DEFAULT_TICKS)


def q_close_series_summary(spark, sf_dir):
    return S.close_series_summary(_bars_1m(spark, sf_dir), S.DEFAULT_BARS)


def q_allowlist_symbols(spark, sf_dir):
    _, tagged = tag_allowed(quotes_from_events(spark, sf_dir, with_day_volume=False), ALLOWLIST)
    status = F.when(F.col("_accepted"), F.lit("accepted")).otherwise(F.lit("rejected"))
    return tagged.groupBy("symbol", status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def q_normalize_symbols(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    u = F.get_json_object("props", "$.k").cast("bigint")
    csv = F.concat(F.col("event_type"), F.lit(", "), F.upper("event_type"), F.lit(",,"),
                   F.when(u >= 50, F.lit("aapl")).otherwise(F.lit(" msft ")), F.lit(","),
                   F.lower("event_type"), F.lit(" "))
    arr = normalize_symbols(csv)
    return ev.select("event_id", F.array_join(arr, "|").alias("symbols"),
                     F.size(arr).cast("bigint").alias("n_symbols"))


# ------------------------------------------------------------------ tables
def _lake(spark, sf_dir) -> dict:
    """Raw table + bar store built from the events quotes (once per session and sf)."""
    key = ("lake", _app(spark), sf_dir)
    if key not in _cache:
        root = scratch_dir(spark, "lake")
        ev = _events(spark, sf_dir)
        sink_batch_append(ev, f"{root}/quotes_raw")
        raw = read_raw(spark, f"{root}/quotes_raw")
        backfill_bars(raw.drop("quote_day"), BarStore(spark, f"{root}/ohlcv", writer="backfill"), "1 minute")
        _cache[key] = {"root": root, "raw": f"{root}/quotes_raw", "bars": f"{root}/ohlcv"}
    entry = dict(_cache[key])
    entry["store"] = BarStore(spark, entry["bars"], writer="backfill")
    return entry


def q_latest_bars_table(spark, sf_dir):
    """The read path: newest bars of one symbol from the bar store (partition-pruned)."""
    return S.latest_bars(_lake(spark, sf_dir)["store"].read(symbol=FLAGSHIP_SYMBOL), FLAGSHIP_SYMBOL,
                         S.DEFAULT_BARS)


def q_latest_ticks_table(spark, sf_dir):
    """The read path: newest ticks of one symbol from the raw table (partition-pruned)."""
    return S.latest_ticks(read_raw(spark, _lake(spark, sf_dir)["raw"]), FLAGSHIP_SYMBOL, S.DEFAULT_TICKS)


def q_compact_bars(spark, sf_dir):
    root = scratch_dir(spark, "compact")
    ev = _events(spark, sf_dir).persist()     # reused by three upserts; released before returning
    store = BarStore(spark, f"{root}/ohlcv", writer="compact")
    store.upsert(aggregate_ohlcv(ev.where(F.col("price") < 100), "1 minute"), batch_id=0)
    store.upsert(aggregate_ohlcv(ev.where(F.col("price") >= 50), "1 minute"), batch_id=1)
    store.upsert(aggregate_ohlcv(ev, "1 minute"), batch_id=2)
    # the first half of the days (closed days) first, then the whole store
    lo, hi = store.read().agg(F.min(F.to_date("window_start")), F.max(F.to_date("window_start"))).first()
    ev.unpersist()
    store.compact(day_lo=lo.isoformat(), day_hi=(lo + (hi - lo) / 2).isoformat())
    store.compact()
    return S.bars_as_doubles(store.read())


def q_upsert_bars(spark, sf_dir):
    root = scratch_dir(spark, "upsert")
    ev = _events(spark, sf_dir).persist()     # reused by the upserts; released before returning
    store = BarStore(spark, f"{root}/ohlcv", writer="upsert")
    # stale first pass: only part of every window's ticks had arrived
    store.upsert(aggregate_ohlcv(ev.where(F.col("price") < 100), "1 minute"), batch_id=0)
    # full recompute replaces every stale bar and inserts the missing ones
    store.upsert(aggregate_ohlcv(ev, "1 minute"), batch_id=1)
    # replaying a committed batch is a no-op
    store.upsert(aggregate_ohlcv(ev.where(F.col("price") < 100), "1 minute"), batch_id=0)
    ev.unpersist()
    return S.bars_as_doubles(store.read())


def q_backfill_bars(spark, sf_dir):
    return S.bars_as_doubles(_lake(spark, sf_dir)["store"].read())


def q_reconcile_counts(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    return reconcile_counts(read_raw(spark, lake["raw"]), lake["store"].read())


def q_count_rows(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    return count_rows(read_raw(spark, lake["raw"]), lake["store"].read())


# ------------------------------------------------------------------ streaming
#: a topic has files for so many micro-batches at least, and more when a file would hold more rows
BATCHES, FILE_ROWS = 10, 100_000
#: days of a topic beyond which its files are cut between hours
LONG_DAYS = 120


def stage_topic_files(spark: SparkSession, quotes: DataFrame, out_dir: str, late=None) -> str:
    """Stage quotes as framed topic rows, those matching ``late`` apart from the others. Returns the
    staging folder; ``publish_staged`` then releases one or the other to the topic folder."""
    held_back = F.lit(False) if late is None else F.coalesce(late, F.lit(False))
    rows = quotes.withColumn("late", held_back)
    framed = avro_encode_frame(_wire_quotes(rows, extra=["late"]), schema_id=1, keep=["quote_time", "late"])
    topic_rows = framed.select(
        "key", "value",
        F.lit("market.quotes").alias("topic"),
        F.pmod(F.hash("key"), F.lit(3)).cast("int").alias("partition"),
        F.unix_micros(F.col("quote_time").cast("timestamp")).alias("offset"),
        F.col("quote_time").cast("timestamp").alias("timestamp"),
        "late")
    staged_dir = f"{out_dir}_staged"
    topic_rows.write.mode("overwrite").partitionBy("late").parquet(staged_dir)
    return staged_dir


def publish_staged(spark: SparkSession, staged_dir: str, out_dir: str, late: bool = False,
                   files_per_batch: int | None = None, least_batches: int = BATCHES, file_rows: int = FILE_ROWS) -> int:
    """Append the on-time rows to the topic folder as files in time order, or, with ``late``, those held
    back, as the files of one micro-batch. A stream with ``maxFilesPerTrigger`` = ``files_per_batch`` then reads
    the topic along the time. The number of files, and so of micro-batches, follows the rows and not the days
    that they span; a file is a range of the time, so a batch has few symbol-days in several files. Returns
    ``files_per_batch`` (default: the task slots)."""
    k = files_per_batch or max(1, spark.sparkContext.defaultParallelism)
    staged = spark.read.schema(T.StructType([*KAFKA_ROW.fields, T.StructField("late", T.BooleanType())])).parquet(staged_dir)
    rows = staged.where(F.col("late") == late).drop("late")
    if late:
        rows.repartition(k).write.mode("append").parquet(f"{out_dir}/late")
        return k
    span = rows.agg(F.count(F.lit(1)).alias("n"), F.datediff(F.max("timestamp"), F.min("timestamp")).alias("days")).first()
    files = max(least_batches * k, -(-span["n"] // file_rows))
    write_in_time_order(rows, f"{out_dir}/on-time", files, ("key", "timestamp"), "timestamp",
                        "hour" if (span["days"] or 0) > LONG_DAYS else "minute")
    return k


def _published_topic(spark, sf_dir) -> dict:
    """The events quotes as an on-time topic folder (all rows published), shared by the
    scenarios that only read it."""
    key = ("topic", _app(spark), sf_dir)
    if key not in _cache:
        root = scratch_dir(spark, "topic")
        staged = stage_topic_files(spark, _events(spark, sf_dir), f"{root}/topic")
        _cache[key] = {"path": f"{root}/topic", "k": publish_staged(spark, staged, f"{root}/topic")}
    return _cache[key]


def _state_partitions(spark) -> int:
    """State partitions for the scenario streams: the cluster's task slots."""
    return max(1, spark.sparkContext.defaultParallelism)


def _stream_run(spark, sf_dir, late_rule: bool = False) -> dict:
    """The two-query app over the events topic. With ``late_rule``, rows with k < 10
    are delivered in a second run after everything else (a late arrival)."""
    key = ("stream", _app(spark), sf_dir, late_rule)
    if key in _cache:
        entry = dict(_cache[key])
        entry["store"] = BarStore(spark, entry["bars"], writer="stream")
        return entry
    root = scratch_dir(spark, "stream")
    store = BarStore(spark, f"{root}/ohlcv", writer="stream")

    def run(topic, k):
        multi_query_app(spark, lambda: src_kafka(spark, path=topic, max_files_per_trigger=k),
                        f"{root}/quotes_raw", store, f"{root}/checkpoints",
                        trigger={"availableNow": True}, num_state_partitions=_state_partitions(spark))

    if late_rule:
        staged = stage_topic_files(spark, _events(spark, sf_dir), f"{root}/topic", late=F.col("volume") < 10)
        run(f"{root}/topic", publish_staged(spark, staged, f"{root}/topic"))
        run(f"{root}/topic", publish_staged(spark, staged, f"{root}/topic", late=True))
    else:
        topic = _published_topic(spark, sf_dir)
        run(topic["path"], topic["k"])
    _cache[key] = {"root": root, "raw": f"{root}/quotes_raw", "bars": f"{root}/ohlcv"}
    return dict(_cache[key], store=store)


def q_stream_ohlcv(spark, sf_dir):
    return S.bars_as_doubles(_stream_run(spark, sf_dir)["store"].read())


def q_stream_raw(spark, sf_dir):
    raw = read_raw(spark, _stream_run(spark, sf_dir)["raw"])
    return raw.select("symbol", F.col("price").cast("double").alias("price"),
                      F.col("volume").cast("double").alias("volume"), "day_volume",
                      ts_to_ms("quote_time").alias("quote_time_ms"), "source")


def q_stream_reconcile(spark, sf_dir):
    """The end-to-end smoke check over the stream's own outputs: raw rows vs bars."""
    run = _stream_run(spark, sf_dir)
    return reconcile_counts(read_raw(spark, run["raw"]), run["store"].read())


def q_late_rows_report(spark, sf_dir):
    run = _stream_run(spark, sf_dir, late_rule=True)
    rep = late_rows_report(read_raw(spark, run["raw"]).drop("quote_day"), run["store"].read())
    return rep.select("symbol", ts_to_ms("window_start").alias("window_start_ms"), "status",
                      "raw_trade_count", "bar_trade_count")


REPAIRED_DAYS = (5, 20)     # of the month


def _damaged_lake(spark, sf_dir) -> dict:
    """A raw table, and a bar store in which two days were rolled up without some of their quotes."""
    key = ("damaged", _app(spark), sf_dir)
    if key not in _cache:
        root = scratch_dir(spark, "damaged")
        sink_batch_append(_events(spark, sf_dir), f"{root}/quotes_raw")
        known = ~F.dayofmonth("quote_time").isin(*REPAIRED_DAYS) | (F.col("volume") >= 30)
        backfill_bars(read_raw(spark, f"{root}/quotes_raw").where(known), BarStore(spark, f"{root}/ohlcv", writer="first"))
        _cache[key] = {"raw": f"{root}/quotes_raw", "bars": f"{root}/ohlcv"}
    return _cache[key]


def q_late_days_report(spark, sf_dir):
    """The report when two days of a month differ: only those are read again."""
    lake = _damaged_lake(spark, sf_dir)
    report = late_rows_report(read_raw(spark, lake["raw"]), BarStore(spark, lake["bars"]))
    return report.select("symbol", ts_to_ms("window_start").alias("window_start_ms"), "status", "raw_trade_count", "bar_trade_count")


def q_backfill_days(spark, sf_dir):
    """The two days repaired from the report; all bars afterwards."""
    lake = _damaged_lake(spark, sf_dir)
    # into a store of its own, so that the damaged one stays as it is for others
    store = BarStore(spark, f"{scratch_dir(spark, 'repaired')}/ohlcv", writer="copy")
    store.upsert(BarStore(spark, lake["bars"]).read(), batch_id=0)
    raw = read_raw(spark, lake["raw"])
    backfill_bars(raw, store, batch_id=1, report=late_rows_report(raw, store))
    return S.bars_as_doubles(store.read())


def q_open_windows(spark, sf_dir):
    """The windows that the stopped stream holds open, read from its checkpoint and compared with the bars."""
    run = _stream_run(spark, sf_dir)
    held = open_windows(spark, f"{run['root']}/checkpoints/ohlcv_1m")
    found = reconcile_open_windows(held, run["store"].read())
    return S.bars_as_doubles(found).join(found.select("symbol", ts_to_ms("window_start").alias("window_start_ms"), "status"),
                                         ["symbol", "window_start_ms"])


def q_topn_stream(spark, sf_dir):
    """The newest bars of every symbol, kept by the stream batch by batch."""
    root, topic = scratch_dir(spark, "topn-stream"), _published_topic(spark, sf_dir)
    top = TopBars(spark, f"{root}/top", S.DEFAULT_BARS)
    quotes = decoded_quotes(read_framed_quotes(src_kafka(spark, path=topic["path"], max_files_per_trigger=topic["k"])))
    with state_partitions(spark, _state_partitions(spark)):
        query = start_bars_query(quotes, BarStore(spark, f"{root}/ohlcv"), f"{root}/checkpoint", trigger={"availableNow": True}, top=top)
    query.awaitTermination()
    return S.topn_bars(top.read(), S.DEFAULT_BARS)


def q_stream_counters(spark, sf_dir):
    """Counts by outcome of corrupted messages, over a restart and a batch that comes twice."""
    root = scratch_dir(spark, "counters")
    frames = _topic_rows(_mangle_frames(avro_encode_frame(_corrupt(_events(spark, sf_dir)), schema_id=1, keep=["_u", "quote_time"])))
    frames.write.parquet(f"{root}/frames")
    staged = spark.read.parquet(f"{root}/frames")
    early = F.dayofmonth("timestamp") <= 15
    for part in (early, ~early):
        staged.where(part).write.mode("append").parquet(f"{root}/topic")
        for _ in range(2):      # the second time as after a crash before the last commit
            with state_partitions(spark, 2):
                query = start_counters_query(validate_quotes(read_framed_quotes(src_kafka(spark, path=f"{root}/topic"))),
                                             f"{root}/counters", f"{root}/checkpoint", {"availableNow": True})
            query.awaitTermination()
            _lose_commit(spark, f"{root}/checkpoint")
    return read_counters(spark, f"{root}/counters")


def q_increments_stream(spark, sf_dir):
    root = scratch_dir(spark, "increments")
    topic = _published_topic(spark, sf_dir)
    src = src_kafka(spark, path=topic["path"], max_files_per_trigger=topic["k"])
    quotes = to_quotes(read_framed_quotes(src).where(F.col("decode_error").isNull()).drop("decode_error"))
    increments_stateful(quotes, f"{root}/checkpoint", lambda rows, n: put_batch(rows, f"{root}/out", n),
                        trigger={"availableNow": True}).awaitTermination()
    res = read_batches(spark, f"{root}/out", "symbol string, quote_time timestamp, day_volume bigint, volume bigint")
    return res.select("symbol", ts_to_ms("quote_time").alias("quote_time_ms"), "day_volume", "volume")


# ------------------------------------------------------------------ replay
def _replay(spark, sf_dir):
    key = ("replay", _app(spark), sf_dir)
    if key not in _cache:
        path = f"{scratch_dir(spark, 'replay')}/replay"
        sink_replay_snapshot(_bars_1m(spark, sf_dir), _events(spark, sf_dir), path, generated_at="1970-01-01T00:00:00Z")
        _cache[key] = path
    return src_replay_snapshot(spark, _cache[key])


def q_replay_roundtrip(spark, sf_dir):
    _, bars = _replay(spark, sf_dir)
    return bars.select("symbol", "window_start_ms", "open", "high", "low", "close", "volume",
                       "quote_volume", "vwap", "trade_count")


def q_replay_ticks(spark, sf_dir):
    ticks, _ = _replay(spark, sf_dir)
    return ticks.select("symbol", "t", "price", "quantity")


# ------------------------------------------------------------------ outputs that several writers share
def _topic_rows(frames: DataFrame, time: str = "quote_time") -> DataFrame:
    """Framed rows in the shape of the topic source."""
    return frames.select("key", "value", F.lit("market.quotes").alias("topic"), F.lit(0).alias("partition"),
                         F.lit(0).cast("bigint").alias("offset"), F.col(time).cast("timestamp").alias("timestamp"))


def _publish(spark, quotes: DataFrame, path: str, num_files: int = 8) -> None:
    frames = avro_encode_frame(_wire_quotes(quotes), schema_id=1, keep=["quote_time"])
    sink_keyed_topic(_topic_rows(frames), path=path, num_files=num_files)


def _app_run(spark, topic: str, root: str, checkpoint: str, files: int | None = None) -> BarStore:
    """One bounded run of the streaming job over a topic folder, into ``root``."""
    store = BarStore(spark, f"{root}/ohlcv")
    multi_query_app(spark, lambda: src_kafka(spark, path=topic, max_files_per_trigger=files), f"{root}/quotes_raw", store,
                    f"{root}/{checkpoint}", trigger={"availableNow": True}, num_state_partitions=_state_partitions(spark))
    return store


def _raw_columns(raw: DataFrame) -> DataFrame:
    return raw.select("symbol", F.col("price").cast("double").alias("price"), F.col("volume").cast("double").alias("volume"),
                      "day_volume", ts_to_ms("quote_time").alias("quote_time_ms"), "source")


def q_topic_stream_bars(spark, sf_dir):
    """Events through the keyed-topic files and the streaming job, one file per micro-batch: no
    quote of any symbol comes late."""
    root = scratch_dir(spark, "topic-stream")
    _publish(spark, _events(spark, sf_dir), f"{root}/topic")
    return S.bars_as_doubles(_app_run(spark, f"{root}/topic", root, "checkpoint", files=1).read())


def q_stream_restart(spark, sf_dir):
    """Two checkpoints, one output: the job over the first half of the days, then, as after the
    loss of its checkpoint, with a new one over the rest."""
    root, ev = scratch_dir(spark, "restart"), _events(spark, sf_dir)
    early = F.dayofmonth("quote_time") <= 15
    _publish(spark, ev.where(early), f"{root}/topic-1")
    _publish(spark, ev.where(~early), f"{root}/topic-2")
    _app_run(spark, f"{root}/topic-1", root, "checkpoint-1")
    store = _app_run(spark, f"{root}/topic-2", root, "checkpoint-2")
    return reconcile_counts(read_raw(spark, f"{root}/quotes_raw"), store.read())


def q_stream_raw_all(spark, sf_dir):
    """Corrupted messages through the streaming job: what the raw table, the bars and the
    quarantine (by reason) hold of them."""
    root = scratch_dir(spark, "raw-all")
    frames = _mangle_frames(avro_encode_frame(_corrupt(_events(spark, sf_dir)), schema_id=1, keep=["_u", "quote_time"]))
    _topic_rows(frames).write.parquet(f"{root}/topic")
    store = _app_run(spark, f"{root}/topic", root, "checkpoint")
    raw, rejected = read_raw(spark, f"{root}/quotes_raw"), read_quarantine(spark, f"{root}/quotes_raw_quarantine")
    return (raw.agg(F.lit("raw").alias("held"), F.count(F.lit(1)).alias("n"))
            .unionByName(store.read().agg(F.lit("bars").alias("held"), F.sum("trade_count").alias("n")))
            .unionByName(rejected.groupBy(F.col("reject_reason").alias("held")).agg(F.count(F.lit(1)).alias("n"))))


def q_raw_append_after_stream(spark, sf_dir):
    """Half of the events by the stream, the other half appended as a batch: one raw table."""
    root, ev = scratch_dir(spark, "append"), _events(spark, sf_dir)
    early = F.dayofmonth("quote_time") <= 15
    _publish(spark, ev.where(early), f"{root}/topic")
    _app_run(spark, f"{root}/topic", root, "checkpoint")
    sink_batch_append(ev.where(~early), f"{root}/quotes_raw")
    return _raw_columns(read_raw(spark, f"{root}/quotes_raw"))


def q_append_retry(spark, sf_dir):
    """The events appended, the same append retried, and some of the rows again by an append of their own."""
    root, ev = scratch_dir(spark, "append-retry"), _events(spark, sf_dir)
    again = ev.where(F.dayofmonth("quote_time") <= 3)
    for rows, name in ((ev, "run-1"), (ev, "run-1"), (again, "run-2")):
        sink_batch_append(rows, f"{root}/quotes_raw", append_id=name)
    return _raw_columns(read_raw(spark, f"{root}/quotes_raw"))


def _lose_commit(spark, checkpoint: str) -> None:
    """As after a crash: the last batch is done, but the checkpoint doesn't know."""
    last = max(int(n) for n in names(spark, f"{checkpoint}/commits"))
    fs, folder, jvm = file_system(spark, f"{checkpoint}/commits")
    for name in (f"{last}", f".{last}.crc"):
        fs.delete(jvm.org.apache.hadoop.fs.Path(folder, name), False)


def q_topic_replayed_batch(spark, sf_dir):
    """Events published by a stream whose last batch comes again after a crash: the topic has every row once."""
    root = scratch_dir(spark, "topic-replay")
    wire = _wire_quotes(_events(spark, sf_dir))
    write_in_time_order(wire, f"{root}/quotes", 4, ("quote_time",), "quote_time")
    for _ in range(2):
        stream = spark.readStream.schema(wire.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/quotes")
        frames = _topic_rows(avro_encode_frame(stream, schema_id=1, keep=["quote_time"]))
        sink_keyed_topic(frames, path=f"{root}/topic", num_files=2, checkpoint=f"{root}/checkpoint", trigger={"availableNow": True}).awaitTermination()
        _lose_commit(spark, f"{root}/checkpoint")
    return _raw_columns(to_quotes(read_framed_quotes(read_topic(spark, f"{root}/topic"))))


def q_table_append(spark, sf_dir):
    """The events streamed into a catalog table that the DDL creates in a namespace of its own."""
    root = scratch_dir(spark, "table")
    name = f"qb_{root.rpartition('-')[2]}"
    ddl_namespace(spark, name)
    ddl_tables(spark, f"{name}.quotes_raw", f"{name}.ohlcv", location_root=root)
    _publish(spark, _events(spark, sf_dir), f"{root}/topic")
    quotes = decoded_quotes(read_framed_quotes(src_kafka(spark, path=f"{root}/topic")))
    sink_raw_append(quotes, None, f"{root}/checkpoint", trigger={"availableNow": True}, table=f"{name}.quotes_raw").awaitTermination()
    return _raw_columns(read_raw(spark, table=f"{name}.quotes_raw"))


def q_bars_topic(spark, sf_dir):
    """Bars published to their topic, read back and decoded."""
    root = scratch_dir(spark, "bars-topic")
    sink_bars_topic(_bars_1m(spark, sf_dir), path=f"{root}/topic")
    decoded = avro_decode(wire_unframe(read_topic(spark, f"{root}/topic")), OHLCV_AVRO)
    return S.bars_as_doubles(decoded.where(F.col("decode_error").isNull()))


def q_null_event_time(spark, sf_dir):
    """Rows without an event time are in no bar."""
    ev = _events(spark, sf_dir)
    return S.bars_as_doubles(aggregate_ohlcv(ev.withColumn("quote_time", F.when(F.col("volume") >= 10, F.col("quote_time"))), "1 minute"))


def q_cast_quote_columns(spark, sf_dir):
    """On-wire text, some of it no number, as decimals."""
    cast = cast_quote_columns(_corrupt(_events(spark, sf_dir)))
    return cast.select("symbol", F.col("price").cast("double").alias("price"), F.col("volume").cast("double").alias("volume"),
                       ts_to_ms("quote_time").alias("quote_time_ms"))


PAYLOAD_FILES = 8


def q_publish_pipeline(spark, sf_dir):
    """The publishing side as one stream, two payload files of a time range each at a time: vendor
    payloads, increments carried from batch to batch, normalised, validated and framed quotes into the
    keyed topic; then the topic read back."""
    root = scratch_dir(spark, "publish")
    chart = _chart_payloads(spark, sf_dir).withColumn("polled", ms_to_ts("quote_time_ms"))
    write_in_time_order(chart, f"{root}/payloads", PAYLOAD_FILES, ("polled",), "polled")
    stream = spark.readStream.schema(chart.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/payloads")
    # two files are two tasks, so payloads are dealt to all task slots before they are parsed
    stream = stream.repartition(_state_partitions(spark), "symbol", "quote_time_ms")
    priced = src_chart_json(stream).select("symbol", ms_to_ts("quote_time_ms").alias("quote_time"), "day_volume",
                                           F.col("price").cast("decimal(38,8)").alias("price"), "reject_reason")

    def publish(counted, number):
        counted = counted.drop("reject_reason")
        valid, _ = split_valid(validate_quotes(normalize_quote(counted.withColumn("quote_time_ms", ts_to_ms("quote_time")))))
        frames = _topic_rows(avro_encode_frame(valid, schema_id=1, keep=["quote_time"]))
        publish_files(frames, f"{root}/topic", batch_name(number), num_files=2)

    increments_stateful(priced, f"{root}/checkpoint", publish, trigger={"availableNow": True},
                        only=F.col("reject_reason").isNull()).awaitTermination()
    decoded = read_framed_quotes(read_topic(spark, f"{root}/topic"))
    return to_quotes(decoded).select("symbol", F.col("price").cast("double").alias("price"), F.col("volume").cast("double").alias("volume"),
                                     "day_volume", ts_to_ms("quote_time").alias("quote_time_ms"), "source")


def _configured(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    reg = {
        "ohlcv_1m": ohlcv("1 minute"),
        "ohlcv_1h": ohlcv("1 hour"),
        "ohlcv_1d": ohlcv("1 day"),
        "ohlcv_ties": ohlcv("1 day", quotes_from_lineitem),
        "ohlcv_exact": q_ohlcv_exact,
        "keyed_topic_roundtrip": q_keyed_topic_roundtrip,
        "latest_bars_table": q_latest_bars_table,
        "latest_ticks_table": q_latest_ticks_table,
        "compact_bars": q_compact_bars,
        "normalize_quotes": q_normalize_quotes,
        "wire_roundtrip": q_wire_roundtrip,
        "bars_wire_roundtrip": q_bars_wire_roundtrip,
        "quarantine_counts": q_quarantine_counts,
        "chart_json": q_chart_json,
        "chart_json_odd": q_chart_json_odd,
        "volume_increments": q_volume_increments,
        "volume_increments_split": q_volume_increments_split,
        "ohlcv_1m_split": q_ohlcv_1m_split,
        "increments_stream": q_increments_stream,
        "latest_bars": q_latest_bars,
        "latest_ticks": q_latest_ticks,
        "latest_bars_all": q_latest_bars_all,
        "topn_per_symbol": q_topn_per_symbol,
        "recent_bars": q_recent_bars,
        "latest_price": q_latest_price,
        "tick_direction": q_tick_direction,
        "close_series_summary": q_close_series_summary,
        "allowlist_symbols": q_allowlist_symbols,
        "normalize_symbols": q_normalize_symbols,
        "upsert_bars": q_upsert_bars,
        "backfill_bars": q_backfill_bars,
        "stream_ohlcv": q_stream_ohlcv,
        "stream_raw": q_stream_raw,
        "stream_reconcile": q_stream_reconcile,
        "late_rows_report": q_late_rows_report,
        "late_days_report": q_late_days_report,
        "backfill_days": q_backfill_days,
        "open_windows": q_open_windows,
        "topn_stream": q_topn_stream,
        "stream_counters": q_stream_counters,
        "reconcile_counts": q_reconcile_counts,
        "count_rows": q_count_rows,
        "replay_roundtrip": q_replay_roundtrip,
        "replay_ticks": q_replay_ticks,
        "topic_stream_bars": q_topic_stream_bars,
        "stream_restart": q_stream_restart,
        "stream_raw_all": q_stream_raw_all,
        "raw_append_after_stream": q_raw_append_after_stream,
        "table_append": q_table_append,
        "append_retry": q_append_retry,
        "topic_replayed_batch": q_topic_replayed_batch,
        "bars_topic": q_bars_topic,
        "null_event_time": q_null_event_time,
        "cast_quote_columns": q_cast_quote_columns,
        "publish_pipeline": q_publish_pipeline,
    }
    return {k: _configured(v) for k, v in reg.items()}
