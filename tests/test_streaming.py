"""Streaming: the late-data script, stream = batch, restart without loss or duplication."""

import datetime as dt

from pyspark.sql import functions as F

from quotebars.operators.rollup import aggregate_ohlcv
from quotebars.sources.ingest import src_kafka
from quotebars.sources.tables import BarStore, read_raw
from quotebars.streaming.app import bars_stream, dropped_by_watermark, multi_query_app, read_quarantine
from quotebars.sources.wire import avro_encode_frame

T0 = dt.datetime(2026, 6, 20, 12, 0, 0)
SCHEMA = "symbol string, price decimal(38,8), volume decimal(38,8), day_volume long, quote_time timestamp"


def _step(spark, rows):
    data = [(s, p, 1, 0, T0 + dt.timedelta(seconds=t)) for s, t, p in rows]
    return spark.createDataFrame(data, "symbol string, price int, volume int, day_volume long, quote_time timestamp") \
        .select("symbol", F.col("price").cast("decimal(38,8)").alias("price"),
                F.col("volume").cast("decimal(38,8)").alias("volume"), "day_volume", "quote_time")


def test_late_data_script(spark, scratch):
    """1-minute windows, 2-minute watermark, update mode, one availableNow run per step."""
    root = scratch("late")
    emitted = []

    def sink(df, batch_id):
        emitted.append([(r.symbol, r.window_start.strftime("%H:%M"), int(r.open), int(r.close), r.trade_count)
                        for r in df.collect()])

    steps = [
        [("A", 1, 100), ("A", 30, 110)],
        [("A", 20, 90), ("A", 300, 95)],
        [("A", 2, 1), ("A", 301, 96), ("B", 185, 7)],
    ]
    expect = [
        {("A", "12:00", 100, 110, 2)},
        {("A", "12:00", 100, 110, 3), ("A", "12:05", 95, 95, 1)},
        {("A", "12:05", 95, 96, 2), ("B", "12:03", 7, 7, 1)},
    ]
    drops = []
    for rows, exp in zip(steps, expect):
        _step(spark, rows).write.mode("append").parquet(f"{root}/src")
        start = len(emitted)
        q = (bars_stream(spark.readStream.schema(SCHEMA).parquet(f"{root}/src"), "1 minute", "2 minutes")
             .writeStream.outputMode("update").option("checkpointLocation", f"{root}/ck")
             .foreachBatch(sink).trigger(availableNow=True).start())
        q.awaitTermination()
        got = set(x for batch in emitted[start:] for x in batch)
        assert got == exp
        assert emitted[-1] == []          # each run ends with an empty micro-batch
        drops.append(dropped_by_watermark(q))
    assert drops == [0, 0, 1]


def _topic(spark, n, t0):
    rows = [("S%d" % (i % 3), str(100 + i % 5), str(1 + i % 4), i, T0 + dt.timedelta(seconds=t0 + 7 * i),
             T0 + dt.timedelta(seconds=t0 + 7 * i), "yahoo") for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, price string, volume string, day_volume long, "
                                     "quote_time timestamp, ingest_time timestamp, source string")
    return avro_encode_frame(df, keep=["quote_time"]).select(
        "key", "value", F.lit("market.quotes").alias("topic"), F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"), F.col("quote_time").alias("timestamp"))


def test_stream_equals_batch_and_restart(spark, scratch):
    root = scratch("app")
    store = BarStore(spark, f"{root}/ohlcv", writer="s")
    src = lambda: src_kafka(spark, path=f"{root}/topic", max_files_per_trigger=1)
    _topic(spark, 60, 0).coalesce(1).write.mode("append").parquet(f"{root}/topic")
    multi_query_app(spark, src, f"{root}/raw", store, f"{root}/ck", trigger={"availableNow": True})
    # "restart": a new run on the same checkpoints after more data arrived
    _topic(spark, 60, 60 * 7).coalesce(1).write.mode("append").parquet(f"{root}/topic")
    multi_query_app(spark, src, f"{root}/raw", store, f"{root}/ck", trigger={"availableNow": True})
    # and a run with nothing new changes nothing
    multi_query_app(spark, src, f"{root}/raw", store, f"{root}/ck", trigger={"availableNow": True})
    raw = read_raw(spark, f"{root}/raw").drop("quote_day")
    assert raw.count() == 120
    batch = aggregate_ohlcv(raw)
    cols = ["symbol", "window_start", "open", "high", "low", "close", "volume", "quote_volume", "vwap",
            "trade_count"]
    assert sorted(tuple(r) for r in store.read().select(cols).collect()) == \
        sorted(tuple(r) for r in batch.select(cols).collect())


def test_quarantine_and_counters(spark, scratch):
    from quotebars.streaming.app import quality_totals
    root = scratch("quar")
    good = _topic(spark, 20, 0)
    bad = good.limit(3).withColumn("value", F.expr("substring(value, 1, 3)"))
    good.unionByName(bad).coalesce(1).write.mode("append").parquet(f"{root}/topic")
    store = BarStore(spark, f"{root}/ohlcv")
    raw_q, _, quar_q = multi_query_app(
        spark, lambda: src_kafka(spark, path=f"{root}/topic"), f"{root}/raw", store, f"{root}/ck",
        trigger={"availableNow": True}, quarantine_path=f"{root}/quarantine")
    assert read_raw(spark, f"{root}/raw").count() == 20
    q = read_quarantine(spark, f"{root}/quarantine")
    assert q.count() == 3 and {r.reject_reason for r in q.collect()} == {"short_frame"}
    assert quality_totals(raw_q) == {"rows": 23, "sent": 20, "dropped": 3}


def test_keyed_topic_files_are_in_time_order_and_keep_key_order(spark, scratch):
    from quotebars.sources.topic import sink_keyed_topic
    root = scratch("topic")
    rows = [("HOT" if i % 4 else "COLD", T0 + dt.timedelta(seconds=i), i) for i in range(400)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp, n int") \
        .select(F.encode("symbol", "UTF-8").alias("key"), F.col("n").cast("string").cast("binary").alias("value"),
                "timestamp")
    sink_keyed_topic(df, path=f"{root}/t", num_files=4)
    files = sorted(spark.read.parquet(f"{root}/t").inputFiles())
    assert len(files) >= 3                       # the hot key spans several files
    seq, last = [], None
    for f in files:
        rows = [(bytes(r.key), r.timestamp) for r in spark.read.parquet(f).collect()]
        assert last is None or min(t for _, t in rows) > last
        last = max(t for _, t in rows)
        seq += rows
    for k in (b"HOT", b"COLD"):
        ts = [t for key, t in seq if key == k]
        assert ts == sorted(ts) and len(ts) == (300 if k == b"HOT" else 100)


def test_keyed_topic_files_stream_without_late_drops(spark, scratch):
    from quotebars.sources.topic import sink_keyed_topic
    root = scratch("topic-stream")
    frames = _topic(spark, 240, 0)
    frames.write.parquet(f"{root}/frames")
    # published by a stream, into files of time ranges
    sink_keyed_topic(spark.readStream.schema(frames.schema).parquet(f"{root}/frames"), path=f"{root}/topic", num_files=4,
                     checkpoint=f"{root}/publish", trigger={"availableNow": True}).awaitTermination()
    multi_query_app(spark, lambda: src_kafka(spark, path=f"{root}/topic", max_files_per_trigger=1), f"{root}/raw",
                    BarStore(spark, f"{root}/ohlcv"), f"{root}/ck", trigger={"availableNow": True})
    assert _totals(spark, root) == (240, 240)


def test_a_publish_that_is_repeated_appears_once(spark, scratch):
    from quotebars.sources.topic import publish_files, read_topic, sink_keyed_topic
    root = scratch("topic-once")
    frames, more = _topic(spark, 40, 0), _topic(spark, 40, 0)
    for _ in range(2):
        sink_keyed_topic(frames, path=f"{root}/t", num_files=2, publish_id="monday")
    assert read_topic(spark, f"{root}/t").count() == 40
    sink_keyed_topic(more, path=f"{root}/t", num_files=2)       # equal rows, another publish
    assert read_topic(spark, f"{root}/t").count() == 80
    # a broken attempt leaves files that nobody sees; the next one replaces them
    frames.limit(7).write.parquet(f"{root}/t/_staged/publish=tuesday")
    assert read_topic(spark, f"{root}/t").count() == 80
    assert publish_files(frames, f"{root}/t", "tuesday", num_files=2)
    assert read_topic(spark, f"{root}/t").count() == 120


def test_a_publish_encodes_each_row_once(spark, scratch):
    from quotebars.sources.topic import sink_keyed_topic
    root, runs = scratch("topic-encode"), spark.sparkContext.accumulator(0)

    def count(n):
        runs.add(1)
        return str(n).encode()

    encode = F.udf(count, "binary").asNondeterministic()        # as the codec of the frames is
    rows = spark.range(0, 500, 1, 4).select(F.lit(b"k").alias("key"), encode("id").alias("value"), F.expr("timestamp_seconds(id * 60)").alias("timestamp"))
    sink_keyed_topic(rows, path=f"{root}/t", num_files=4)
    assert runs.value == 500
    assert spark.read.parquet(f"{root}/t").count() == 500


def test_times_before_and_without(spark):
    from quotebars.sources.topic import in_time_ranges
    rows = spark.createDataFrame([(None,), (T0,), (T0 - dt.timedelta(days=40000),), (T0 + dt.timedelta(hours=3),)], "timestamp timestamp")
    assert in_time_ranges(rows, "timestamp", 3).count() == 4
    assert in_time_ranges(rows.limit(0), "timestamp", 3).count() == 0
    assert in_time_ranges(rows.where("timestamp IS NULL"), "timestamp", 3).count() == 1


def test_quality_listener_totals(spark, scratch):
    import time

    from quotebars.operators.quality import observe_counters, validate_quotes
    from quotebars.streaming.app import QualityListener
    root = scratch("listener")
    rows = [("A", "1", "1", T0), ("A", "x", "1", T0), ("B", "2", "-1", T0)]
    spark.createDataFrame(rows, "symbol string, price string, volume string, quote_time timestamp") \
        .write.parquet(f"{root}/src")
    listener = QualityListener()
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("symbol string, price string, volume string, quote_time timestamp") \
            .parquet(f"{root}/src")
        q = (observe_counters(validate_quotes(stream)).writeStream.format("noop")
             .option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        deadline = time.time() + 20
        while listener.totals.get("rows", 0) < 3 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert listener.totals == {"rows": 3, "sent": 1, "dropped": 2}


def test_job_entry_point(spark, scratch):
    from quotebars.streaming.__main__ import main
    root = scratch("job")
    _topic(spark, 30, 0).coalesce(1).write.parquet(f"{root}/topic")
    main(["--source-path", f"{root}/topic", "--raw-path", f"{root}/raw", "--bars-path", f"{root}/bars",
          "--quarantine-path", f"{root}/quarantine", "--checkpoint", f"{root}/ck", "--available-now",
          "--state-partitions", "2"], spark=spark)
    raw = read_raw(spark, f"{root}/raw").drop("quote_day")
    assert raw.count() == 30
    bars = BarStore(spark, f"{root}/bars").read()
    assert bars.groupBy().sum("trade_count").collect()[0][0] == 30


def _totals(spark, root):
    bars = BarStore(spark, f"{root}/ohlcv").read().groupBy().sum("trade_count").first()[0]
    return read_raw(spark, f"{root}/raw").count(), bars


def test_new_checkpoint_on_existing_outputs_loses_nothing(spark, scratch):
    root = scratch("twice")
    for run, n in (("a", 10), ("b", 20)):
        _topic(spark, n, 0 if run == "a" else 4000).coalesce(1).write.parquet(f"{root}/topic-{run}")
        multi_query_app(spark, lambda run=run: src_kafka(spark, path=f"{root}/topic-{run}"), f"{root}/raw",
                        BarStore(spark, f"{root}/ohlcv"), f"{root}/ck-{run}", trigger={"availableNow": True})
    assert _totals(spark, root) == (30, 30)


def test_restart_after_bars_were_committed_but_not_the_batch(spark, scratch):
    """A crash between the bar commit and the checkpoint commit: the batch comes again."""
    import glob
    import os
    root = scratch("crash")
    src = lambda: src_kafka(spark, path=f"{root}/topic")
    _topic(spark, 30, 0).coalesce(1).write.parquet(f"{root}/topic")
    multi_query_app(spark, src, f"{root}/raw", BarStore(spark, f"{root}/ohlcv"), f"{root}/ck", trigger={"availableNow": True})
    for f in glob.glob(f"{root}/ck/ohlcv_1m/commits/*") + glob.glob(f"{root}/ck/ohlcv_1m/commits/.*crc"):
        os.remove(f)
    for _ in range(2):
        multi_query_app(spark, src, f"{root}/raw", BarStore(spark, f"{root}/ohlcv"), f"{root}/ck", trigger={"availableNow": True})
        assert _totals(spark, root) == (30, 30)


def test_raw_keeps_rows_that_fail_a_check(spark, scratch):
    root = scratch("all")
    rows = [("A", "1", "1", 1, T0, T0, "s"), ("A", "n/a", "1", 2, T0, T0, "s"), ("A", "2", "-1", 3, T0, T0, "s")]
    df = spark.createDataFrame(rows, "symbol string, price string, volume string, day_volume long, quote_time timestamp, "
                                     "ingest_time timestamp, source string")
    good = avro_encode_frame(df).select("key", "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"),
                                        F.lit(0).cast("bigint").alias("offset"), F.lit(T0).alias("timestamp"))
    good.unionByName(good.limit(1).withColumn("value", F.lit(b"x"))).coalesce(1).write.parquet(f"{root}/topic")
    multi_query_app(spark, lambda: src_kafka(spark, path=f"{root}/topic"), f"{root}/raw", BarStore(spark, f"{root}/ohlcv"),
                    f"{root}/ck", trigger={"availableNow": True})
    assert _totals(spark, root) == (3, 3)
    assert sorted(r.reject_reason for r in read_quarantine(spark, f"{root}/raw_quarantine").collect()) == \
        ["bad_price", "negative_volume", "short_frame"]


def test_job_creates_its_catalog_tables(spark, scratch):
    from quotebars.streaming.__main__ import main
    root = scratch("tables")
    _topic(spark, 30, 0).coalesce(1).write.parquet(f"{root}/topic")
    main(["--source-path", f"{root}/topic", "--raw-table", "qb_job.quotes", "--bars-path", f"{root}/bars",
          "--checkpoint", f"{root}/ck", "--available-now", "--table-format", "parquet"], spark=spark)
    assert read_raw(spark, table="qb_job.quotes").count() == 30


def test_kafka_source_options():
    from quotebars.sources.ingest import kafka_options
    got = kafka_options("h:1", "t", "earliest", 5000, {"minPartitions": 12})
    assert got == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest",
                   "maxOffsetsPerTrigger": "5000", "minPartitions": "12"}


def _long_events(spark, folder, days):
    """Two events a day for a symbol each, and one without a time."""
    rows = [(2 * d + i, T0 + dt.timedelta(days=d, seconds=i), "AB"[i], 10.0 + i, f'{{"k": {1 + d % 20}}}') for d in range(days) for i in (0, 1)]
    rows.append((-1, None, "A", 1.0, '{"k": 50}'))
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, value double, props string") \
        .write.parquet(f"{folder}/events.parquet")


def test_micro_batches_follow_the_rows_and_not_the_days(spark, scratch):
    from quotebars.plans import queries as Q
    root, days = scratch("long"), 300
    _long_events(spark, root, days)
    topic = Q._published_topic(spark, root)
    files = spark.read.parquet(f"{topic['path']}/on-time").inputFiles()
    assert len(files) <= Q.BATCHES * topic["k"] < days      # 100 chunks of three days had k files each
    got = {r.symbol: r for r in Q.queries()["stream_reconcile"](spark, root).collect()}
    assert {s: (r.raw_rows, r.bars, r.bar_trades, r.ok) for s, r in got.items()} == {s: (days, days, days, True) for s in "AB"}


def test_topic_files_are_more_when_rows_are_more(spark, scratch):
    from quotebars.plans import queries as Q
    from quotebars.sources.driver_tables import quotes_from_events
    root = scratch("more")
    _long_events(spark, root, 30)
    late = F.col("volume") < 5
    staged = Q.stage_topic_files(spark, quotes_from_events(spark, root), f"{root}/topic", late=late)
    assert Q.publish_staged(spark, staged, f"{root}/topic", files_per_batch=2, least_batches=2, file_rows=6) == 2
    files = sorted(spark.read.parquet(f"{root}/topic/on-time").inputFiles())
    assert 5 <= len(files) <= 9          # 49 rows, six to a file
    seen = [spark.read.parquet(f).agg(F.min("timestamp"), F.max("timestamp")).first() for f in files]
    times = [t for pair in seen for t in pair if t is not None]
    assert times == sorted(times)
    assert Q.publish_staged(spark, staged, f"{root}/topic", late=True, files_per_batch=2) == 2
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/topic").count() == 61
    assert spark.read.parquet(f"{root}/topic/late").count() == spark.read.parquet(staged).where("late = 'true'").count() == 16
