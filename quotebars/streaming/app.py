"""Structured Streaming job: quotes topic -> raw table (append) + bars (upsert).

Two queries read the source independently: a stateless exactly-once raw append and a
watermarked tumbling-window rollup whose update-mode output is upserted per
micro-batch. (A single foreachBatch cannot carry window state across batches, so the
double read is deliberate.) Watermarking needs a TIMESTAMP column; NTZ inputs are
cast under the UTC session zone first.

Shuffle partitions of a stateful query are fixed at its first start (they are stored
in the checkpoint); set ``spark.sql.shuffle.partitions`` before the first run.
"""

from __future__ import annotations

import functools
from contextlib import contextmanager
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from quotebars.operators.quality import observe_counters, split_valid, validate_quotes
from quotebars.operators.rollup import aggregate_ohlcv
from quotebars.schemas import WATERMARK_DELAY, WINDOW_DURATION
from quotebars.sources.ingest import to_quotes
from quotebars.sources.tables import BarStore, _file_system, sink_raw_append, writer_id
from quotebars.sources.wire import read_framed_quotes
from quotebars.session import configure
from quotebars.streaming.serving import TopBars, start_counters_query


def decoded_quotes(tagged: DataFrame) -> DataFrame:
    """Canonical quotes of every message that decodes. A price, volume or time that is no such
    value is NULL: the row is in the raw table, and counts as a trade of its window if it has
    one; the quarantine holds the original values and the reason besides."""
    return to_quotes(tagged.where(F.col("decode_error").isNull()))


def with_event_time(quotes: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    return (quotes.withColumn("quote_time", F.col("quote_time").cast("timestamp"))
                  .withWatermark("quote_time", delay))


def bars_stream(quotes: DataFrame, window_duration: str = WINDOW_DURATION,
                delay: str = WATERMARK_DELAY) -> DataFrame:
    return aggregate_ohlcv(with_event_time(quotes, delay), window_duration)


def start_bars_query(quotes: DataFrame, store: BarStore, checkpoint: str,
                     window_duration: str = WINDOW_DURATION, delay: str = WATERMARK_DELAY,
                     trigger: dict | None = None, query_name: str = "ohlcv_1m", top: TopBars | None = None):
    """Update-mode windowed rollup upserted per micro-batch (batch id = idempotency key); ``top`` is a
    serving table of the newest bars to keep up to date besides."""
    upsert = store.for_checkpoint(checkpoint).foreach_batch()

    def step(bars: DataFrame, batch_id: int) -> None:
        # a batch's changed bars, written to both; dealt anew, as Spark can't hold the sorted output of the state
        held = bars.repartition("symbol", "window_start").persist()
        try:
            upsert(held, batch_id)
            top.put(held, batch_id)
        finally:
            held.unpersist()

    writer = (bars_stream(quotes, window_duration, delay).writeStream.queryName(query_name)
              .outputMode("update")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(upsert if top is None else step))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_quarantine_query(kafka_rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                           query_name: str = "quotes_quarantine"):
    """Exactly-once append of rejected messages with their reason (partitioned by it), in a part
    of the folder for each checkpoint; ``read_quarantine`` reads them all."""
    path = f"{path.rstrip('/')}/{writer_id(kafka_rows.sparkSession, checkpoint)}"
    tagged = validate_quotes(read_framed_quotes(kafka_rows))
    _, quarantine = split_valid(tagged)
    writer = (quarantine.writeStream.queryName(query_name).format("parquet").outputMode("append")
              .partitionBy("reject_reason").option("checkpointLocation", checkpoint).option("path", path))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rejected messages of all checkpoints."""
    fs, root, _ = _file_system(spark, path.rstrip("/"))
    # one folder per checkpoint
    parts = sorted(st.getPath().toString() for st in fs.listStatus(root))
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.parquet(p) for p in parts])


@contextmanager
def state_partitions(spark: SparkSession, n: int | None):
    """Start a stateful query with ``n`` shuffle (= state store) partitions. A query
    clones the session conf when it starts and the count is then fixed by its
    checkpoint, so the session setting is restored right after the start."""
    if not n:
        yield
        return
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def multi_query_app(spark: SparkSession, source: Callable[[], DataFrame], raw_path: str | None,
                    store: BarStore, checkpoint_root: str, window_duration: str = WINDOW_DURATION,
                    delay: str = WATERMARK_DELAY, trigger: dict | None = None,
                    wait: bool = True, quarantine_path: str | None = None,
                    num_state_partitions: int | None = None, raw_table: str | None = None,
                    top: TopBars | None = None, counters_path: str | None = None):
    """Start the raw append, the bar upsert and the quarantine append, each reading the
    source itself and owning a checkpoint sub-folder. The raw table (a folder, or the
    catalog table ``raw_table``) gets every message that decodes; messages that don't, or
    that fail a check, go to the quarantine with their reason (by default next to the raw
    folder, or under the checkpoints if there is none). The raw query carries ``quality``
    observed metrics (rows, sent, dropped) in its progress. ``top`` keeps the newest bars of every symbol,
    ``counters_path`` the counts by outcome since the checkpoint's first run. With ``wait`` the call blocks
    until all finish (bounded triggers) or one fails/ends (unbounded)."""
    configure(spark)
    quarantine_path = quarantine_path or (f"{raw_path.rstrip('/')}_quarantine" if raw_path else f"{checkpoint_root}/quarantined")
    tagged = observe_counters(validate_quotes(read_framed_quotes(source())), "quality")
    raw_q = sink_raw_append(decoded_quotes(tagged), raw_path, f"{checkpoint_root}/quotes_raw", trigger=trigger, table=raw_table)
    with state_partitions(spark, num_state_partitions):
        bars_q = start_bars_query(decoded_quotes(read_framed_quotes(source())), store, f"{checkpoint_root}/ohlcv_1m",
                                  window_duration, delay, trigger, top=top)
        queries = [raw_q, bars_q, start_quarantine_query(source(), quarantine_path, f"{checkpoint_root}/quarantine", trigger)]
        if counters_path:
            queries.append(start_counters_query(validate_quotes(read_framed_quotes(source())), counters_path,
                                                f"{checkpoint_root}/counters", trigger))
    if wait:
        if trigger and (trigger.get("availableNow") or trigger.get("once")):
            for q in queries:
                q.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
        for q in queries:
            if q.exception() is not None:
                raise RuntimeError(f"query {q.name} failed: {q.exception()}")
    return tuple(queries)


def dropped_by_watermark(query) -> int:
    """Rows the watermark dropped as late, summed over the retained progress reports
    (they are still in the raw table; ``late_rows_report`` lists the affected bars)."""
    return sum(int(op.numRowsDroppedByWatermark or 0)
               for p in query.recentProgress for op in (p.stateOperators or []))


def quality_totals(query, name: str = "quality") -> dict:
    """Sum the observed quality counters over the query's retained progress reports."""
    totals: dict = {}
    for p in query.recentProgress:
        row = (p.observedMetrics or {}).get(name)
        if row is None:
            continue
        for k, v in row.asDict().items():
            totals[k] = totals.get(k, 0) + int(v or 0)
    return totals


class QualityListener(StreamingQueryListener):
    """Running totals of the observed quality counters for a long-running app
    (register with ``spark.streams.addListener``)."""

    def __init__(self, name: str = "quality"):
        self.name = name
        self.totals: dict = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        metrics = event.progress.observedMetrics.get(self.name)
        if metrics is None:
            return
        for k, v in metrics.asDict().items():
            self.totals[k] = self.totals.get(k, 0) + int(v or 0)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
