"""Keyed topic sink: framed messages keyed by symbol, per-key order preserved.

With a Kafka bootstrap address the rows go to the Kafka sink (batch or streaming; needs the
Kafka connector on the classpath), with producer options such as ``acks=all`` and
``compression.type=zstd``. Without one, the same rows are written as parquet files in time
order: a file holds a range of the time, sorted by key and time within it. So a hot key is
spread over many files, reading the files in order replays every key in order, and a stream
that takes one file after the other sees time advance and drops nothing as late. The ranges are
cut between blocks of time (minutes), from the blocks' counts. Every publish is a folder that
appears whole and once: a publish or a micro-batch that is repeated after a crash finds itself done.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotebars.schemas import KAFKA_ROW
from quotebars.sources.folders import batch_name, file_system, put_once

PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.compression.type": "zstd", "kafka.linger.ms": "50",
                    "kafka.enable.idempotence": "true"}
#: unit of time that a file is not cut within
BLOCK = "minute"


def sink_keyed_topic(frames: DataFrame, topic: str = "market.quotes", bootstrap: str | None = None,
                     path: str | None = None, order_cols=("timestamp",), num_files: int | None = None,
                     checkpoint: str | None = None, options: dict | None = None, trigger: dict | None = None,
                     publish_id: str | None = None, block: str = BLOCK):
    """Publish ``key, value`` rows (plus ``order_cols``, the first of them a time) keyed by symbol.

    To files, a batch publish is known by its ``publish_id`` (a new one if none is given) and a
    stream's by its checkpoint and batch number; one that has been published before is left out. The
    Kafka sink is at least once. Returns the started streaming query for a streaming input, else None."""
    opts = dict(PRODUCER_OPTIONS)
    opts.update(options or {})
    if bootstrap:
        out = frames.select("key", "value").where(F.col("value").isNotNull())
        if frames.isStreaming:
            w = out.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
            for k, v in opts.items():
                w = w.option(k, v)
            if checkpoint is None:     # stable per topic, so a restart resumes where it stopped
                from quotebars.session import checkpoint_root
                checkpoint = f"{checkpoint_root(frames.sparkSession)}/publish-{topic}"
            return (w.trigger(**trigger) if trigger else w).option("checkpointLocation", checkpoint).start()
        w = out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
        for k, v in opts.items():
            w = w.option(k, v)
        w.save()
        return None
    if not path:
        raise ValueError("give either a Kafka bootstrap address or a file path")
    if frames.isStreaming:
        if checkpoint is None:
            from quotebars.session import checkpoint_root
            checkpoint = f"{checkpoint_root(frames.sparkSession)}/topic-sink/{topic}"
        from quotebars.sources.tables import writer_id
        writer = writer_id(frames.sparkSession, checkpoint)

        def publish(batch: DataFrame, number: int) -> None:
            publish_files(batch, path, f"{writer}-{batch_name(number)}", order_cols, num_files, block)

        w = frames.writeStream.option("checkpointLocation", checkpoint).foreachBatch(publish)
        return (w.trigger(**trigger) if trigger else w).start()
    publish_files(frames, path, publish_id or uuid.uuid4().hex[:12], order_cols, num_files, block)
    return None


def publish_files(frames: DataFrame, path: str, publish_id: str, order_cols=("timestamp",), num_files: int | None = None,
                  block: str = BLOCK) -> bool:
    """Publish rows as files in the order of time, in the folder ``publish_id``. False if that is there; the
    rows are evaluated all the same then, as a stateful stream commits its state only so."""
    spark = frames.sparkSession
    n = num_files or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

    def write(folder: str) -> None:
        write_in_time_order(frames, folder, n, ("key", *order_cols), order_cols[0], block, F.col("value").isNotNull())

    if put_once(spark, path, f"publish={publish_id}", write):
        return True
    frames.write.format("noop").mode("overwrite").save()
    return False


def write_in_time_order(rows: DataFrame, folder: str, files: int, sort_cols, time_col: str = "timestamp", block: str = BLOCK,
                        only: Column | None = None) -> None:
    """Write the rows (those for which ``only`` holds) as ``files`` parquet files, each a range of time, sorted by
    ``sort_cols``, in the order of their names and, for a file stream, of their modification times. Columns other
    than the time are evaluated once, ``only`` included."""
    ranged = in_time_ranges(rows, time_col, files, block)
    (ranged if only is None else ranged.where(only)).sortWithinPartitions(*sort_cols).write.mode("overwrite").parquet(folder)
    _stamp(rows.sparkSession, folder)


def in_time_ranges(rows: DataFrame, time_col: str, files: int, block: str = BLOCK) -> DataFrame:
    """``rows`` in ``files`` partitions, each a range of time, in order, and about equal in rows as far as
    whole blocks allow. The cuts come from one count for each block of time, for which only the time is
    read; rows without a time are in the first partition."""
    when = F.date_trunc(block, F.col(time_col))
    counts = rows.where(F.col(time_col).isNotNull()).groupBy(when.alias("block")).agg(F.count(F.lit(1)).alias("n"))
    along = Window.orderBy("block")     # one row for each block of time
    before = F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy())
    placed = counts.select("block", F.floor(before * files / total).alias("file"))
    cuts = placed.groupBy("file").agg(F.min("block").alias("begin")).orderBy("begin").collect()     # a row for each file
    return rows.repartitionById(files, F.coalesce(_number(F.col(time_col), [r["begin"] for r in cuts[1:]], 0), F.lit(0)))


def _number(value: Column, cuts: list, low: int) -> Column:
    """How many of the ascending ``cuts`` ``value`` has reached, by halving."""
    if not cuts:
        return F.lit(low)
    mid = len(cuts) // 2
    return F.when(value < F.lit(cuts[mid]), _number(value, cuts[:mid], low)).otherwise(_number(value, cuts[mid + 1:], low + mid + 1))


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    """All published rows."""
    return spark.read.schema(KAFKA_ROW).option("recursiveFileLookup", "true").parquet(path)


def _stamp(spark, path: str) -> None:
    """Give the files modification times in the order of their names, as a file stream reads by
    modification time and tasks may end in any order. A publish does so before it is shown. One call
    per file; a store that keeps no such times ignores it."""
    fs, folder, _ = file_system(spark, path)
    found = [st for st in fs.listStatus(folder) if st.getPath().getName().startswith("part-")]
    last = int(time.time() * 1000)
    for i, st in enumerate(sorted(found, key=lambda st: st.getPath().getName())):
        fs.setTimes(st.getPath(), last - len(found) + i, -1)


def sink_bars_topic(bars: DataFrame, topic: str = "market.ohlcv", schema_id: int = 2,
                    bootstrap: str | None = None, path: str | None = None, num_files: int | None = None,
                    checkpoint: str | None = None, options: dict | None = None, publish_id: str | None = None):
    """Publish bars with the BAR contract (decimals as Avro bytes-decimal), keyed by
    symbol and ordered by window start per key."""
    from quotebars.schemas import OHLCV_AVRO
    from quotebars.sources.wire import avro_encode_frame
    frames = avro_encode_frame(bars, schema_id=schema_id, contract=OHLCV_AVRO, keep=["window_start"])
    return sink_keyed_topic(frames.withColumnRenamed("window_start", "timestamp"), topic=topic,
                            bootstrap=bootstrap, path=path, num_files=num_files, checkpoint=checkpoint,
                            options=options, publish_id=publish_id)
