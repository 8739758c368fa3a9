"""Streaming volume increments: the batch scan, carried over from one micro-batch to the next.

Within a micro-batch the predecessor of a quote is found by the same ``ordered_scan`` as in the
batch form, per (symbol, block of event time), so a symbol with most of the rows is spread over
tasks. What reaches across micro-batches is one row for each symbol: its newest quote so far. It
joins the scan as the row before the symbol's first one. The rows are kept in a small table beside
the checkpoint, one version for each micro-batch, so a repeated batch starts from the same state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebars.operators.sequence import ordered_scan
from quotebars.sources.folders import BatchState

CARRY = "symbol string, quote_time timestamp, day_volume bigint"
_KIND, _PREVIOUS = "_kind", "_previous"
ORDER = ("quote_time", _KIND, "day_volume", "price")


def increments_after(quotes: DataFrame, carry: DataFrame, block: Column | None = None) -> DataFrame:
    """``quotes`` with ``volume`` = bigint increment, after a ``carry`` (``carry_after`` the batches before).

    A quote older than the symbol's carried one is late: it gets 0 and does not move the reference, so
    only a newer lower cumulative value counts as a day reset. So does a quote without a time. Everything
    else is as in ``volume_increments``: max(0, day_volume - previous), 0 for a symbol's first quote.
    ``block`` (default: the hour) must not fall along the time; a task scans one block of a symbol."""
    block = F.date_trunc("hour", "quote_time") if block is None else block
    columns = [c for c in quotes.columns if c != "volume"]
    since = carry.select(F.col("symbol").alias("_symbol"), F.col("quote_time").alias("_since"))
    dated = quotes.drop("volume").join(since, F.col("symbol").eqNullSafe(F.col("_symbol")), "left")
    late = F.coalesce(F.col("quote_time") < F.col("_since"), F.col("quote_time").isNull())
    on_time = dated.where(~late).select(*columns, F.lit(1).alias(_KIND))
    rows = on_time.unionByName(carry.withColumn(_KIND, F.lit(0)), allowMissingColumns=True)
    scanned = ordered_scan(rows, ["symbol"], list(ORDER), "day_volume", previous=_PREVIOUS, block=block)
    zero = F.lit(0).cast("bigint")
    increment = F.coalesce(F.greatest(zero, F.col("day_volume") - F.col(_PREVIOUS)), zero)
    counted = scanned.where(F.col(_KIND) == 1).select(*columns, increment.alias("volume"))
    return counted.unionByName(dated.where(late).select(*columns, zero.alias("volume")))


def carry_after(quotes: DataFrame, carry: DataFrame) -> DataFrame:
    """Each symbol's newest quote of a micro-batch and the carry before it: one row for each symbol."""
    rows = quotes.where(F.col("quote_time").isNotNull()).withColumn(_KIND, F.lit(1))
    rows = rows.unionByName(carry.withColumn(_KIND, F.lit(0)), allowMissingColumns=True)
    place = F.struct(*[F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("value")).alias(c) for c in ORDER])
    newest = rows.groupBy("symbol").agg(F.max_by(F.struct("quote_time", "day_volume"), place).alias("newest"))
    return newest.select("symbol", "newest.quote_time", "newest.day_volume")


def increments_stateful(quotes: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], object], block: Column | None = None,
                        trigger: dict | None = None, query_name: str = "increments", only: Column | None = None):
    """Start a stream that gives every micro-batch of ``quotes`` (symbol, quote_time, day_volume, price and
    more) with its increments to ``sink(rows, batch_id)``. A batch may come again after a crash, with the
    same rows and number: a sink that puts it under its number keeps it once. ``only`` tells which rows
    count; it is applied to a batch's evaluated rows, so Spark can't evaluate what it needs a second time
    below a repartition of the source."""
    state = BatchState(quotes.sparkSession, f"{checkpoint.rstrip('/')}/carry", CARRY)

    def step(batch: DataFrame, batch_id: int) -> None:
        before = state.before(batch_id, batch.sparkSession)
        held = batch.persist()      # the scan reads it several times, the sink and the carry read its result
        rows = increments_after(held if only is None else held.where(only), before, block).persist()
        try:
            # held once before the scan's branches ask for it, else each of them evaluates the source
            held.write.format("noop").mode("overwrite").save()
            sink(rows, batch_id)
            state.put(carry_after(rows, before), batch_id)
        finally:
            rows.unpersist()
            held.unpersist()

    writer = quotes.writeStream.queryName(query_name).option("checkpointLocation", checkpoint).foreachBatch(step)
    return (writer.trigger(**trigger) if trigger else writer).start()
