"""Small tables that a stream keeps up to date: the newest bars of every symbol, and counts by outcome.

Each is replaced in every micro-batch (``BatchState``), from the table before the batch and what the
batch has changed, so a batch that is repeated gives the same table again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotebars.operators.quality import publish_counters
from quotebars.operators.serving import DEFAULT_BARS, topn_per_symbol
from quotebars.schemas import BAR
from quotebars.sources.folders import BatchState

COUNTERS = "status string, n bigint"


class TopBars:
    """The newest ``n`` bars of every symbol: at most ``n`` rows a symbol, whatever the history.

    A bar is only ever added or replaced, so the newest ``n`` after a batch are among the newest ``n`` before
    it and the batch's own; a late row changes a bar that is among them or one that is too old to show."""

    def __init__(self, spark: SparkSession, path: str, n: int = DEFAULT_BARS) -> None:
        self.state, self.n = BatchState(spark, path, BAR), n

    def merged(self, before: DataFrame, changed: DataFrame) -> DataFrame:
        keys = changed.select(F.col("symbol").alias("_symbol"), F.col("window_start").alias("_start"))
        same = F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("window_start") == F.col("_start"))
        bars = before.join(keys, same, "left_anti").unionByName(changed.select(*before.columns))
        return topn_per_symbol(bars, [F.col("window_start").desc()], self.n).drop("rn")

    def put(self, changed: DataFrame, batch_id: int) -> None:
        self.state.put(self.merged(self.state.before(batch_id, changed.sparkSession), changed), batch_id)

    def read(self) -> DataFrame:
        return self.state.read()


def start_counters_query(tagged: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, query_name: str = "quotes_counters"):
    """Rows per outcome (``publish_counters``) of all batches of a checkpoint so far, restarts included. The
    counts are the stream's own state, so each row counts once however often its batch is tried."""
    state = BatchState(tagged.sparkSession, path, COUNTERS)

    def step(changed: DataFrame, batch_id: int) -> None:
        both = state.before(batch_id, changed.sparkSession).unionByName(changed)
        state.put(both.groupBy("status").agg(F.max("n").alias("n")), batch_id)      # a count only grows

    writer = (publish_counters(tagged).writeStream.queryName(query_name).outputMode("update")
              .option("checkpointLocation", checkpoint).foreachBatch(step))
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    return BatchState(spark, path, COUNTERS).read()
