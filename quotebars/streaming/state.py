"""What a stopped rollup knows, read from its checkpoint: the watermark and the windows still open.

The open windows come from Spark's state data source, the watermark from the offset log of the last
committed micro-batch. Neither needs the stream to run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotebars.functions.scalar import vwap_case
from quotebars.schemas import BAR_VALUE_COLUMNS, DECIMAL
from quotebars.sources.folders import names

_PLACE = f"struct<quote_time:timestamp,day_volume:bigint,price:{DECIMAL}>"
#: the aggregation buffers of ``aggregate_ohlcv``, in its order; the state data source names some of them alike
BUFFERS = (f"struct<open:{DECIMAL},open_place:{_PLACE},close:{DECIMAL},close_place:{_PLACE},low:{DECIMAL},high:{DECIMAL},"
           f"volume:{DECIMAL},no_volume:boolean,quote_volume:decimal(38,6),no_quote_volume:boolean,trade_count:bigint>")


def watermark_of(spark: SparkSession, checkpoint: str):
    """The event-time watermark (a UTC timestamp) of the last committed micro-batch, None before the first. A
    window that ends by then is closed: the stream never changes its bar again."""
    done = [int(n) for n in names(spark, f"{checkpoint.rstrip('/')}/commits")]
    if not done:
        return None
    log = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{max(done)}")
    millis = F.get_json_object("value", "$.batchWatermarkMs").cast("bigint")
    return log.select(F.max(F.timestamp_millis(millis))).first()[0]


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The bars of the windows that the rollup with this checkpoint holds as state, as of its last committed
    micro-batch or of ``batch_id``: the bar columns but for ``updated_at``."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint).select("key.symbol", F.col("key.window.start").alias("window_start"),
                                           F.col("key.window.end").alias("window_end"), F.col("value").cast(BUFFERS).alias("v"))
    money = {c: F.col(f"v.{c}").cast(DECIMAL).alias(c) for c in ("open", "high", "low", "close", "volume", "quote_volume")}
    vwap = vwap_case(F.col("v.quote_volume"), F.col("v.volume"), F.col("v.close")).cast(DECIMAL).alias("vwap")
    return state.select("symbol", "window_start", "window_end", *money.values(), vwap, "v.trade_count")


def reconcile_open_windows(held: DataFrame, bars: DataFrame) -> DataFrame:
    """Every open window with ``status``: ``same`` if the bar table has the bar as the state has it, ``differs``
    or ``missing``. Only the windows in ``held`` are looked up."""
    other = bars.select(F.col("symbol").alias("_symbol"), F.col("window_start").alias("_start"),
                        *[F.col(c).alias(f"_{c}") for c in (*BAR_VALUE_COLUMNS, "trade_count")])
    met = held.join(other, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("window_start") == F.col("_start")), "left")
    same = F.lit(True)
    for c in (*BAR_VALUE_COLUMNS, "trade_count"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    status = F.when(F.col("_start").isNull(), "missing").when(same, "same").otherwise("differs")
    return met.select(*held.columns, status.alias("status"))
