"""Tumbling-window OHLCV/VWAP rollup (batch and streaming share this code)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotebars.functions.scalar import vwap_case
from quotebars.schemas import BAR, WINDOW_DURATION

EXACT_INPUT = "decimal(18,8)"


def aggregate_ohlcv(quotes: DataFrame, window_duration: str = WINDOW_DURATION,
                    exact: bool = False, with_updated_at: bool = True) -> DataFrame:
    """Roll quotes into tumbling bars keyed by ``(symbol, window_start)``.

    * open/close are the prices of the first/last quote in event time; quotes sharing a
      timestamp are ordered by ``(quote_time, day_volume, price)`` so the result never
      depends on arrival order.
    * high/low skip NULL prices; trade_count counts every row (NULL price included).
    * vwap = sum(price*volume) / sum(volume), or close when the window traded nothing.
    * default arithmetic keeps decimal(38,8) inputs, whose products Spark rounds to 6
      places; ``exact=True`` narrows inputs to decimal(18,8) so every product and the
      sums keep all 16 fractional digits before the final decimal(38,8) cast (inputs
      must fit decimal(18,8), i.e. below 1e10; a larger value fails the ANSI cast).
    * rows with a NULL quote_time fall out of every window.

    Aggregation is partial per task then final after one exchange on
    ``(window, symbol)``, so a hot symbol costs one partial row per task and window.
    """
    money = {c: F.col(c).cast(EXACT_INPUT) if exact else F.col(c) for c in ("price", "volume")}
    place = F.struct("quote_time", "day_volume", "price")
    bars = quotes.groupBy("symbol", F.window("quote_time", window_duration)).agg(
        F.struct(F.min_by("price", place).alias("open"), F.max_by("price", place).alias("close"),
                 F.min("price").alias("low"), F.max("price").alias("high")).alias("prices"),
        F.sum(money["volume"]).alias("volume"),
        F.sum(money["price"] * money["volume"]).alias("quote_volume"),
        F.count(F.lit(1)).alias("trade_count"))
    # where each field of the contract comes from, unless it has its own column
    source = {"window_start": F.col("window.start"), "window_end": F.col("window.end"), "updated_at": F.current_timestamp(),
              "vwap": vwap_case("quote_volume", "volume", "prices.close")}
    source |= {c: F.col(f"prices.{c}") for c in ("open", "high", "low", "close")}
    fields = [f for f in BAR.fields if with_updated_at or f.name != "updated_at"]
    return bars.select(*[source.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in fields])
