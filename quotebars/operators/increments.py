"""Traded-volume increments from cumulative day volume (batch form).

increment = max(0, day_volume - previous day_volume of the same symbol), 0 for the
symbol's first quote. A day reset (lower cumulative value) gives 0 and the lower
value becomes the new reference. The predecessor comes from ``ordered_scan`` in blocks of
event time, so no task holds all rows of a symbol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebars.operators.sequence import ordered_scan

DEFAULT_ORDER = ("quote_time", "day_volume", "price")


def volume_increments(quotes: DataFrame, order_cols=DEFAULT_ORDER, out_col: str = "volume",
                      block: Column | None = None) -> DataFrame:
    """Replace/add ``out_col`` with the bigint increment of ``day_volume`` per symbol. ``block``
    is the unit that one task scans (default: a symbol's day)."""
    prev = "_prev_day_volume"
    scanned = ordered_scan(quotes, ["symbol"], list(order_cols), "day_volume",
                           previous=prev, block=F.to_date(order_cols[0]) if block is None else block)
    inc = F.coalesce(F.greatest(F.lit(0).cast("bigint"), F.col("day_volume") - F.col(prev)),
                     F.lit(0).cast("bigint"))
    return scanned.withColumn(out_col, inc).drop(prev)
