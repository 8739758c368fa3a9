"""Read-side operators: latest bars/ticks, top-N per symbol, tick direction, summaries.

All are plain DataFrame plans. A single-symbol read filters on the bare ``symbol``
column (pushed to the scan / partition pruning) and ends in ``orderBy(...).limit(n)``,
which Spark plans as ``TakeOrderedAndProject`` (per-task top-n, then a merge of at
most n rows per task). Per-symbol top-N uses ``row_number() <= n``, which Spark turns
into a partial ``WindowGroupLimit`` *before* the shuffle, so a hot symbol ships at
most n rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotebars.functions.scalar import tick_side, ts_to_ms

MAX_LIMIT = 500
DEFAULT_BARS = 120
DEFAULT_TICKS = 40
DEFAULT_ALL_BARS = 10
RECENT_BARS = 12
TICK_ORDER = ("quote_time", "day_volume", "price")


def check_limit(n: int, max_limit: int = MAX_LIMIT) -> int:
    if not isinstance(n, int) or isinstance(n, bool) or n < 1 or n > max_limit:
        raise ValueError(f"limit must be an integer in 1..{max_limit}, got {n!r}")
    return n


def serve_bars(bars: DataFrame) -> DataFrame:
    """Bars in the read shape: millis timestamps and doubles."""
    return bars.select(
        "symbol",
        ts_to_ms("window_start").alias("window_start_ms"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume", "vwap")],
        F.col("trade_count"),
    )


def bars_as_doubles(bars: DataFrame) -> DataFrame:
    """Every bar column except ``updated_at``, as millis and doubles (for comparisons)."""
    return bars.select(
        "symbol",
        ts_to_ms("window_start").alias("window_start_ms"),
        ts_to_ms("window_end").alias("window_end_ms"),
        *[F.col(c).cast("double").alias(c)
          for c in ("open", "high", "low", "close", "volume", "quote_volume", "vwap")],
        F.col("trade_count"),
    )


def serve_ticks(quotes: DataFrame) -> DataFrame:
    """Quotes in the read shape: volume -> quantity, quote_time -> trade_time_ms."""
    return quotes.select(
        "symbol",
        F.col("price").cast("double").alias("price"),
        F.col("volume").cast("double").alias("quantity"),
        ts_to_ms("quote_time").alias("trade_time_ms"),
    )


def filter_symbol(df: DataFrame, symbol: str) -> DataFrame:
    return df.where(F.col("symbol") == F.lit(symbol))


def latest_bars(bars: DataFrame, symbol: str, n: int = DEFAULT_BARS) -> DataFrame:
    """Newest n bars of one symbol, returned oldest first."""
    check_limit(n)
    newest = filter_symbol(bars, symbol).orderBy(F.col("window_start").desc()).limit(n)
    return serve_bars(newest).orderBy("window_start_ms")


def latest_ticks(quotes: DataFrame, symbol: str, n: int = DEFAULT_TICKS) -> DataFrame:
    """Newest n quotes of one symbol, newest first (ties: larger day_volume, price first)."""
    check_limit(n)
    newest = [F.col(c).desc() for c in TICK_ORDER]
    # the whole order once more over the n rows, before it is projected away
    return serve_ticks(filter_symbol(quotes, symbol).orderBy(*newest).limit(n).orderBy(*newest))


def latest_bars_all(bars: DataFrame, n: int = DEFAULT_ALL_BARS) -> DataFrame:
    """Newest n bars across all symbols (ties broken by symbol)."""
    check_limit(n)
    return serve_bars(bars.orderBy(F.col("window_start").desc(), F.col("symbol").asc()).limit(n))


def topn_per_symbol(df: DataFrame, order_cols, n: int, rank_col: str = "rn") -> DataFrame:
    """Top n rows per symbol by ``order_cols`` (Columns, e.g. ``F.col('t').desc()``); n is free,
    unlike the limit of the two single-symbol reads."""
    if n < 1:
        raise ValueError(f"n must be positive, got {n!r}")
    w = Window.partitionBy("symbol").orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def topn_bars(bars: DataFrame, n: int = DEFAULT_BARS) -> DataFrame:
    """Serving table: newest n bars of every symbol with their recency rank."""
    ranked = topn_per_symbol(bars, [F.col("window_start").desc()], n)
    return ranked.select(
        "symbol", ts_to_ms("window_start").alias("window_start_ms"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume", "vwap")],
        "trade_count", F.col("rn").cast("bigint").alias("rn"))


def recent_bars(bars: DataFrame, n: int = RECENT_BARS) -> DataFrame:
    """The table view: last n bars per symbol, newest first (rn = 1 is newest)."""
    return topn_bars(bars, n)


def latest_price(quotes: DataFrame) -> DataFrame:
    """Price of the newest quote of each symbol (partial + final aggregation)."""
    order = F.struct(*[F.col(c) for c in TICK_ORDER])
    return quotes.groupBy("symbol").agg(
        F.max_by(F.col("price"), order).cast("double").alias("price"),
        ts_to_ms(F.max("quote_time")).alias("trade_time_ms"),
    )


def tick_direction(quotes: DataFrame, n: int = DEFAULT_TICKS) -> DataFrame:
    """The tape: newest n ticks per symbol, each 'up' if its price is >= the next older
    *shown* tick (the oldest shown tick is 'up'). The comparison runs after the top-n
    cut, on at most n rows per symbol."""
    ranked = topn_per_symbol(quotes, [F.col(c).desc() for c in TICK_ORDER], n)
    older = F.lead(F.col("price")).over(Window.partitionBy("symbol").orderBy("rn"))
    return ranked.select(
        "symbol", F.col("rn").cast("bigint").alias("rn"),
        F.col("price").cast("double").alias("price"),
        F.col("volume").cast("double").alias("quantity"),
        ts_to_ms("quote_time").alias("trade_time_ms"),
        tick_side(F.col("price"), older).alias("side"),
    )


def close_series_summary(bars: DataFrame, n: int = DEFAULT_BARS) -> DataFrame:
    """Chart scaling over the newest n bars of each symbol: min/max close, range (a flat
    series gets range 1), first/last close and direction ('up' if last >= first).
    Symbols with fewer than two bars get no summary."""
    ranked = topn_per_symbol(bars, [F.col("window_start").desc()], n)
    close = F.col("close").cast("double")
    s = ranked.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("points"),
        F.min(close).alias("min_close"),
        F.max(close).alias("max_close"),
        F.min_by(close, F.col("window_start")).alias("first_close"),
        F.max_by(close, F.col("window_start")).alias("last_close"),
    )
    rng = F.col("max_close") - F.col("min_close")
    return s.where(F.col("points") >= 2).select(
        "symbol", "points", "min_close", "max_close",
        F.when(rng == 0, F.lit(1.0)).otherwise(rng).alias("close_range"),
        "first_close", "last_close",
        F.when(F.col("last_close") >= F.col("first_close"), F.lit("up")).otherwise(F.lit("down")).alias("direction"),
    )
