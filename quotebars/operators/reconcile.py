"""Backfill, late-row report, reconciliation counts.

The report and the backfill work on days that need it. A day of a symbol is compared by sums that
do not depend on the order of rows and that raw quotes and bars have in common, so finding the days
takes one narrow pass and a shuffle of one row for each (symbol, day) and task. Only the days that
differ are read again, as partitions, and recomputed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebars.operators.rollup import aggregate_ohlcv
from quotebars.schemas import BAR_VALUE_COLUMNS, WINDOW_DURATION
from quotebars.session import scratch_dir
from quotebars.sources.tables import BarStore

DAY = "quote_day"
COMPARED = (*BAR_VALUE_COLUMNS, "trade_count")


def _start(window_duration: str) -> Column:
    return F.window("quote_time", window_duration)["start"]


def _bars_of(bars: DataFrame | BarStore, days: list | None = None) -> DataFrame:
    """All bars, or those of some days (of a store only the partitions from the first to the last are read)."""
    if isinstance(bars, BarStore):
        bars = bars.read(day_lo=min(days).isoformat(), day_hi=max(days).isoformat()) if days else bars.read()
    return bars if days is None else bars.where(F.to_date("window_start").isin(days))


def _weight(start: Column) -> Column:
    """A number for each window, so that weighted counts tell which windows the rows are in."""
    return F.pmod(F.xxhash64(start), F.lit((1 << 31) - 1)).cast("decimal(10,0)")


def _sums(rows: DataFrame, start: Column, count: Column, money: dict[str, Column]) -> DataFrame:
    return rows.groupBy("symbol", F.to_date(start).alias("day")).agg(
        F.sum(count).alias("count"), F.sum(_weight(start) * count.cast("decimal(18,0)")).alias("windows"),
        *[F.sum(money[c]).cast("decimal(38,6)").alias(c) for c in ("volume", "quote_volume")],
        F.max(money["high"]).alias("high"), F.min(money["low"]).alias("low"))


def _fingerprints(bars: DataFrame) -> DataFrame:
    """A sum over all values of a day's bars."""
    return bars.groupBy("symbol", F.to_date("window_start").alias("day")).agg(
        F.sum(F.xxhash64("window_start", *COMPARED).cast("decimal(38,0)")).alias("bars"))


def differing_days(raw: DataFrame, bars: DataFrame | BarStore, window_duration: str = WINDOW_DURATION, thorough: bool = False) -> DataFrame:
    """(symbol, day) for which raw and bars disagree, as a small table in the shared scratch folder.

    Compared are the counts, the counts weighted by window, volume, quote volume, highest and lowest price:
    whatever rows are lost, late, repeated or in another window shows in them. With ``thorough`` every bar is
    recomputed and all its values go into the sum, so that a bar that was changed by hand shows, too."""
    if thorough:
        expected, actual = _fingerprints(aggregate_ohlcv(raw, window_duration, with_updated_at=False)), _fingerprints(_bars_of(bars))
    else:
        timed = raw.where(F.col("quote_time").isNotNull()).select(
            "symbol", _start(window_duration).alias("start"), "price", "volume", (F.col("price") * F.col("volume")).alias("traded"))
        expected = _sums(timed, F.col("start"), F.lit(1).cast("bigint"),
                         {"volume": F.col("volume"), "quote_volume": F.col("traded"), "high": F.col("price"), "low": F.col("price")})
        actual = _sums(_bars_of(bars), F.col("window_start"), F.col("trade_count"),
                       {c: F.col(c) for c in ("volume", "quote_volume", "high", "low")})
    checks = [c for c in expected.columns if c not in ("symbol", "day")]
    e, a = expected.alias("e"), actual.alias("a")
    met = e.join(a, F.col("e.symbol").eqNullSafe(F.col("a.symbol")) & (F.col("e.day") == F.col("a.day")), "full_outer")
    same = F.lit(True)
    for c in checks:
        same = same & F.col(f"e.{c}").eqNullSafe(F.col(f"a.{c}"))
    found = met.where(~same).select(F.coalesce("e.symbol", "a.symbol").alias("symbol"), F.coalesce("e.day", "a.day").alias("day"))
    path = f"{scratch_dir(raw.sparkSession, 'days')}/days"
    found.write.parquet(path)
    return raw.sparkSession.read.parquet(path)


def _calendar(days: DataFrame) -> list:
    """The days to read, which the calendar bounds."""
    return sorted(r["day"] for r in days.select("day").distinct().collect())


def _raw_of(raw: DataFrame, days: DataFrame, calendar: list, window_duration: str) -> DataFrame:
    """The quotes of the (symbol, day) in ``days``, whole windows. If a day has a whole number of windows, a
    quote is in a window of its own day, and a raw table with day partitions is read only there."""
    if _divides_a_day(window_duration) and DAY in raw.columns:
        raw = raw.where(F.col(DAY).isin(calendar))
    found = raw.where(F.col("quote_time").isNotNull()).withColumn("_day", F.to_date(_start(window_duration)))
    keys = days.select(F.col("symbol").alias("_symbol"), F.col("day").alias("_d"))
    return found.join(keys, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("_day") == F.col("_d")), "left_semi").drop("_day")


def _divides_a_day(window_duration: str) -> bool:
    """Whether a day is a whole number of windows, for widths such as ``1 minute``."""
    number, unit = window_duration.split()
    seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}.get(unit.rstrip("s"))
    return seconds is not None and number.isdigit() and int(number) > 0 and 86400 % (int(number) * seconds) == 0


def backfill_bars(raw: DataFrame, store, window_duration: str = WINDOW_DURATION,
                  watermark=None, batch_id: int | None = None, report: DataFrame | None = None) -> DataFrame:
    """Recompute bars from the raw table and upsert them. With ``watermark`` (the
    stream's current event-time watermark, ``streaming.state.watermark_of``) only closed windows are
    written, so the backfill never races a bar the stream still updates. With ``report`` (rows of
    ``late_rows_report``) only its bars are, and only their days are read; a bar without any raw rows
    stays as it is, as an upsert deletes nothing."""
    keys = None
    if report is not None:
        path = f"{scratch_dir(raw.sparkSession, 'report')}/keys"
        report.where("status <> 'extra'").select("symbol", "window_start", F.to_date("window_start").alias("day")).write.parquet(path)
        keys = raw.sparkSession.read.parquet(path)      # read for the days, the quotes and the bars
        raw = _raw_of(raw, keys.select("symbol", "day").distinct(), _calendar(keys), window_duration)
    bars = aggregate_ohlcv(raw, window_duration)
    if keys is not None:
        named = keys.select(F.col("symbol").alias("_symbol"), F.col("window_start").alias("_start"))
        bars = bars.join(named, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("window_start") == F.col("_start")), "left_semi")
    if watermark is not None:
        bars = bars.where(F.col("window_end") <= F.lit(watermark).cast("timestamp"))
    store.upsert(bars, batch_id=batch_id)
    return bars


def late_rows_report(raw: DataFrame, bars: DataFrame | BarStore, window_duration: str = WINDOW_DURATION,
                     thorough: bool = False) -> DataFrame:
    """Bars that disagree with a recompute from raw: ``missing`` (raw has the window,
    the bar table not — typically all its rows arrived after the watermark),
    ``differs`` (some rows were dropped as late), ``extra`` (a bar with no raw rows).
    Only mismatching keys are returned. The recompute is of the days that ``differing_days`` finds."""
    days = differing_days(raw, bars, window_duration, thorough)
    calendar = _calendar(days)
    expected = aggregate_ohlcv(_raw_of(raw, days, calendar, window_duration), window_duration, with_updated_at=False).alias("e")
    keys = days.select(F.col("symbol").alias("_symbol"), F.col("day").alias("_d"))
    found = _bars_of(bars, calendar) if calendar else _bars_of(bars).limit(0)
    actual = found.join(keys, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.to_date("window_start") == F.col("_d")), "left_semi").alias("a")
    joined = expected.join(actual, F.col("e.symbol").eqNullSafe(F.col("a.symbol"))
                           & (F.col("e.window_start") == F.col("a.window_start")), "full_outer")
    differs = None
    for c in COMPARED:
        d = ~F.col(f"e.{c}").eqNullSafe(F.col(f"a.{c}"))
        differs = d if differs is None else (differs | d)
    status = (F.when(F.col("a.window_start").isNull(), F.lit("missing"))
               .when(F.col("e.window_start").isNull(), F.lit("extra"))
               .when(differs, F.lit("differs")))
    return joined.select(
        F.coalesce("e.symbol", "a.symbol").alias("symbol"),
        F.coalesce("e.window_start", "a.window_start").alias("window_start"),
        status.alias("status"),
        F.col("e.trade_count").alias("raw_trade_count"),
        F.col("a.trade_count").alias("bar_trade_count"),
    ).where(F.col("status").isNotNull())


def reconcile_counts(raw: DataFrame, bars: DataFrame, min_raw_rows: int = 1) -> DataFrame:
    """Per symbol: raw rows, raw rows with an event time, bars, sum of trade_count, and
    ``ok`` = raw >= min_raw_rows, bars >= 1 and every timed raw row is in a bar."""
    r = raw.groupBy("symbol").agg(F.count(F.lit(1)).alias("raw_rows"),
                                  F.count("quote_time").alias("timed_rows"))
    b = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("bars"),
                                   F.sum("trade_count").alias("bar_trades"))
    j = r.join(b, "symbol", "full_outer")
    filled = j.select(
        "symbol",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
          for c in ("raw_rows", "timed_rows", "bars", "bar_trades")])
    ok = ((F.col("raw_rows") >= min_raw_rows) & (F.col("bars") >= 1)
          & (F.col("bar_trades") == F.col("timed_rows")))
    return filled.withColumn("ok", ok)


def count_rows(raw: DataFrame, bars: DataFrame) -> DataFrame:
    """Row counts per table, per symbol and in total (symbol NULL = whole table)."""
    rows = raw.select(F.lit("quotes_raw").alias("table_name"), "symbol").unionByName(
        bars.select(F.lit("ohlcv").alias("table_name"), "symbol"))
    # one pass: a count for each symbol, and one for each table from the same partial counts
    per = rows.groupBy("table_name", "symbol").agg(F.count(F.lit(1)).alias("n"))
    total = (per.rollup("table_name", "symbol").agg(F.sum("n").alias("n"), F.grouping_id().alias("_set"))
             .where("_set < 3"))
    return total.select("table_name", "symbol", "n")
