"""Replay snapshots: per symbol its newest bars, and all ticks in the windows of those bars.

The scalable form is one JSON line for each symbol, or several for one with many ticks: a line ends at the
first full second after ``LINE_TICKS`` of them, so no row holds all ticks of a busy symbol. The page's layout, one document
``{generated_at, symbols: [..], ticks: {sym: [{t, price, quantity}]}, ohlcv: {sym:
[{window_start_ms, open, high, low, close, volume, quote_volume, vwap, trade_count}]}}``, is
assembled for an explicit list of symbols only, whose length bounds it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebars.functions.scalar import ts_to_ms
from quotebars.operators.serving import TICK_ORDER, topn_per_symbol
from quotebars.schemas import REPLAY

REPLAY_BARS = 12
#: ticks after which a symbol's next second begins a new line
LINE_TICKS = 10_000
#: one line of the per-symbol form
REPLAY_LINE = T.StructType([
    T.StructField("generated_at", T.StringType()), T.StructField("symbol", T.StringType()),
    T.StructField("ticks", REPLAY["ticks"].dataType.valueType), T.StructField("ohlcv", REPLAY["ohlcv"].dataType.valueType)])


def replay_rows(bars: DataFrame, quotes: DataFrame, bars_per_symbol: int = REPLAY_BARS, generated_at: str | None = None,
                line_ticks: int | None = LINE_TICKS) -> DataFrame:
    """Rows of REPLAY_LINE, entries oldest first: the newest ``bars_per_symbol`` bars of each symbol,
    and every tick from the start of the first of them on. The bars are in a symbol's first row; without
    ``line_ticks`` that is the only one."""
    newest = topn_per_symbol(bars, [F.col("window_start").desc()], bars_per_symbol)
    bar = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name)
                     for f in REPLAY_LINE["ohlcv"].dataType.elementType.fields])
    per_bar = (newest.withColumn("window_start_ms", ts_to_ms("window_start")).groupBy("symbol")
               .agg(F.sort_array(F.collect_list(bar)).alias("ohlcv"), F.min("window_start").alias("_from")))
    tick = F.struct(ts_to_ms("quote_time").alias("t"), F.col("price").cast("double").alias("price"),
                    F.col("volume").cast("bigint").alias("quantity"))
    shown = quotes.join(per_bar.select(F.col("symbol").alias("_symbol"), "_from"), F.col("symbol").eqNullSafe(F.col("_symbol")))
    shown = shown.where(F.col("quote_time") >= F.col("_from")).drop("_symbol", "_from")
    if line_ticks:
        shown = in_lines(shown, line_ticks)
    else:
        shown = shown.withColumn("_line", F.lit(0).cast("bigint"))
    per_line = shown.groupBy("symbol", "_line").agg(
        F.transform(F.sort_array(F.collect_list(F.struct(*TICK_ORDER, tick.alias("tick")))), lambda x: x["tick"]).alias("ticks"))
    stamp = F.lit(generated_at) if generated_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    empty = lambda c: F.array().cast(REPLAY_LINE[c].dataType)
    first = per_bar.select(F.col("symbol").alias("_s"), "ohlcv", F.lit(0).cast("bigint").alias("_l"))
    joined = per_line.join(first, F.col("symbol").eqNullSafe(F.col("_s")) & (F.col("_line") == F.col("_l")), "full_outer")
    name = F.when(F.col("_l").isNull(), F.col("symbol")).otherwise(F.col("_s"))
    return joined.select(stamp.alias("generated_at"), name.alias("symbol"), F.coalesce("ticks", empty("ticks")).alias("ticks"),
                         F.coalesce("ohlcv", empty("ohlcv")).alias("ohlcv"))


def in_lines(ticks: DataFrame, line_ticks: int) -> DataFrame:
    """``ticks`` with ``_line``: whole seconds of a symbol in a row, from counts of its seconds. The ticks of a few
    bars' windows are in few seconds, whatever their number."""
    second = F.date_trunc("second", "quote_time")
    counts = ticks.groupBy("symbol", second.alias("_second")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("symbol").orderBy("_second").rowsBetween(Window.unboundedPreceding, -1)
    lines = counts.select(F.col("symbol").alias("_s"), "_second", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / line_ticks).alias("_line"))
    return ticks.join(lines, F.col("symbol").eqNullSafe(F.col("_s")) & (second == F.col("_second"))).drop("_s", "_second")


def build_replay_snapshot(bars: DataFrame, quotes: DataFrame, symbols: list[str], bars_per_symbol: int = REPLAY_BARS,
                          generated_at: str | None = None) -> DataFrame:
    """One row in the document layout, for the listed symbols (one without bars is left out)."""
    listed = F.col("symbol").isin(list(symbols))
    rows = replay_rows(bars.where(listed), quotes.where(listed), bars_per_symbol, generated_at, line_ticks=None)
    return rows.agg(F.max("generated_at").alias("generated_at"), F.sort_array(F.collect_list("symbol")).alias("symbols"),
                    F.map_from_entries(F.collect_list(F.struct("symbol", "ticks"))).alias("ticks"),
                    F.map_from_entries(F.collect_list(F.struct("symbol", "ohlcv"))).alias("ohlcv"))


def sink_replay_snapshot(bars: DataFrame, quotes: DataFrame, path: str, symbols: list[str] | None = None,
                         bars_per_symbol: int = REPLAY_BARS, generated_at: str | None = None) -> None:
    """Write lines per symbol, or for listed symbols the single document."""
    if symbols is None:
        replay_rows(bars, quotes, bars_per_symbol, generated_at).write.mode("overwrite").json(path)
    else:
        build_replay_snapshot(bars, quotes, symbols, bars_per_symbol, generated_at).coalesce(1).write.mode("overwrite").json(path)


def src_replay_snapshot(spark: SparkSession, path: str, document: bool = False) -> tuple[DataFrame, DataFrame]:
    """(ticks, bars) rows from lines per symbol, or with ``document`` from the single document; a
    missing snapshot gives two empty frames."""
    schema = REPLAY if document else REPLAY_LINE
    try:
        found = spark.read.schema(schema).option("multiLine", document).json(path)
    except AnalysisException as exc:  # missing path -> no entries, like the page's fallback
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        found = spark.createDataFrame([], schema)
    if document:
        return tuple(found.select(F.explode(c).alias("symbol", "items")).select("symbol", F.inline("items")) for c in ("ticks", "ohlcv"))
    return tuple(found.select("symbol", F.inline(c)) for c in ("ticks", "ohlcv"))
