"""Read-side operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotebars.operators import serving as S
from quotebars.operators.rollup import aggregate_ohlcv

T0 = dt.datetime(2026, 6, 20, 12, 0, 0)


def _quotes(spark, prices, sym="A", step=60):
    rows = [(sym, str(p), "1", i, T0 + dt.timedelta(seconds=step * i)) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, "symbol string, price string, volume string, day_volume long, "
                                       "quote_time timestamp") \
        .withColumn("price", F.col("price").cast("decimal(38,8)")) \
        .withColumn("volume", F.col("volume").cast("decimal(38,8)"))


def test_limits_validated():
    for bad in (0, 501, -1, 2.5, True):
        with pytest.raises(ValueError):
            S.check_limit(bad)
    assert S.check_limit(500) == 500


def test_latest_bars_chronological(spark):
    bars = aggregate_ohlcv(_quotes(spark, [1, 2, 3, 4, 5]))
    got = S.latest_bars(bars, "A", 3).collect()
    assert [r.close for r in got] == [3.0, 4.0, 5.0]
    assert got[0].window_start_ms < got[-1].window_start_ms


def test_latest_ticks_newest_first(spark):
    got = S.latest_ticks(_quotes(spark, [1, 2, 3], step=1), "A", 2).collect()
    assert [r.price for r in got] == [3.0, 2.0]


def test_tick_direction_after_limit(spark):
    # prices oldest..newest 5, 3, 4, 4, 2 ; show newest 4: 2, 4, 4, 3
    got = S.tick_direction(_quotes(spark, [5, 3, 4, 4, 2], step=1), 4).orderBy("rn").collect()
    assert [(r.price, r.side) for r in got] == [(2.0, "down"), (4.0, "up"), (4.0, "up"), (3.0, "up")]


def test_close_series_summary(spark):
    bars = aggregate_ohlcv(_quotes(spark, [3, 1, 2]).unionByName(_quotes(spark, [7], sym="B")))
    got = {r.symbol: r for r in S.close_series_summary(bars).collect()}
    assert set(got) == {"A"}           # B has fewer than two points
    a = got["A"]
    assert (a.min_close, a.max_close, a.close_range, a.first_close, a.last_close, a.direction) == \
        (1.0, 3.0, 2.0, 3.0, 2.0, "down")
    flat = S.close_series_summary(aggregate_ohlcv(_quotes(spark, [4, 4]))).collect()[0]
    assert flat.close_range == 1.0 and flat.direction == "up"


def test_topn_plans_partial_window_limit(spark):
    bars = aggregate_ohlcv(_quotes(spark, list(range(30))))
    plan = S.topn_bars(bars, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert S.topn_bars(bars, 5).count() == 5


def test_latest_price(spark):
    got = S.latest_price(_quotes(spark, [1, 9, 4])).collect()[0]
    assert got.price == 4.0
