"""Rollup semantics: the three reference cases re-typed from the spec, plus edge cases."""

import datetime as dt
import random
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotebars.operators.rollup import aggregate_ohlcv
from quotebars.sources.ingest import cast_quote_columns

UTC = dt.timezone.utc
T0 = dt.datetime(2026, 6, 20, 12, 0, 0, tzinfo=UTC)
SCHEMA = "symbol string, price string, volume string, quote_time timestamp"


def _df(spark, rows, with_dv=True):
    df = spark.createDataFrame(rows, SCHEMA)
    if with_dv:
        df = df.withColumn("day_volume", F.lit(0).cast("bigint"))
    return cast_quote_columns(df)


def _t(s):
    return T0 + dt.timedelta(seconds=s)


def test_single_window(spark):
    rows = [("AAPL", "100.0", "1.0", _t(1)), ("AAPL", "110.0", "2.0", _t(2)),
            ("AAPL", "90.0", "1.0", _t(3)), ("AAPL", "105.0", "1.0", _t(4))]
    out = aggregate_ohlcv(_df(spark, rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.open, r.high, r.low, r.close) == (Decimal("100"), Decimal("110"), Decimal("90"), Decimal("105"))
    assert r.volume == Decimal("5") and r.quote_volume == Decimal("515") and r.vwap == Decimal("103")
    assert r.trade_count == 4
    assert r.window_end - r.window_start == dt.timedelta(minutes=1)


def test_zero_volume_vwap_is_close(spark):
    rows = [("MSFT", "430.0", "0.0", _t(5)), ("MSFT", "431.0", "0.0", _t(9))]
    r = aggregate_ohlcv(_df(spark, rows)).collect()[0]
    assert r.volume == Decimal("0") and r.vwap == Decimal("431") and r.trade_count == 2


def test_splits_windows_and_symbols(spark):
    rows = [("AAPL", "100.0", "1.0", _t(10)), ("AAPL", "200.0", "1.0", _t(70)), ("GOOG", "140.0", "3.0", _t(15))]
    out = aggregate_ohlcv(_df(spark, rows)).collect()
    assert len(out) == 3
    goog = [r for r in out if r.symbol == "GOOG"][0]
    assert goog.vwap == Decimal("140") and goog.trade_count == 1


def test_ties_are_order_independent(spark):
    # three quotes share one timestamp: open/close follow (quote_time, day_volume, price)
    base = [("A", "3.0", "1", _t(1), 30), ("A", "1.0", "1", _t(1), 10), ("A", "2.0", "1", _t(1), 20)]
    for perm in (base, base[::-1], [base[1], base[2], base[0]]):
        df = cast_quote_columns(spark.createDataFrame(perm, SCHEMA + ", day_volume bigint").repartition(3))
        r = aggregate_ohlcv(df).collect()[0]
        assert (r.open, r.close) == (Decimal("1"), Decimal("3"))


def test_null_price_counts_and_null_time_drops(spark):
    rows = [("A", None, "1", _t(1)), ("A", "5", "1", _t(2)), ("A", "7", "1", None)]
    r = aggregate_ohlcv(_df(spark, rows)).collect()
    assert len(r) == 1 and r[0].trade_count == 2 and r[0].high == Decimal("5") and r[0].low == Decimal("5")


def test_unparseable_price_does_not_fail(spark):
    # ANSI casts would fail the job; try_cast gives NULL. Like min_by itself, open is the
    # first quote's price even when that price is NULL (validate_quotes quarantines such
    # rows before they reach the rollup).
    rows = [("A", "abc", "1", _t(1)), ("A", "2", "1", _t(2))]
    r = aggregate_ohlcv(_df(spark, rows)).collect()[0]
    assert r.open is None and r.close == Decimal("2") and r.high == Decimal("2") and r.trade_count == 2


def test_decimal_rounding_default_and_exact(spark):
    # 0.123456789 * 1.5 = 0.1851851835: default keeps 6 places per product (half up)
    rows = [("A", "0.12345679", "1.5", _t(1))]
    r = aggregate_ohlcv(_df(spark, rows)).collect()[0]
    assert r.quote_volume == Decimal("0.18518500")   # 0.185185185 rounded to 6 places
    e = aggregate_ohlcv(_df(spark, rows), exact=True).collect()[0]
    assert e.quote_volume == Decimal("0.18518519")   # exact product, one final rounding


def test_null_volume_vwap_falls_back(spark):
    rows = [("A", "10", None, _t(1)), ("A", "12", None, _t(2))]
    r = aggregate_ohlcv(_df(spark, rows)).collect()[0]
    assert r.vwap == Decimal("12")


quote = st.tuples(st.sampled_from(["A", "B"]), st.integers(1, 10_000), st.integers(0, 50), st.integers(0, 600))


@settings(max_examples=15, deadline=None)
@given(st.lists(quote, min_size=1, max_size=40))
def test_property_invariants(spark, rows):
    data = [(s, f"{p / 100:.2f}", str(v), _t(t), i) for i, (s, p, v, t) in enumerate(rows)]
    schema = SCHEMA + ", day_volume bigint"
    a = aggregate_ohlcv(cast_quote_columns(spark.createDataFrame(data, schema)), with_updated_at=False)
    shuffled = list(data)
    random.Random(7).shuffle(shuffled)
    b = aggregate_ohlcv(cast_quote_columns(spark.createDataFrame(shuffled, schema).repartition(3)),
                        with_updated_at=False)
    ra = sorted(a.collect())
    assert ra == sorted(b.collect())
    for r in ra:
        assert r.low <= r.open <= r.high and r.low <= r.close <= r.high
        if r.volume > 0:
            assert r.low - Decimal("0.000001") <= r.vwap <= r.high + Decimal("0.000001")
