"""Validation reasons, counters and the allow-list."""

import datetime as dt

from quotebars.operators.quality import allowlist_symbols, publish_counters, validate_quotes

T0 = dt.datetime(2026, 6, 20, 12, 0, 0)
SCHEMA = "symbol string, price string, volume string, quote_time timestamp"


def test_reasons_in_order(spark):
    rows = [("A", "1", "1", T0), (None, "1", "1", T0), (" ", "1", "1", T0), ("A", "x", "1", T0),
            ("A", "1", "y", T0), ("A", "1", "-1", T0), ("A", "1", "1", None), (None, "x", "-1", None)]
    got = [r.reject_reason for r in validate_quotes(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert got == [None, "null_symbol", "null_symbol", "bad_price", "bad_volume", "negative_volume",
                   "null_quote_time", "null_symbol"]


def test_counters(spark):
    rows = [("A", "1", "1", T0), ("A", "x", "1", T0), ("A", "x", "1", T0)]
    got = {r.status: r.n for r in publish_counters(validate_quotes(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got == {"valid": 1, "bad_price": 2}


def test_allowlist(spark):
    rows = [("aapl",), ("BAD",), (None,), ("Goog",)]
    acc, rej = allowlist_symbols(spark.createDataFrame(rows, "symbol string"), "AAPL,goog")
    assert sorted(r.symbol for r in acc.collect()) == ["AAPL", "GOOG"]
    rej_rows = rej.collect()
    assert sorted(str(r.symbol) for r in rej_rows) == ["BAD", "None"]
    assert rej_rows[0].allowed == ["AAPL", "GOOG"]
