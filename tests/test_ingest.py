"""Raw poll records, vendor chart payloads, symbol lists."""

import datetime as dt
import json

from pyspark.sql import functions as F

from quotebars.functions.scalar import normalize_symbols
from quotebars.operators.quality import parse_allowlist
from quotebars.sources.ingest import normalize_quote, src_chart_json, to_quotes


def test_normalize_quote_matches_contract(spark):
    raw = spark.createDataFrame([("AAPL", 190.42, 1250, 5000000, 1700000000000)],
                                "symbol string, price double, volume long, day_volume long, quote_time_ms long")
    r = normalize_quote(raw).collect()[0]
    assert (r.symbol, r.price, r.volume, r.day_volume, r.source) == ("AAPL", "190.42", "1250", 5000000, "yahoo")
    assert r.quote_time == dt.datetime(2023, 11, 14, 22, 13, 20) and r.ingest_time == r.quote_time
    q = to_quotes(normalize_quote(raw)).collect()[0]
    assert str(q.price) == "190.42000000"


def _payload(meta_price, closes, volumes):
    return json.dumps({"chart": {"result": [{"meta": {"regularMarketPrice": meta_price},
                                             "indicators": {"quote": [{"close": closes, "volume": volumes}]}}]}})


def test_chart_payloads(spark):
    rows = [
        ("AAPL", _payload(190.42, [189.9, 190.42], [1000, 250])),
        ("B", _payload(None, [10.0, 11.5, None], [1, None, 2])),
        ("C", _payload(None, [None, None], [5])),
        ("D", json.dumps({"chart": {"result": [{"meta": {}}]}})),
        ("E", "not json"),
    ]
    got = {r.symbol: (r.price, r.day_volume, r.reject_reason)
           for r in src_chart_json(spark.createDataFrame(rows, "symbol string, payload string")).collect()}
    assert got["AAPL"] == (190.42, 1250, None)
    assert got["B"] == (11.5, 3, None)
    assert got["C"] == (None, 5, "no_price")
    assert got["D"] == (None, 0, "no_price")
    assert got["E"] == (None, 0, "no_price")


def test_an_odd_field_is_missing_and_the_others_stay(spark):
    rows = [
        ("price", _payload("n/a", [7.5], [3])),
        ("truth", _payload(True, [7.5], [3])),
        ("object", _payload({"raw": 1}, [7.5, "x", None], [3, "4", False, {"v": 1}, 2])),
        ("close", _payload(1.5, "none", [1])),
        ("volume", _payload(1.5, [2.0], "none")),
        ("fractions", _payload(2, [2.0], [0.5, 0.75, 1])),
        ("huge", _payload(1e300, [2.0], [1e60, 5])),
        ("string", json.dumps({"chart": {"result": [{"meta": {"regularMarketPrice": 3}, "indicators": "none"}]}})),
        ("list", json.dumps([1, 2])), ("scalar", "17"), ("empty", ""), ("null", None), ("cut", _payload(1, [1], [1])[:-2]),
        ("twice", '{"chart":{"result":[{"meta":{"regularMarketPrice":1,"regularMarketPrice":2}}]}}'),
    ]
    got = {r.symbol: (r.price, r.day_volume) for r in src_chart_json(spark.createDataFrame(rows, "symbol string, payload string")).collect()}
    assert got == {"price": (7.5, 3), "truth": (7.5, 3), "object": (7.5, 5), "close": (1.5, 1), "volume": (1.5, 0), "fractions": (2.0, 2),
                   "huge": (1e300, 5), "string": (3.0, 0), "list": (None, 0), "scalar": (None, 0), "empty": (None, 0), "null": (None, 0),
                   "cut": (None, 0), "twice": (None, 0)}


def test_default_source_and_updated_at(spark):
    from quotebars.operators.rollup import aggregate_ohlcv
    raw = spark.createDataFrame([("A", "1", "2", 3, dt.datetime(2026, 6, 20), None), ("A", "1", "2", 3, dt.datetime(2026, 6, 20), "feed")],
                                "symbol string, price string, volume string, day_volume long, quote_time timestamp, source string")
    quotes = to_quotes(raw.withColumn("ingest_time", F.col("quote_time")))
    assert sorted(r.source for r in quotes.collect()) == ["feed", "yahoo"]
    before = spark.sql("SELECT current_timestamp()").first()[0]
    stamped = [r.updated_at for r in aggregate_ohlcv(quotes).collect()]
    assert len(stamped) == 1 and before <= stamped[0] <= spark.sql("SELECT current_timestamp()").first()[0]
    assert "updated_at" not in aggregate_ohlcv(quotes, with_updated_at=False).columns


def test_normalize_symbols(spark):
    df = spark.createDataFrame([(" aapl, GOOG,,aapl , msft",), ("",), (None,)], "s string")
    got = [r.x for r in df.select(normalize_symbols("s").alias("x")).collect()]
    assert got == [["AAPL", "GOOG", "MSFT"], [], None]
    assert parse_allowlist(" aapl, GOOG,,aapl ") == ["AAPL", "GOOG"]
    assert F is not None


def test_double_text_matches_producer_format(spark):
    from quotebars.functions.scalar import double_text
    vals = [190.42, 100.0, 0.0, 1e7, 12345678.9, 1.5e15, 1e16, 1.2345e20, 0.001, 0.00012, 1e-4, 1.5e-5,
            1e-300, -2.5e8, 0.1, 1 / 3, 123456789012.34, -0.00031, 1.7976931348623157e308]
    got = spark.createDataFrame([(v,) for v in vals], "x double").select(double_text("x").alias("t")).collect()
    assert [r.t for r in got] == [repr(v) for v in vals]
