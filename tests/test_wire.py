"""Framed Avro codec: round trips, contracts and poison frames."""

import datetime as dt
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotebars.operators.quality import split_valid, validate_quotes
from quotebars.schemas import OHLCV_AVRO, QUOTE_AVRO
from quotebars.sources.wire import _layout, avro_decode, avro_encode_frame, read_framed_quotes, wire_unframe
from tests.avro_reference import decode_record, encode_record

T0 = dt.datetime(2023, 11, 14, 22, 13, 20)
WIRE = "symbol string, price string, volume string, day_volume long, quote_time timestamp, " \
       "ingest_time timestamp, source string"


def test_record_roundtrip_quote():
    names, kinds, scales = _layout(QUOTE_AVRO)
    rec = ["AAPL", "190.42", "1250", 5000000, 1700000000000, 1700000000000, "yahoo"]
    assert decode_record(encode_record(rec, kinds, scales), kinds, scales) == rec


def test_known_encoding_bytes():
    # zigzag varint: 1 -> 0x02, -1 -> 0x01, 64 -> 0x80 0x01; string = length + utf-8
    _, kinds, scales = _layout({"fields": [{"name": "a", "type": "long"}, {"name": "b", "type": "long"},
                                           {"name": "c", "type": "long"}, {"name": "d", "type": "string"}]})
    assert encode_record([1, -1, 64, "hi"], kinds, scales) == bytes([0x02, 0x01, 0x80, 0x01, 0x04]) + b"hi"


@settings(max_examples=50, deadline=None)
@given(st.text(min_size=0, max_size=8), st.integers(-2**63, 2**63 - 1),
       st.decimals(min_value=-10**20, max_value=10**20, places=8, allow_nan=False, allow_infinity=False))
def test_property_encode_decode_identity(sym, n, d):
    fields = {"fields": [{"name": "s", "type": "string"}, {"name": "n", "type": "long"},
                         {"name": "d", "type": {"type": "bytes", "logicalType": "decimal",
                                                "precision": 38, "scale": 8}}]}
    _, kinds, scales = _layout(fields)
    out = decode_record(encode_record([sym, n, d], kinds, scales), kinds, scales)
    assert out[0] == sym and out[1] == n and out[2] == d


def test_frame_roundtrip_in_spark(spark):
    rows = [("AAPL", "190.42", "1250", 5000000, T0, T0, "yahoo"), ("MSFT", "1.5", "0", 7, T0, T0, "yahoo")]
    df = spark.createDataFrame(rows, WIRE)
    framed = avro_encode_frame(df, schema_id=42)
    k = framed.collect()
    assert k[0].key == b"AAPL" and k[0].value[0] == 0 and int.from_bytes(k[0].value[1:5], "big") == 42
    back = read_framed_quotes(framed).collect()
    assert {(r.symbol, r.price, r.volume, r.day_volume, r.quote_time, r.schema_id, r.decode_error)
            for r in back} == {("AAPL", "190.42", "1250", 5000000, T0, 42, None),
                               ("MSFT", "1.5", "0", 7, T0, 42, None)}


def test_bar_contract_decimals(spark):
    rows = [("A", T0, T0 + dt.timedelta(minutes=1), Decimal("1.23456789"), Decimal("-2.5"), Decimal("0"),
             Decimal("99999999999.12345678"), Decimal("5"), Decimal("6"), Decimal("7"), 3, T0)]
    schema = ("symbol string, window_start timestamp, window_end timestamp, open decimal(38,8), "
              "high decimal(38,8), low decimal(38,8), close decimal(38,8), volume decimal(38,8), "
              "quote_volume decimal(38,8), vwap decimal(38,8), trade_count long, updated_at timestamp")
    df = spark.createDataFrame(rows, schema)
    back = avro_decode(wire_unframe(avro_encode_frame(df, schema_id=2, contract=OHLCV_AVRO)), OHLCV_AVRO).collect()[0]
    assert back.open == Decimal("1.23456789") and back.high == Decimal("-2.5")
    assert back.close == Decimal("99999999999.12345678") and back.trade_count == 3 and back.decode_error is None


def test_poison_frames_are_quarantined(spark):
    good = avro_encode_frame(spark.createDataFrame([("AAPL", "1", "2", 3, T0, T0, "yahoo")], WIRE)).collect()[0].value
    cases = [
        (None, "null_value"),
        (bytes(good[:3]), "short_frame"),
        (bytes([1]) + bytes(good[1:]), "bad_magic"),
        (bytes(good[:-2]), "bad_avro"),             # truncated body
        (bytes(good) + b"\x00", "bad_avro"),        # trailing bytes
        (bytes(good[:5]) + b"\x01" + b"x" * 10, "bad_avro"),   # negative string length
        (bytes(good[:5]), "short_frame"),           # header only
        (bytes(good), None),
    ]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "id int, value binary")
    got = {r.id: r.reject_reason for r in validate_quotes(read_framed_quotes(df)).collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(cases)}
    valid, quarantine = split_valid(validate_quotes(read_framed_quotes(df)))
    assert valid.count() == 1 and quarantine.count() == len(cases) - 1


def test_invalid_record_is_not_encoded(spark):
    df = spark.createDataFrame([(None, "1", "2", 3, T0, T0, "yahoo")], WIRE)
    assert avro_encode_frame(df).collect()[0].value is None
    assert F is not None


# ---------------------------------------------------------------- vectorised codec vs reference
import pyarrow as pa  # noqa: E402

from quotebars.sources import avro_codec  # noqa: E402

_MIXED = {"fields": [{"name": "s", "type": "string"}, {"name": "n", "type": "long"},
                     {"name": "d", "type": {"type": "bytes", "logicalType": "decimal", "precision": 38, "scale": 8}},
                     {"name": "t", "type": "string"}]}
_row = st.tuples(st.text(max_size=6), st.integers(-2**63, 2**63 - 1),
                 st.decimals(min_value=-10**29, max_value=10**29, places=8, allow_nan=False, allow_infinity=False),
                 st.text(max_size=3))


@settings(max_examples=60, deadline=None)
@given(st.lists(_row, min_size=1, max_size=30))
def test_vectorised_codec_matches_reference(rows):
    names, kinds, scales = _layout(_MIXED)
    rec = pa.StructArray.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.decimal128(38, 8)), pa.array([r[3] for r in rows], pa.string())],
        names=names)
    bodies = avro_codec.encode(rec, kinds, scales, names)
    for r, b in zip(rows, bodies.to_pylist()):
        assert decode_record(b, kinds, scales) == list(r)                 # reference reads our bytes
    ref = pa.array([encode_record(list(r), kinds, scales) for r in rows], pa.binary())
    out = avro_codec.decode(ref, kinds, scales, names, [None, None, pa.decimal128(38, 8), None])
    got = out.to_pylist()
    for r, g in zip(rows, got):                                           # we read the reference's bytes
        assert (g["s"], g["n"], g["d"], g["t"], g["decode_error"]) == (r[0], r[1], r[2], r[3], None)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=24), min_size=1, max_size=20))
def test_vectorised_decode_rejects_like_reference(blobs):
    names, kinds, scales = _layout(QUOTE_AVRO)
    out = avro_codec.decode(pa.array(blobs, pa.binary()), kinds, scales, names, [None] * len(kinds)).to_pylist()
    for blob, g in zip(blobs, out):
        try:
            want = decode_record(blob, kinds, scales)
        except (ValueError, UnicodeDecodeError, OverflowError):
            want = None
        if want is None:
            assert g["decode_error"] == "bad_avro" and g["symbol"] is None
        else:
            assert g["decode_error"] is None and [g[n] for n in names] == want


def test_vectorised_encode_skips_null_records():
    names, kinds, scales = _layout(QUOTE_AVRO)
    rec = pa.StructArray.from_arrays(
        [pa.array(["A", None]), pa.array(["1", "2"]), pa.array(["3", "4"]), pa.array([1, 2], pa.int64()),
         pa.array([5, 6], pa.int64()), pa.array([5, None], pa.int64()), pa.array(["x", "y"])], names=names)
    out = avro_codec.encode(rec, kinds, scales, names).to_pylist()
    assert out[1] is None and decode_record(out[0], kinds, scales) == ["A", "1", "3", 1, 5, 5, "x"]


def test_sink_bars_topic_files(spark, scratch):
    from quotebars.operators.rollup import aggregate_ohlcv
    from quotebars.sources.ingest import cast_quote_columns
    from quotebars.schemas import OHLCV_AVRO
    from quotebars.sources.topic import sink_bars_topic
    rows = [("A", "10.5", "2", 1, T0 + dt.timedelta(seconds=70 * i)) for i in range(5)]
    q = cast_quote_columns(spark.createDataFrame(
        rows, "symbol string, price string, volume string, day_volume long, quote_time timestamp"))
    bars = aggregate_ohlcv(q)
    out = scratch("bars_topic")
    sink_bars_topic(bars, path=out, num_files=2)
    back = avro_decode(wire_unframe(spark.read.parquet(out)), OHLCV_AVRO)
    got = sorted((r.symbol, r.window_start, r.close, r.trade_count, r.schema_id) for r in back.collect())
    want = sorted((r.symbol, r.window_start, r.close, r.trade_count, 2) for r in bars.collect())
    assert got == want


def test_vectorised_decode_rejects_wide_decimals():
    names, kinds, scales = _layout(_MIXED)
    types = [None, None, pa.decimal128(38, 8), None]

    def body(dec_bytes):
        out = bytearray(encode_record(["x", 1, 0, "y"], kinds, scales))
        # replace the decimal field (after 'x' and the long) with the given bytes
        prefix = bytes([2]) + b"x" + bytes([2])
        rest = out[len(prefix):]
        dec_len = rest[0] // 2
        tail = bytes(rest[1 + dec_len:])
        zz = len(dec_bytes) * 2
        return prefix + bytes([zz]) + dec_bytes + tail

    ok_body = body((10 ** 37).to_bytes(16, "big", signed=True))
    too_big = body((10 ** 38).to_bytes(16, "big", signed=True))
    too_long = body(b"\x00" * 17)
    out = avro_codec.decode(pa.array([ok_body, too_big, too_long], pa.binary()), kinds, scales, names,
                            types).to_pylist()
    assert out[0]["decode_error"] is None and out[0]["d"] == Decimal(10 ** 37).scaleb(-8)
    for r in out[1:]:
        assert r["decode_error"] == "bad_avro" and r["s"] is None and r["d"] is None and r["t"] is None


def test_native_flag_falls_back_without_avro_jar(spark):
    rows = [("AAPL", "190.42", "1250", 5000000, T0, T0, "yahoo")]
    framed = avro_encode_frame(spark.createDataFrame(rows, WIRE), native=True)
    back = avro_decode(wire_unframe(framed), QUOTE_AVRO, native=True).collect()[0]
    assert (back.symbol, back.price, back.volume, back.decode_error) == ("AAPL", "190.42", "1250", None)
