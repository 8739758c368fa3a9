"""Fixed data contracts: Spark StructTypes and the Avro record layouts.

The field lists, order, types and the ``source`` default below are fixed values that
must equal the wire contract for messages to decode.
"""

from __future__ import annotations

import json

from pyspark.sql import types as T

DECIMAL = "decimal(38,8)"
DEC = T.DecimalType(38, 8)
DEFAULT_SOURCE = "yahoo"
WINDOW_DURATION = "1 minute"
WATERMARK_DELAY = "2 minutes"
MAGIC_BYTE = 0

# Canonical quote row (raw table and stream after decode + cast).
QUOTE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", DEC),
    T.StructField("volume", DEC),
    T.StructField("day_volume", T.LongType()),
    T.StructField("quote_time", T.TimestampType()),
    T.StructField("ingest_time", T.TimestampType()),
    T.StructField("source", T.StringType()),
])

# One OHLCV/VWAP bar, keyed by (symbol, window_start).
BAR = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("open", DEC),
    T.StructField("high", DEC),
    T.StructField("low", DEC),
    T.StructField("close", DEC),
    T.StructField("volume", DEC),
    T.StructField("quote_volume", DEC),
    T.StructField("vwap", DEC),
    T.StructField("trade_count", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])
BAR_KEY = ("symbol", "window_start")
BAR_VALUE_COLUMNS = ("open", "high", "low", "close", "volume", "quote_volume", "vwap")

# Same-shaped stand-in for the Kafka source row.
KAFKA_ROW = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Replay snapshot layout.
REPLAY_TICK = T.StructType([
    T.StructField("t", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.LongType()),
])
REPLAY_BAR = T.StructType([
    T.StructField("window_start_ms", T.LongType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("quote_volume", T.DoubleType()),
    T.StructField("vwap", T.DoubleType()),
    T.StructField("trade_count", T.LongType()),
])
REPLAY = T.StructType([
    T.StructField("generated_at", T.StringType()),
    T.StructField("symbols", T.ArrayType(T.StringType())),
    T.StructField("ticks", T.MapType(T.StringType(), T.ArrayType(REPLAY_TICK))),
    T.StructField("ohlcv", T.MapType(T.StringType(), T.ArrayType(REPLAY_BAR))),
])

# Avro record contracts (field names, order and types as on the wire).
_DEC_BYTES = {"type": "bytes", "logicalType": "decimal", "precision": 38, "scale": 8}
_TS_MILLIS = {"type": "long", "logicalType": "timestamp-millis"}
QUOTE_AVRO = {
    "type": "record", "name": "Quote",
    "fields": [
        {"name": "symbol", "type": "string"},
        {"name": "price", "type": "string"},
        {"name": "volume", "type": "string"},
        {"name": "day_volume", "type": "long"},
        {"name": "quote_time", "type": _TS_MILLIS},
        {"name": "ingest_time", "type": _TS_MILLIS},
        {"name": "source", "type": "string", "default": DEFAULT_SOURCE},
    ],
}
OHLCV_AVRO = {
    "type": "record", "name": "Ohlcv",
    "fields": [
        {"name": "symbol", "type": "string"},
        {"name": "window_start", "type": _TS_MILLIS},
        {"name": "window_end", "type": _TS_MILLIS},
        {"name": "open", "type": _DEC_BYTES},
        {"name": "high", "type": _DEC_BYTES},
        {"name": "low", "type": _DEC_BYTES},
        {"name": "close", "type": _DEC_BYTES},
        {"name": "volume", "type": _DEC_BYTES},
        {"name": "quote_volume", "type": _DEC_BYTES},
        {"name": "vwap", "type": _DEC_BYTES},
        {"name": "trade_count", "type": "long"},
        {"name": "updated_at", "type": _TS_MILLIS},
    ],
}


def avro_schema_json(contract: dict) -> str:
    return json.dumps(contract)
