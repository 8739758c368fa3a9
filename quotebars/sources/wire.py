"""Framed Avro messages: frame/unframe in Spark SQL, the Avro body by ``from_avro``/``to_avro``
when the Avro data source is on the classpath. Where it is not, the two fixed record contracts
(string, long, timestamp-millis, bytes-decimal fields) go through an Arrow UDF (whole batches,
vectorised with numpy in ``avro_codec``). Everything around it — header checks, schema id, key,
casting — stays in JVM expressions.

Frame layout: byte 0 magic (0), bytes 1-4 big-endian schema id, then the Avro body.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebars.functions.scalar import ms_to_ts, ts_to_ms
from quotebars.schemas import MAGIC_BYTE, QUOTE_AVRO, avro_schema_json
from quotebars.sources import avro_codec

HEADER_LEN = 5


# ---------------------------------------------------------------- Avro primitives
def _kind(ftype) -> str:
    if isinstance(ftype, dict):
        if ftype.get("logicalType") == "decimal":
            return "decimal"
        return ftype["type"]
    return ftype


def _layout(contract: dict):
    names = [f["name"] for f in contract["fields"]]
    kinds = [_kind(f["type"]) for f in contract["fields"]]
    scales = [f["type"].get("scale", 0) if isinstance(f["type"], dict) else 0 for f in contract["fields"]]
    return names, kinds, scales


def _spark_type(kind: str):
    return {"string": T.StringType(), "long": T.LongType(), "decimal": T.DecimalType(38, 8)}[kind]


def body_schema(contract: dict) -> T.StructType:
    names, kinds, _ = _layout(contract)
    return T.StructType([T.StructField(n, _spark_type(k)) for n, k in zip(names, kinds)]
                        + [T.StructField("decode_error", T.StringType())])


# ---------------------------------------------------------------- batch UDFs
def _once(udf):
    """Evaluate the codec once per row: without this, a filter on a decoded field (e.g.
    ``decode_error IS NULL``) is pushed below the projection and the optimizer
    substitutes the UDF call into it, so the codec would run twice. Marking the UDF
    non-deterministic keeps filters above it (the codec itself is a pure function)."""
    return udf.asNondeterministic()


def _encoder(contract: dict):
    names, kinds, scales = _layout(contract)

    @F.arrow_udf(T.BinaryType())
    def encode(rec: pa.Array) -> pa.Array:
        return avro_codec.encode(rec, kinds, scales, names)

    return _once(encode)


def _decoder(contract: dict):
    names, kinds, scales = _layout(contract)
    types = [pa.decimal128(38, sc) if k == "decimal" else None for k, sc in zip(kinds, scales)]

    @F.arrow_udf(body_schema(contract))
    def decode(body: pa.Array) -> pa.Array:
        return avro_codec.decode(body, kinds, scales, names, types)

    return _once(decode)


_ENCODERS: dict = {}
_DECODERS: dict = {}


def _native_avro():
    try:
        from pyspark.sql.avro.functions import from_avro, to_avro  # noqa: F401
        return from_avro, to_avro
    except Exception:  # pragma: no cover - depends on the image
        return None


# ---------------------------------------------------------------- operators
def header(value: Column, schema_id: int) -> Column:
    return F.concat(F.unhex(F.format_string("%02X%08X", F.lit(MAGIC_BYTE), F.lit(schema_id))), value)


def avro_encode_frame(quotes: DataFrame, schema_id: int = 1, contract: dict = QUOTE_AVRO,
                      key_col: str = "symbol", native: bool = True, keep=()) -> DataFrame:
    """Wire-shaped rows (contract fields; times as TIMESTAMP or millis) -> ``key, value``
    (plus the ``keep`` columns carried through).

    ``value`` is NULL for a record the contract rejects (e.g. a NULL field); callers drop
    and count those (``publish_counters``)."""
    names, kinds, _ = _layout(contract)
    fields = []
    for f in contract["fields"]:
        c = F.col(f["name"])
        if isinstance(f["type"], dict) and f["type"].get("logicalType") == "timestamp-millis" \
                and not isinstance(quotes.schema[f["name"]].dataType, T.LongType):
            c = ts_to_ms(c)
        elif _kind(f["type"]) == "string":
            c = c.cast("string")
        fields.append(c.alias(f["name"]))
    rec = F.struct(*fields)
    key = F.encode(F.col(key_col).cast("string"), "UTF-8").alias("key")
    if native and _native_avro():
        body = _native_avro()[1](rec, avro_schema_json(contract))
        try:
            return quotes.select(key, F.when(body.isNotNull(), header(body, schema_id)).alias("value"), *keep)
        except AnalysisException:      # the Avro data source is not on the classpath
            pass
    enc = _ENCODERS.setdefault(contract["name"], _encoder(contract))
    body = enc(rec)
    return quotes.select(key, F.when(body.isNotNull(), header(body, schema_id)).alias("value"), *keep)


def wire_unframe(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``magic``, ``schema_id``, ``body`` and the frame-level ``frame_error``."""
    v = F.col(value_col)
    magic = F.when(F.length(v) >= 1, F.conv(F.hex(F.substring(v, 1, 1)), 16, 10).cast("int"))
    schema_id = F.when(F.length(v) >= HEADER_LEN, F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("bigint"))
    err = (F.when(v.isNull(), F.lit("null_value"))
            .when(F.length(v) <= HEADER_LEN, F.lit("short_frame"))
            .when(magic != F.lit(MAGIC_BYTE), F.lit("bad_magic")))
    return df.select("*", magic.alias("magic"), schema_id.alias("schema_id"),
                     F.when(err.isNull(), F.expr(f"substring(`{value_col}`, {HEADER_LEN + 1})")).alias("body"),
                     err.alias("frame_error"))


def avro_decode(df: DataFrame, contract: dict = QUOTE_AVRO, body_col: str = "body",
                native: bool = True) -> DataFrame:
    """Decode the Avro body into the contract's columns; a poison body never fails the
    query: it gets ``decode_error`` (frame errors take precedence)."""
    names, kinds, _ = _layout(contract)
    decoded = None
    if native and _native_avro():
        rec = _native_avro()[0](F.col(body_col), avro_schema_json(contract), {"mode": "PERMISSIVE"})
        try:
            decoded = df.withColumn("_rec", rec).withColumn(
                "_err", F.when(F.col(body_col).isNotNull() & F.col("_rec").isNull(), F.lit("bad_avro")))
        except AnalysisException:      # the Avro data source is not on the classpath
            decoded = None
    if decoded is None:
        dec = _DECODERS.setdefault(contract["name"], _decoder(contract))
        decoded = df.withColumn("_rec", dec(F.col(body_col))).withColumn("_err", F.col("_rec.decode_error"))
    err = F.coalesce(F.col("frame_error"), F.col("_err")) if "frame_error" in df.columns else F.col("_err")
    out = [c for c in df.columns if c not in (body_col,)]
    cols = [F.col(c) for c in out if c not in names and c != "frame_error"]
    for f in contract["fields"]:
        c = F.col(f"_rec.{f['name']}")
        if isinstance(f["type"], dict) and f["type"].get("logicalType") == "timestamp-millis":
            c = ms_to_ts(c)
        cols.append(c.alias(f["name"]))
    cols.append(err.alias("decode_error"))
    return decoded.select(*cols)


def read_framed_quotes(kafka_rows: DataFrame, native: bool = True) -> DataFrame:
    """Kafka-shaped rows -> decoded wire quotes (strings for price/volume) with
    ``decode_error`` set for poison messages; pair with ``validate_quotes``."""
    return avro_decode(wire_unframe(kafka_rows), QUOTE_AVRO, native=native)
