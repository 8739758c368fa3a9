"""The Avro body of a record, one value at a time: what the vectorised codec is tested against."""

from decimal import Context, Decimal

import pandas as pd

_EXACT = Context(prec=80)      # decimal(38,8) values need up to 38 digits; the default is 28


def _write_long(out: bytearray, v: int) -> None:
    n = (v << 1) ^ (v >> 63)
    while n & ~0x7F:
        out.append((n & 0x7F) | 0x80)
        n >>= 7
    out.append(n)


def _read_long(buf: bytes, pos: int) -> tuple[int, int]:
    shift = 0
    n = 0
    while True:
        if pos >= len(buf) or shift > 63:
            raise ValueError("truncated or oversized varint")
        b = buf[pos]
        pos += 1
        n |= (b & 0x7F) << shift
        if not b & 0x80:
            break
        shift += 7
    return (n >> 1) ^ -(n & 1), pos


def _read_bytes(buf: bytes, pos: int) -> tuple[bytes, int]:
    size, pos = _read_long(buf, pos)
    if size < 0 or pos + size > len(buf):
        raise ValueError("bad length")
    return buf[pos:pos + size], pos + size


def encode_record(values, kinds, scales) -> bytes:
    out = bytearray()
    for v, kind, scale in zip(values, kinds, scales):
        if v is None or (not isinstance(v, (str, bytes)) and pd.isna(v)):
            raise ValueError("null in a non-nullable field")
        if kind == "string":
            data = str(v).encode("utf-8")
            _write_long(out, len(data))
            out += data
        elif kind == "long":
            _write_long(out, int(v))
        elif kind == "decimal":
            unscaled = int(Decimal(v).scaleb(scale, _EXACT).to_integral_value(context=_EXACT))
            size = max(1, (unscaled.bit_length() + 8) // 8)
            data = unscaled.to_bytes(size, "big", signed=True)
            _write_long(out, len(data))
            out += data
        else:
            raise ValueError(f"unsupported Avro type {kind}")
    return bytes(out)


def decode_record(buf: bytes, kinds, scales) -> list:
    pos = 0
    vals = []
    for kind, scale in zip(kinds, scales):
        if kind == "string":
            data, pos = _read_bytes(buf, pos)
            vals.append(data.decode("utf-8"))
        elif kind == "long":
            v, pos = _read_long(buf, pos)
            vals.append(v)
        elif kind == "decimal":
            data, pos = _read_bytes(buf, pos)
            vals.append(Decimal(int.from_bytes(data, "big", signed=True)).scaleb(-scale, _EXACT))
        else:
            raise ValueError(f"unsupported Avro type {kind}")
    if pos != len(buf):
        raise ValueError("trailing bytes")
    return vals
