"""Vectorised Avro binary codec for flat records (string, long, bytes-decimal fields).

Works on whole Arrow batches with numpy: a field is read for every record of the batch
at once (one position per record), so a batch costs a few numpy passes per field
instead of a Python loop per record. Used through ``arrow_udf`` (Arrow in, Arrow out).
Records that break the layout (truncated varints, negative or overlong lengths,
trailing bytes, invalid UTF-8) come back as NULL with an error flag; a record with a
NULL field is not encoded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

MAX_VARINT = 10


# ---------------------------------------------------------------- helpers
def _binary_parts(arr: pa.Array):
    """(data uint8, start int64, end int64, valid bool) of a binary/string array."""
    arr = arr.cast(pa.binary()) if not pa.types.is_binary(arr.type) else arr
    n = len(arr)
    bufs = arr.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int32, count=n + 1 + arr.offset)[arr.offset:] \
        if bufs[1] is not None else np.zeros(n + 1, dtype=np.int32)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and len(bufs[2]) else \
        np.zeros(1, dtype=np.uint8)
    valid = ~np.asarray(arr.is_null(), dtype=bool) if arr.null_count else np.ones(n, dtype=bool)
    return data, offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64), valid


def _gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenate data[start[i]:start[i]+length[i]] for all i (lengths >= 0)."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, dtype=np.uint8)
    rel = np.arange(total, dtype=np.int64) - np.repeat(np.cumsum(length) - length, length)
    return data[np.repeat(start, length) + rel]


def _offsets(length: np.ndarray) -> np.ndarray:
    out = np.zeros(len(length) + 1, dtype=np.int64)
    np.cumsum(length, out=out[1:])
    if out[-1] > np.iinfo(np.int32).max:
        raise ValueError("batch too large for 32-bit offsets")
    return out.astype(np.int32)


def _validity(mask: np.ndarray):
    if mask.all():
        return None
    return pa.py_buffer(np.packbits(mask.astype(np.uint8), bitorder="little").tobytes())


def _read_varint(data, pos, end, ok):
    """Zigzag varint at pos for every ok record -> (int64 value, new pos); clears ok on error."""
    n = len(pos)
    acc = np.zeros(n, dtype=np.uint64)
    done = np.zeros(n, dtype=bool)
    size = np.zeros(n, dtype=np.int64)
    for k in range(MAX_VARINT):
        active = ok & ~done
        if not active.any():
            break
        idx = pos + k
        inside = active & (idx < end)
        ok &= ~(active & ~inside)
        b = np.zeros(n, dtype=np.uint64)
        b[inside] = data[idx[inside]]
        acc[inside] |= (b[inside] & np.uint64(0x7F)) << np.uint64(7 * k)
        fin = inside & (b < 128)
        size[fin] = k + 1
        done |= fin
    ok &= done
    value = ((acc >> np.uint64(1)) ^ (np.uint64(0) - (acc & np.uint64(1)))).view(np.int64)
    return value, pos + size


def _write_varint_bytes(values: np.ndarray):
    """Zigzag varint bytes per value -> (bytes matrix [n, 10] uint8, sizes int64)."""
    v = values.astype(np.int64)
    z = ((v << np.int64(1)) ^ (v >> np.int64(63))).view(np.uint64)
    n = len(z)
    mat = np.zeros((n, MAX_VARINT), dtype=np.uint8)
    size = np.ones(n, dtype=np.int64)
    rest = z.copy()
    for k in range(MAX_VARINT):
        more = rest > np.uint64(0x7F)
        mat[:, k] = ((rest & np.uint64(0x7F)) | np.where(more, np.uint64(0x80), np.uint64(0))).astype(np.uint8)
        size = np.where(more, k + 2, size) if k + 1 < MAX_VARINT else size
        rest = rest >> np.uint64(7)
        if not more.any():
            break
    return mat, size


# ---------------------------------------------------------------- decimals
def _decimal_words(arr: pa.Array):
    """decimal128 array -> (low uint64, high int64) little-endian words."""
    n = len(arr)
    words = np.frombuffer(arr.buffers()[1], dtype=np.uint64, count=2 * (n + arr.offset))[2 * arr.offset:]
    return words[0::2], words[1::2].view(np.int64)


def _decimal_from_int64(unscaled: np.ndarray, valid: np.ndarray, big: dict, dtype) -> pa.Array:
    low = unscaled.view(np.uint64).copy()
    high = np.where(unscaled < 0, -1, 0).astype(np.int64)
    for i, value in big.items():          # rare: unscaled beyond 64 bits
        low[i] = value & 0xFFFFFFFFFFFFFFFF
        high[i] = np.int64(np.uint64((value >> 64) & 0xFFFFFFFFFFFFFFFF).view(np.int64))
    words = np.empty(2 * len(low), dtype=np.uint64)
    words[0::2] = low
    words[1::2] = high.view(np.uint64)
    return pa.Array.from_buffers(dtype, len(low), [_validity(valid), pa.py_buffer(words.tobytes())])


# ---------------------------------------------------------------- decode
def decode(bodies: pa.Array, kinds, scales, names, types) -> pa.StructArray:
    """Binary Avro bodies -> struct of the fields + ``decode_error`` ('bad_avro' or NULL)."""
    data, pos, end, present = _binary_parts(bodies)
    n = len(pos)
    ok = present.copy()
    columns = []
    for kind, scale in zip(kinds, scales):
        if kind == "long":
            value, pos = _read_varint(data, pos, end, ok)
            columns.append(("long", value))
        else:                                  # string or bytes-decimal: varint length + bytes
            size, pos = _read_varint(data, pos, end, ok)
            ok &= size >= 0
            if kind == "decimal":
                ok &= size <= 16                   # decimal128 holds at most 16 bytes
            size = np.where(ok, size, 0)
            start = pos
            stop = pos + size
            ok &= stop <= end
            pos = np.where(ok, stop, pos)
            columns.append((kind, (start, size, scale)))
    ok &= pos == end
    # wide decimals (over 8 bytes, rare): read exactly now, so a value beyond 38 digits marks
    # the record bad before any field array is built
    big_decimals = []
    for kind, payload in columns:
        big = {}
        if kind == "decimal":
            start, size, _ = payload
            for i in np.flatnonzero(ok & (size > 8)):
                v = int.from_bytes(data[start[i]:start[i] + size[i]].tobytes(), "big", signed=True)
                if abs(v) >= 10 ** 38:
                    ok[i] = False
                else:
                    big[int(i)] = v
        big_decimals.append(big)
    arrays = []
    for (kind, payload), typ, big in zip(columns, types, big_decimals):
        if kind == "long":
            arrays.append(pa.Array.from_buffers(pa.int64(), n, [_validity(ok),
                                                pa.py_buffer(np.where(ok, payload, 0).astype(np.int64).tobytes())]))
        elif kind == "string":
            start, size, _ = payload
            size = np.where(ok, size, 0)
            arr = pa.Array.from_buffers(pa.string(), n, [_validity(ok), pa.py_buffer(_offsets(size).tobytes()),
                                                         pa.py_buffer(_gather(data, start, size).tobytes())])
            try:
                arr.validate(full=True)
            except pa.ArrowInvalid:
                bad = _invalid_utf8_rows(data, start, size, ok)
                ok &= ~bad
                return decode_with_mask(bodies, kinds, scales, names, types, ok)
            arrays.append(arr)
        else:
            start, size, scale = payload
            size = np.where(ok, size, 0)
            arrays.append(_decode_decimals(data, start, size, ok, typ,
                                           {i: v for i, v in big.items() if ok[i]}))
    err = np.where(present & ~ok, "bad_avro", None)
    arrays.append(pa.array(err, type=pa.string()))
    return pa.StructArray.from_arrays(arrays, names=list(names) + ["decode_error"])


def decode_with_mask(bodies, kinds, scales, names, types, ok):
    """Second pass after invalid UTF-8 was found: decode, then null the bad rows."""
    out = decode(pa.array(np.where(ok, bodies.to_numpy(zero_copy_only=False), None), type=pa.binary()),
                 kinds, scales, names, types)
    present = ~np.asarray(bodies.is_null(), dtype=bool)
    err = np.where(present & ~ok, "bad_avro", out.field("decode_error").to_numpy(zero_copy_only=False))
    fields = [out.field(i) for i in range(len(names))] + [pa.array(err, type=pa.string())]
    return pa.StructArray.from_arrays(fields, names=list(names) + ["decode_error"])


def _invalid_utf8_rows(data, start, size, ok) -> np.ndarray:
    bad = np.zeros(len(start), dtype=bool)
    for i in np.flatnonzero(ok):
        try:
            data[start[i]:start[i] + size[i]].tobytes().decode("utf-8")
        except UnicodeDecodeError:
            bad[i] = True
    return bad


def _decode_decimals(data, start, size, ok, typ, big: dict) -> pa.Array:
    n = len(start)
    small = ok & (size <= 8)
    value = np.zeros(n, dtype=np.int64)
    for k in range(8):                       # big-endian two's complement, sign-extended
        has = small & (size > k)
        byte = np.zeros(n, dtype=np.int64)
        byte[has] = data[start[has] + k]
        value = np.where(has, (value << np.int64(8)) | byte, value)
    neg = small & (size > 0)
    first = np.zeros(n, dtype=np.int64)
    first[neg] = data[start[neg]]
    sign = neg & (first >= 128)
    # sizes below 8 bytes: subtract 2^(8*size) when the sign bit is set (8 bytes wrap already)
    value = np.where(sign & (size < 8), value - (np.int64(1) << (np.int64(8) * size).clip(0, 62)), value)
    return _decimal_from_int64(value, ok, big, typ)


# ---------------------------------------------------------------- encode
def encode(rec: pa.StructArray, kinds, scales, names) -> pa.Array:
    """Struct of contract fields -> Avro bodies (NULL where a field is NULL)."""
    n = len(rec)
    valid = ~np.asarray(rec.is_null(), dtype=bool) if rec.null_count else np.ones(n, dtype=bool)
    pieces = []                   # per field: (kind, payload)
    lengths = []
    for name, kind, scale in zip(names, kinds, scales):
        col = rec.field(name)
        if col.null_count:
            valid &= ~np.asarray(col.is_null(), dtype=bool)
        if kind == "long":
            vals = np.asarray(col.fill_null(0).cast(pa.int64()), dtype=np.int64)
            mat, size = _write_varint_bytes(vals)
            pieces.append(("varint", (mat, size)))
            lengths.append(size)
        elif kind == "string":
            data, start, stop, _ = _binary_parts(col.cast(pa.string()).cast(pa.binary()))
            size = stop - start
            mat, vsize = _write_varint_bytes(size)
            pieces.append(("bytes", (mat, vsize, data, start, size)))
            lengths.append(vsize + size)
        else:
            raw, size = _decimal_bytes(col.cast(pa.decimal128(38, scale)))
            mat, vsize = _write_varint_bytes(size)
            pieces.append(("bytes", (mat, vsize, raw, np.arange(n, dtype=np.int64) * 16 + (16 - size), size)))
            lengths.append(vsize + size)
    row_len = np.where(valid, np.sum(lengths, axis=0), 0).astype(np.int64)
    offsets = _offsets(row_len)
    out = np.zeros(int(row_len.sum()), dtype=np.uint8)
    cursor = offsets[:-1].astype(np.int64)
    for (kind, payload), field_len in zip(pieces, lengths):
        mat, vsize = payload[0], payload[1]
        for k in range(MAX_VARINT):
            sel = valid & (vsize > k)
            if not sel.any():
                break
            out[cursor[sel] + k] = mat[sel, k]
        if kind == "bytes":
            _, _, data, start, size = payload
            size_v = np.where(valid, size, 0)
            dst = cursor + vsize
            chunk = _gather(data, start, size_v)
            if len(chunk):
                out[_gather_positions(dst, size_v)] = chunk
        cursor = cursor + np.where(valid, field_len, 0)
    return pa.Array.from_buffers(pa.binary(), n, [_validity(valid), pa.py_buffer(offsets.tobytes()),
                                                  pa.py_buffer(out.tobytes())])


def _gather_positions(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    total = int(length.sum())
    rel = np.arange(total, dtype=np.int64) - np.repeat(np.cumsum(length) - length, length)
    return np.repeat(start, length) + rel


def _decimal_bytes(arr: pa.Array):
    """decimal128 -> (16-byte big-endian words as uint8, minimal two's-complement size)."""
    n = len(arr)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.int64)
    low, high = _decimal_words(arr)
    le = np.empty((n, 2), dtype=np.uint64)
    le[:, 0] = low
    le[:, 1] = high.view(np.uint64)
    be = le.view(np.uint8).reshape(n, 16)[:, ::-1].copy()        # big-endian 16 bytes per value
    neg = high < 0
    filler = np.where(neg, 0xFF, 0x00).astype(np.uint8)
    # leading bytes equal to the sign filler can be dropped while the next byte keeps the sign
    size = np.full(n, 16, dtype=np.int64)
    for k in range(15):
        can = (be[:, k] == filler) & (((be[:, k + 1] >= 128) == neg)) & (size == 16 - k)
        size = np.where(can, 16 - k - 1, size)
    return be.reshape(-1), size
