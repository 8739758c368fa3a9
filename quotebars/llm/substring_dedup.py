"""Removal of repeated byte strings: every byte that a string of LENGTH bytes covers which also
starts earlier (in an earlier document, or earlier in the same one).

1. Anchors. Of the GRAM-byte strings in a window of LENGTH bytes, the one with the least hash
   is the window's anchor, so equal windows have equal anchors at equal places. Successive
   windows with one anchor make a stretch; stretches, not windows, are shuffled, as hashes.
2. Whole stretches that come again are settled by their hash: all but the first go.
3. Different stretches around equal anchors (the ends of repeated passages) may share some of
   their windows. Their bytes are fetched, and bucket-pointer refinement sorts their suffixes to
   the depth of a window: buckets by the first Q bytes, refined by sorting on the bucket ids of
   later offsets, whose updated ids the next refinement uses again, so that the depth doubles.
   Suffixes alone in their bucket drop out on the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotebars.llm.tables import record_batch
from quotebars.llm.words import mix
from quotebars.session import scratch_dir

LENGTH, GRAM, Q = 100, 32, 8
#: bytes that are hashed at once, and that the first occurrences in a task are looked up among
PIECE, COMBINE = 1 << 20, 16 << 20
#: bytes of stretches whose suffixes are sorted together, about
REFINE = 1 << 20
#: stretches around one anchor from which on their windows are spread by content
CROWD = 20_000
_U64 = np.uint64
_RANDOM = np.random.default_rng(88172645463325252)
_BYTE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64)
_FACTOR = int(_RANDOM.integers(0, 1 << 63)) * 2 + 1
_INDEX = (1 << 24) - 1


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP = _powers(_FACTOR, PIECE + LENGTH + 8)
_DOWN = _powers(pow(_FACTOR, -1, 1 << 64), PIECE + LENGTH + 8)


def stretches(pieces: list[tuple[int, int, bytes]]) -> dict[str, np.ndarray]:
    """The stretches of (uid, offset, bytes) pieces, in order: anchor (32-bit hash), whole (hash of
    all bytes from the first window's start to the last one's end), uid, lo and hi (offsets of
    the first and last window's start) and the anchor's offset ``at``."""
    data = b"".join(p[2] for p in pieces)
    raw = np.frombuffer(data, dtype=np.uint8)
    size = np.array([len(p[2]) for p in pieces], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])[:-1]
    n = len(raw)
    empty = np.zeros(0, dtype=np.int64)
    if n < LENGTH:
        return {"anchor": empty.astype(np.uint32), "whole": empty.astype(np.uint64), "uid": empty, "lo": empty, "hi": empty, "at": empty}
    up = _UP if n <= len(_UP) else _powers(_FACTOR, n)
    down = _DOWN if n <= len(_DOWN) else _powers(pow(_FACTOR, -1, 1 << 64), n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * up[:n], out=sums[1:])
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[:n - GRAM + 1])
    # hash above, place below: the least is the leftmost of the least hashes
    least = (grams & ~_U64(_INDEX)) | np.arange(len(grams), dtype=np.uint64)
    width, span = LENGTH - GRAM + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    anchor = (least & _U64(_INDEX)).astype(np.int64)
    owner = np.repeat(np.arange(len(pieces)), size)[:len(anchor)]
    valid = np.arange(len(anchor)) + LENGTH <= (begin + size)[owner]
    starts = np.flatnonzero(valid)
    if not len(starts):
        return stretches([])
    a = anchor[starts]
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (starts[1:] != starts[:-1] + 1)])
    lo, hi = starts[new], starts[np.r_[new[1:], len(starts)] - 1]
    at, doc = a[new], owner[lo]
    whole = (sums[hi + LENGTH] - sums[lo]) * down[lo]
    whole = mix(mix(whole) ^ ((hi - lo) * 256 + (at - lo)).astype(np.uint64))
    base = np.array([p[1] for p in pieces], dtype=np.int64)[doc] - begin[doc]
    return {"anchor": (grams[at] & _U64(0xFFFFFFFF)).astype(np.uint32), "whole": whole,
            "uid": np.array([p[0] for p in pieces], dtype=np.int64)[doc], "lo": lo + base, "hi": hi + base, "at": at + base}


def repeats(anchor: np.ndarray, whole: np.ndarray, uid: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by (anchor, whole, uid, lo), and which of the rows so ordered are not the first
    of their anchor and whole hash."""
    order = np.lexsort((lo, uid, whole, anchor))
    a, w = anchor[order], whole[order]
    return order, np.r_[False, (a[1:] == a[:-1]) & (w[1:] == w[:-1])] if len(order) else np.zeros(0, dtype=bool)


def joined_runs(uid: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals that overlap or touch, joined, by uid and begin."""
    if not len(uid):
        return uid, begin, end
    order = np.lexsort((begin, uid))
    uid, begin, end = uid[order], begin[order], end[order]
    # the furthest end so far in the same document: a running maximum over (document, end)
    doc = np.cumsum(np.r_[0, uid[1:] != uid[:-1]])
    scale = int(end.max()) + 1
    reach = np.maximum.accumulate(doc * scale + end) - doc * scale
    new = np.r_[True, (uid[1:] != uid[:-1]) | (begin[1:] > reach[:-1])]
    first = np.flatnonzero(new)
    return uid[first], begin[first], reach[np.r_[first[1:], len(uid)] - 1]


def refine(data: bytes, suffixes: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Bucket ids of the suffixes: equal just for those whose first ``depth`` bytes are equal
    (-1 for a suffix that is alone). Every suffix must have ``depth`` bytes."""
    raw = np.frombuffer(data + bytes(Q), dtype=np.uint8)
    first = np.ndarray((len(data),), dtype=">u8", buffer=raw.data, strides=(1,)).astype(np.uint64)
    _, bucket = np.unique(first, return_inverse=True)
    bucket = bucket.astype(np.int64)
    known = Q
    out = np.full(len(suffixes), -1, dtype=np.int64)
    live = np.arange(len(suffixes))
    # which places in the text can still matter: all, until the last refinement
    while True:
        step = min(known, depth - known)
        last = known + step >= depth
        places = suffixes[live] if last else np.arange(len(data))
        later = places + step
        inside = later < len(data)
        second = np.where(inside, bucket[np.minimum(later, len(data) - 1)], -1)
        key = bucket[places] * (len(data) + 1) + second + 1
        _, ids = np.unique(key, return_inverse=True)
        if last:
            count = np.bincount(ids)
            shared = count[ids] > 1
            out[live[shared]] = ids[shared]
            return out
        bucket = ids.astype(np.int64)
        known += step
        own = bucket[suffixes[live]]
        live = live[np.bincount(own, minlength=int(bucket.max()) + 1)[own] > 1]
        if not len(live):
            return out


def _planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight together: long runs of equal bytes, which shuffles compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _flat(data: bytes, n: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(width, n).T).view(kind).reshape(n)


def pack(s: dict[str, np.ndarray]) -> bytes:
    n = len(s["uid"])
    return np.int64(n).tobytes() + _planes(s["anchor"]) + _planes(s["whole"]) + _planes(s["uid"].astype(np.int64)) + \
        _planes(s["lo"].astype(np.int64)) + (s["hi"] - s["lo"]).astype(np.uint8).tobytes() + (s["at"] - s["lo"]).astype(np.uint8).tobytes()


def unpack(blobs: list[bytes]) -> dict[str, np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {k: [] for k in ("anchor", "whole", "uid", "lo", "hi", "at")}
    for blob in blobs:
        n, at = int(np.frombuffer(blob, dtype=np.int64, count=1)[0]), 8
        for name, kind in (("anchor", "u4"), ("whole", "u8"), ("uid", "i8"), ("lo", "i8")):
            width = n * np.dtype(kind).itemsize
            parts[name].append(_flat(blob[at:at + width], n, kind))
            at += width
        parts["hi"].append(parts["lo"][-1] + np.frombuffer(blob, dtype=np.uint8, count=n, offset=at))
        parts["at"].append(parts["lo"][-1] + np.frombuffer(blob, dtype=np.uint8, count=n, offset=at + n))
    return {k: np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for k, v in parts.items()}


_SPANS = "uid long, begin long, end long, at long, crowd boolean"
_SPAN_FIELDS = pa.schema([("uid", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("at", pa.int64()), ("crowd", pa.bool_())])


def _span_batch(uid: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray | None = None, crowd: np.ndarray | None = None) -> pa.RecordBatch:
    n = len(uid)
    return record_batch(_SPAN_FIELDS, [uid, begin, end, np.full(n, -1) if at is None else at, np.zeros(n, dtype=bool) if crowd is None else crowd])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text"), strict=True):
        yield uid, text.as_py() or b""


def find_stretches(docs: DataFrame, parts: int) -> DataFrame:
    """(part, kind, blob) from rows (uid, text): packed stretches by their anchor's part (kind 0),
    first occurrences in a task's last COMBINE bytes only; of the others the intervals (kind 1)."""
    out = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])

    def flush(held: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        s = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
        order, again = repeats(s["anchor"], s["whole"], s["uid"], s["lo"])
        gone = order[again]
        uid, begin, end = joined_runs(s["uid"][gone], s["lo"][gone], s["hi"][gone] + LENGTH)
        first = np.sort(order[~again])
        part = (s["anchor"][first] % np.uint32(parts)).astype(np.int32)
        first = first[np.argsort(part, kind="stable")]
        cuts = np.searchsorted(np.sort(part), np.arange(parts + 1))
        rows = [(p, 0, pack({k: v[first[cuts[p]:cuts[p + 1]]] for k, v in s.items()})) for p in range(parts) if cuts[p] < cuts[p + 1]]
        if len(uid):
            rows.append((int(uid[0] % parts), 1, np.stack([uid, begin, end]).astype(np.int64).tobytes()))
        if rows:
            yield record_batch(out, list(zip(*rows, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        pieces: list[tuple[int, int, bytes]] = []
        size = total = 0
        for batch in batches:
            for uid, text in _rows(batch):
                for at in range(0, max(len(text) - LENGTH + 1, 0), PIECE):
                    piece = text[at:at + PIECE + LENGTH - 1]
                    if pieces and size + len(piece) > PIECE + LENGTH:
                        held.append(stretches(pieces))
                        pieces, size = [], 0
                    pieces.append((uid, at, piece))
                    size += len(piece)
                    total += len(piece)
                if total >= COMBINE:
                    held.append(stretches(pieces))
                    yield from flush(held)
                    held, pieces, size, total = [], [], 0, 0
        if pieces:
            held.append(stretches(pieces))
        if held:
            yield from flush(held)

    return docs.mapInArrow(run, "part int, kind int, blob binary")


def settle_stretches(packed: DataFrame, parts: int) -> DataFrame:
    """Rows of _SPANS: intervals to remove (at -1), and stretches (by their first occurrences)
    that share an anchor with different ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = []
        for batch in batches:
            for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                if kind:
                    yield _span_batch(*np.frombuffer(blob, dtype=np.int64).reshape(3, -1))
                else:
                    blobs.append(blob)
        if not blobs:
            return
        s = unpack(blobs)
        del blobs
        order, again = repeats(s["anchor"], s["whole"], s["uid"], s["lo"])
        gone = order[again]
        if len(gone):
            yield _span_batch(*joined_runs(s["uid"][gone], s["lo"][gone], s["hi"][gone] + LENGTH))
        first = order[~again]
        a = s["anchor"][first]
        group = np.cumsum(np.r_[0, a[1:] != a[:-1]])
        count = np.bincount(group)[group]
        ask, n = first[count > 1], count[count > 1]
        if len(ask):
            yield _span_batch(s["uid"][ask], s["lo"][ask], s["hi"][ask], s["at"][ask], n > CROWD)

    return packed.repartition(parts, "part").select("kind", "blob").mapInArrow(run, _SPANS)


def fetch_bytes(asked: DataFrame) -> DataFrame:
    """(key, uid, begin, data) of asked stretches, from rows (uid, text, asked): equal windows get
    equal keys, as they share the anchor, or in a crowd as they are keyed by themselves."""
    out = pa.schema([("key", pa.int64()), ("uid", pa.int64()), ("begin", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                uid, text = batch.column("uid")[i].as_py(), batch.column("text")[i].as_py()
                rows = []
                for x in batch.column("asked")[i].as_py():
                    if x["crowd"]:
                        rows += [(_digest(text[b:b + LENGTH]), uid, b, text[b:b + LENGTH]) for b in range(x["begin"], x["end"] + 1)]
                    else:
                        rows.append((_digest(text[x["at"]:x["at"] + GRAM]), uid, x["begin"], text[x["begin"]:x["end"] + LENGTH]))
                yield record_batch(out, list(zip(*rows, strict=True)))

    return asked.mapInArrow(run, "key long, uid long, begin long, data binary")


def _digest(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def refine_stretches(fetched: DataFrame, parts: int) -> DataFrame:
    """Intervals of _SPANS: windows of the fetched stretches that also start earlier. A task sorts
    the suffixes of about REFINE bytes at a time, all stretches of a key together."""
    def again_in(uid: np.ndarray, begin: np.ndarray, datas: list[bytes]) -> Iterator[pa.RecordBatch]:
        size = np.array([len(d) for d in datas], dtype=np.int64)
        place = np.concatenate([[0], np.cumsum(size)])[:-1]
        windows = size - LENGTH + 1
        owner = np.repeat(np.arange(len(size)), windows)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        bucket = refine(b"".join(datas), place[owner] + within)
        live = np.flatnonzero(bucket >= 0)
        bucket, u, b = bucket[live], uid[owner[live]], begin[owner[live]] + within[live]
        order = np.lexsort((b, u, bucket))
        again = np.r_[False, bucket[order][1:] == bucket[order][:-1]] if len(order) else np.zeros(0, dtype=bool)
        gone = order[again]
        if len(gone):
            yield _span_batch(*joined_runs(u[gone], b[gone], b[gone] + LENGTH))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, uids, begins, datas = [], [], [], []
        for batch in batches:
            keys.append(batch.column("key").to_numpy())
            uids.append(batch.column("uid").to_numpy())
            begins.append(batch.column("begin").to_numpy())
            datas += batch.column("data").to_pylist()
        if not datas:
            return
        key, uid, begin = np.concatenate(keys), np.concatenate(uids), np.concatenate(begins)
        shares = -(-sum(map(len, datas)) // REFINE)
        share = (key.view(np.uint64) >> np.uint64(20)) % np.uint64(shares)
        for k in range(shares):
            some = np.flatnonzero(share == k)
            if len(some):
                yield from again_in(uid[some], begin[some], [datas[i] for i in some])

    return fetched.repartition(parts, "key").mapInArrow(run, _SPANS)


def cut_texts(rows: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) from rows (doc_id, text, gone): the spans are the maximal
    removed runs, kept the other bytes."""
    fields = [("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pa.schema([batch.schema.field("doc_id"), *fields])
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                size, spans, kept = [], [], []
                for text, gone in zip(part.column("text"), part.column("gone"), strict=True):
                    data = text.as_py() or b""
                    size.append(len(data))
                    if not gone.is_valid or not len(gone):
                        spans.append([])
                        kept.append(data)
                        continue
                    flat = gone.values.flatten()
                    begin, end = flat[0].to_numpy(), flat[1].to_numpy()
                    _, begin, end = joined_runs(np.zeros(len(begin), dtype=np.int64), begin, end)
                    edges = [0, *np.stack([begin, end], axis=1).ravel().tolist(), len(data)]
                    spans.append([{"start": a, "end": b} for a, b in zip(edges[1:-1:2], edges[2:-1:2], strict=True)])
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                yield record_batch(out, [part.column("doc_id"), size, spans, kept])

    return rows.select("doc_id", "text", "gone").mapInArrow(
        run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def _with_uid(docs: DataFrame, root: str) -> DataFrame:
    """(uid, doc_id, text): uid is the identifier itself, if each row has one of its own. Else rows
    that share one are told apart by their texts' order, and null identifiers come last."""
    ids = docs.select("doc_id")
    clash = ids.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").agg(F.max("count")).first()[0]
    if clash is None:
        return docs.select(F.col("doc_id").alias("uid"), "doc_id", "text")
    most = ids.agg(F.max(F.abs("doc_id"))).first()[0] or 0
    if (most + 2) * (clash + 1) >= 1 << 62:
        raise ValueError("identifiers that repeat must be smaller")
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("text")) - 1
    numbered = docs.withColumn("uid", F.coalesce("doc_id", F.lit(most + 1)) * (clash + 1) + number)
    numbered.select("uid", "doc_id", "text").write.parquet(f"{root}/numbered")
    return docs.sparkSession.read.parquet(f"{root}/numbered")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for every row of ``docs``: the size of the text in UTF-8, the
    maximal removed byte runs and the remaining bytes.

    Matches never cross documents and are judged on the input. A null or short text loses
    nothing (null: no bytes). Rows that share an identifier are documents of their own, in the
    order of their texts; a null identifier comes after all others. An empty table gives no rows."""
    spark = docs.sparkSession
    root = scratch_dir(spark, "substring-dedup")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = _with_uid(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text")), root)
    settle_stretches(find_stretches(rows.select("uid", "text"), parts), parts).write.parquet(f"{root}/spans")
    spans = spark.read.parquet(f"{root}/spans")
    asked = spans.where("at >= 0").groupBy("uid").agg(F.collect_list(F.struct("begin", "end", "at", "crowd")).alias("asked"))
    refined = refine_stretches(fetch_bytes(rows.join(asked, "uid").select("uid", "text", "asked")), parts)
    refined.write.parquet(f"{root}/refined")
    gone = (spans.where("at < 0").unionByName(spark.read.parquet(f"{root}/refined"))
            .groupBy("uid").agg(F.collect_list(F.struct("begin", "end")).alias("gone")))
    return cut_texts(rows.join(gone, "uid", "left"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) after removal. A cut may fall inside a character; such broken characters
    are replaced by U+FFFD."""
    return remove_repeats(docs, key, text).select(F.col("doc_id").alias(key), F.decode("kept", "UTF-8").alias(text))
