"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle is a file of frames with a
seek table in a skippable frame at its end. The index maps each record to its bundle, frame
and offset in the decompressed frame, so one record costs one seek and one frame.

A task writes bundles of its own under fresh names and reports them as index rows. The index
is what Spark commits: a bundle that a lost or repeated attempt leaves behind is in no index
row and is never read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebars.llm.tables import record_batch

#: payloads from this size on are stored once
REVISIT_BYTES = 100
#: uncompressed bytes after which a frame, and a bundle, is closed
FRAME_BYTES, BUNDLE_BYTES = 1 << 18, 64 << 20
# fixed values of the seekable Zstandard format: skippable frame and seek table footer
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "

INDEX = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("record_type", T.StringType()),
    T.StructField("bundle", T.StringType()), T.StructField("frame", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
RECORDS = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("payload", T.BinaryType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("refers_to", T.LongType())])


def _urn(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"" if page_id is None else str(page_id).encode())


def _page_id(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def format_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record with its payload, or a revisit record with the HTTP header alone."""
    http = _HEAD + str(len(payload)).encode() + b"\r\n\r\n"
    block = http + payload if refers_to is None else http
    lines = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
             b"WARC-Record-ID: " + _urn(page_id), b"WARC-Date: 1970-01-01T00:00:00Z",
             b"Content-Type: application/http;msgtype=response", b"WARC-Payload-Digest: sha256:" + digest.encode()]
    if url is not None:  # a target is one line
        lines.append(b"WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A").encode())
    if refers_to is not None:
        lines += [b"WARC-Profile: " + _PROFILE.encode(), b"WARC-Refers-To: " + _urn(refers_to)]
    lines.append(b"Content-Length: " + str(len(block)).encode())
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, object], int]:
    """The record that begins at ``at``, as a row of RECORDS, and where the next one begins."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}")
    head = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    size = int(head["content-length"])
    block = data[end + 4:end + 4 + size]
    if len(block) != size or data[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = int(http.rpartition(b":")[2])
    digest = head["warc-payload-digest"].removeprefix("sha256:")
    whole = head["warc-type"] == "response"
    if whole and (len(payload) != declared or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {head['warc-record-id']} is not the one that was written")
    url = head.get("warc-target-uri")
    if url is not None:
        url = url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    return {"page_id": _page_id(head["warc-record-id"]), "url": url, "record_type": head["warc-type"],
            "payload": payload if whole else None, "payload_bytes": declared, "payload_digest": digest,
            "refers_to": _page_id(head.get("warc-refers-to"))}, end + 8 + size


#: schemes that executors write to and read from with Arrow's file systems, and their names there
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def arrow_root(spark: SparkSession, root: str) -> str:
    """The folder as Arrow's file systems name it. Hadoop settles what a path without a scheme, or one as
    ``file:/x``, means; a scheme that Arrow has no file system for is refused before anything is written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    uri = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(folder).toUri()
    if uri.getScheme() not in SCHEMES:
        raise ValueError(f"bundles can't be written to {uri.getScheme()}: folders, use one of {', '.join(sorted(SCHEMES))}")
    return f"{SCHEMES[uri.getScheme()]}://{uri.getRawAuthority() or ''}{uri.getRawPath()}"


class BundleWriter:
    """One bundle: records go into the open frame; frames and at last the seek table into the file."""

    def __init__(self, root: str, frame_bytes: int = FRAME_BYTES):
        fs, path = pyarrow.fs.FileSystem.from_uri(root) if "://" in root else (pyarrow.fs.LocalFileSystem(), root)
        self.frame_bytes = frame_bytes
        self.name = f"bundle-{uuid.uuid4().hex}.warc.zst"
        self.file = fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.coder = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.held = self.total = 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame, offset in the frame and length of the record."""
        place = len(self.frames), self.held, len(record)
        self.open.append(record)
        self.held += len(record)
        self.total += len(record)
        if self.held >= self.frame_bytes:
            self.flush()
        return place

    def flush(self) -> None:
        if self.open:
            frame = self.coder.compress(b"".join(self.open))
            self.file.write(frame)
            self.frames.append((len(frame), self.held))
            self.open, self.held = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        foot = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(table) + len(foot)) + table + foot)
        self.file.close()


class BundleReader:
    """Reads the seek table at the end of a bundle, then any frame by its number."""

    def __init__(self, root: str, name: str):
        fs, path = pyarrow.fs.FileSystem.from_uri(root) if "://" in root else (pyarrow.fs.LocalFileSystem(), root)
        self.file = fs.open_input_file(f"{path}/{name}")
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE or flags:
            raise ValueError(f"{name} has no seek table")
        table = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.sizes = list(struct.iter_unpack("<II", table))
        self.begin = [0]
        for packed, _ in self.sizes:
            self.begin.append(self.begin[-1] + packed)

    def frame(self, number: int) -> bytes:
        packed, size = self.sizes[number]
        data = zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, self.begin[number]), max_output_size=size)
        if len(data) != size:
            raise ValueError("a frame has not the size that the seek table states")
        return data


def payload_of(html: str = "html") -> Column:
    return F.coalesce(F.col(html), F.lit("")).cast("binary")


def write_archive(pages: DataFrame, root: str, key: str = "page_id", url: str = "url", html: str = "html",
                  frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write a record per row under ``root`` and return the index, which is stored there too.

    Of equal payloads of at least REVISIT_BYTES, rows with the smallest page_id are responses
    and the others revisit them; null payloads are empty, a null page_id is never referred to
    nor revisits unless its payload has an owner, rows that repeat the smallest page_id are
    responses all. Other columns are left out; an empty table writes no bundle."""
    place = arrow_root(pages.sparkSession, root)
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        payload_of(html).alias("payload"))
    digest = F.sha2("payload", 256)
    owners = (rows.where(F.octet_length("payload") >= REVISIT_BYTES).select("page_id", digest.alias("digest"))
              .groupBy("digest").agg(F.min("page_id").alias("owner"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 AND owner IS NOT NULL").select("digest", "owner"))
    planned = (rows.withColumn("digest", digest).join(owners, "digest", "left")
               .withColumn("refers_to", F.when(~F.col("owner").eqNullSafe(F.col("page_id")), F.col("owner")))
               .select("page_id", "url", "payload", "digest", "refers_to"))
    places = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("bundle", pa.string()),
                        ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, index = None, []
        for batch in batches:
            for i in range(batch.num_rows):  # one row at a time: a payload may be large
                row = [c[i].as_py() for c in batch.columns]
                bundle = bundle or BundleWriter(place, frame_bytes)
                frame, offset, length = bundle.add(format_record(*row))
                index.append((row[0], "response" if row[4] is None else "revisit", bundle.name, frame, offset, length))
                if bundle.total >= bundle_bytes:
                    bundle.close()
                    yield record_batch(places, list(zip(*index, strict=True)))
                    bundle, index = None, []
        if bundle:
            bundle.close()
            yield record_batch(places, list(zip(*index, strict=True)))

    planned.mapInArrow(write, INDEX).write.parquet(f"{root}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{root}/index")


def read_archive(index: DataFrame, root: str) -> DataFrame:
    """Every record of the index's bundles, in rows of RECORDS; payloads are checked against
    their digests. A bundle is read by one task, a frame at a time."""
    fields = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])
    place = arrow_root(index.sparkSession, root)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                bundle = BundleReader(place, name)
                for number in range(len(bundle.sizes)):
                    data, at, found = bundle.frame(number), 0, []
                    while at < len(data):
                        record, at = parse_record(data, at)
                        found.append(record)
                    yield pa.RecordBatch.from_pylist(found, schema=fields)

    return index.select("bundle").distinct().mapInArrow(read, RECORDS)


def read_records(wanted: DataFrame, root: str) -> DataFrame:
    """The records of some index rows: for each, one seek to its frame and its offset in there."""
    fields = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])
    place = arrow_root(wanted.sparkSession, root)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str, int] | None = None
        bundle, data = None, b""
        for batch in batches:
            for row in batch.to_pylist():
                if bundle is None or held is None or held[0] != row["bundle"]:
                    bundle = BundleReader(place, row["bundle"])
                    held = None
                if held != (row["bundle"], row["frame"]):
                    data, held = bundle.frame(row["frame"]), (row["bundle"], row["frame"])
                record, end = parse_record(data, row["offset"])
                if end - row["offset"] != row["length"]:
                    raise ValueError("the index does not fit the bundle")
                yield pa.RecordBatch.from_pylist([record], schema=fields)

    return (wanted.repartition("bundle").sortWithinPartitions("bundle", "frame", "offset")
            .select(*INDEX.fieldNames()).mapInArrow(read, RECORDS))
