"""Seekable Zstandard bundles of WARC records.

Records are grouped into frames that decompress on their own; a bundle ends with a skippable frame that holds
the seek table of the Zstandard seekable format.  An index maps every record to its bundle, frame and offset
within the frame, and reading goes through the seek table: a task opens a bundle, looks up the frame and reads
no more than that.

Bundles are files in the shared folder, written by tasks with pyarrow's file systems.  A task that is run again
writes bundles of its own; only those that its index names are read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from etalage.llm.common import open_shared, written
from etalage.storage import scratch_path

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 26
FRAMES_PER_TASK = 256
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1


# Records -------------------------------------------------------------------------------------------------------------

def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _headers(first: str, fields: list[tuple[str, str]]) -> bytes:
    return "".join([first, "\r\n", *[f"{k}: {v}\r\n" for k, v in fields], "\r\n"]).encode("utf-8")


def _one_line(text: str) -> str:
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in text)


def record(number: int, page_id, url: str | None, payload: bytes | None, payload_digest: str, payload_bytes: int,
           refers_to=None, refers_number: int | None = None, date: str = DATE) -> bytes:
    """A response with its payload, or (``payload`` None) a revisit of another record."""
    fields = [("WARC-Type", "revisit" if payload is None else "response"), ("WARC-Record-ID", f"<urn:record:{number}>"),
              ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
              ("X-Payload-Length", str(payload_bytes))]
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    block = b""
    if payload is None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<urn:record:{refers_number}>")]
        if refers_to is not None:
            fields.append(("X-Refers-To-Page-Id", str(refers_to)))
    else:
        fields.append(("Content-Type", "application/http;msgtype=response"))
        block = _headers("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"),
                                             ("Content-Length", str(len(payload)))]) + payload
    fields.append(("Content-Length", str(len(block))))
    return _headers("WARC/1.1", fields) + block + b"\r\n\r\n"


def parse(data: memoryview | bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header fields and block of the record at ``at``, and where the next one starts."""
    data = bytes(data) if not isinstance(data, bytes) else data
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a record")
    fields = dict(line.split(": ", 1) for line in lines)
    start, size = end + 4, int(fields["Content-Length"])
    if data[start + size:start + size + 4] != b"\r\n\r\n":
        raise ValueError("record of another length than its header says")
    return fields, data[start:start + size], start + size + 4


# Bundles -------------------------------------------------------------------------------------------------------------

class BundleWriter:
    """Frames go out as they fill, the seek table when the bundle is closed."""

    def __init__(self, folder: str, frame_bytes: int = FRAME_BYTES):
        self.uri = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.zst"
        system, path = open_shared(self.uri)
        self.out = system.open_output_stream(path, compression=None)
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frame_bytes, self.bytes = frame_bytes, 0
        self.table: list[tuple[int, int]] = []
        self.waiting: list[bytes] = []
        self.held = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame and offset within the frame of the record."""
        if self.waiting and self.held + len(data) > self.frame_bytes:
            self._flush()
        place = len(self.table), self.held
        self.waiting.append(data)
        self.held += len(data)
        self.bytes += len(data)
        return place

    def _flush(self) -> None:
        if self.waiting:
            frame = self.compressor.compress(b"".join(self.waiting))
            self.out.write(frame)
            self.table.append((len(frame), self.held))
            self.waiting, self.held = [], 0

    def close(self) -> None:
        self._flush()
        entries = b"".join(struct.pack("<II", *e) for e in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class BundleReader:
    def __init__(self, uri: str):
        system, path = open_shared(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"no seek table: {uri}")
        width = 12 if flags & 0x80 else 8
        table = self._read(size - 9 - width * frames, width * frames)
        self.frames, at = [], 0
        for k in range(frames):
            packed, whole = struct.unpack_from("<II", table, k * width)
            self.frames.append((at, packed, whole))
            at += packed

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def frame(self, number: int) -> bytes:
        at, packed, whole = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(self._read(at, packed), max_output_size=whole)

    def close(self) -> None:
        self.file.close()


# Jobs ----------------------------------------------------------------------------------------------------------------

_INDEX = "number long, bundle string, frame int, at long"


def _write_bundles(folder: str, frame_bytes: int, bundle_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, index = None, []
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for r in batch.slice(start, 256).to_pylist():
                    payload = None if r["revisit"] else (r["html"] or b"")
                    data = record(r["number"], r["page_id"], r["url"], payload,
                                  base64.b32encode(bytes.fromhex(r["sha1"])).decode(), r["payload_bytes"],
                                  r["refers_to"], r["refers_number"], date)
                    if bundle is not None and bundle.bytes + len(data) > bundle_bytes:
                        bundle.close()
                        bundle = None
                    bundle = bundle or BundleWriter(folder, frame_bytes)
                    frame, at = bundle.add(data)
                    index.append((r["number"], bundle.uri, frame, at))
                    if len(index) >= 10_000:
                        yield _index_batch(index)
                        index = []
        if bundle is not None:
            bundle.close()
        if index:
            yield _index_batch(index)

    return write


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    number, bundle, frame, at = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(bundle, pa.string()),
                                       pa.array(frame, pa.int32()), pa.array(at, pa.int64())],
                                      names=["number", "bundle", "frame", "at"])


def write_bundles(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url",
                  html: str = "html", min_bytes: int = 0, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES, date: str = DATE) -> DataFrame:
    """Write one record per page and return the index (number, bundle, frame, at).

    Of pages with equal payloads of ``min_bytes`` or more, the one with the smallest id is the response (null ids
    last; of repeated rows one) and the others revisit it.  Null pages have an empty payload.  Payloads are
    compared by length and SHA-1; only digests that occur more than once take part in the join.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    system, path = open_shared(folder)
    system.create_dir(path, recursive=True)
    body = F.coalesce(F.encode(F.col(f"`{html}`"), "UTF-8"), F.lit(b""))
    rows = written(pages.select(
        F.monotonically_increasing_id().alias("number"), F.col(f"`{page_id}`").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"), body.alias("html"), F.sha1(body).alias("sha1"),
        F.octet_length(body).cast("long").alias("payload_bytes")), "warc-pages")
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "number")).alias("first")
    shared = written(rows.where(F.col("payload_bytes") >= min_bytes).groupBy("sha1", "payload_bytes")
                     .agg(first, F.count("*").alias("n")).where("n > 1").select("sha1", "payload_bytes", "first"), "warc-shared")
    revisit = F.coalesce(F.col("first.number") != F.col("number"), F.lit(False))
    marked = (rows.join(shared, ["sha1", "payload_bytes"], "left").withColumn("revisit", revisit)
              .select("number", "page_id", "url", F.when(~F.col("revisit"), F.col("html")).alias("html"), "sha1",
                      "payload_bytes", "revisit", F.when(F.col("revisit"), F.col("first.page_id")).alias("refers_to"),
                      F.when(F.col("revisit"), F.col("first.number")).alias("refers_number")))
    return written(marked.mapInArrow(_write_bundles(folder, frame_bytes, bundle_bytes, date), _INDEX), "warc-index")


_READ = ("number long, page_id string, url string, record_type string, payload_bytes long, payload_digest string, "
         "refers_to string, payload binary")


def _read_frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, name = None, None
    for batch in batches:
        for bundle, frame, places in zip(*(c.to_pylist() for c in batch.columns)):
            if bundle != name:
                if reader is not None:
                    reader.close()
                reader, name = BundleReader(bundle), bundle
            data = reader.frame(frame)
            yield _records(data, places)
    if reader is not None:
        reader.close()


def _records(data: bytes, places: list[int]) -> pa.RecordBatch:
    rows = []
    for at in places:
        fields, block, _ = parse(data, at)
        kind, payload = fields["WARC-Type"], None
        size, sha = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response":
            payload = block[block.index(b"\r\n\r\n") + 4:]
            if (len(payload), digest(payload)) != (size, sha):
                raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
        rows.append((int(fields["WARC-Record-ID"][len("<urn:record:"):-1]), fields.get("X-Page-Id"),
                     fields.get("WARC-Target-URI"), kind, size, sha, fields.get("X-Refers-To-Page-Id"), payload))
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = [f.split()[0] for f in _READ.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_bundles(index: DataFrame) -> DataFrame:
    """The records that ``index`` names, frame by frame; each frame is read and decompressed once.

    The records of a frame are bounded by its size, so their offsets are gathered in one row.
    """
    frames = written(index.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list("at")).alias("places")), "warc-frames")
    # by number of frames, as the bytes that they stand for are not in these rows
    tasks = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(frames.count() / FRAMES_PER_TASK))
    return (frames.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame")
            .mapInArrow(_read_frames, _READ))


def warc_query(spark, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    kind = pages.schema["page_id"].dataType
    return read_bundles(write_bundles(pages)).select(
        F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind))
