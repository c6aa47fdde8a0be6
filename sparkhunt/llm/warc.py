"""WARC archives as seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each holding whole WARC records, and a
seek table in a skippable frame at its end (the published seekable format, with
checksums).  The manifest maps every record to its bundle, frame, and offset and length
inside the frame, so one record is read by decompressing one frame.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkhunt.llm.common import SharedFile, batches, open_shared
from sparkhunt.names import c
from sparkhunt.operators.lookup import totals_join
from sparkhunt.session import cut_lineage

#: Fixed values of the seekable format: skippable frame, footer, and checksum flag.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80

MANIFEST = "key string, bundle string, frame int, offset long, length long"
_MANIFEST_ARROW = pa.schema([("key", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])
RECORDS = "key string, record_type string, target_uri string, payload binary, payload_bytes long, payload_digest string, refers_to string"
_RECORDS_ARROW = pa.schema(
    [("key", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string())]
)


def with_revisits(pages: DataFrame, key: str, payload: Column, least_bytes: int) -> DataFrame:
    """(key, uri, payload, digest, refers_to) of ``pages`` with a ``uri`` column.

    Of equal payloads of ``least_bytes`` or more, the rows with the smallest key are
    responses (a repeated key repeats the response, a null key counts as largest); the
    others refer to that key and carry no payload any further.
    """
    rows = pages.select(c(key).alias("key"), c("uri"), payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    groups = (
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    joined = totals_join(rows, cut_lineage(groups), ["digest"], "n")
    refers = F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first"))
    return joined.withColumn("refers_to", refers).drop("first")


def _header_text(value: str) -> str:
    """A header value on one line of ASCII."""
    return quote(value, safe="!#$&'()*+,/:;=?@[]~")


def record_bytes(key: str | None, uri: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC/1.1 record; a revisit states the length of the payload it leaves out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid5(NAMESPACE_URL, f'record:{key}')}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if key is not None:
        head.append(f"X-Record-Key: {_header_text(key)}")
    if uri is not None:
        head.append(f"WARC-Target-URI: {_header_text(uri)}")
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:uuid:{uuid5(NAMESPACE_URL, f'record:{refers_to}')}>",
            f"X-Refers-To-Key: {_header_text(refers_to)}",
            f"X-Payload-Length: {len(payload)}",
        ]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class BundleWriter:
    """Writes records into frames of one bundle file."""

    def __init__(self, folder: str, stem: str, frame_bytes: int, level: int):
        self.file = SharedFile(folder, stem, ".warc.zst")
        self._frame_bytes, self._zstd = frame_bytes, zstandard.ZstdCompressor(level=level)
        self._held: list[bytes] = []
        self._length = 0
        self._seek: list[tuple[int, int, int]] = []

    def add(self, record: bytes) -> tuple[int, int]:
        """Returns the record's frame and its offset there."""
        if self._length and self._length + len(record) > self._frame_bytes:
            self._end_frame()
        place = len(self._seek), self._length
        self._held.append(record)
        self._length += len(record)
        return place

    def _end_frame(self) -> None:
        if not self._held:
            return
        plain = b"".join(self._held)
        packed = self._zstd.compress(plain)
        self.file.write(packed)
        self._seek.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self._held, self._length = [], 0

    def close(self) -> None:
        self._end_frame()
        body = b"".join(struct.pack("<III", *x) for x in self._seek) + struct.pack("<IBI", len(self._seek), CHECKSUMS, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.file.close()


class BundleReader:
    """Random access to the frames of a bundle through its seek table."""

    def __init__(self, folder: str, name: str):
        self._file = open_shared(folder, name)
        size = self._file.size()
        self._file.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", self._file.read(9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError(f"{name} has no seek table")
        self._file.seek(size - 9 - 12 * n)
        table = self._file.read(12 * n)
        self.frames, start = [], 0
        for packed, plain, check in struct.iter_unpack("<III", table):
            self.frames.append((start, packed, plain, check))
            start += packed

    def frame(self, number: int) -> bytes:
        start, packed, plain, check = self.frames[number]
        self._file.seek(start)
        data = zstandard.ZstdDecompressor().decompress(self._file.read(packed), max_output_size=plain)
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {number} is damaged")
        return data

    def close(self) -> None:
        self._file.close()


def parse_record(data: bytes, start: int = 0) -> tuple[dict, int]:
    """The record at ``start`` and where the next one begins; checks a response's digest."""
    end = data.index(b"\r\n\r\n", start)
    lines = data[start:end].decode("ascii").split("\r\n")
    head = dict(x.split(": ", 1) for x in lines[1:])
    block_start, length = end + 4, int(head["Content-Length"])
    block = data[block_start : block_start + length]
    payload = block[block.index(b"\r\n\r\n") + 4 :]
    digest, kind = head["WARC-Payload-Digest"].removeprefix("sha256:"), head["WARC-Type"]
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("a payload differs from its digest")
    text = lambda name: unquote(head[name]) if name in head else None
    row = {
        "key": text("X-Record-Key"),
        "record_type": kind,
        "target_uri": text("WARC-Target-URI"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": int(head.get("X-Payload-Length", len(payload))),
        "payload_digest": digest,
        "refers_to": text("X-Refers-To-Key"),
    }
    return row, block_start + length + 4


def write_bundles(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    uri: str = "url",
    html: str = "html",
    least_bytes: int = 100,
    frame_bytes: int = 1 << 18,
    bundle_bytes: int = 1 << 26,
    level: int = 3,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write one record per row below ``folder`` and return the manifest (also kept there).

    A null payload is written as an empty one, null keys and addresses are left out of the
    record, an empty table gives no bundle; columns other than the three are not read.
    A record longer than a frame has a frame to itself.  Files of attempts that were lost
    stay unnamed by the manifest and may be deleted.
    """
    named = pages.select(c(key).alias("id"), c(uri).cast("string").alias("uri"), c(html).cast("string").alias("html"))
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = with_revisits(named, "id", payload, least_bytes).select(
        F.col("key").cast("string"), "uri", "payload", "digest", F.col("refers_to").cast("string")
    )

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def places():
            writer, held, number = None, [], 0
            for part in parts:
                for i in range(part.num_rows):
                    k, address, body, digest, refers = (part.column(j)[i].as_py() for j in range(5))
                    if writer is None:
                        writer = BundleWriter(folder, f"bundle-{TaskContext.get().partitionId():06d}-{number:04d}", frame_bytes, level)
                        number += 1
                    record = record_bytes(k, address, body, digest, refers, date)
                    frame, offset = writer.add(record)
                    held.append({"key": k, "bundle": writer.file.name, "frame": frame, "offset": offset, "length": len(record)})
                    if writer.file.size >= bundle_bytes or len(held) >= 100_000:
                        writer.close()
                        yield from held
                        writer, held = None, []
            if writer is not None:
                writer.close()
                yield from held

        yield from batches(places(), _MANIFEST_ARROW)

    rows.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the bundles that the manifest names, as ``RECORDS``."""
    names = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("bundle").distinct()
    names = names.repartition(min(max(names.count(), 1), 10_000), "bundle")

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for part in parts:
                for name in part.column(0).to_pylist():
                    bundle = BundleReader(folder, name)
                    for number in range(len(bundle.frames)):
                        data, at = bundle.frame(number), 0
                        while at < len(data):
                            row, at = parse_record(data, at)
                            yield row
                    bundle.close()

        yield from batches(records(), _RECORDS_ARROW, weigh=lambda r: len(r["payload"] or b""))

    return names.mapInArrow(read, RECORDS)


def fetch_records(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """The records of the keys in ``keys`` (column ``key``), by frame and offset."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    wanted = manifest.join(keys.select(F.col("key").cast("string")).distinct(), "key", "left_semi")
    placed = wanted.repartition("bundle").sortWithinPartitions("bundle", "frame", "offset").select("bundle", "frame", "offset")

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            at, bundle, data = (None, None), None, b""
            for part in parts:
                for name, number, offset in zip(*(part.column(j).to_pylist() for j in range(3)), strict=True):
                    if name != at[0]:
                        bundle = BundleReader(folder, name)
                    if (name, number) != at:
                        data, at = bundle.frame(number), (name, number)
                    yield parse_record(data, offset)[0]

        yield from batches(records(), _RECORDS_ARROW, weigh=lambda r: len(r["payload"] or b""))

    return placed.mapInArrow(read, RECORDS)
