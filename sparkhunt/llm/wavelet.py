"""Token ids in wavelet matrices, one succinct compressed file per shard.

The matrix of a shard holds one bit-plane per bit of an id, highest first; after each
plane the ids are stably parted by their bit.  A rank directory (ones before each block)
and separately compressed blocks let a reader answer access, rank, select and count while
unpacking only the blocks it touches.
"""

from __future__ import annotations

import functools
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkhunt.llm.bpe import PieceEncoder
from sparkhunt.llm.common import SharedFile, batches, open_shared
from sparkhunt.names import c

MAGIC = b"WVMX0001"
BLOCK_BYTES = 1 << 15
MANIFEST = "part int, seq int, file string, n_docs long, n_tokens long"
_MANIFEST_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def _planes(ids: np.ndarray, levels: int) -> Iterator[tuple[np.ndarray, int]]:
    """(packed bits, number of zeros) of each level."""
    held = ids
    for level in range(levels):
        bits = (held & held.dtype.type(1 << (levels - 1 - level))) != 0
        low = held.compress(~bits)
        yield np.packbits(bits), len(low)
        held = np.concatenate([low, held.compress(bits)])


def write_shard(folder: str, stem: str, ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, nulls: np.ndarray, level: int = 1) -> str:
    """Write one shard; ``doc_ids`` and ``lengths`` of its documents in order."""
    levels = max(1, int(ids.max()).bit_length() if len(ids) else 1)
    if levels <= 16:
        ids = ids.astype(np.uint16)
    out, packer = SharedFile(folder, stem, ".wvm"), zstandard.ZstdCompressor(level=level)
    out.write(MAGIC)
    directory = {"n": len(ids), "levels": levels, "zeros": [], "blocks": [], "ones": []}
    for bits, zeros in _planes(ids, levels):
        starts = np.arange(0, max(len(bits), 1), BLOCK_BYTES)
        ones = np.concatenate([[0], np.cumsum(np.add.reduceat(np.bitwise_count(bits).astype(np.int64), starts))]) if len(bits) else np.zeros(1, np.int64)
        places = []
        for at in range(0, len(bits), BLOCK_BYTES):
            packed = packer.compress(bits[at : at + BLOCK_BYTES].tobytes())
            places.append((out.size, len(packed)))
            out.write(packed)
        directory["zeros"].append(zeros)
        directory["blocks"].append(places)
        directory["ones"].append(ones.tolist())
    docs = packer.compress(doc_ids.astype("<i8").tobytes() + lengths.astype("<i8").tobytes() + np.packbits(nulls).tobytes())
    directory["docs"] = (out.size, len(docs), len(doc_ids))
    out.write(docs)
    footer = packer.compress(json.dumps(directory).encode())
    out.write(footer + struct.pack("<Q", len(footer)) + MAGIC)
    out.close()
    return out.name


class WaveletShard:
    """Reads a shard: by position, by range and by token."""

    def __init__(self, folder: str, name: str, cached_blocks: int = 256):
        self._file = open_shared(folder, name)
        size = self._file.size()
        self._file.seek(size - 16)
        length, magic = struct.unpack("<Q8s", self._file.read(16))
        if magic != MAGIC:
            raise ValueError(f"{name} is not a wavelet shard")
        self._unpack = zstandard.ZstdDecompressor()
        head = json.loads(self._read(size - 16 - length, length))
        self.n, self.levels, self.zeros = head["n"], head["levels"], head["zeros"]
        self._blocks, self._docs = head["blocks"], head["docs"]
        self._ones = [np.array(x, np.int64) for x in head["ones"]]
        self._block = functools.lru_cache(cached_blocks)(self._load_block)

    def close(self) -> None:
        self._file.close()

    def _read(self, start: int, length: int) -> bytes:
        self._file.seek(start)
        return self._unpack.decompress(self._file.read(length))

    def _load_block(self, level: int, number: int) -> np.ndarray:
        return np.unpackbits(np.frombuffer(self._read(*self._blocks[level][number]), np.uint8))

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, lengths and which ids are null."""
        start, length, n = self._docs
        data = self._read(start, length)
        nulls = np.unpackbits(np.frombuffer(data[16 * n :], np.uint8))[:n].astype(bool)
        return np.frombuffer(data[: 8 * n], "<i8"), np.frombuffer(data[8 * n : 16 * n], "<i8"), nulls

    def rank1(self, level: int, position: int) -> int:
        """Ones before ``position`` in a plane."""
        number, rest = divmod(position, 8 * BLOCK_BYTES)
        if not rest:
            return int(self._ones[level][number])
        return int(self._ones[level][number]) + int(self._block(level, number)[:rest].sum())

    def select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) zero or one of a plane."""
        ones, width = self._ones[level], 8 * BLOCK_BYTES
        upto = ones if bit else np.minimum(np.arange(len(ones)) * width, self.n) - ones
        number = int(np.searchsorted(upto, k, side="right")) - 1
        inside = np.flatnonzero(self._block(level, number) == bit)[k - int(upto[number])]
        return number * width + int(inside)

    def access(self, position: int) -> int:
        """The token at a position."""
        token = 0
        for level in range(self.levels):
            number, rest = divmod(position, 8 * BLOCK_BYTES)
            bit = int(self._block(level, number)[rest])
            ones = self.rank1(level, position)
            position = self.zeros[level] + ones if bit else position - ones
            token = token << 1 | bit
        return token

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        if token >> self.levels:
            return 0, 0
        for level in range(self.levels):
            a, b = self.rank1(level, low), self.rank1(level, high)
            low, high = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.levels - 1 - level) & 1 else (low - a, high - b)
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """How often a token occurs in positions low to high."""
        a, b = self._range(token, low, self.n if high is None else high)
        return b - a

    def locate(self, token: int, low: int = 0, high: int | None = None) -> Iterator[int]:
        """The positions of a token, in ascending order."""
        for at in range(*self._range(token, low, self.n if high is None else high)):
            for level in range(self.levels - 1, -1, -1):
                bit = token >> (self.levels - 1 - level) & 1
                at = self.select(level, bit, at - self.zeros[level] * bit)
            yield at

    def tokens(self) -> np.ndarray:
        """The whole sequence, from the lowest plane up."""
        held = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            packed = b"".join(self._read(*x) for x in self._blocks[level])
            bits = np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n).view(bool)
            above, zeros = np.empty_like(held), self.zeros[level]
            above[np.flatnonzero(~bits)] = held[:zeros]
            above[np.flatnonzero(bits)] = held[zeros:] | held.dtype.type(1 << (self.levels - 1 - level))
            held = above
        return held


@functools.lru_cache(1)
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)  # one per worker, so that its pieces serve many tasks


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    shard_tokens: int = 1 << 21,
) -> DataFrame:
    """Encode whole texts, close each with ``end_id`` and write shards in key order.

    Rows are range-partitioned and sorted by (key, text), null keys first; repeated keys
    stay separate documents next to each other.  A null text counts as empty and gives
    just the end id.  A shard ends with the document that fills it, so its size is
    bounded by ``shard_tokens`` and one document.  An empty table gives no shard.  Other
    columns are not read.  ``tokenizer`` is the path of a tokenizer file on every node.
    Returns the manifest, which is also kept in the folder; files of lost attempts are
    not named there.
    """
    rows = docs.select(c(key).cast("long").alias("id"), F.coalesce(c(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", "text")

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), _encoder(tokenizer)
        ids, docs_held, lengths, nulls, held, seq = [], [], [], [], 0, 0

        def flush() -> dict:
            name = write_shard(folder, f"shard-{part:06d}-{seq:04d}", np.concatenate(ids), np.concatenate(docs_held), np.concatenate(lengths), np.concatenate(nulls))
            return {"part": part, "seq": seq, "file": name, "n_docs": sum(map(len, docs_held)), "n_tokens": held}

        def shards():
            nonlocal held, seq
            for batch in parts:
                for at in range(0, batch.num_rows, 512):
                    some = batch.slice(at, 512)
                    tokens, n, _ = encoder.encode(some.column(1))
                    ends = np.cumsum(n)
                    ids.append(np.insert(tokens, ends, end_id))
                    docs_held.append(some.column(0).fill_null(0).to_numpy())
                    nulls.append(some.column(0).is_null().to_numpy(zero_copy_only=False))
                    lengths.append(n + 1)
                    held += len(ids[-1])
                    if held >= shard_tokens:
                        yield flush()
                        for x in (ids, docs_held, lengths, nulls):
                            x.clear()
                        held, seq = 0, seq + 1
            if ids:
                yield flush()

        yield from batches(shards(), _MANIFEST_ARROW)

    ordered.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the shard files.

    ``start`` counts the ids of all documents before; its running sum has one row per
    shard.  ``ids_crc32`` covers the ids as little-endian unsigned 32-bit integers.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    shards = placed.repartition(min(max(manifest.count(), 1), 10_000), "file")

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name, base in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                shard = WaveletShard(folder, name)
                ids, (docs, lengths, nulls) = shard.tokens().astype("<u4"), shard.documents()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crc = np.fromiter((zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.int64, len(docs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, mask=nulls), pa.array(starts + base), pa.array(lengths), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )
                shard.close()

    return shards.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def count_token(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """(file, n): how often a token occurs in each shard, from a few blocks of it."""
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("file")

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            names = part.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({"file": names, "n": [WaveletShard(folder, x).count(token) for x in names]})

    return files.mapInArrow(read, "file string, n long")
