"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words where near-duplicates and passages are compared.
NOT_WORD = r"[^\p{L}\p{N}]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """Lower-case words of a text; null and empty texts have none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for what is run inside; they are set back afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def own_name(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores in front until no column of ``taken`` is called so."""
    taken = {x.lower() for x in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a shared folder, for use inside tasks."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri if "://" in uri or uri.startswith("file:") else f"file://{uri}"))


class SharedFile:
    """A file that appears in a shared folder under a name of its own when it is whole.

    Each task attempt writes another name, so a lost or repeated attempt never changes a
    file that a manifest already names.
    """

    def __init__(self, folder: str, stem: str, suffix: str):
        self.name = f"{stem}-{uuid.uuid4().hex}{suffix}"
        self._fs, root = filesystem(folder)
        self._fs.create_dir(root, recursive=True)
        self._whole, self._part = f"{root}/{self.name}", f"{root}/.{self.name}.part"
        self._out = self._fs.open_output_stream(self._part)
        self.size = 0

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._out.close()
        self._fs.move(self._part, self._whole)


def open_shared(folder: str, name: str) -> pa.NativeFile:
    file_system, root = filesystem(folder)
    return file_system.open_input_file(f"{root}/{name}")


def batches(rows: Iterable[dict], schema: pa.Schema, most_rows: int = 2048, most_bytes: int = 8 << 20, weigh=None) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded size from single rows."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += weigh(row) if weigh else 0
        if len(held) >= most_rows or weight >= most_bytes:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)
