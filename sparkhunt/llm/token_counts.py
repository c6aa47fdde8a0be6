"""Token counts of the sections of a document, from one encoding of the whole document."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkhunt.llm.bpe import PieceEncoder
from sparkhunt.names import c

#: Who gets a token that lies across section borders.
RULES = ("most", "first", "last")


def line_sizes(text: Column) -> Column:
    """Characters of a text's lines; a line break belongs to the line it ends."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.transform(lines, lambda x: F.char_length(x) + 1)


def field_sizes(*fields: Column) -> Column:
    """Sizes of the parts of ``concat(*fields)``."""
    return F.array(*[F.char_length(F.coalesce(f, F.lit(""))) for f in fields])


def allocate(spans: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it crosses a border) for sorted section ends.

    ``most``: the section with most of the token's characters, the earlier one of equals;
    ``first`` and ``last``: that of its first or last character.  Sections without
    characters get no token; a token without characters goes where it begins.
    """
    first = np.searchsorted(ends, spans[:, 0], side="right")
    last = np.maximum(np.searchsorted(ends, np.maximum(spans[:, 1] - 1, spans[:, 0]), side="right"), first)
    first, last = (np.minimum(x, len(ends) - 1) for x in (first, last))
    crosses = first != last
    if rule == "first":
        return first, crosses
    if rule == "last":
        return last, crosses
    owner = first.copy()
    for i in np.flatnonzero(crosses):
        edges = np.clip(np.concatenate([[spans[i, 0]], ends[first[i] : last[i]], [spans[i, 1]]]), spans[i, 0], spans[i, 1])
        owner[i] = first[i] + int(np.argmax(np.diff(edges)))
    return owner, crosses


@functools.lru_cache(1)
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path, offsets=True, most=300_000)


def attribute_tokens(docs: DataFrame, sizes: Column, tokenizer: str, key: str = "doc_id", text: str = "text", rule: str = "most") -> DataFrame:
    """Tokens of every section of every document.

    ``sizes`` lists the characters of the text's sections in order (see
    :func:`line_sizes`, :func:`field_sizes`); they are cut off at, and the last one
    stretched to, the end of the text.  Returns one row per section: the key, ``section``
    (from 0), ``n_chars``, ``n_tokens`` and ``n_crossing`` (tokens given to it that reach
    into other sections).  The ``n_tokens`` of a document add up to the tokens of its
    whole text.  A null text counts as empty; an empty text has its sections with 0
    tokens, a document without sections one section; repeated rows are repeated in the
    result; an empty table gives no row; other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind = docs.schema[key].dataType
    rows = docs.select(c(key).alias("key"), F.coalesce(c(text), F.lit("")).alias("text"), sizes.cast("array<int>").alias("sizes"))
    schema = T.StructType([T.StructField(key, kind)] + [T.StructField(x, T.LongType()) for x in ("section", "n_chars", "n_tokens", "n_crossing")])
    names = schema.names

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for part in parts:
            for at in range(0, part.num_rows, 256):
                some = part.slice(at, 256)
                texts = some.column(1).to_pylist()
                _, lengths, spans = encoder.encode(some.column(1))
                size_list = some.column(2)
                counted, low = [], 0
                for i, (whole, n) in enumerate(zip(texts, lengths.tolist(), strict=True)):
                    given = size_list[i].values
                    given = np.zeros(1, np.int64) if given is None or not len(given) else given.fill_null(0).to_numpy().astype(np.int64)
                    ends = np.minimum(np.cumsum(given), len(whole))
                    ends[-1] = len(whole)
                    owner, crosses = allocate(spans[low : low + n], ends, rule)
                    counted.append((np.diff(ends, prepend=0), np.bincount(owner, minlength=len(ends)), np.bincount(owner[crosses], minlength=len(ends))))
                    low += n
                sections = np.array([len(x[0]) for x in counted])
                number = np.arange(sections.sum()) - np.repeat(np.cumsum(sections) - sections, sections)
                keys = some.column(0).take(pa.array(np.repeat(np.arange(some.num_rows), sections)))
                yield pa.RecordBatch.from_arrays([keys, pa.array(number), *(pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*counted, strict=True))], names)

    return rows.mapInArrow(count, schema)
