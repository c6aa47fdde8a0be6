"""Removal of repeated byte strings by bucket-pointer refinement of suffix buckets.

A window is a string of ``WINDOW`` bytes.  The q-gram with the smallest hash in it is its
anchor, so equal windows have equal anchors at equal places, and the windows of one anchor
stand next to each other: one row per anchor stands for all of them.  Spark deals rows
into q-gram buckets.  Anchors with equal surroundings are settled by their order alone;
what differs near the anchor is refined: suffixes in buckets of eight bytes are sorted by
the bucket number of the suffix eight bytes on, the new numbers serve for 16 bytes on, and
so forth up to the window's length.  Suffixes alone in a bucket are refined no further.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkhunt.llm.common import own_name, with_settings
from sparkhunt.names import c
from sparkhunt.operators.lookup import fits_broadcast
from sparkhunt.session import cut_lineage

WINDOW, GRAM = 100, 24
#: Window starts that are worked on at once, so that memory does not follow a text's length.
_SLICE = 1 << 19
_ODD = np.random.default_rng(41).integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)
_BYTE = np.random.default_rng(43).integers(0, 2**63, 256, dtype=np.uint64)
_ANCHORS = "h long, c long, id long, tie long, span long"
_SETTLED = "h long, id long, tie long, span long, stop long"
_RUNS = "id long, tie long, start long, stop long"
_TEXT_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}


def _pack(low, before, n):
    """First window, bytes from it to the anchor, and number of windows, as one number."""
    return low << 16 | before << 8 | n


def _unpack(span: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return span >> 16, span >> 8 & 255, span & 255


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each value begins (and the last ends)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = column.cast(pa.large_binary())
    buffers = wide.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(wide) + 1, 8 * wide.offset)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data, offsets


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM bytes from each place on."""
    h = _BYTE[data]
    for k, width in enumerate((1, 2, 4)):
        h = h[:-width] * _ODD[k] + (h[width:] ^ (h[width:] >> np.uint64(29)))
    eight = h
    h = eight[:-8] * _ODD[3] + (eight[8:] ^ (eight[8:] >> np.uint64(29)))
    h = h[:-8] * _ODD[4] + (eight[16:] ^ (eight[16:] >> np.uint64(31)))
    h ^= h >> np.uint64(32)
    return h * _ODD[5]


def anchors(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor's hash, first window, number of windows, bytes from there to the anchor).

    Windows lie inside one text; places count in ``data``.
    """
    first, last = int(offsets[0]), int(offsets[-1])
    ends = np.repeat(offsets[1:], np.diff(offsets))  # the end of the text of each byte
    for low in range(first, last, _SLICE):
        part = data[low : min(low + _SLICE + WINDOW - 1, last)]
        if len(part) < WINDOW:
            return
        hashes = _gram_hashes(part)
        # the hash decides, of equal ones the first place
        least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        width, whole = 1, WINDOW - GRAM + 1
        while 2 * width <= whole:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        least = np.minimum(least[: len(least) - (whole - width)], least[whole - width :])
        starts = np.arange(low, low + len(least))
        starts = starts[starts + WINDOW <= ends[starts - first]]
        if not len(starts):
            continue
        anchor = (least[starts - low] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(starts) > 1)]))
        n = np.diff(np.append(new, len(starts)))
        yield hashes[anchor[new]].view(np.int64), starts[new], n, anchor[new] + low - starts[new]


def _digests(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    view = memoryview(data)
    return np.frombuffer(b"".join(blake2b(view[a:b], digest_size=8).digest() for a, b in zip(low.tolist(), high.tolist(), strict=True)), np.int64)


def _ranks(ids: pa.Array, ties: np.ndarray) -> np.ndarray:
    """Equal numbers for equal (id, tie), rising in their order, null ids first."""
    some, value = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
    order = np.lexsort((ties, value, some))
    a, b, d = some[order], value[order], ties[order]
    new = np.concatenate([[0], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (d[1:] != d[:-1])]) if len(order) else np.zeros(0)
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _first_of_equals(h: np.ndarray, digest: np.ndarray, rank: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that come first among those with equal surroundings, and those that come later.

    Rows that repeat a place of a text with the same key are in neither.
    """
    order = np.lexsort((low, rank, h, digest))
    same = (h[order][1:] == h[order][:-1]) & (digest[order][1:] == digest[order][:-1])
    again = same & (rank[order][1:] == rank[order][:-1]) & (low[order][1:] == low[order][:-1])
    first = order[np.concatenate([[True], ~same])] if len(order) else order
    return first, order[1:][same & ~again]


def _joined(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching runs of one owner as one; sorted by owner and start."""
    if not len(owner):
        return owner, start, stop
    order = np.lexsort((start, owner))
    owner, start, stop = owner[order], start[order], stop[order]
    number = np.cumsum(np.concatenate([[0], owner[1:] != owner[:-1]]))
    base = number * (int(stop.max()) + 2)
    reach = np.maximum.accumulate(stop + base)
    new = np.flatnonzero(np.concatenate([[True], start[1:] + base[1:] > reach[:-1]]))
    return owner[new], start[new], (reach - base)[np.append(new[1:], len(owner)) - 1]


def _anchor_rows(ids: pa.Array, ties: np.ndarray, owner: np.ndarray, h: np.ndarray, digest: np.ndarray, low: np.ndarray, before: np.ndarray, n: np.ndarray, context: list[bytes] | None) -> pa.RecordBatch:
    """What has to be dealt out: the first rows among equals, and runs settled already (h null)."""
    first, later = _first_of_equals(h, digest, _ranks(ids, ties)[owner], low)
    whose, start, stop = _joined(owner[later], low[later], low[later] + n[later] + WINDOW - 1)
    rows, done = np.concatenate([owner[first], whose]), len(whose)
    columns = [
        pa.array(np.concatenate([h[first], np.zeros(done, np.int64)]), mask=np.arange(len(rows)) >= len(first)),
        pa.array(np.concatenate([digest[first], stop])),
        ids.take(pa.array(rows)).cast(pa.int64()),
        pa.array(ties[rows]),
        pa.array(np.concatenate([_pack(low[first], before[first], n[first]), _pack(start, 0, 0)])),
    ]
    names = ["h", "c", "id", "tie", "span"]
    if context is not None:
        columns.append(pa.array([context[i] for i in first.tolist()] + [None] * done, pa.binary()))
        names.append("context")
    return pa.RecordBatch.from_arrays(columns, names)


def _dealt(texts: DataFrame) -> DataFrame:
    """Anchors of all texts (id, tie, text); copies inside one batch are settled at once."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            data, offsets = _bytes_of(part.column(2))
            found = list(anchors(data, offsets))
            if not found:
                continue
            h, low, n, before = (np.concatenate(x) for x in zip(*found))
            owner = np.searchsorted(offsets, low, side="right") - 1
            digest = _digests(data, low, low + n + WINDOW - 1)
            yield _anchor_rows(part.column(0), part.column(1).to_numpy(), owner, h, digest, low - offsets[owner], before, n, None)

    return texts.mapInArrow(run, _ANCHORS)


def _settled(rows: DataFrame, context: bool) -> DataFrame:
    """Runs that occur earlier (h null), and the first of each of several surroundings of a q-gram.

    Sorted rows stream by: of a bucket one waiting row is held, whatever its size.
    """
    names = ["h", "c", "id", "tie", "span", *(["context"] if context else [])]
    place = F.coalesce("h", F.xxhash64("tie", "span"))
    ordered = rows.select(*names).repartition(place).sortWithinPartitions("h", "c", "id", "tie", "span")
    schema = pa.schema([("h", pa.int64()), ("id", pa.int64()), ("tie", pa.int64()), ("span", pa.int64()), ("stop", pa.int64()), *([("context", pa.binary())] if context else [])])

    def made(part: pa.RecordBatch, rows: np.ndarray, done: bool) -> pa.RecordBatch:
        some = part.take(pa.array(rows))
        span, none = some.column(4), pa.nulls(len(rows), pa.int64())
        if done:
            low, _, n = _unpack(span.to_numpy())
            columns = [none, some.column(2), some.column(3), pa.array(low << 16), pa.array(low + n + WINDOW - 1)]
        else:
            columns = [some.column(0), some.column(2), some.column(3), span, none]
        if context:
            columns.append(pa.nulls(len(rows), pa.binary()) if done else some.column(5))
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, groups, waiting = None, 0, None  # the last row; its bucket's groups; the first one's row
        for part in parts:
            known = part.filter(part.column(0).is_null())
            if known.num_rows:
                columns = [known.column(0), known.column(2), known.column(3), known.column(4), known.column(1)]
                yield pa.RecordBatch.from_arrays([*columns, *([known.column(5)] if context else [])], schema=schema)
            part = part.filter(part.column(0).is_valid())
            if not part.num_rows:
                continue
            whole = part if last is None else pa.concat_batches([last, part])
            skip = whole.num_rows - part.num_rows
            h, digest, tie, span = (whole.column(k).to_numpy() for k in (0, 1, 3, 4))
            key, null = whole.column(2).fill_null(0).to_numpy(), whole.column(2).is_null().to_numpy(zero_copy_only=False)
            bucket = np.concatenate([[last is None], h[1:] != h[:-1]])
            group = bucket | np.concatenate([[False], digest[1:] != digest[:-1]])
            again = np.concatenate([[False], (key[1:] == key[:-1]) & (null[1:] == null[:-1]) & (tie[1:] == tie[:-1]) & (span[1:] == span[:-1])]) & ~group
            later = np.flatnonzero(~group & ~again)
            later = later[later >= skip]
            if len(later):
                yield made(whole, later, True)
            number = np.cumsum(bucket)  # 0: the bucket that the rows before have begun
            counts = np.bincount(number, group, int(number[-1]) + 1).astype(np.int64)
            if last is not None:
                counts[0] += groups
                if groups == 1 and counts[0] > 1:
                    yield made(waiting, np.array([0]), False)
            firsts = np.flatnonzero(group)
            several = firsts[counts[number[firsts]] > 1]
            if len(several):
                yield made(whole, several, False)
            groups = int(counts[-1])
            if groups == 1 and bucket[number == number[-1]].any():
                waiting = whole.slice(int(np.flatnonzero(bucket)[-1]), 1)
            last = whole.slice(whole.num_rows - 1, 1)

    return ordered.mapInArrow(run, _SETTLED + (", context binary" if context else ""))


def refine(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number for the window at each of ``starts``: equal for equal windows, -1 if alone.

    Buckets of eight bytes are refined by the numbers of later suffixes: 8, 16 and 32 bytes
    on, then 36 on for the whole window.
    """
    grams = np.zeros(max(len(data) - 7, 0), np.uint64)
    for k in range(8):
        grams |= data[k : k + len(grams)].astype(np.uint64) << np.uint64(8 * k)
    number = np.full(len(data) + WINDOW, -1, np.int64)

    def renumber(at: np.ndarray, keys: np.ndarray) -> None:
        number[:] = -1
        if len(at):
            _, own, counts = np.unique(keys, return_inverse=True, return_counts=True)
            shared = counts[own] > 1
            number[at[shared]] = own[shared]

    renumber(np.arange(len(grams)), grams)
    for step in (8, 16, 32, WINDOW - 64):
        at = np.flatnonzero(number[: len(data)] >= 0)
        at = at[number[at + step] >= 0]
        if step == WINDOW - 64:
            at = at[np.isin(at, starts, assume_unique=True)]
        renumber(at, number[at] << 32 | number[at + step])
    return number[starts]


def _repeated_runs(rows: pa.Table) -> pa.RecordBatch:
    """Runs of bytes in windows that occur earlier in these buckets."""
    data, offsets = _bytes_of(rows.column("context"))
    ids, ties = rows.column("id").combine_chunks(), rows.column("tie").to_numpy()
    low, _, n = _unpack(rows.column("span").to_numpy())
    owner = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    number = refine(data[offsets[0] : offsets[-1]], offsets[owner] - offsets[0] + inside)
    some = np.flatnonzero(number >= 0)
    owner, place, number = owner[some], low[owner[some]] + inside[some], number[some]
    _, later = _first_of_equals(number, number, _ranks(ids, ties)[owner], place)
    whose, start, stop = _joined(owner[later], place[later], place[later] + WINDOW)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(whose)), pa.array(ties[whose]), pa.array(start), pa.array(stop)], ["id", "tie", "start", "stop"])


def _refined(contexts: DataFrame, rows: int, most: int) -> DataFrame:
    """Refine whole buckets, up to ``most`` rows at a time besides the last bucket."""
    ordered = contexts.select("h", "id", "tie", "span", "context").repartition(1 + rows // 50_000, "h").sortWithinPartitions("h")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for part in parts:
            h = part.column(0).to_numpy()
            if sum(x.num_rows for x in held) >= most:  # hand on the buckets that are whole
                new = np.flatnonzero(np.concatenate([[h[0] != held[-1].column(0)[-1].as_py()], h[1:] != h[:-1]]))
                if len(new):
                    yield _repeated_runs(pa.Table.from_batches([*held, part.slice(0, int(new[0]))]))
                    held, part = [], part.slice(int(new[0]))
            held.append(part)
        if held:
            yield _repeated_runs(pa.Table.from_batches(held))

    return ordered.mapInArrow(run, _RUNS)


def _split(contexts: DataFrame, level: int) -> DataFrame:
    """Part each row by its windows' place before the anchor, into ranges halved ``level``
    times; a bucket is then what all windows of a range have in common."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            made: list[tuple] = []
            low, before, n = (x.tolist() for x in _unpack(part.column(3).to_numpy()))
            for i, context in enumerate(part.column(4).to_pylist()):
                o = before[i]
                while o > before[i] - n[i]:
                    number = o >> (7 - level)
                    least, most = number << (7 - level), min(((number + 1) << (7 - level)) - 1, WINDOW - GRAM)
                    end = max(least, before[i] - n[i] + 1)
                    first, count = before[i] - o, o - end + 1
                    own = context[first : first + count - 1 + WINDOW]
                    key = context[before[i] - least : before[i] + WINDOW - most]
                    mark = blake2b(key, digest_size=8, person=bytes([level, number])).digest()
                    made.append((i, mark, blake2b(own, digest_size=8).digest(), low[i] + first, o, count, own))
                    o = end - 1
            owner, h, digest, start, o, count, own = zip(*made)
            to_long = lambda x: np.frombuffer(b"".join(x), np.int64)
            whole = [np.array(x, np.int64) for x in (owner, start, o, count)]
            yield _anchor_rows(part.column(1), part.column(2).to_numpy(), whole[0], to_long(h), to_long(digest), whole[1], whole[2], whole[3], list(own))

    return contexts.select("h", "id", "tie", "span", "context").mapInArrow(run, _ANCHORS + ", context binary")


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows as (id, tie, text); the tie orders different texts with one key."""
    whole = F.coalesce(c(text), F.lit(""))
    tie = F.conv(F.substring(F.sha2(whole, 256), 1, 15), 16, 10).cast("long")
    return docs.select(c(key).cast("long").alias("id"), tie.alias("tie"), whole.alias("text"))


def _next_to(texts: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Texts with the rows of ``found`` (id, tie, ..) that belong to them; both grow with the
    input, so they are sorted and merged at every size."""
    found = found.withColumnsRenamed({"id": "of_id", "tie": "of_tie"}).hint("merge")
    return texts.join(found, F.col("of_id").eqNullSafe(F.col("id")) & (F.col("of_tie") == F.col("tie")), how)


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_rows: int = 5_000) -> DataFrame:
    """(id, tie, spans) of the texts with bytes in a window that occurs earlier.

    ``spans`` is a sorted list of (start, stop) in bytes, maximal and apart from each
    other.  A window is earlier with a smaller key, or in the same text with a smaller
    start; null keys come first, and different texts with one key by ``tie``.

    A bucket with more than ``bucket_rows`` different surroundings is parted by the
    windows' place before the anchor, each part with a longer common string, seven times
    at most: then a part is a single window.  Nothing is left out on the way.
    """
    spark = docs.sparkSession
    texts = _keyed(docs, key, text)
    with with_settings(spark, _TEXT_ROWS):
        settled = cut_lineage(_settled(_dealt(texts), context=False))
    runs = [settled.where("h is null").select("id", "tie", F.expr("shiftright(span, 16)").alias("start"), "stop")]
    open_rows = settled.where("h is not null").select("h", "id", "tie", "span")
    part = F.col("text").cast("binary").substr(F.expr("cast(shiftright(span, 16) + 1 as int)"), F.expr(f"cast((span & 255) + {WINDOW - 1} as int)"))
    contexts = cut_lineage(_next_to(texts, open_rows, "inner").select("h", "id", "tie", "span", part.alias("context")))
    for level in range(1, 9):
        rows = contexts.count()
        if not rows:
            break
        large = cut_lineage(contexts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows).select("h"))
        hot = bool(large.take(1)) and level < 8
        side = F.broadcast(large) if not hot or fits_broadcast(large) else large
        with with_settings(spark, _TEXT_ROWS):
            runs.append(cut_lineage(_refined(contexts.join(side, "h", "left_anti") if hot else contexts, rows, bucket_rows)))
            if not hot:
                break
            settled = cut_lineage(_settled(_split(contexts.join(side, "h", "left_semi"), level), context=True))
        runs.append(settled.where("h is null").select("id", "tie", F.expr("shiftright(span, 16)").alias("start"), "stop"))
        contexts = settled.where("h is not null").select("h", "id", "tie", "span", "context")
    found = runs[0]
    for more in runs[1:]:
        found = found.unionByName(more)
    return cut_lineage(_spans(found))


def _spans(runs: DataFrame) -> DataFrame:
    """One row per text with its runs joined; holds the runs of one batch and one text."""
    ordered = runs.repartition("id", "tie").sortWithinPartitions("id", "tie", "start")

    def joined(rows: pa.Table) -> pa.RecordBatch:
        ids, ties = rows.column(0).combine_chunks(), rows.column(1).to_numpy()
        owner, start, stop = _joined(_ranks(ids, ties), rows.column(2).to_numpy(), rows.column(3).to_numpy())
        ranks = _ranks(ids, ties)
        firsts = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]]))
        cuts = np.searchsorted(owner, np.arange(len(firsts) + 1)).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(start), pa.array(stop)], ["start", "stop"])
        return pa.RecordBatch.from_arrays([ids.take(pa.array(firsts)), pa.array(ties[firsts]), pa.ListArray.from_arrays(pa.array(cuts), pairs)], ["id", "tie", "spans"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for part in parts:
            whole = pa.Table.from_batches([*held, part]).combine_chunks()
            ranks = _ranks(whole.column(0).combine_chunks(), whole.column(1).to_numpy())
            new = int(np.searchsorted(ranks, ranks[-1]))  # the last text may go on
            if new:
                yield joined(whole.slice(0, new))
            held = whole.slice(new).to_batches()
        if held:
            yield joined(pa.Table.from_batches(held))

    return ordered.mapInArrow(run, "id long, tie long, spans array<struct<start: long, stop: long>>")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_rows: int = 5_000) -> DataFrame:
    """Every row of ``docs`` without the bytes of 100-byte strings that occur earlier.

    Returns the key, ``n_bytes``, ``spans`` (start and stop of the removed runs, none if
    null or empty) and ``kept``, the bytes left (binary, as a cut may part a character).
    Strings are judged on the input.  A null text counts as empty; a text under 100 bytes
    stays; equal rows are one text and lose the same; see :func:`repeated_spans` for the
    order.  An empty table gives no row; other columns are not read.
    """
    texts = _keyed(docs, key, text)
    spans = repeated_spans(docs, key, text, bucket_rows)
    joined = _next_to(texts, spans, "left").select("id", "text", "spans")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            kept, sizes = [], []
            for data, runs in zip(part.column(1).cast(pa.binary()).to_pylist(), part.column(2).to_pylist(), strict=True):
                sizes.append(len(data))
                if runs:
                    cuts = [0, *(x for r in runs for x in (r["start"], r["stop"])), len(data)]
                    data = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
                kept.append(data)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), part.column(2), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    name = key if key.lower() not in ("n_bytes", "spans", "kept") else own_name(key, ["n_bytes", "spans", "kept"])
    out = joined.mapInArrow(run, "id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
    return out.withColumnRenamed("id", name)
