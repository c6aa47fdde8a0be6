"""N-gram Jaccard join with a MinHash LSH forest and exact verification.

Each text has one path of small minimum hashes per tree.  Sorted paths are the tries of
the forest: rows with a common prefix stand next to each other.  Prefixes are shortened
from the full depth until pairs at the threshold share one with the wanted recall.  What
shares a prefix is verified exactly, in units of bounded size: texts are put into chunks,
and two chunks meet once if some trie has a prefix in both.  No pair is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkhunt.llm.common import own_name, words
from sparkhunt.names import c
from sparkhunt.operators.components import connected_components
from sparkhunt.operators.lookup import fits_broadcast, totals_join
from sparkhunt.session import cut_lineage

SHINGLE = 5
_ODD = (np.random.default_rng(17).integers(1, 2**63, SHINGLE + 2, dtype=np.uint64) | np.uint64(1)).astype(np.uint64)


def matching_depth(trees: int, depth: int, threshold: float, recall: float) -> int:
    """The longest prefix with which pairs at the threshold meet in some tree often enough."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_hashes(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word runs of all texts in one array, and how many each text has.

    ``flat`` holds the word hashes of all texts.  A text of one to four words has one
    run, its words; a text without words has none.
    """
    flat = flat.view(np.uint64)
    ends = np.cumsum(sizes)
    held = np.zeros(len(flat), np.uint64)
    left = np.repeat(ends, sizes) - np.arange(len(flat))  # words from here to the text's end
    for i in range(SHINGLE):
        held[: len(flat) - i] += np.where(left[: len(flat) - i] > i, flat[i:] * _ODD[i], 0).astype(np.uint64)
    whole = np.repeat(sizes, sizes)
    held += np.minimum(whole, SHINGLE).astype(np.uint64) * _ODD[SHINGLE]
    held ^= held >> np.uint64(31)
    held *= _ODD[SHINGLE + 1]
    held ^= held >> np.uint64(29)
    first = (left == whole) & (whole < SHINGLE)
    return held[(left >= SHINGLE) | first], np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, (sizes > 0).astype(sizes.dtype))


def paths(shingles: np.ndarray, counts: np.ndarray, trees: int, depth: int, seed: int) -> np.ndarray:
    """(texts, trees * depth) 16-bit minimum hashes; rows of texts without shingles are 0."""
    odd = np.random.default_rng(seed).integers(0, 2**31, trees * depth, dtype=np.uint32) * 2 + 1
    out = np.zeros((len(counts), trees * depth), np.uint16)
    some = np.flatnonzero(counts)
    narrow = (shingles >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum(counts) - counts
    for at in range(0, len(some), 64):  # so few texts that their hashes stay in the cache
        rows = some[at : at + 64]
        low, high = starts[rows[0]], starts[rows[-1]] + counts[rows[-1]]
        part, cuts = narrow[low:high], starts[rows] - low
        for i, k in enumerate(odd):
            least = np.minimum.reduceat(part * k, cuts)
            out[rows, i] = (least ^ (least >> np.uint32(16))).astype(np.uint16)
    return out


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), sizes


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _signed(docs: DataFrame, trees: int, depth: int, seed: int) -> DataFrame:
    """Adds ``paths`` (null without words) to rows with ``row``, ``id``, ``digest``, ``w``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            shingles, counts = shingle_hashes(*_lists(part.column("w")))
            found = paths(shingles, counts, trees, depth, seed).astype(">u2")
            made = pa.array([x.tobytes() if n else None for x, n in zip(found, counts, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("id"), part.column("digest"), made], ["row", "id", "digest", "paths"])

    schema = T.StructType([x for x in docs.schema.fields if x.name != "w"] + [T.StructField("paths", T.BinaryType())])
    return docs.mapInArrow(run, schema)


class _Unit:
    """The texts of one pair of chunks and their verified links."""

    def __init__(self, rows: list[tuple], threshold: float, tree_bytes: int, prefix_bytes: int, cross: bool):
        self.node = np.array([r[0] for r in rows], np.int64)
        self.copies = np.array([r[1] for r in rows], np.int64)
        self.side = np.array([r[2] for r in rows])
        self.sets = [r[4] for r in rows]
        raw = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), -1, tree_bytes)[:, :, :prefix_bytes]
        self.prefixes = np.ascontiguousarray(raw).view(f"V{prefix_bytes}")[:, :, 0]
        self.threshold, self.cross = threshold, cross

    def links(self) -> Iterator[tuple[int, np.ndarray]]:
        """(text, later texts that it is linked to), by place in the unit."""
        sizes = np.array([len(s) for s in self.sets])
        flat = np.concatenate(self.sets)
        values, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
        number = np.cumsum(counts > 1) - 1
        shared = counts[inverse] > 1
        owner, column = np.repeat(np.arange(len(sizes)), sizes)[shared], number[inverse[shared]]
        width = int(number[-1]) + 1 if len(number) else 0
        bits = np.zeros((len(sizes), width // 8 + 1), np.uint8)
        np.bitwise_or.at(bits, (owner, column // 8), (1 << (column % 8)).astype(np.uint8))
        keys = np.unique(self.prefixes.reshape(-1), return_inverse=True)[1].reshape(self.prefixes.shape)
        for i in range(len(sizes) - 1):
            later = np.arange(i + 1, len(sizes))
            if self.cross:
                later = later[self.side[later] != self.side[i]]
            low, high = np.minimum(sizes[i], sizes[later]), np.maximum(sizes[i], sizes[later])
            later = later[low >= self.threshold * high]
            later = later[(keys[later] == keys[i]).any(axis=1)]
            if len(later):
                both = np.bitwise_count(bits[later] & bits[i]).sum(axis=1, dtype=np.int64)
                yield i, later[both >= self.threshold * (sizes[i] + sizes[later] - both) - 1e-9]

    def result(self) -> Iterator[dict]:
        root = np.arange(len(self.node))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        linked = np.zeros(len(self.node), np.int64)
        for i, later in self.links():
            linked[i] += self.copies[later].sum()
            linked[later] += self.copies[i]
            for j in later.tolist():
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for i in np.flatnonzero(linked):
            yield {"node": int(self.node[i]), "links": int(linked[i]), "root": int(self.node[find(i)])}


def _verified(members: DataFrame, threshold: float, tree_bytes: int, prefix_bytes: int) -> DataFrame:
    """(node, links, root) per unit from rows sorted by unit; holds one unit at a time."""
    schema = "node long, links long, root long"
    arrow = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    ordered = members.select("a", "b", "node", "copies", "chunk", "paths", "shingles").repartition("a", "b").sortWithinPartitions("a", "b", "node")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []

        def done():
            if len(rows) < 2:
                return
            found = list(_Unit(rows, threshold, tree_bytes, prefix_bytes, at[0] != at[1]).result())
            if found:
                yield pa.RecordBatch.from_pylist(found, arrow)

        for part in parts:
            sets, sizes = _lists(part.column(6))
            cuts = np.cumsum(sizes)[:-1]
            for a, b, node, copies, chunk, path, own in zip(*(part.column(j).to_pylist() for j in range(6)), np.split(sets, cuts), strict=True):
                if (a, b) != at:
                    yield from done()
                    at, rows = (a, b), []
                rows.append((node, copies, chunk, path, own.copy()))
        yield from done()

    return ordered.mapInArrow(run, schema)


def _linked_texts(docs: DataFrame, key: str, text: str, threshold: float, trees: int, depth: int, recall: float, chunk: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(rows with their digest; texts with copies, component and links), both written."""
    prefix = matching_depth(trees, depth, threshold, recall)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), c(key).alias("id"), F.unhex(F.sha2(F.coalesce(c(text), F.lit("")), 256)).alias("digest"), word_hashes(c(text)).alias("w")
    )
    signed = cut_lineage(_signed(rows, trees, depth, seed))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("row").alias("row")))
    texts = cut_lineage(
        signed.groupBy("digest").agg(first.alias("f"), F.count(F.lit(1)).alias("copies"), F.first("paths").alias("paths"))
        .select(F.col("f.row").alias("node"), F.col("f.id").alias("id"), "digest", "copies", "paths")
    )
    # the tries: sorted paths, whose runs have a common prefix
    tree_bytes, prefix_bytes = 2 * depth, 2 * prefix
    branch = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    leaves = texts.where(F.col("paths").isNotNull()).select("node", branch, "paths").select(
        "node", "tree", F.expr(f"substring(paths, tree * {tree_bytes} + 1, {prefix_bytes})").alias("prefix")
    )
    runs = leaves.groupBy("tree", "prefix").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    in_runs = cut_lineage(totals_join(leaves, cut_lineage(runs), ["tree", "prefix"], "n", how="inner"))
    # texts near each other get one label in most cases: the smallest text within a few runs
    groups = cut_lineage(in_runs.groupBy("node").agg(F.min("head").alias("group")))
    members = in_runs.select("node", "tree", "prefix")
    for _ in range(2):
        met = members.join(groups, "node").groupBy("tree", "prefix").agg(F.min("group").alias("group"), F.count(F.lit(1)).alias("n"))
        groups = cut_lineage(totals_join(members, cut_lineage(met), ["tree", "prefix"], "n", how="inner").groupBy("node").agg(F.min("group").alias("group")))
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("members"), F.count(F.lit(1)).alias("n"))
    place = F.struct("group", F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / chunk)).alias("part"))
    chunks = cut_lineage(totals_join(groups, cut_lineage(sizes), ["group"], "n", how="inner").select("node", F.xxhash64(place).alias("chunk")))
    # chunks that have a run in common; a chunk always meets itself
    places = in_runs.join(chunks, "node").groupBy("tree", "prefix").agg(F.collect_set("chunk").alias("chunks")).where(F.size("chunks") > 1)
    pair = F.explode(F.flatten(F.transform("chunks", lambda x: F.transform(F.filter("chunks", lambda y: y > x), lambda y: F.struct(x.alias("a"), y.alias("b"))))))
    across = places.select(F.sort_array("chunks").alias("chunks")).distinct().select(pair.alias("u")).select("u.a", "u.b").distinct()
    units = cut_lineage(across.unionByName(chunks.select(F.col("chunk").alias("a"), F.col("chunk").alias("b")).distinct()))
    wanted = cut_lineage(texts.join(chunks, "node").select("node", "id", "digest", "copies", "paths", "chunk"))
    small = wanted.select("node", F.col("id").alias("text_id"), F.col("digest").alias("text_digest"))
    again = docs.select(c(key).alias("id"), F.coalesce(c(text), F.lit("")).alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    found = again.join(F.broadcast(small) if fits_broadcast(small) else small, (F.col("digest") == F.col("text_digest")) & F.col("id").eqNullSafe(F.col("text_id"))).select(
        "node", word_hashes(F.col("text")).alias("w")
    )

    def shingled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            flat, counts = shingle_hashes(*_lists(part.column(1)))
            own = [np.unique(x) for x in np.split(flat.view(np.int64), np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.list_(pa.int64()))], ["node", "shingles"])

    sets = found.mapInArrow(shingled, "node long, shingles array<long>").dropDuplicates(["node"])
    meets = units.select(F.col("a").alias("chunk"), "a", "b").unionByName(units.where("a <> b").select(F.col("b").alias("chunk"), "a", "b"))
    members = wanted.join(sets, "node").join(meets, "chunk")
    verified = cut_lineage(_verified(members, threshold, tree_bytes, prefix_bytes))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(verified.select(F.col("node").alias("src"), F.col("root").alias("dst")), verified.select("node"))
    known = texts.select("node", "id", "digest", "copies").join(parts, "node", "left").join(links, "node", "left").select(
        "node", "digest", "copies", F.coalesce("component", "node").alias("component"), "id", F.coalesce("links", F.lit(0)).alias("links")
    )
    return signed, cut_lineage(known)


def jaccard_join(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    trees: int = 32,
    depth: int = 8,
    recall: float = 0.999,
    chunk: int = 512,
    seed: int = 23,
) -> DataFrame:
    """(doc_id, class_id, n_links) for every row of ``docs``.

    Texts are linked when the Jaccard similarity of their sets of five-word shingles is
    ``threshold`` or more (words: runs of letters and digits in lower case; a text of one
    to four words is one shingle).  ``n_links`` counts the other rows linked to a row,
    copies included; ``class_id`` is the smallest key of all rows reached through links.
    Equal texts, also empty ones, are one class; a text without words is linked to its
    copies only; null counts as empty; rows repeated with the same key are copies; null
    keys rank behind all others; an empty table gives no row; other columns are not read.

    A pair at the threshold is found with a probability of ``recall`` at least, closer
    pairs with a higher one; what is found is verified on whole texts.

    Copies are reduced to one row before anything is joined.  Paths and sets of runs are
    light; only texts that share a prefix with another text are read again.
    """
    signed, known = _linked_texts(docs, key, text, threshold, trees, depth, recall, chunk, seed)
    classes = known.groupBy("component").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n"))
    named = totals_join(known, cut_lineage(classes), ["component"], "n", how="inner").select(
        "digest", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("n")
    )
    return totals_join(signed.select("id", "digest"), cut_lineage(named), ["digest"], "n", how="inner").select(
        F.col("id").alias(key), "class_id", "n_links"
    )


def one_of_each(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    trees: int = 32,
    depth: int = 8,
    recall: float = 0.999,
    chunk: int = 512,
    seed: int = 23,
) -> DataFrame:
    """The rows of ``docs`` that stay when of each class of :func:`jaccard_join` one is kept.

    That is the row with the smallest key; null keys rank behind all others, and of rows
    that repeat the key with the same text one stays.
    """
    _, known = _linked_texts(docs, key, text, threshold, trees, depth, recall, chunk, seed)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("node").alias("node"), F.col("digest").alias("digest")))
    kept = cut_lineage(known.groupBy("component").agg(first.alias("f")).select("f.id", "f.digest"))
    own, its_id, its_digest = (own_name(x, docs.columns) for x in ("own_digest", "kept_id", "kept_digest"))
    kept = kept.withColumnsRenamed({"id": its_id, "digest": its_digest})
    digest = F.unhex(F.sha2(F.coalesce(c(text), F.lit("")), 256))
    marked = docs.select(*[c(x) for x in docs.columns], digest.alias(own))
    few = F.broadcast(kept) if fits_broadcast(kept) else kept
    return marked.join(few, (c(own) == c(its_digest)) & c(key).eqNullSafe(c(its_id))).dropDuplicates([own]).select(*[c(x) for x in docs.columns])
