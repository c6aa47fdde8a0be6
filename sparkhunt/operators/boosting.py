"""Boosted trees for two classes with second-order gains on binned features.

Bin edges come once from exact ranks.  Each level of a tree is one job: every partition
sums the gradients and hessians of its rows per node, feature and bin; the sums are shuffled
by (node, block of features), where a scan over the bins gives the block's best split.  The
driver holds the trees and the edges.  Gradients are whole numbers of 2**-30, so sums and
with them the trees do not depend on the order of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkhunt.names import c
from sparkhunt.operators.ordering import row_positions, running_sum
from sparkhunt.session import cut_lineage, discard

_UNIT = float(1 << 30)
#: Features whose sums travel together.
_BLOCK = 16
#: The sums of so many gradients, each at most _UNIT, are exact in a double.
_EXACT_ROWS = 1 << 16
_SPLITS = pa.schema([("slot", pa.int32()), ("gain", pa.float64()), ("feature", pa.int32()), ("bin", pa.int32()), ("gl", pa.int64()), ("hl", pa.int64()), ("g", pa.int64()), ("h", pa.int64())])
_SPLIT_ROW = "slot int, gain double, feature int, bin int, gl long, hl long, g long, h long"


@dataclass
class Tree:
    """A tree as arrays: the children of node n are 2n (bin at most ``bin``) and 2n + 1."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @classmethod
    def of_depth(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1)
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n))

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        node, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(depth):
            f = self.feature[node]
            right = bins[rows, np.maximum(f, 0)] > self.bin[node]
            node = np.where(f >= 0, 2 * node + right, node)
        return node


@dataclass
class BoostedTrees:
    edges: list[np.ndarray]
    depth: int
    trees: list[Tree] = field(default_factory=list)

    @property
    def kind(self) -> type:
        """One byte a bin, if that holds the last one."""
        return np.uint8 if all(len(e) < 256 for e in self.edges) else np.uint16

    def binned(self, matrix: np.ndarray) -> np.ndarray:
        """The number of edges at or below each value; NaN counts as largest."""
        out = np.empty(matrix.shape, self.kind)
        for i, edges in enumerate(self.edges):
            out[:, i] = np.searchsorted(edges, matrix[:, i], side="right")
        return out

    def margins(self, bins: np.ndarray, start: int = 0) -> np.ndarray:
        out = np.zeros(len(bins))
        for tree in self.trees[start:]:
            out += tree.value[tree.nodes(bins, self.depth)]
        return out

    def log_odds(self, vectors: Column) -> Column:
        """The sum of the trees' values for a vector column."""

        @F.pandas_udf("double")
        def run(rows: pd.Series) -> pd.Series:
            matrix = np.stack([np.asarray(v, dtype=float) for v in rows]) if len(rows) else np.zeros((0, len(self.edges)))
            return pd.Series(self.margins(self.binned(matrix)))

        return run(vectors)


def _arrow_matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _stored_bins(column: pa.BinaryArray, model: BoostedTrees) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), model.kind).reshape(len(column), len(model.edges))


def bin_edges(df: DataFrame, vec: str, bins: int) -> list[np.ndarray]:
    """Edges per feature: the smallest value of each of ``bins`` equal shares of the rows.

    Exact, from counts per value and their running sum; at most features times bins edges
    reach the driver.
    """

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            matrix = _arrow_matrix(part.column(0))
            for f in range(matrix.shape[1]):
                values, n = np.unique(matrix[:, f] + 0.0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), f, np.int32)), pa.array(values), pa.array(n)], ["f", "x", "n"])

    counts = cut_lineage(df.select(c(vec)).mapInArrow(count, "f int, x double, n long").groupBy("f", "x").agg(F.sum("n").alias("n")))
    total = counts.where("f = 0").agg(F.sum("n").alias("n")).first().n or 0
    placed = running_sum(row_positions(counts, ["f", "x"]), ["f"], "pos", F.col("n"), "upto")
    share = F.expr(f"((upto - n) * {bins}) div {max(total, 1)}").alias("share")
    firsts = placed.select("f", share, "x").groupBy("f", "share").agg(F.min("x").alias("x")).where("share > 0").orderBy("f", "x").collect()
    width = counts.agg(F.max("f").alias("f")).first().f
    found: list[list[float]] = [[] for _ in range(0 if width is None else width + 1)]
    for r in firsts:
        found[r.f].append(r.x)
    discard(counts)
    return [np.array(x) for x in found]


def _best_split(key: tuple[int, int], sums: np.ndarray, penalty: float, least_weight: float) -> dict | None:
    """Best (feature, bin) of one node in one block; of equal gains the first."""
    slot, block = key
    left = np.cumsum(sums, axis=1)  # (features, bins, 2)
    whole = left[0, -1]
    gl, hl = left[..., 0] / _UNIT, left[..., 1] / _UNIT
    g, h = whole[0] / _UNIT, whole[1] / _UNIT
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (gl * gl / (hl + penalty) + (g - gl) * (g - gl) / (h - hl + penalty) - g * g / (h + penalty))
    gain = np.where((hl >= least_weight) & (h - hl >= least_weight), gain, -np.inf)
    f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return {"slot": slot, "gain": float(gain[f, b]), "feature": int(block * _BLOCK + f), "bin": int(b), "gl": int(left[f, b, 0]), "hl": int(left[f, b, 1]), "g": int(whole[0]), "h": int(whole[1])}


def _splits(table: DataFrame, model: BoostedTrees, done: int, tree: Tree, level: int, slots: dict[int, int], penalty: float, least_weight: float) -> list:
    """The best split per node of a level and block of features."""
    width, sizes = len(model.edges), [len(e) + 1 for e in model.edges]
    bins = max(sizes)
    # a block's sums: those of its features one after the other, each as long as it has bins
    blocks = [range(at, min(at + _BLOCK, width)) for at in range(0, width, _BLOCK)]
    starts = [np.cumsum([0, *(sizes[f] for f in block)]) for block in blocks]

    def sum_up(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros((len(slots), at[-1], 2), np.int64) for at in starts]
        place = np.full(2 ** (level + 1), -1, np.int64)
        for node, slot in slots.items():
            place[node] = slot
        for part in parts:
            own = _stored_bins(part.column(1), model)
            margin = part.column(2).to_numpy() + model.margins(own, done)
            p = 1.0 / (1.0 + np.exp(-margin))
            g = np.rint((p - part.column(0).to_numpy()) * _UNIT)
            h = np.rint(np.maximum(p * (1.0 - p), 1e-16) * _UNIT)
            slot = place[tree.nodes(own, level)]
            own, g, h, slot = own[slot >= 0], g[slot >= 0], h[slot >= 0], slot[slot >= 0]
            for at in range(0, len(slot), _EXACT_ROWS):
                some = slice(at, at + _EXACT_ROWS)
                columns = np.ascontiguousarray(own[some].T)
                for block, start, sums in zip(blocks, starts, held, strict=True):
                    for f, a, b in zip(block, start, start[1:], strict=False):
                        keys = slot[some] * (b - a) + columns[f]
                        for k, weights in enumerate((g[some], h[some])):
                            sums[:, a:b, k] += np.bincount(keys, weights, len(slots) * (b - a)).astype(np.int64).reshape(len(slots), -1)
        for s, b in ((s, b) for s in range(len(slots)) for b in range(len(blocks)) if held[b][s].any()):
            yield pa.RecordBatch.from_pydict({"slot": pa.array([s], pa.int32()), "block": pa.array([b], pa.int32()), "sums": [held[b][s].tobytes()]})

    def choose(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        out = []

        def done_with() -> None:
            if at is not None:
                start = starts[at[1]]
                sums = np.zeros((len(start) - 1, bins, 2), np.int64)
                for f, (a, b) in enumerate(zip(start, start[1:], strict=False)):
                    sums[f, : b - a] = total.reshape(-1, 2)[a:b]
                out.append(_best_split(at, sums, penalty, least_weight))

        for part in parts:
            for s, b, data in zip(*(x.to_pylist() for x in part.columns), strict=True):
                sums = np.frombuffer(data, np.int64)
                if (s, b) != at:
                    done_with()
                    at, total = (s, b), sums.copy()
                else:
                    total += sums
        done_with()
        if out:
            yield pa.RecordBatch.from_pylist(out, _SPLITS)

    summed = table.select("y", "bins", "margin").mapInArrow(sum_up, "slot int, block int, sums binary")
    ordered = summed.repartition("slot", "block").sortWithinPartitions("slot", "block")
    return ordered.mapInArrow(choose, _SPLIT_ROW).collect()


def fit(
    df: DataFrame,
    vec: str,
    label: str,
    rounds: int = 100,
    depth: int = 6,
    rate: float = 0.3,
    penalty: float = 1.0,
    least_weight: float = 1.0,
    least_gain: float = 1e-6,
    bins: int = 256,
    keep_every: int = 10,
) -> BoostedTrees:
    """Fit ``rounds`` trees of at most ``depth`` levels on a vector column and 0/1 labels.

    Leaves are -G / (H + ``penalty``) times ``rate``; a split needs a hessian sum of
    ``least_weight`` on both sides and a gain above ``least_gain``; of equal gains the
    first feature and bin is taken.  Without rows the model has no tree and predicts 0.
    The margins of the rows are written every ``keep_every`` rounds, so that a task runs
    through few trees.
    """
    model = BoostedTrees(bin_edges(df, vec, bins), depth)
    if not model.edges:
        return model

    def to_bins(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            own = model.binned(_arrow_matrix(part.column(1)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.tobytes() for x in own], pa.binary()), pa.array(np.zeros(len(own)))], ["y", "bins", "margin"])

    rows = df.select(c(label).cast("double").alias("y"), c(vec))
    table = cut_lineage(rows.mapInArrow(to_bins, "y double, bins binary, margin double"))
    done = 0
    for _ in range(rounds):
        tree, slots = Tree.of_depth(depth), {1: 0}
        for level in range(depth):
            found: dict[int, tuple] = {}
            for r in _splits(table, model, done, tree, level, slots, penalty, least_weight):
                rank = (-r.gain, r.feature, r.bin)
                if r.slot not in found or rank < found[r.slot][0]:
                    found[r.slot] = rank, r
            if level == 0:
                whole = found[0][1]
                tree.value[1] = -rate * (whole.g / _UNIT) / (whole.h / _UNIT + penalty)
            open_nodes = [n for n, slot in slots.items() if slot in found and found[slot][1].gain > least_gain]
            for node in open_nodes:
                r = found[slots[node]][1]
                tree.feature[node], tree.bin[node] = r.feature, r.bin
                for child, g, h in ((2 * node, r.gl, r.hl), (2 * node + 1, r.g - r.gl, r.h - r.hl)):
                    tree.value[child] = -rate * (g / _UNIT) / (h / _UNIT + penalty)
            slots = {child: i for i, child in enumerate(x for n in sorted(open_nodes) for x in (2 * n, 2 * n + 1))}
            if not slots:
                break
        model.trees.append(tree)
        if len(model.trees) - done == keep_every:
            table, done = _with_margins(table, model, done), len(model.trees)
    discard(table)
    return model


def _with_margins(table: DataFrame, model: BoostedTrees, done: int) -> DataFrame:
    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            own = _stored_bins(part.column(1), model)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(part.column(2).to_numpy() + model.margins(own, done))], ["y", "bins", "margin"])

    new = cut_lineage(table.mapInArrow(add, "y double, bins binary, margin double"))
    discard(table)
    return new
