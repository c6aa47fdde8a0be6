"""Exact quantiles of large columns by radix selection.

The bits of a double, with the sign bit turned, order like the numbers.  They are read as
four digits of 16 bits: one scan counts the digits of all columns, and each wanted rank
picks the digit it falls under; the next scan counts the next digit of the rows below the
picked ones.  Four scans give every rank of every column exactly, whatever the values.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkhunt.names import c

_DIGITS, _BITS = 4, 16
_TOP = np.uint64(1 << 63)


def _ordered(values: np.ndarray) -> np.ndarray:
    """Unsigned integers that order like the numbers, NaN last."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.uint64)
    return np.where(bits & _TOP, ~bits, bits | _TOP)


def _number(pattern: int) -> float:
    bits = pattern ^ (1 << 63) if pattern >> 63 else pattern ^ ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def _digit_counts(numbers: DataFrame, prefixes: Sequence[np.ndarray], digit: int) -> DataFrame:
    """(a, p, d, n): rows of column ``a`` per value of a digit, below its p-th prefix."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for a, known in enumerate(prefixes):
                column = part.column(a).drop_null()
                if not len(column) or not len(known):
                    continue
                bits = _ordered(column.to_numpy(zero_copy_only=False))
                head = bits >> np.uint64(64 - _BITS * digit) if digit else np.zeros(len(bits), np.uint64)
                at = np.minimum(np.searchsorted(known, head), len(known) - 1)
                under = known[at] == head
                low = (bits[under] >> np.uint64(64 - _BITS * (digit + 1))) & np.uint64((1 << _BITS) - 1)
                keys, n = np.unique((at[under] << _BITS) | low.astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), a, np.int32)), pa.array((keys >> _BITS).astype(np.int32)), pa.array((keys & ((1 << _BITS) - 1)).astype(np.int32)), pa.array(n)], ["a", "p", "d", "n"]
                )

    return numbers.mapInArrow(count, "a int, p int, d int, n long").groupBy("a", "p", "d").agg(F.sum("n").alias("n"))


def exact_quantiles(
    df: DataFrame, attrs: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column (NULLs left out), as driver numbers.

    What a scan leaves are at most 65,536 counts per column and wanted rank; their running
    sum is a window over one column and prefix, and one row per rank reaches the driver.
    """
    numbers = df.select(*[c(a).cast("double").alias(f"x{i}") for i, a in enumerate(attrs)])
    first = _digit_counts(numbers, [np.zeros(1, np.uint64)] * len(attrs), 0).collect()
    sizes = [sum(r.n for r in first if r.a == a) for a in range(len(attrs))]
    # (column, rank) -> digits read so far and the rank among the rows that share them
    wanted: dict[tuple[int, int], tuple[int, int]] = {}
    for a, n in enumerate(sizes):
        counts = sorted((r.d, r.n) for r in first if r.a == a)
        for rank in {f(p * (n - 1)) for p in probabilities for f in (math.floor, math.ceil)} if n else ():
            below = 0
            for d, m in counts:
                if rank < below + m:
                    wanted[a, rank] = d, rank - below
                    break
                below += m
    for digit in range(1, _DIGITS if wanted else 1):
        prefixes = [np.array(sorted({p for (b, _), (p, _) in wanted.items() if b == a}), np.uint64) for a in range(len(attrs))]
        place = [{int(p): i for i, p in enumerate(known)} for known in prefixes]
        asked = [(a, place[a][p], rank, rest) for (a, rank), (p, rest) in wanted.items()]
        ranks = df.sparkSession.createDataFrame(asked, "a int, p int, rank long, rest long")
        upto = F.sum("n").over(Window.partitionBy("a", "p").orderBy("d"))
        placed = _digit_counts(numbers, prefixes, digit).withColumn("upto", upto)
        hits = placed.join(F.broadcast(ranks), ["a", "p"]).where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest")))
        wanted = {(r.a, r.rank): (int(prefixes[r.a][r.p]) << _BITS | r.d, r.rest - (r.upto - r.n)) for r in hits.collect()}
    result: dict[str, list[float | None]] = {}
    for a, attr in enumerate(attrs):
        out: list[float | None] = []
        for p in probabilities:
            if not sizes[a]:
                out.append(None)
                continue
            at = p * (sizes[a] - 1)
            below, above = (_number(wanted[a, f(at)][0]) for f in (math.floor, math.ceil))
            out.append(below if below == above else below + (above - below) * (at - math.floor(at)))
        result[attr] = out
    return result
