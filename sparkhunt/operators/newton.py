"""Logistic regression for two classes by Newton steps from summed moments.

A step is one job: every partition sums loss, gradient and Hessian of its rows, the sums of
the partitions meet per row of the Hessian, and the driver solves for the step.  What it
holds is bounded by the square of the number of features, never by the rows.  The optimum
is unique, so the fit does not depend on a start, a seed or the order of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkhunt.names import c

_PART = pa.schema([("line", pa.int32()), ("part", pa.int64()), ("sums", pa.binary())])
#: Rows whose moments are summed by one matrix product.
_ROWS = 2048


@dataclass
class LogisticModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the intercept first

    def margins(self, matrix: np.ndarray) -> np.ndarray:
        if not len(self.mean):  # fitted without rows
            return np.full(len(matrix), self.weights[0])
        return ((matrix - self.mean) / self.scale) @ self.weights[1:] + self.weights[0]

    def log_odds(self, vectors: Column) -> Column:
        """The log odds of label 1 for a vector column."""

        @F.pandas_udf("double")
        def run(rows: pd.Series) -> pd.Series:
            matrix = np.stack([np.asarray(v, dtype=float) for v in rows]) if len(rows) else np.zeros((0, len(self.mean)))
            return pd.Series(self.margins(matrix))

        return run(vectors)


def _summed(df: DataFrame, moments: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum over all rows (features, label) of a matrix of moments, None without rows.

    ``moments`` gives the matrix of a block of rows.  Each line of the matrix is summed over
    the partitions by a group of its own, partitions in order.
    """

    def per_partition(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = None
        for part in parts:
            for at in range(0, part.num_rows, _ROWS):
                block = part.slice(at, _ROWS)
                matrix = block.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(block.num_rows, -1)
                found = moments(matrix, block.column(1).to_numpy(zero_copy_only=False).astype(float))
                held = found if held is None else held + found
        if held is not None:
            n, own = len(held), TaskContext.get().partitionId()
            lines = [pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, own, np.int64)), pa.array([x.tobytes() for x in held], pa.binary())]
            yield pa.RecordBatch.from_arrays(lines, schema=_PART)

    def per_line(rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values("part")
        total = np.sum([np.frombuffer(x) for x in ordered["sums"]], axis=0)
        return pd.DataFrame({"line": [ordered["line"].iloc[0]], "sums": [total.tobytes()]})

    parts = df.mapInArrow(per_partition, "line int, part long, sums binary")
    lines = parts.groupBy("line").applyInPandas(per_line, "line int, sums binary").collect()
    return np.stack([np.frombuffer(r.sums) for r in sorted(lines, key=lambda r: r.line)]) if lines else None


def fit(df: DataFrame, vec: str, label: str, penalty: float = 1.0, steps: int = 30, near: float = 1e-10) -> LogisticModel:
    """Weights that minimise the summed log loss plus ``penalty`` / 2 times their squares.

    Features are centred and divided by their sample deviation (a constant one by 1); the
    intercept bears no penalty.  A step that raises the loss is halved; the fit ends once a
    step can lower it by less than ``near``, or after ``steps`` jobs.  With one class only
    the intercept grows until then; without rows all weights are 0.  ``label`` is 0 or 1,
    vectors have one length; rows with a null in either are not used.
    """
    # features and label are read once a step: the caller stores what is dear to compute
    rows = df.select(c(vec).cast("array<double>").alias("x"), c(label).cast("double").alias("y")).where("x is not null and y is not null")
    sums = _summed(rows, lambda x, y: np.array([[len(x), *x.sum(axis=0)]]))
    if sums is None:
        return LogisticModel(np.zeros(0), np.ones(0), np.zeros(1))
    n, mean = sums[0, 0], sums[0, 1:] / sums[0, 0]
    spread = np.sqrt(_summed(rows, lambda x, y: ((x - mean) ** 2).sum(axis=0, keepdims=True))[0] / max(n - 1, 1))
    scale = np.where(spread > 0, spread, 1.0)
    ridge = np.full(len(mean) + 1, penalty)
    ridge[0] = 0.0

    def moments_at(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
            margin = z @ weights
            p = 0.5 * (1.0 + np.tanh(0.5 * margin))
            loss = np.logaddexp(0.0, margin) - y * margin
            # lines of the Hessian, then the gradient and the loss
            hessian = z.T @ (z * (p * (1.0 - p))[:, None])
            return np.vstack([hessian, z.T @ (p - y), np.full(z.shape[1], loss.sum())])

        total = _summed(rows, moments)
        loss = total[-1, 0] + 0.5 * float(ridge @ weights**2)
        return loss, total[-2] + ridge * weights, total[:-2] + np.diag(ridge)

    held = np.zeros(len(mean) + 1)
    loss, gradient, hessian = moments_at(held)
    step = np.linalg.solve(hessian, -gradient)
    for _ in range(steps - 1):
        if -gradient @ step < near:
            break
        new = moments_at(held + step)
        if new[0] > loss + 1e-9 * abs(loss):
            step = step / 2
            continue
        held = held + step
        loss, gradient, hessian = new
        step = np.linalg.solve(hessian, -gradient)
    return LogisticModel(mean, scale, held)
