"""Which plot fits which columns, and the points it needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkhunt.names import c

# Plot kind by (x kind, y kind); None where no plot is defined.
PLOT_KINDS = {
    ("categorical", "categorical"): None,
    ("categorical", "numerical"): "area",
    ("categorical", "timestamp"): None,
    ("categorical", None): "count_x",
    ("numerical", "categorical"): None,
    ("numerical", "numerical"): "scatter",
    ("numerical", "timestamp"): None,
    ("numerical", None): "dist_x",
    ("timestamp", "categorical"): "time_count",
    ("timestamp", "numerical"): "time_sum",
    ("timestamp", "timestamp"): None,
    ("timestamp", None): None,
    (None, "categorical"): "count_y",
    (None, "numerical"): "dist_y",
    (None, "timestamp"): None,
}
OVERRIDES = (
    "bar",
    "area",
    "dist_x",
    "dist_y",
    "count_x",
    "count_y",
    "scatter",
    "time_count",
    "time_sum",
)


def plot_kind(x_kind: str | list | None, y_kind: str | None, override: str | None = None) -> str:
    """Plot kind for two column kinds; several x columns must be of one kind."""
    if isinstance(x_kind, (list, tuple)):
        if len(set(x_kind)) > 1:
            raise ValueError(f"no plot for columns of several kinds: {x_kind}")
        x_kind = x_kind[0]
    if override:
        if override not in OVERRIDES:
            raise ValueError(f"unknown plot kind {override!r}")
        return override
    if x_kind is None and y_kind is None:
        raise ValueError("name an x or a y column")
    kind = PLOT_KINDS[x_kind, y_kind]
    if kind is None:
        raise ValueError(f"no plot for {y_kind} over {x_kind}")
    return kind


def plot_kinds(kinds_df: DataFrame) -> DataFrame:
    """Plot kind of every (x_kind, y_kind) row; NULL where no plot is defined."""
    kind = F.lit(None).cast("string")
    for (x, y), name in PLOT_KINDS.items():
        hit = c("x_kind").eqNullSafe(F.lit(x)) & c("y_kind").eqNullSafe(F.lit(y))
        if name:
            kind = F.when(hit, name).otherwise(kind)
    return kinds_df.withColumn("plot", kind)


def plot_points(df: DataFrame, x: str, y: str) -> DataFrame:
    """The x, y rows of a scatter, bar or area plot."""
    return df.select(c(x).alias("x"), c(y).alias("y"))
