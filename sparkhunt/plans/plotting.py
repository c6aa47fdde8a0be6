"""The data behind a plot of one or two columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sparkhunt.operators import aggregates as agg
from sparkhunt.operators.plots import plot_kind, plot_points


def plot_data(
    df: DataFrame, x: str | Sequence[str] | None = None, y: str | None = None, kind: str | None = None
) -> DataFrame:
    """Choose the plot by the kinds of the columns and return its data."""
    many = x is not None and not isinstance(x, str)
    x_kind = agg.feature_kind(df, list(x) if many else x) if x else None
    y_kind = agg.feature_kind(df, y) if y else None
    kind = plot_kind(x_kind, y_kind, kind)
    if kind in ("dist_x", "dist_y"):
        col = x if kind == "dist_x" else y
        return agg.boxplot_stats(df, list(col)) if many else agg.histogram10(df, col)
    if kind in ("count_x", "count_y"):
        return agg.value_counts(df, x if kind == "count_x" else y)
    if kind == "time_count":
        return agg.time_count(df, x, y)
    if kind == "time_sum":
        return agg.time_sum(df, x, y)
    return plot_points(df, x, y)
