"""Clustering of a table by the method its column types allow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sparkhunt.operators.dbscan import dbscan_mixed, dbscan_numeric
from sparkhunt.operators.kmeans import kmeans_cluster


def cluster_method(df: DataFrame, cols: Sequence[str], method: str = "kmeans") -> str:
    """Text columns force DBSCAN on mixed distance, else the method asked for."""
    kinds = dict(df.dtypes)
    if any(kinds[n] in ("string", "boolean") for n in cols):
        return "dbscan_mixed"
    return {"kmeans": "kmeans", "dbscan": "dbscan_numeric"}[method.lower()]


def cluster_auto(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    method: str = "kmeans",
    key: str = "id",
    **params,
) -> DataFrame:
    """Add ``cluster``; all columns take part when none are named."""
    cols = list(cols or df.columns)
    chosen = cluster_method(df, cols, method)
    if chosen == "kmeans":
        return kmeans_cluster(df, cols, **params)
    return (dbscan_mixed if chosen == "dbscan_mixed" else dbscan_numeric)(df, cols, key=key, **params)
