"""Registration of queries with the SQL that gives the same result in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from queryset.views import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CONN = {"src_ip": "src_ref.value", "dst_ip": "dst_ref.value"}
PROC = {
    "binary_name": "binary_ref.name",
    "parent_name": "parent_ref.binary_ref.name",
    "folder": "binary_ref.parent_directory_ref.path",
}
HASHES = {"h_md5": "hashes.MD5", "h_sha1": "hashes.'SHA-1'", "h_sha256": "hashes.'SHA-256'"}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under an operator name."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(sql, "duckdb")
        return fn

    return register
