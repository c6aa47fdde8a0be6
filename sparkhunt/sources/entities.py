"""Entity tables in and out: Parquet, JSON records, literal rows, the hour model."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

HOUR_MODEL_SCHEMA = T.StructType(
    [
        T.StructField("hour", T.IntegerType()),
        T.StructField("bin", T.IntegerType()),
        T.StructField("n", T.LongType()),
    ]
)


def scan_entities(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_multi(spark: SparkSession, *paths: str) -> tuple[DataFrame, ...]:
    """Related tables in the order they are given (observations, users, connections)."""
    return tuple(spark.read.parquet(p) for p in paths)


def sink_parquet_gzip(df: DataFrame, path: str) -> None:
    df.write.option("compression", "gzip").parquet(path)


def scan_json_records(
    spark: SparkSession, path: str, schema: T.StructType | str, array_file: bool = False
) -> DataFrame:
    """JSON records with a given schema.

    Files with one record per line are split between tasks.  A file that is one JSON
    array (``array_file=True``) can only be read by one task per file.
    """
    return spark.read.schema(schema).option("multiLine", array_file).json(path)


def sink_json_records(df: DataFrame, path: str) -> None:
    df.write.json(path)


def hour_model_save(model_df: DataFrame, path: str) -> None:
    model_df.select("hour", "bin", "n").coalesce(1).write.parquet(path)  # 144 rows


def hour_model_load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HOUR_MODEL_SCHEMA).parquet(path)


def literal_entities(
    spark: SparkSession, rows: Iterable[dict | tuple], schema: T.StructType | str
) -> DataFrame:
    """Inline rows of a hunt, e.g. a handful of domain names to look up."""
    return spark.createDataFrame(list(rows), schema)
