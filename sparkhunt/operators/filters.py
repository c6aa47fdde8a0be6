"""Filters, projections and set operations on entity tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkhunt.functions.intel import endpoint_of_type
from sparkhunt.names import c
from sparkhunt.operators.ordering import row_positions


def filter_attr_eq(df: DataFrame, attr: str, value) -> DataFrame:
    return df.where(c(attr) == value)


def filter_attr_gt(df: DataFrame, attr: str, value) -> DataFrame:
    return df.where(c(attr) > value)


def filter_attr_like(df: DataFrame, attr: str, value: str) -> DataFrame:
    return df.where(c(attr).like(value))


def filter_attr_regex(df: DataFrame, attr: str, value: str) -> DataFrame:
    return df.where(c(attr).rlike(value))


def filter_time_range(df: DataFrame, attr: str, start: datetime | str, stop: datetime | str) -> DataFrame:
    """Rows with start <= time < stop; the bounds are literals and reach the scan."""
    low, high = F.lit(start).cast("timestamp"), F.lit(stop).cast("timestamp")
    if dict(df.dtypes)[attr] == "timestamp_ntz":
        low, high = low.cast("timestamp_ntz"), high.cast("timestamp_ntz")
    return df.where((c(attr) >= low) & (c(attr) < high))


def filter_last_days(df: DataFrame, attr: str, days: int, anchor: datetime | Column) -> DataFrame:
    """Rows of the last ``days`` days before ``anchor`` (a time or a scalar subquery)."""
    end = anchor if isinstance(anchor, Column) else F.lit(anchor)
    return df.where(c(attr) >= end - F.make_dt_interval(F.lit(int(days))))


def project_attrs(df: DataFrame, attrs: Sequence[str]) -> DataFrame:
    return df.select(*[c(a) for a in attrs])


def add_row_attr(
    df: DataFrame, key: str, name: str = "x_new_attr", prefix: str = "newval"
) -> DataFrame:
    """Label every row with its position in the order of ``key``."""
    placed = row_positions(df, [key], "__pos")
    return placed.withColumn(name, F.concat(F.lit(prefix), F.col("__pos").cast("string"))).drop("__pos")


def clean_column_names(df: DataFrame) -> DataFrame:
    """Remove single quotes from attribute names."""
    return df.toDF(*[name.replace("'", "") for name in df.columns])


def entity_type_dispatch(df: DataFrame, attr: str = "type") -> DataFrame:
    """Add the lookup endpoint and the attribute looked up, row by row."""
    observable = F.when(c(attr) == "file", first_hash(df))
    if "value" in df.columns:
        observable = observable.otherwise(c("value"))
    endpoint = endpoint_of_type(c(attr))
    return df.withColumn("x_endpoint", endpoint).withColumn(
        "x_observable", F.when(endpoint.isNotNull(), observable)
    )


def first_hash(df: DataFrame) -> Column:
    """First hash of a file in column order; NULL for tables without hash columns."""
    hashes = [c(name) for name in df.columns if name.startswith("hashes.")]
    return F.coalesce(*hashes) if hashes else F.lit(None).cast("string")


def outlier_mask(value: Column, lower: Column, upper: Column) -> Column:
    return (value < lower) | (value > upper)


def drop_falsy(df: DataFrame, attr: str) -> DataFrame:
    return df.where(c(attr).isNotNull() & (c(attr) != ""))


def split_by_status(df: DataFrame, prefix: str, attr: str = "status") -> DataFrame:
    return df.where(c(attr).startswith(prefix))


def distinct_values(df: DataFrame, attr: str) -> DataFrame:
    return df.select(c(attr)).distinct()


def traffic_ip_list(
    df: DataFrame, src: str = "src_ref.value", dst: str = "dst_ref.value"
) -> DataFrame:
    """Distinct sources and distinct destinations; an address in both appears twice."""
    sources = df.select(c(src).alias("ip")).distinct()
    return sources.unionAll(df.select(c(dst).alias("ip")).distinct())


def union_labeled(*parts: DataFrame) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def union_train_test(train_df: DataFrame, test_df: DataFrame) -> DataFrame:
    return train_df.unionByName(test_df)


def map_center(df: DataFrame, lat: str, lon: str, key: str) -> DataFrame:
    """Coordinates of the first row in the order of ``key``."""
    first = F.min_by(F.struct(c(lat).alias("lat"), c(lon).alias("lon")), c(key))
    return df.agg(first.alias("center")).select("center.*")


def geo_label(*columns: Column) -> Column:
    """One line per column; a missing value is written as ``None``."""
    return F.concat_ws("\n", *[F.coalesce(x.cast("string"), F.lit("None")) for x in columns])


def geo_markers(df: DataFrame, lat: str, lon: str, labels: Sequence[str]) -> DataFrame:
    return df.select(
        c(lat).alias("lat"), c(lon).alias("lon"), geo_label(*[c(a) for a in labels]).alias("label")
    )
