"""Stateless scoring and time buckets on streaming tables.

The analytics read one batch; what they do row by row also works on a stream.  Time
buckets and the hourly histogram become windowed counts with a watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkhunt.names import c


def stream_time_series(
    stream: DataFrame, ts: str, value: Column, width: str, late: str = "10 minutes"
) -> DataFrame:
    """(time, value) per window; rows later than ``late`` are not waited for."""
    windowed = stream.withWatermark(ts, late).groupBy(F.window(c(ts), width).alias("w"))
    return windowed.agg(value.alias("value")).select(F.col("w.start").alias("time"), "value")


def stream_hourly_histogram(stream: DataFrame, ts: str, late: str = "10 minutes") -> DataFrame:
    """Counts per ten-minute window with its hour and bin; add them up per (hour, bin)."""
    counts = stream_time_series(stream, ts, F.count(F.lit(1)), "10 minutes", late)
    return counts.select(
        "time",
        F.hour("time").alias("hour"),
        F.floor(F.minute("time") / 10).cast("int").alias("bin"),
        F.col("value").alias("n"),
    )
