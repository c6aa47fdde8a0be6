"""Timestamps: ISO text, week calendar, time buckets."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkhunt.names import let

ISO_PATTERN = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z"

# Bucket widths in seconds and their labels, in the order they are tried.
BUCKETS = (
    (1, "1S"),
    (5, "5S"),
    (10, "10S"),
    (30, "30S"),
    (60, "1T"),
    (300, "5T"),
    (600, "10T"),
    (1800, "30T"),
    (3600, "1H"),
    (43200, "12H"),
    (86400, "1D"),
    (172800, "2D"),
    (604800, "1W"),
    (2592000, "1M"),
)
BUCKET_SECONDS = {label: width for width, label in BUCKETS}

WEEKDAYS = ("Mo", "Tu", "We", "Th", "Fr", "Sa", "Su")
DAY_RANGES = ("0to6", "6to12", "12to18", "18to0")
CALENDAR_FLAGS = WEEKDAYS + DAY_RANGES


def iso_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def iso_time_parts(text: Column) -> Column:
    """Struct (hour, minute, second) of an ISO timestamp text, in UTC sessions."""
    return let(
        iso_timestamp(text),
        lambda ts: F.struct(
            F.hour(ts).alias("hour"), F.minute(ts).alias("minute"), F.second(ts).alias("second")
        ),
    )


def epoch_seconds(text: Column) -> Column:
    """Whole epoch seconds of an ISO timestamp text; the fraction is dropped."""
    return F.unix_seconds(iso_timestamp(text))


def week_calendar(epoch: Column, monday_zero: bool = False) -> Column:
    """Calendar features of epoch seconds as one struct.

    The default keeps the published week: hours counted with an offset of 48, so
    1970-01-01 (a Thursday) falls on day 2, and a Saturday that lasts until hour 148.
    ``monday_zero=True`` uses offset 72 and seven days of 24 hours.
    """
    offset, saturday_end = (72, 144) if monday_zero else (48, 148)
    return let(epoch, lambda e: _calendar(e, offset, saturday_end))


def _calendar(epoch: Column, offset: int, saturday_end: int) -> Column:
    hours = F.floor(epoch / 3600)
    of_week = F.pmod(hours + offset, F.lit(168)).cast("int")
    edges = [0, 24, 48, 72, 96, 120, saturday_end, 168]
    range_no = F.floor(F.pmod(of_week, F.lit(24)) / 6).cast("int")
    fields = [
        of_week.alias("timeofweek"),
        F.floor(of_week / 24).cast("int").alias("weekday"),
        range_no.alias("HourRange"),
        F.floor(epoch / 86400).alias("Days"),
    ]
    for label, start, stop in zip(WEEKDAYS, edges, edges[1:]):
        fields.append(((of_week >= start) & (of_week < stop)).cast("int").alias(label))
    for number, label in enumerate(DAY_RANGES):
        fields.append((range_no == number).cast("int").alias(label))
    fields.append(F.lit(1).alias("NoOfRecords"))
    return F.struct(*fields)


def _pick(span_seconds: float) -> str:
    for width, label in BUCKETS:
        if span_seconds >= width and 10 <= span_seconds / width <= 40:
            return label
    return BUCKETS[-1][1]


def pick_bucket(t0: datetime, t1: datetime) -> str:
    """Bucket label for a time span: the first width giving 10 to 40 buckets, else 1M."""
    return _pick((t1 - t0).total_seconds())


def pick_bucket_of_span(seconds: Column) -> Column:
    """:func:`pick_bucket` as an expression over a span in seconds."""
    label = F.lit(BUCKETS[-1][1])
    for width, name in reversed(BUCKETS):
        label = F.when(seconds.between(10 * width, 40 * width), F.lit(name)).otherwise(label)
    return label


def time_bucket(ts: Column, rule: str, t0: Column) -> Column:
    """Label timestamp of the bucket that holds ``ts``.

    Fixed widths count from midnight of the first day ``t0``; weeks are labelled with
    their Sunday and months with their last day.
    """
    if rule == "1W":
        return F.date_trunc("week", ts) + F.expr("INTERVAL 6 DAYS")
    if rule == "1M":
        return F.last_day(ts).cast("timestamp")
    width = BUCKET_SECONDS[rule]
    origin = F.unix_seconds(F.date_trunc("day", t0))
    steps = F.floor((F.unix_seconds(ts) - origin) / width)
    return F.timestamp_seconds(origin + steps * width)


def next_bucket(label: Column, rule: str, steps: Column) -> Column:
    """Label ``steps`` buckets after ``label``; used to list the empty buckets."""
    if rule == "1M":
        return F.last_day(F.add_months(label, steps)).cast("timestamp")
    return F.timestamp_seconds(F.unix_seconds(label) + steps * BUCKET_SECONDS[rule])
