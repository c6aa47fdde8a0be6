"""Aggregations: totals, profiles, scaling, and the data behind plots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkhunt.functions.timeparts import (
    BUCKET_SECONDS,
    CALENDAR_FLAGS,
    ISO_PATTERN,
    epoch_seconds,
    iso_timestamp,
    next_bucket,
    pick_bucket,
    time_bucket,
    week_calendar,
)
from sparkhunt.names import c
from sparkhunt.operators.quantiles import exact_quantiles


def one_value(df: DataFrame, value: Column) -> Column:
    """A one-row aggregate of ``df`` as a scalar subquery.

    Add it as a column and refer to that: Spark plans every mention of a subquery anew.
    """
    return df.agg(value.alias("v")).select("v").scalar()


# -- connections per process ---------------------------------------------------------------


def conn_sum_by_guid(df: DataFrame, key: str = "x_guid") -> DataFrame:
    return df.groupBy(c(key)).agg(F.sum(c("x_opened_connection_count")).alias("connections"))


def conn_nunique_by_guid(df: DataFrame, key: str = "x_guid") -> DataFrame:
    return df.groupBy(c(key)).agg(
        F.count_distinct(c("opened_connection_ref_0.id")).alias("connections")
    )


# -- outlier bounds and scaling --------------------------------------------------------------


def outlier_bounds_stddev(df: DataFrame, attr: str, k: float = 3) -> DataFrame:
    mean, cutoff = F.avg(c(attr)), F.stddev_samp(c(attr)) * k
    return df.agg((mean - cutoff).alias("lower"), (mean + cutoff).alias("upper"))


def outlier_bounds_iqr(df: DataFrame, attr: str, k: float = 1.5) -> DataFrame:
    q1, q3 = exact_quantiles(df, [attr], [0.25, 0.75])[attr]
    bounds = (None, None) if q1 is None else (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return df.sparkSession.createDataFrame([bounds], "lower double, upper double")


def minmax_scale(df: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Scale columns to [0, 1]; a constant column becomes 0."""
    ends = F.struct(
        *[F.min(c(a)).cast("double").alias(f"lo{i}") for i, a in enumerate(attrs)],
        *[F.max(c(a)).cast("double").alias(f"hi{i}") for i, a in enumerate(attrs)],
    )
    scaled = {}
    for i, a in enumerate(attrs):
        low, high = F.col(f"__ends.lo{i}"), F.col(f"__ends.hi{i}")
        width = F.when(high > low, high - low).otherwise(F.lit(1.0))
        scaled[a] = (c(a) - low) / width
    return df.withColumn("__ends", one_value(df, ends)).withColumns(scaled).drop("__ends")


def score_normalize(df: DataFrame, attr: str = "x_suspicious_score") -> DataFrame:
    return minmax_scale(df, [attr])


def score_rank(
    df: DataFrame, k: int, attr: str = "x_suspicious_score", tie_break: Sequence[str] = ("id",)
) -> DataFrame:
    """The k highest scores."""
    return df.orderBy(c(attr).desc(), *[c(t) for t in tie_break]).limit(k)


# -- entity profiles --------------------------------------------------------------------------


def with_calendar(df: DataFrame, attr: str = "first_observed", monday_zero: bool = False) -> DataFrame:
    """Add the week-calendar columns of an ISO timestamp text."""
    calendar = week_calendar(epoch_seconds(c(attr)), monday_zero)
    return df.withColumn("__cal", calendar).select("*", "__cal.*").drop("__cal")


def mean_daily_count(df: DataFrame, keys: Sequence[str], name: str = "Mean") -> DataFrame:
    """Average requests per active day."""
    daily = df.groupBy(*[c(k) for k in keys], F.col("Days")).agg(F.count("id").alias("n"))
    return daily.groupBy(*[c(k) for k in keys]).agg(F.avg("n").alias(name))


def max_pair_count(
    df: DataFrame, keys: Sequence[str], partner: str, name: str = "Max"
) -> DataFrame:
    """Requests of the most frequent partner."""
    pairs = df.groupBy(*[c(k) for k in keys], c(partner)).agg(F.count("id").alias("n"))
    return pairs.where(c(partner).isNotNull()).groupBy(*[c(k) for k in keys]).agg(F.max("n").alias(name))


def _profile(df: DataFrame, keys: Sequence[str], partners: dict[str, str], pair: str) -> DataFrame:
    """Profile of an entity from one shared pre-aggregation.

    Rows are first reduced to counts per (key, partners, day, weekday, range).  All
    sums, distincts, daily means and pair maxima are then taken from that much smaller
    table, whose rows are unique, so a hot key is spread over its partners and days.
    No branch filters it, so Spark runs the pre-aggregation once and reuses its shuffle.
    """
    cal = df if "Days" in df.columns else with_calendar(df)
    keyed = [c(k) for k in keys]
    base = (
        cal.dropna(subset=[f"`{k}`" for k in keys])
        .groupBy(*keyed, *[c(p) for p in partners], F.col("Days"), *[F.col(x) for x in CALENDAR_FLAGS])
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 0")
    )
    result = base.groupBy(*keyed).agg(
        *[F.sum(F.col(x) * F.col("n")).alias(x) for x in CALENDAR_FLAGS],
        F.sum("n").alias("NoOfRecords"),
    )
    for partner, name in partners.items():
        distinct = base.select(*keyed, c(partner)).distinct()
        result = result.join(distinct.groupBy(*keyed).agg(F.count(c(partner)).alias(name)), list(keys))
    daily = base.groupBy(*keyed, F.col("Days")).agg(F.sum("n").alias("per_day"))
    mean = daily.groupBy(*keyed).agg(F.avg("per_day").alias("Mean"))
    pairs = base.groupBy(*keyed, c(pair)).agg(F.sum("n").alias("per_pair"))
    known = F.when(c(pair).isNotNull(), F.col("per_pair"))
    most = pairs.groupBy(*keyed).agg(F.max(known).alias("Max"))
    return result.join(mean, list(keys)).join(most, list(keys))


def source_profile(df: DataFrame) -> DataFrame:
    return _profile(df, ["source"], {"username": "F1", "destination": "destination"}, "destination")


def user_profile(df: DataFrame) -> DataFrame:
    return _profile(df, ["username"], {"source": "F1", "destination": "F2"}, "destination")


def user_domain_profile(df: DataFrame) -> DataFrame:
    return _profile(df, ["username", "domain"], {"source": "F1", "destination": "F2"}, "destination")


def destination_profile(df: DataFrame) -> DataFrame:
    return _profile(df, ["destination"], {"username": "F1", "source": "F2"}, "source")


PROFILE_FEATURES = ("NoOfRecords", "Mean", "Max") + CALENDAR_FLAGS


# -- histograms and counts ----------------------------------------------------------------------


def hourly_histogram(df: DataFrame, attr: str = "first_observed", width_s: int = 600) -> DataFrame:
    """Rows per hour of day and bin of the hour, with zeros: 24 x (3600 / width) rows."""
    ts = iso_timestamp(c(attr)) if dict(df.dtypes)[attr] == "string" else c(attr)
    counts = (
        df.where(ts.isNotNull())
        .groupBy(
            F.hour(ts).alias("hour"),
            F.floor((F.minute(ts) * 60 + F.second(ts)) / width_s).cast("int").alias("bin"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_hour = -(-3600 // width_s)
    grid = df.sparkSession.range(24 * per_hour).select(
        F.floor(F.col("id") / per_hour).cast("int").alias("hour"),
        (F.col("id") % per_hour).cast("int").alias("bin"),
    )
    return grid.join(F.broadcast(counts), ["hour", "bin"], "left").select(
        "hour", "bin", F.coalesce("n", F.lit(0)).alias("n")
    )


def value_counts(df: DataFrame, attr: str) -> DataFrame:
    """Counts per value, most frequent first, ties by value."""
    counts = df.where(c(attr).isNotNull()).groupBy(c(attr).alias("value")).count()
    return counts.orderBy(F.desc("count"), "value")


def histogram10(df: DataFrame, attr: str, bins: int = 10) -> DataFrame:
    """Equal-width bins from minimum to maximum; the last bin includes the maximum.

    A constant column gets the range value - 0.5 .. value + 0.5.
    """
    x = c(attr).cast("double")
    lo, hi = F.min(x), F.max(x)
    edges = F.struct(
        F.when(lo == hi, lo - 0.5).otherwise(lo).alias("low"),
        (F.when(lo == hi, F.lit(1.0)).otherwise(hi - lo) / bins).alias("width"),
    )
    ends = one_value(df, edges)
    low, width = F.col("__ends.low"), F.col("__ends.width")
    counts = (
        df.where(x.isNotNull())
        .select(x.alias("x"), ends.alias("__ends"))
        .groupBy(F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.withColumn("__ends", ends).join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def boxplot_stats(df: DataFrame, attrs: Sequence[str], k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (last datum within k IQR) and outlier count per column."""
    quartiles = exact_quantiles(df, attrs, [0.25, 0.5, 0.75])
    aggs = []
    for i, a in enumerate(attrs):
        q1, median, q3 = quartiles[a]
        if q1 is None:
            empty = [F.max(F.lit(None).cast("double")).alias(n) for n in _BOX]
            aggs.append(F.struct(*empty, F.count_if(F.lit(False)).alias("n_outliers")).alias(f"b{i}"))
            continue
        x = c(a).cast("double")
        low, high = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        row = F.struct(
            F.lit(q1).alias("q1"),
            F.lit(median).alias("median"),
            F.lit(q3).alias("q3"),
            F.least(F.min(F.when(x >= low, x)), F.lit(q1)).alias("whisker_low"),
            F.greatest(F.max(F.when(x <= high, x)), F.lit(q3)).alias("whisker_high"),
            F.count_if((x < low) | (x > high)).alias("n_outliers"),
        )
        aggs.append(row.alias(f"b{i}"))
    names = [F.struct(F.lit(a).alias("attr"), F.col(f"b{i}").alias("b")) for i, a in enumerate(attrs)]
    return (
        df.agg(*aggs)
        .select(F.explode(F.array(*names)).alias("r"))
        .select("r.attr", "r.b.*")
    )


_BOX = ("q1", "median", "q3", "whisker_low", "whisker_high")


def boxplot_outliers(df: DataFrame, attrs: Sequence[str], k: float = 1.5) -> DataFrame:
    """Values outside the fences, one row per value."""
    quartiles = exact_quantiles(df, attrs, [0.25, 0.75])
    cells = []
    for a in attrs:
        q1, q3 = quartiles[a]
        x = c(a).cast("double")
        if q1 is None:
            continue
        outside = (x < q1 - k * (q3 - q1)) | (x > q3 + k * (q3 - q1))
        cells.append(F.when(outside, F.struct(F.lit(a).alias("attr"), x.alias("value"))))
    if not cells:
        return df.sparkSession.createDataFrame([], "attr string, value double")
    return df.select(F.explode(F.array_compact(F.array(*cells))).alias("r")).select("r.*")


# -- time series ----------------------------------------------------------------------------------


def _as_timestamp(df: DataFrame, attr: str) -> Column:
    return iso_timestamp(c(attr)) if dict(df.dtypes)[attr] == "string" else c(attr).cast("timestamp")


def time_bounds(df: DataFrame, ts: str) -> DataFrame:
    t = _as_timestamp(df, ts)
    return df.agg(F.min(t).alias("t0"), F.max(t).alias("t1"))


def time_series(
    df: DataFrame, ts: str, y: str, agg: Callable[[Column], Column], bucket: str | None = None
) -> DataFrame:
    """(time, value): ``agg`` of ``y`` per bucket, with 0 for empty buckets."""
    bounds = time_bounds(df, ts).first()
    if bounds["t0"] is None:
        return df.sparkSession.createDataFrame([], "time timestamp, value double")
    rule = bucket or pick_bucket(bounds["t0"], bounds["t1"])
    t = _as_timestamp(df, ts)
    t0, t1 = F.lit(bounds["t0"]), F.lit(bounds["t1"])
    first, last = time_bucket(t0, rule, t0), time_bucket(t1, rule, t0)
    found = (
        df.where(t.isNotNull())
        .groupBy(time_bucket(t, rule, t0).alias("time"))
        .agg(agg(c(y)).alias("value"))
    )
    if rule == "1M":
        steps = F.months_between(last, first).cast("long")
    else:
        steps = F.floor((F.unix_seconds(last) - F.unix_seconds(first)) / F.lit(BUCKET_SECONDS[rule]))
    count = df.sparkSession.range(1).select(steps.alias("n")).first()["n"] + 1
    grid = df.sparkSession.range(count).select(
        next_bucket(first, rule, F.col("id").cast("int")).alias("time")
    )
    return grid.join(found, "time", "left").select(
        "time", F.coalesce("value", F.lit(0)).alias("value")
    )


def time_count(df: DataFrame, ts: str, y: str, bucket: str | None = None) -> DataFrame:
    return time_series(df, ts, y, F.count, bucket)


def time_sum(df: DataFrame, ts: str, y: str, bucket: str | None = None) -> DataFrame:
    return time_series(df, ts, y, F.sum, bucket)


# -- kinds of columns --------------------------------------------------------------------------------

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def feature_kinds(df: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """(attr, kind) with kind timestamp, numerical or categorical; one pass over the data.

    Text counts as a timestamp when every value looks like an ISO timestamp.  Names
    that end in ``_id``, and ``pid``, are never numerical.
    """
    types = dict(df.dtypes)
    kinds = []
    for a in attrs:
        if types[a].startswith("timestamp") or types[a] == "date":
            kind = F.lit("timestamp")
        elif types[a] == "string":
            iso = F.bool_and(c(a).rlike("^" + ISO_PATTERN))
            kind = F.when(F.coalesce(iso, F.lit(False)), "timestamp").otherwise("categorical")
        elif types[a].startswith(("decimal", *_NUMBERS)) and not (a.endswith("_id") or a == "pid"):
            kind = F.lit("numerical")
        else:
            kind = F.lit("categorical")
        kinds.append(F.struct(F.lit(a).alias("attr"), kind.alias("kind")))
    rows = F.array(*kinds)
    return df.agg(rows.alias("r")).select(F.explode("r").alias("r")).select("r.*")


def feature_kind(df: DataFrame, attr: str | Sequence[str]) -> str | list[str]:
    if isinstance(attr, str):
        return feature_kinds(df, [attr]).first()["kind"]
    found = {r["attr"]: r["kind"] for r in feature_kinds(df, list(attr)).collect()}
    return [found[a] for a in attr]
