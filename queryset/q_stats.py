"""Aggregations, profiles and the data behind plots."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.catalog import query
from sparkhunt.functions import timeparts as tp
from sparkhunt.operators import aggregates as agg
from sparkhunt.operators import plots
from sparkhunt.plans.plotting import plot_data

# -- bounds, scaling, distributions --------------------------------------------------------


@query(
    "outlier_bounds_stddev",
    "select round(avg(l_quantity) - 3 * stddev_samp(l_quantity), 6) as lower, round(avg(l_quantity) + 3 * stddev_samp(l_quantity), 6) as upper from lineitem",
)
def _(t):
    b = agg.outlier_bounds_stddev(t("lineitem"), "l_quantity")
    return b.select(F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))


@query(
    "outlier_bounds_iqr",
    """select round(q1 - 1.5 * (q3 - q1), 6) as lower, round(q3 + 1.5 * (q3 - q1), 6) as upper from
       (select quantile_cont(l_extendedprice, 0.25) as q1, quantile_cont(l_extendedprice, 0.75) as q3 from lineitem)""",
)
def _(t):
    b = agg.outlier_bounds_iqr(t("lineitem"), "l_extendedprice")
    return b.select(F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"))


@query(
    "minmax_scale",
    """select l_orderkey, l_linenumber, round((l_extendedprice - a) / (b - a), 6) as price, round((l_quantity - c) / (d - c), 6) as quantity, 0.0e0 as constant
       from lineitem, (select min(l_extendedprice) as a, max(l_extendedprice) as b, min(l_quantity) as c, max(l_quantity) as d from lineitem)""",
)
def _(t):
    df = t("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"),
        F.lit(7).alias("constant"),
    )
    scaled = agg.minmax_scale(df, ["price", "quantity", "constant"])
    return scaled.withColumns({n: F.round(n, 6) for n in ("price", "quantity")})


@query(
    "histogram10",
    """with e as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem),
       h as (select cast(least(floor((l_extendedprice - lo) / ((hi - lo) / 10)), 9) as int) as bin, count(*) as n from lineitem, e group by 1)
       select cast(b.range as int) as bin, round(lo + b.range * ((hi - lo) / 10), 6) as low, round(lo + (b.range + 1) * ((hi - lo) / 10), 6) as high, coalesce(n, 0) as n
       from range(10) b cross join e left join h on h.bin = b.range""",
)
def _(t):
    h = agg.histogram10(t("lineitem"), "l_extendedprice")
    return h.withColumns({n: F.round(n, 6) for n in ("low", "high")})


def _box(col: str) -> str:
    return f"""select '{col}' as attr, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
      round(least((select min({col}) from lineitem where {col} >= q1 - 1.5 * (q3 - q1)), q1), 6) as whisker_low,
      round(greatest((select max({col}) from lineitem where {col} <= q3 + 1.5 * (q3 - q1)), q3), 6) as whisker_high,
      (select count(*) from lineitem where {col} < q1 - 1.5 * (q3 - q1) or {col} > q3 + 1.5 * (q3 - q1)) as n_outliers
      from (select quantile_cont({col}, 0.25) as q1, quantile_cont({col}, 0.5) as median, quantile_cont({col}, 0.75) as q3 from lineitem)"""


@query("boxplot_stats", " union all ".join(_box(x) for x in ("l_quantity", "l_extendedprice", "l_discount")))
def _(t):
    b = agg.boxplot_stats(t("lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return b.withColumns({n: F.round(n, 6) for n in agg._BOX})


def _outside(x: str) -> str:
    return f"select '{x}' as attr, {x}::double as value from lineitem, (select quantile_cont({x}::double, 0.25) as a, quantile_cont({x}::double, 0.75) as b from lineitem) q where {x} < a - 0.5 * (b - a) or {x} > b + 0.5 * (b - a)"


@query("boxplot_outliers", " union all ".join(_outside(x) for x in ("l_quantity", "l_extendedprice")))
def _(t):
    return agg.boxplot_outliers(t("lineitem"), ["l_quantity", "l_extendedprice"], 0.5)


@query("value_counts", "select l_returnflag || l_linestatus as value, count(*) as count from lineitem group by 1")
def _(t):
    df = t("lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("state"))
    return agg.value_counts(df, "state")


# -- time --------------------------------------------------------------------------------------


@query("time_bounds", "select strftime(min(ts), '%Y-%m-%d %H:%M:%S') as t0, strftime(max(ts), '%Y-%m-%d %H:%M:%S') as t1 from events")
def _(t):
    b = agg.time_bounds(t("v_connections"), "first_observed")
    text = lambda n: F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n)
    return b.select(text("t0"), text("t1"))


def _series(value: str) -> str:
    return f"""with g as (select unnest(generate_series((select date_trunc('day', min(ts)) from events), (select max(ts) from events), interval 1 day)) as d)
      select strftime(d, '%Y-%m-%d') as day, coalesce(v, 0) as value from g left join (select date_trunc('day', ts) as d2, {value} as v from events group by 1) x on d = d2"""


def _days(series):
    return series.select(F.date_format("time", "yyyy-MM-dd").alias("day"), "value")


@query("time_count", _series("count(event_type)"))
def _(t):
    return _days(agg.time_count(t("v_connections"), "first_observed", "dst_ip"))


@query("time_sum", _series("cast(sum(cast(floor(value * 100) as bigint)) as bigint)"))
def _(t):
    return _days(agg.time_sum(t("v_connections"), "first_observed", "src_byte_count"))


@query(
    "time_bucket",
    """select event_id, strftime(time_bucket(interval 12 hours, ts, timestamp '2000-01-01'), '%Y-%m-%d %H:%M') as half_day,
      strftime(date_trunc('week', ts) + interval 6 days, '%Y-%m-%d') as week, strftime(last_day(ts), '%Y-%m-%d') as month,
      strftime(time_bucket(interval 2 days, ts, timestamp '2024-01-01'), '%Y-%m-%d') as two_days from events""",
)
def _(t):
    ts, t0 = F.col("ts").cast("timestamp"), F.lit("2024-01-01 05:00:00").cast("timestamp")
    text = lambda rule, fmt: F.date_format(tp.time_bucket(ts, rule, t0), fmt)
    return t("events").select(
        "event_id",
        text("12H", "yyyy-MM-dd HH:mm").alias("half_day"),
        text("1W", "yyyy-MM-dd").alias("week"),
        text("1M", "yyyy-MM-dd").alias("month"),
        text("2D", "yyyy-MM-dd").alias("two_days"),
    )


_SPANS = "select user_id, event_type, epoch(max(ts)) - epoch(min(ts)) as span from events group by 1, 2"


def _pick_sql() -> str:
    rows = " ".join(f"when span between {10 * w} and {40 * w} then '{n}'" for w, n in tp.BUCKETS)
    return f"select user_id, event_type, case {rows} else '1M' end as bucket from ({_SPANS})"


@query("pick_bucket", _pick_sql())
def _(t):
    spans = t("events").groupBy("user_id", "event_type").agg(
        (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))).alias("us")
    )
    return spans.select("user_id", "event_type", tp.pick_bucket_of_span(F.col("us") / 1e6).alias("bucket"))


# -- columns and plots ----------------------------------------------------------------------------

_KINDS = """select attr, case when attr in ('first_observed') then case when (select bool_and(regexp_matches(first_observed, '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}(\\.\\d+)?Z')) from v_connections) then 'timestamp' else 'categorical' end
  when attr in ('src_port', 'src_byte_count') then 'numerical' else 'categorical' end as kind
  from (values ('first_observed'), ('src_port'), ('src_byte_count'), ('user_id'), ('dst_ip')) v(attr)"""


@query("feature_kind", _KINDS)
def _(t):
    return agg.feature_kinds(t("v_connections"), ["first_observed", "src_port", "src_byte_count", "user_id", "dst_ip"])


@query(
    "plot_kind",
    f"""with k as ({_KINDS}), p as (select a.attr as x, b.attr as y, a.kind as x_kind, b.kind as y_kind from k a, k b)
      select x, y, case when x_kind = 'categorical' and y_kind = 'numerical' then 'area' when x_kind = 'numerical' and y_kind = 'numerical' then 'scatter'
      when x_kind = 'timestamp' and y_kind = 'categorical' then 'time_count' when x_kind = 'timestamp' and y_kind = 'numerical' then 'time_sum' end as plot from p""",
)
def _(t):
    attrs = ["first_observed", "src_port", "src_byte_count", "user_id", "dst_ip"]
    kinds = agg.feature_kinds(t("v_connections"), attrs)
    ys = F.array(*[F.lit(a) for a in attrs])
    pairs = kinds.select(F.col("attr").alias("x"), F.col("kind").alias("x_kind"), F.explode(ys).alias("y"))
    pairs = pairs.join(kinds.select(F.col("attr").alias("y"), F.col("kind").alias("y_kind")), "y")
    return plots.plot_kinds(pairs).select("x", "y", "plot")


@query("plot_points", "select src_port as x, src_byte_count as y from v_connections")
def _(t):
    return plot_data(t("v_connections"), "src_port", "src_byte_count")


# -- calendar and entity profiles -------------------------------------------------------------------

_CAL = """
with cal0 as (select *, cast(floor(floor(epoch(ts)) / 3600) as bigint) as h, cast(floor(floor(epoch(ts)) / 86400) as bigint) as "Days"
  from (select a.*, e.ts from v_auth a join events e using (event_id)) q),
cal1 as (select *, cast((h + 48) % 168 as int) as timeofweek from cal0),
cal as (select *, src_ip as source, dst_ip as destination, user_id as username, cast(floor(timeofweek / 24) as int) as weekday, cast(floor((timeofweek % 24) / 6) as int) as "HourRange",
  cast(timeofweek < 24 as int) as "Mo", cast(timeofweek >= 24 and timeofweek < 48 as int) as "Tu", cast(timeofweek >= 48 and timeofweek < 72 as int) as "We",
  cast(timeofweek >= 72 and timeofweek < 96 as int) as "Th", cast(timeofweek >= 96 and timeofweek < 120 as int) as "Fr",
  cast(timeofweek >= 120 and timeofweek < 148 as int) as "Sa", cast(timeofweek >= 148 as int) as "Su",
  cast(floor((timeofweek % 24) / 6) = 0 as int) as "0to6", cast(floor((timeofweek % 24) / 6) = 1 as int) as "6to12",
  cast(floor((timeofweek % 24) / 6) = 2 as int) as "12to18", cast(floor((timeofweek % 24) / 6) = 3 as int) as "18to0" from cal1)
"""
FLAGS = [f'"{x}"' for x in tp.CALENDAR_FLAGS]
AUTH_NAMES = {"src_ip": "source", "dst_ip": "destination", "user_id": "username"}


@query("week_calendar", _CAL + f'select id, timeofweek, weekday, "HourRange", "Days", {", ".join(FLAGS)}, 1 as "NoOfRecords" from cal')
def _(t):
    cal = t("v_auth").select("id", tp.week_calendar(tp.epoch_seconds(F.col("first_observed"))).alias("w"))
    return cal.select("id", "w.*")


def _profile_sql(keys: str, distincts: str, pair: str) -> str:
    sums = ", ".join(f"cast(sum({x}) as bigint) as {x}" for x in FLAGS)
    return f"""base as (select {keys}, {distincts}, {sums}, count(*) as "NoOfRecords" from cal where {keys.split(',')[0]} is not null group by {keys}),
mean as (select {keys}, avg(n) as "Mean" from (select {keys}, "Days", count(*) as n from cal group by {keys}, "Days") group by {keys}),
most as (select {keys}, max(n) as "Max" from (select {keys}, {pair}, count(*) as n from cal group by {keys}, {pair}) group by {keys}),
prof as (select * from base join mean using ({keys}) join most using ({keys}))"""


PROFILES = {
    "source_profile": ("source", 'count(distinct username) as "F1", count(distinct destination) as destination', "destination", agg.source_profile),
    "user_profile": ("username", 'count(distinct source) as "F1", count(distinct destination) as "F2"', "destination", agg.user_profile),
    "user_domain_profile": ("username, domain", 'count(distinct source) as "F1", count(distinct destination) as "F2"', "destination", agg.user_domain_profile),
    "destination_profile": ("destination", 'count(distinct username) as "F1", count(distinct source) as "F2"', "source", agg.destination_profile),
}


def _auth(t):
    return t("v_auth", **AUTH_NAMES)


for _name, (_keys, _distincts, _pair, _fn) in PROFILES.items():

    @query(_name, _CAL + ", " + _profile_sql(_keys, _distincts, _pair) + ' select * replace (round("Mean", 6) as "Mean") from prof')
    def _(t, fn=_fn):
        return fn(_auth(t)).withColumn("Mean", F.round("Mean", 6))


@query(
    "mean_daily_count",
    _CAL + 'select username, round(avg(n), 6) as "Mean" from (select username, "Days", count(*) as n from cal group by 1, 2) group by 1',
)
def _(t):
    out = agg.mean_daily_count(agg.with_calendar(_auth(t)), ["username"])
    return out.select("username", F.round("Mean", 6).alias("Mean"))


@query(
    "max_pair_count",
    'select dst_ip as destination, max(n) as "Max" from (select dst_ip, src_ip, count(*) as n from v_auth group by 1, 2) group by 1',
)
def _(t):
    return agg.max_pair_count(_auth(t), ["destination"], "source")
