"""Sources, sinks, filters, projections, set operations and plain joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.catalog import CONN, HASHES, PROC, query
from sparkhunt import registry
from sparkhunt.names import c
from sparkhunt.operators import filters as fl
from sparkhunt.operators import joins as jn
from sparkhunt.session import scratch_path
from sparkhunt.sources import entities as io

AUTH = {"src_ip": "src_ref.value", "dst_ip": "dst_ref.value"}


def observations(t):
    return t.sql("select id, first_observed from v_auth")


def users(t):
    return t.sql("select id, user_id from v_auth")


def connections(t):
    return t.sql("select id, src_ip, dst_ip, status from v_auth").withColumnsRenamed(AUTH)


# -- sources and sinks ---------------------------------------------------------------------


@query("scan_entities", "select event_id, event_type, value from events")
def _(t):
    return io.scan_entities(t.spark, f"{t.folder}/events.parquet").select("event_id", "event_type", "value")


@query(
    "scan_multi",
    """select o_orderkey, c_name, n_name from orders join customer on o_custkey = c_custkey
       join nation on c_nationkey = n_nationkey""",
)
def _(t):
    o, cu, n = io.scan_multi(t.spark, *[f"{t.folder}/{x}.parquet" for x in ("orders", "customer", "nation")])
    joined = o.join(cu, o["o_custkey"] == cu["c_custkey"]).join(n, cu["c_nationkey"] == n["n_nationkey"])
    return joined.select("o_orderkey", "c_name", "n_name")


@query("sink_parquet_gzip", "select id, src_ip, dst_ip, dst_port from v_connections")
def _(t):
    path = scratch_path(t.spark, "traffic")
    io.sink_parquet_gzip(t("v_connections").select("id", "src_ip", "dst_ip", "dst_port"), path)
    return io.scan_entities(t.spark, path)


_RECORD = "event_id bigint, url string, user_agent string"


@query("scan_json_records", "select event_id, url, user_agent from v_http")
def _(t):
    path = scratch_path(t.spark, "records")
    io.sink_json_records(t("v_http"), path)
    return io.scan_json_records(t.spark, path, _RECORD)


@query("sink_json_records", "select id, command_line from v_process where command_line is not null")
def _(t):
    path = scratch_path(t.spark, "processes")
    io.sink_json_records(t("v_process").select("id", "command_line").where("command_line is not null"), path)
    return io.scan_json_records(t.spark, path, "id string, command_line string")


_HISTOGRAM = """
select h.range as hour, b.range as bin, coalesce(n, 0) as n from range(24) h, range(6) b
left join (select extract(hour from ts) as hr, floor((extract(minute from ts) * 60 + floor(extract(second from ts))) / 600) as bi,
  count(*) as n from events group by 1, 2) x on x.hr = h.range and x.bi = b.range
"""
_HISTOGRAM_INT = f"select cast(hour as int) as hour, cast(bin as int) as bin, n from ({_HISTOGRAM})"


def _model(t):
    from sparkhunt.operators.aggregates import hourly_histogram

    return hourly_histogram(t("v_connections"))


@query("hour_model_save", _HISTOGRAM_INT)
def _(t):
    path = scratch_path(t.spark, "hours")
    io.hour_model_save(_model(t), path)
    return t.spark.read.parquet(path)


@query("hour_model_load", f"select hour, sum(n) as total from ({_HISTOGRAM_INT}) where n > 0 group by hour")
def _(t):
    path = scratch_path(t.spark, "hours")
    io.hour_model_save(_model(t), path)
    model = io.hour_model_load(t.spark, path)
    return model.where("n > 0").groupBy("hour").agg(F.sum("n").alias("total"))


@query(
    "literal_entities",
    """select value, count(*) as n from v_connections
       join (values ('9.59.150.142'), ('192.168.1.2')) v(value) on dst_ip = value group by value""",
)
def _(t):
    rows = [{"value": "9.59.150.142"}, {"value": "192.168.1.2"}]
    wanted = io.literal_entities(t.spark, rows, "value string")
    traffic = t("v_connections").select(F.col("dst_ip").alias("value"))
    return traffic.join(wanted, "value").groupBy("value").agg(F.count(F.lit(1)).alias("n"))


# -- filters and projections ------------------------------------------------------------------


@query("filter_attr_eq", "select id, pid from v_process where binary_name = 'powershell.exe'")
def _(t):
    return fl.filter_attr_eq(t("v_process", **PROC), "binary_ref.name", "powershell.exe").select("id", "pid")


@query("filter_attr_gt", "select id, dst_port from v_connections where dst_port > 443")
def _(t):
    return fl.filter_attr_gt(t("v_connections"), "dst_port", 443).select("id", "dst_port")


@query("filter_attr_like", "select id, value from v_url where value like '%$' || '{%'")
def _(t):
    return fl.filter_attr_like(t("v_url"), "value", "%${%").select("id", "value")


@query("filter_attr_regex", "select id, value from v_url where regexp_matches(value, 'blog[.][a-z]+')")
def _(t):
    return fl.filter_attr_regex(t("v_url"), "value", "blog[.][a-z]+").select("id", "value")


@query(
    "filter_time_range",
    "select event_id, user_id from events where ts >= timestamp '2024-01-05 06:00:00' and ts < timestamp '2024-01-20 00:00:00'",
)
def _(t):
    rows = fl.filter_time_range(t("events"), "ts", "2024-01-05 06:00:00", "2024-01-20 00:00:00")
    return rows.select("event_id", "user_id")


@query(
    "filter_last_days",
    "select event_id from events where ts >= (select max(ts) from events) - interval 7 days",
)
def _(t):
    anchor = t("events").agg(F.max("ts").alias("m")).select("m").scalar()
    return fl.filter_last_days(t("events"), "ts", 7, anchor).select("event_id")


@query("project_attrs", "select id, src_ip, dst_port from v_connections")
def _(t):
    rows = fl.project_attrs(t("v_connections", **CONN), ["id", "src_ref.value", "dst_port"])
    return rows.withColumnRenamed("src_ref.value", "src_ip")


@query(
    "add_row_attr",
    """select event_id, 'newval' || cast(row_number() over (order by event_id) - 1 as string) as x_new_attr from events""",
)
def _(t):
    return fl.add_row_attr(t("events").select("event_id"), "event_id")


@query("clean_column_names", "select h_sha1 as \"hashes_SHA-1\", p_partkey from v_file")
def _(t):
    clean = fl.clean_column_names(t("v_file", **HASHES))
    return clean.select(c("hashes.SHA-1").alias("hashes_SHA-1"), "p_partkey")


@query(
    "entity_type_dispatch",
    """select id, case when type in ('ipv4-addr','ipv6-addr') then 'ipr' when type in ('domain-name','url') then 'url'
       when type = 'file' then 'malware' end as x_endpoint,
       case when type = 'file' then coalesce(h_md5, h_sha1, h_sha256) when type <> 'process' then value end as x_observable
       from v_entities""",
)
def _(t):
    return fl.entity_type_dispatch(t("v_entities", **HASHES)).select("id", "x_endpoint", "x_observable")


@query("first_hash", "select id, coalesce(h_md5, h_sha1, h_sha256) as x_hash from v_file")
def _(t):
    df = t("v_file", **HASHES)
    return df.select("id", fl.first_hash(df).alias("x_hash"))


@query(
    "outlier_mask",
    """select event_id, (value < lo or value > hi) as outlier from events,
       (select avg(value) - 1.5 * stddev_samp(value) as lo, avg(value) + 1.5 * stddev_samp(value) as hi from events)""",
)
def _(t):
    from sparkhunt.operators.aggregates import outlier_bounds_stddev

    bounds = outlier_bounds_stddev(t("events"), "value", 1.5).select(F.struct("lower", "upper").alias("b")).scalar()
    mask = fl.outlier_mask(F.col("value"), bounds["lower"], bounds["upper"])
    return t("events").select("event_id", mask.alias("outlier"))


@query("drop_falsy", "select id, command_line from v_process where command_line is not null and command_line <> ''")
def _(t):
    return fl.drop_falsy(t("v_process"), "command_line").select("id", "command_line")


@query(
    "split_by_status",
    """select 'benign' as part, id from v_auth where starts_with(status, 'benign')
       union all select 'unknown', id from v_auth where starts_with(status, 'unknown')""",
)
def _(t):
    auth = t("v_auth")
    part = lambda p: fl.split_by_status(auth, p).select(F.lit(p).alias("part"), "id")
    return part("benign").unionAll(part("unknown"))


@query("distinct_values", "select distinct dst_ip from v_connections")
def _(t):
    return fl.distinct_values(t("v_connections"), "dst_ip")


@query(
    "traffic_ip_list",
    "select distinct src_ip as ip from v_connections union all select distinct dst_ip from v_connections",
)
def _(t):
    return fl.traffic_ip_list(t("v_connections", **CONN))


@query(
    "union_labeled",
    """select id, status from v_auth where status in ('benign', 'malicious')
       union all select id, case when event_id % 2 = 0 then 'benign' else 'malicious' end from v_auth where status = 'unknown'""",
)
def _(t):
    auth = t("v_auth")
    guess = F.when(F.col("event_id") % 2 == 0, "benign").otherwise("malicious")
    unknown = fl.split_by_status(auth, "unknown").select("id", guess.alias("status"))
    known = [fl.split_by_status(auth, s).select("id", "status") for s in ("benign", "malicious")]
    return fl.union_labeled(*known, unknown)


@query(
    "map_center",
    "select lat, lon from v_geo_event where s_suppkey = (select min(s_suppkey) from v_geo_event)",
)
def _(t):
    return fl.map_center(t("v_geo_event"), "lat", "lon", "s_suppkey")


_LABEL = "action || chr(10) || coalesce(cast(outcome as string), 'None')"


@query("geo_label", f"select s_suppkey, {_LABEL} as label from v_geo_event")
def _(t):
    return t("v_geo_event").select("s_suppkey", fl.geo_label(F.col("action"), F.col("outcome")).alias("label"))


@query("geo_markers", f"select lat, lon, {_LABEL} as label from v_geo_event")
def _(t):
    return fl.geo_markers(t("v_geo_event"), "lat", "lon", ["action", "outcome"])


# -- joins ---------------------------------------------------------------------------------------


@query(
    "assemble_auth_requests",
    "select id, user_id, src_ip, dst_ip, status, first_observed from v_auth",
)
def _(t):
    joined = jn.assemble_auth_requests(observations(t), users(t), connections(t))
    return joined.withColumnsRenamed({v: k for k, v in AUTH.items()})


@query(
    "linked_entities",
    "select id, src_ip, dst_ip, status from v_auth where user_id in ('u1', 'u2', 'u3')",
)
def _(t):
    chosen = users(t).where(F.col("user_id").isin("u1", "u2", "u3"))
    return jn.linked_entities(chosen, connections(t)).withColumnsRenamed({v: k for k, v in AUTH.items()})


@query(
    "guid_totals_backjoin",
    """select id, coalesce(total, 0) as connections from v_process p left join
       (select x_guid, cast(sum(x_opened_connection_count) as bigint) as total from v_process where x_guid is not null group by x_guid) g
       on p.x_guid = g.x_guid""",
)
def _(t):
    return jn.guid_totals_backjoin(t("v_process")).select("id", "connections")


@query(
    "writeback_by_id",
    "select id, first_observed, user_id, status from v_auth where status = 'unknown'",
)
def _(t):
    result = t.sql("select id, user_id, status from v_auth where status = 'unknown'")
    return jn.writeback_by_id(observations(t), result, ["user_id", "status"])


@query(
    "hostname_resolve",
    """select event_id, hostname, addr from (select event_id, 'h' || cast(event_id % 25 as string) || '.evil.example' as hostname
       from events) e left join v_dns using (hostname)""",
)
def _(t):
    hosts = t.sql("select event_id, 'h' || cast(event_id % 25 as string) || '.evil.example' as hostname from events")
    return jn.hostname_resolve(hosts, t("v_dns")).select("event_id", "hostname", "addr")


# -- registry ----------------------------------------------------------------------------------------


@query("apply_analytic", f"select lat, lon, {_LABEL} as label from v_geo_event")
def _(t):
    return registry.apply_analytic("geo-markers", t("v_geo_event"), lat="lat", lon="lon", labels=["action", "outcome"])
