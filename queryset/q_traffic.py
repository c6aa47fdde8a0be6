"""Traffic classes, the hour model, enrichment, address ranges and whois."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.catalog import CONN, HASHES, query

from sparkhunt.functions import intel, ipaddr, timeparts as tp, whois as wh
from sparkhunt.functions.whois_rules import COUNTRY_CODES, LINE_RULES, MONTHS
from sparkhunt.names import c
from sparkhunt.operators import aggregates as agg
from sparkhunt.operators import geo
from sparkhunt.operators import joins as jn
from sparkhunt.plans import enrichment, exfiltration

# -- address classes and categories ---------------------------------------------------------


def _number(ip: str) -> str:
    parts = f"string_split({ip}, '.')"
    return " + ".join(f"cast({parts}[{i + 1}] as bigint) * {256 ** (3 - i)}" for i in range(4))


def _in(number: str, networks) -> str:
    spans = " or ".join(f"({number} between {a} and {b})" for a, b in ipaddr.merged_ranges(networks))
    return f"({spans})"


_PRIVATE = "(" + _in("{n}", ipaddr.PRIVATE_NETWORKS) + " and {n} not in (3221225481, 3221225482))"
_ENDS = f"""
with ends as (select *, {_number('src_ip')} as sn, {_number('dst_ip')} as dn from v_connections),
cls as (select *, {_PRIVATE.replace('{n}', 'sn')} as sp, {_PRIVATE.replace('{n}', 'dn')} as dp,
  {_in('sn', ['9.0.0.0/8'])} as si, {_in('dn', ['9.0.0.0/8'])} as di from ends),
cat as (select *, case when src_ip = '9.59.150.142' then 'Sensitive->' when sp then 'Private->' when si then 'IBM->'
  when not dp and not di then 'External->' else 'Unknown-' end
  || case when not dp and not di then 'External' when di then 'IBM' else 'Unknown' end as category from cls)
"""


@query("ip_is_private", _ENDS + "select id, sp as src_private, dp as dst_private from cls")
def _(t):
    return t("v_connections").select(
        "id",
        ipaddr.ip_is_private(F.col("src_ip")).alias("src_private"),
        ipaddr.ip_is_private(F.col("dst_ip")).alias("dst_private"),
    )


@query("traffic_category", _ENDS + "select id, category from cat")
def _(t):
    return t("v_connections").select(
        "id", ipaddr.traffic_category(F.col("src_ip"), F.col("dst_ip")).alias("category")
    )


@query(
    "ip_is_private_6",
    "select event_id, case when event_id % 10 in (0, 1, 3, 6, 9) then true when event_id % 10 = 7 then null else false end as private from v_addresses",
)
def _(t):
    return t("v_addresses").select("event_id", ipaddr.ip_is_private(F.col("ip")).alias("private"))


@query(
    "cidr_membership_6",
    "select event_id, case when event_id % 10 = 7 then null else event_id % 10 in (2, 6, 9) end as in_network from v_addresses",
)
def _(t):
    nets = ["2606:4700::/32", "fd00::/31", "fd00:1:2::/48", "10.2.0.0/16"]
    return jn.cidr_membership(t("v_addresses"), "ip", nets).select("event_id", "in_network")


_NETS = ["10.1.0.0/16", "10.1.4.0/24", "172.16.0.0/25", "203.0.64.0/18"]


@query("cidr_membership", f"select id, {_in(_number('dst_ip'), _NETS)} as in_network from v_connections")
def _(t):
    return jn.cidr_membership(t("v_connections", **CONN), "dst_ref.value", _NETS).select("id", "in_network")


# -- hour model --------------------------------------------------------------------------------

_HOURS = """
with grid as (select h.range as hour, b.range as bin from range(24) h, range(6) b),
cnt as (select extract(hour from ts) as hour, cast(floor((extract(minute from ts) * 60 + floor(extract(second from ts))) / 600) as bigint) as bin,
  count(*) as n from events group by 1, 2),
model as (select cast(grid.hour as int) as hour, cast(grid.bin as int) as bin, coalesce(n, 0) as n from grid left join cnt using (hour, bin)),
total as (select hour, sum(n) as total from model group by hour),
rowed as (select c.*, extract(hour from ts) as hour, cast(floor((extract(minute from ts) * 60 + floor(extract(second from ts))) / 600) as bigint) as bin from v_connections c)
"""


@query("hourly_histogram", _HOURS + "select * from model")
def _(t):
    return agg.hourly_histogram(t("v_connections"))


@query(
    "hour_model_join",
    _HOURS + "select id, m.n, cast(total as bigint) as total from rowed r join model m on m.hour = r.hour and m.bin = r.bin join total s on s.hour = r.hour",
)
def _(t):
    df = t("v_connections")
    return jn.hour_model_join(df, agg.hourly_histogram(df)).select("id", "n", "total")


_PROB = "round(1 - cast(m.n as double) / cast(total as double), 6)"


@query(
    "exfil_probability",
    _HOURS + f"select id, {_PROB} as p from rowed r join model m on m.hour = r.hour and m.bin = r.bin join total s on s.hour = r.hour",
)
def _(t):
    df = t("v_connections")
    joined = jn.hour_model_join(df, agg.hourly_histogram(df))
    return joined.select("id", F.round(ipaddr.exfil_probability(F.col("n"), F.col("total")), 6).alias("p"))


@query(
    "exfiltration",
    _ENDS + ", " + _HOURS.strip()[len("with ") :]
    + f" select r.id, category, {_PROB} as p from rowed r join model m on m.hour = r.hour and m.bin = r.bin join total s on s.hour = r.hour join cat on cat.id = r.id",
)
def _(t):
    df = t("v_connections", **CONN)
    out = exfiltration.exfiltration(df, agg.hourly_histogram(df))
    return out.select(
        "id", F.col("x_possible_exfil_op").alias("category"), F.round("x_exfil_op_probability", 6).alias("p")
    )


@query(
    "iso_time_parts",
    "select id, cast(extract(hour from ts) as int) as hour, cast(extract(minute from ts) as int) as minute, cast(floor(extract(second from ts)) as int) as second from v_connections",
)
def _(t):
    return t("v_connections").select("id", tp.iso_time_parts(c("first_observed")).alias("p")).select("id", "p.*")


@query("epoch_seconds", "select id, cast(floor(epoch(ts)) as bigint) as epoch from v_connections")
def _(t):
    return t("v_connections").select("id", tp.epoch_seconds(c("first_observed")).alias("epoch"))


# -- intelligence lookups -----------------------------------------------------------------------

_SANS = """
docs as (select ip, json_extract(doc, '$.ip') as j from v_intel_ip where json_extract(doc, '$.ip') is not null),
fields as (select ip, coalesce(cast(json_extract(j, '$.attacks') as bigint), 0) as attacks, j->>'$.ascountry' as ascountry, j->>'$.asname' as asname,
  array_to_string(json_keys(j, '$.threatfeeds'), ',') as threatfeeds,
  list_min(list_transform(json_keys(j, '$.threatfeeds'), lambda k: j->>('$.threatfeeds.' || k || '.firstseen'))) as firstseen,
  list_max(list_transform(json_keys(j, '$.threatfeeds'), lambda k: j->>('$.threatfeeds.' || k || '.lastseen'))) as lastseen from docs)
"""
_SANS_NAMES = ("attacks", "ascountry", "asname", "threatfeeds", "firstseen", "lastseen")


@query("sans_fields", "with " + _SANS + "select * from fields")
def _(t):
    parsed = t("v_intel_ip").select("ip", intel.sans_fields(c("doc")).alias("f")).where("f is not null")
    return parsed.select("ip", "f.*")


@query("feed_span", "with " + _SANS + "select ip, firstseen, lastseen from fields where threatfeeds is not null")
def _(t):
    feeds = t("v_intel_ip").select("ip", intel.parse_ip_doc(c("doc"))["threatfeeds"].alias("m")).where("m is not null")
    return feeds.select("ip", intel.feed_span(F.col("m")).alias("s")).select("ip", "s.*")


@query(
    "intel_ip_enrich",
    "with " + _SANS + "select id, " + ", ".join(f"{x}.{n} as {x}_{n}" for x in ("s", "d") for n in _SANS_NAMES)
    + " from v_connections v left join fields s on s.ip = v.src_ip left join fields d on d.ip = v.dst_ip",
)
def _(t):
    out = jn.intel_ip_enrich(t("v_connections", **CONN), t("v_intel_ip"))
    ends = {"s": "src_ref.value", "d": "dst_ref.value"}
    return out.select("id", *[c(f"x_{a}_{n}").alias(f"{x}_{n}") for x, a in ends.items() for n in _SANS_NAMES])


_XFE = """
docs as (select endpoint, observable, case endpoint when 'url' then json_extract(doc, '$.result') when 'malware' then json_extract(doc, '$.malware') else doc::json end as j from v_intel_indicator),
hist as (select *, json_extract(j, '$.history[#-1].asns') as asns from docs),
fields as (select endpoint, observable,
  case when endpoint <> 'malware' and len(json_keys(j, '$.cats')) > 0 then array_to_string(json_keys(j, '$.cats'), ',') end as cats,
  case when endpoint <> 'malware' then cast(j->>'$.score' as double) end as score,
  case when endpoint = 'ipr' then j->>'$.geo.country' end as geo,
  case when endpoint = 'ipr' then list_filter(list_transform(json_keys(asns), lambda k:
     case when coalesce(asns->>('$.' || k || '.removed'), 'false') = 'false' then nullif(asns->>('$.' || k || '.Company'), '') end), lambda x: x is not null)[1] end as company,
  case when endpoint = 'malware' then j->>'$.risk' end as risk,
  case when endpoint = 'malware' then j->>'$.family[0]' end as family from hist)
"""
_XFE_NAMES = ("cats", "score", "geo", "company", "risk", "family")


def _flat(prefix):
    return [
        F.array_join(c(f"{prefix}{n}"), ",").alias(n) if n in ("cats", "family") else c(f"{prefix}{n}").alias(n)
        for n in _XFE_NAMES
    ]


@query("xfe_fields", "with " + _XFE + "select endpoint, observable, " + ", ".join(_XFE_NAMES) + " from fields")
def _(t):
    f = t("v_intel_indicator").select("endpoint", "observable", intel.xfe_fields(c("doc"), c("endpoint")).alias("f"))
    return f.select("endpoint", "observable", "f.*").select("endpoint", "observable", *_flat(""))


@query("xfe_company", "with " + _XFE + "select observable, company from fields where endpoint = 'ipr'")
def _(t):
    rows = t("v_intel_indicator").where("endpoint = 'ipr'")
    return rows.select("observable", intel.xfe_company(c("doc")).alias("company"))


@query(
    "intel_observable_enrich",
    "with " + _XFE + "select id, " + ", ".join(_XFE_NAMES) + """ from v_entities e left join fields f on f.endpoint =
      case when type in ('ipv4-addr','ipv6-addr') then 'ipr' when type in ('domain-name','url') then 'url' when type = 'file' then 'malware' end
      and f.observable = case when type = 'file' then coalesce(h_md5, h_sha1, h_sha256) else value end""",
)
def _(t):
    return jn.intel_observable_enrich(t("v_entities", **HASHES), t("v_intel_indicator")).select("id", *_flat("x_xfe_"))


_CUT = "regexp_replace(ltrim(string_split({0}, ':')[1]), '\\.$', '')"


@query(
    "ip_domain_enrich",
    f"""select id, coalesce({_CUT.format('ptr')}, '') as x_domain_name, coalesce({_CUT.format('organization')}, '') as x_domain_organization
        from v_connections v left join v_ptr p on p.ip = v.dst_ip left join v_organizations o on o.ip = v.dst_ip""",
)
def _(t):
    out = jn.ip_domain_enrich(t("v_connections", **CONN), t("v_ptr"), t("v_organizations"))
    return out.select("id", "x_domain_name", "x_domain_organization")


@query(
    "ptr_org_fields",
    "select ip, regexp_replace(ltrim(string_split(rtrim('ptr: ' || ptr), ':')[2]), '\\.$', '') as name from v_ptr",
)
def _(t):
    return t("v_ptr").select("ip", wh.ptr_org_fields(F.concat(F.lit("ptr: "), "ptr")).alias("name"))


_GEO = f"""
with ips as (select ip, {_number('ip')} as n from (select src_ip as ip from v_connections union select dst_ip from v_connections)),
geo as (select ip, latitude, longitude from ips join v_geo_blocks on n between start_ip and end_ip)
"""


@query("ip_geolocate", _GEO + "select * from geo")
def _(t):
    v = t("v_connections")
    ips = v.select(c("src_ip").alias("ip")).unionAll(v.select(c("dst_ip").alias("ip")))
    return geo.ip_geolocate(ips, t("v_geo_blocks"), "ip")


@query(
    "ip_geolocate_nested",
    """
    with p as (select ip, n4, k6 from v_geo_points group by all),
    hits as (
      select ip, latitude, longitude, n4 - low4 as d4, null as low6, high4 - low4 as wide, null as high6 from p join v_geo_networks on n4 between low4 and high4
      union all select ip, latitude, longitude, null, low6, null, high6 from p join v_geo_networks on k6 between low6 and high6
    )
    select ip, latitude::double as latitude, longitude::double as longitude from hits qualify row_number() over (partition by ip order by d4, wide, low6 desc, high6) = 1
    """,
)
def _(t):
    return geo.ip_geolocate(t("v_geo_points"), t("v_geo_networks"), "ip")


@query(
    "pin_ips",
    _GEO + "select geo.* from geo join (select distinct src_ip as ip from v_connections union all select distinct dst_ip from v_connections) using (ip)",
)
def _(t):
    return enrichment.pin_ips(t("v_connections", **CONN), t("v_geo_blocks"))


# -- whois -------------------------------------------------------------------------------------------


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _country(x: str) -> str:
    rows = " ".join(f"when {_q(k)} then {_q(v)}" for k, v in COUNTRY_CODES)
    return f"case upper({x}) {rows} else upper({x}) end"


def _value(regex: str, template: str, flags: str) -> str:
    x = f"regexp_extract(l, {_q(regex)}, 1)" if template == "%1" else _q("" if template == "%" else template)
    return _country(x) if "M" in flags else x


def _rule_case(what) -> str:
    rows = " ".join(f"when regexp_matches(l, {_q(r[0])}) then {what(i, r)}" for i, r in enumerate(LINE_RULES, 1))
    return f"case {rows} end"


_CLEAN = "regexp_replace(regexp_replace({0}, '\\s*$', ''), '\\.$', '')"
_FLAGS = "case r " + " ".join(f"when {i} then {_q(x[3])}" for i, x in enumerate(LINE_RULES, 1)) + " end"
_TAG = "case r " + " ".join(f"when {i} then {_q(x[1])}" for i, x in enumerate(LINE_RULES, 1)) + " end"
_VAL = "case r " + " ".join(f"when {i} then {_value(x[0], x[2], x[3])}" for i, x in enumerate(LINE_RULES, 1)) + " end"


def _parse(name: str, source: str) -> str:
    """CTEs that add rule number, tag, value and flags to rows with a cleaned line ``l``."""
    return f"""{name}_r as materialized (select *, {_rule_case(lambda i, r: str(i))} as r from ({source}) s),
{name} as materialized (select *, {_TAG} as tag, {_VAL} as value, {_FLAGS} as flags from {name}_r)"""


_PARSED = "with " + _parse("parsed", f"select ip, line_no, {_CLEAN.format('line')} as l from v_whois_text")


@query("whois_parse", _PARSED + " select ip, line_no, tag, value, flags, r as rule_no from parsed where r is not null")
def _(t):
    return wh.whois_parse(t("v_whois_text"))


_MULTI = f"""with recursive base as (select ip, line_no, line as raw, {_CLEAN.format('line')} as l,
   lead(line) over (partition by ip order by line_no) as nxt from v_whois_text),
{_parse('first', 'select * from base')},
walk(ip, line_no) as (select ip, min(line_no) from first group by ip union all
  select w.ip, w.line_no + case when f.tag in ('+wrap', '@join') and f.nxt is not null then 2 else 1 end from walk w join first f on f.ip = w.ip and f.line_no = w.line_no),
glued as (select f.*, w.line_no is null as used from first f left join walk w on w.ip = f.ip and w.line_no = f.line_no),
{_parse('second', "select ip, line_no, raw, used, case when tag = '+wrap' and nxt is not null then l || ' ' || nxt when tag = '@join' and nxt is not null then l || nxt else l end as l from glued")},
kept as (select * from second where not coalesce(used, false)),
seg as (select *, sum(case when tag = '@nslist' then 1 else 0 end) over (partition by ip order by line_no) as seg,
  coalesce(tag = '@nslist', false) as start, regexp_matches(raw, '^\\s*$') as blank, regexp_matches(raw, '^\\S+:') as label, regexp_matches(raw, '^\\s+\\S') as indented from kept),
cls as (select *, not start and not blank and not label as server, bool_or(start and value <> '') over (partition by ip, seg) as strict from seg),
srv as (select *, min(case when server then line_no end) over (partition by ip, seg) as first_server from cls),
ended as (select *, min(case when not start and (label or (blank and line_no > first_server) or (server and not indented and strict)) then line_no end) over (partition by ip, seg) as stop from srv),
multi as materialized (
  select ip, line_no, 'ns' as tag, regexp_extract(raw, '^\\s*(\\S+)', 1) as value, '' as flags from ended where seg > 0 and server and (stop is null or line_no < stop)
  union all
  select ip, line_no, case when tag = '@nslist' then 'ns' else tag end, case when tag in ('ns', '@nslist') then lower(value) else value end, flags from ended
  where r is not null and tag not in ('+wrap', '@join') and value <> '' and not (seg > 0 and server and (stop is null or line_no < stop)))
"""


@query("whois_multiline", _MULTI + "select ip, line_no, tag, value from multi")
def _(t):
    return wh.whois_multiline(t("v_whois_text")).select("ip", "line_no", "tag", "value")


_FIRST = """, vals as materialized (select ip, tag, coalesce(arg_max(value, line_no) filter (flags <> ''), arg_min(value, line_no) filter (flags = '')) as value
  from multi where tag <> 'ns' group by ip, tag
  union all select ip, 'ns', string_agg(value, ',' order by line_no) from multi where tag = 'ns' and value <> '' group by ip)"""


def _values(t):
    return wh.first_wins_tag(wh.whois_multiline(t("v_whois_text")))


@query("first_wins_tag", _MULTI + _FIRST + " select ip, tag, value from vals")
def _(t):
    return _values(t)


_RENAMED = _FIRST + """, named as (select *, case tag when 'whois' then 'registrar' when 'registered' then 'created' else tag end as target from vals),
 renamed as (select ip, target as tag, value from named n where tag = target or not exists (select 1 from vals v where v.ip = n.ip and v.tag = n.target))"""


@query("whois_tag_rename", _MULTI + _RENAMED + " select ip, tag, value from renamed")
def _(t):
    return wh.whois_tag_rename(_values(t))


@query(
    "sorted_tags",
    _MULTI + _RENAMED + " select ip, string_agg(tag || ': ' || value, chr(10) order by tag || ': ' || value) as tags from renamed group by ip",
)
def _(t):
    return wh.sorted_tags(wh.whois_tag_rename(_values(t)))


_NAMES = """select event_id, case event_id % 9 when 0 then '10.1.2.' || cast(event_id % 200 as string) when 1 then 'a.b.example.com'
  when 2 then 'www.uni' || cast(event_id % 50 as string) || '.edu' when 3 then 'x.y.co.uk' when 4 then 'de' when 5 then 'example.de' when 6 then 'a.b.example.org'
  when 7 then 'm.w.x.y.z.fr' else 'example.com' end as name from events"""


@query(
    "whois_domain_key",
    f"""select event_id, case when regexp_full_match(name, '[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+') then name
      when regexp_matches(name, '\\.(com|edu)$') then array_to_string(string_split(name, '.')[-2:], '.')
      when regexp_matches(name, '\\...$') then array_to_string(string_split(name, '.')[-3:], '.') else name end as domain from ({_NAMES})""",
)
def _(t):
    return t.sql(_NAMES).select("event_id", wh.whois_domain_key(F.col("name")).alias("domain"))


@query(
    "whois_country_map",
    f"select event_id, {_country('country')} as code from (select event_id, case event_id % 4 when 0 then 'United States' when 1 then 'croatia/Hrvatska' when 2 then 'Iceland' else 'Poland' end as country from events)",
)
def _(t):
    rows = t.sql("select event_id, case event_id % 4 when 0 then 'United States' when 1 then 'croatia/Hrvatska' when 2 then 'Iceland' else 'Poland' end as country from events")
    return rows.select("event_id", wh.whois_country_map(F.col("country")).alias("code"))


_MONTH = "case lower({0}) " + " ".join(f"when '{k}' then {v}" for k, v in MONTHS) + " end"


def _date_case() -> str:
    """Epoch text of a cleaned date ``d``."""
    def epoch(y, m, d):
        text = f"printf('%04d-%02d-%02d', try_cast({y} as int), try_cast({m} as int), try_cast({d} as int))"
        return f"cast(cast(epoch(try_cast({text} as date)) as bigint) as string)"

    def group(regex, n):
        return f"regexp_extract(d, {_q(regex)}, {n})"

    def plain(regex, y, m, d, extra="true"):
        return f"when regexp_matches(d, {_q(regex)}) and {extra} then {epoch(group(regex, y), group(regex, m), group(regex, d))}"

    def named(regex, y, m, d):
        month = _MONTH.format(group(regex, m))
        return f"when regexp_matches(d, {_q(regex)}) and {month} is not null then {epoch(group(regex, y), month, group(regex, d))}"

    # The date layouts, in their order.
    compact = "^([0-9]{4})([0-9]{2})([0-9]{2})\\s*"
    num = lambda n: f"try_cast({group(compact, n)} as int)"
    slashed = "^([0-9]+)[/\\-.]([0-9]+)[/\\-.]([0-9]{4})\\s*"
    one, two = (f"try_cast({group(slashed, n)} as int) > 12" for n in (1, 2))
    rows = [
        plain(compact, 1, 2, 3, f"{num(1)} > 1990 and {num(1)} < 2040 and {num(2)} between 1 and 12 and {num(3)} between 1 and 31"),
        plain("^([0-9]{4})[\\-./]\\s*([0-9]{2})[\\-./]\\s*([0-9]{2})\\s*", 1, 2, 3),
        plain("^([0-9]{4})[\\-./]\\s*([0-9])[\\-./]\\s*([0-9]{2})\\s*", 1, 2, 3),
        named("^([0-9]{2})-([A-Za-z]+)-([0-9]{4})\\s*", 3, 2, 1),
        named("^[A-Z][a-z][a-z], ([A-Za-z]+) ([0-9]+), ([0-9]{4})$", 3, 1, 2),
        named("^([0-9]*) ([A-Za-z]+) ([0-9]{4})\\s*", 3, 2, 1),
        named("^[A-Z][a-z][a-z] ([A-Za-z]+) ([0-9]+) [0-9]{2}:[0-9]{2}:[0-9]{2} \\S+ ([0-9]{4})$", 3, 1, 2),
        named("^[A-Z][a-z][a-z] ([A-Za-z]+) ([0-9]+) ([0-9]{4})$", 3, 1, 2),
        named("^([0-9]{4})[\\-.]([A-Za-z]+)[\\-.]([0-9]+)\\s*", 1, 2, 3),
        named("^([0-9][0-9]?)-([A-Za-z]+)-([0-9]+)\\s*", 3, 2, 1),
        plain(slashed, 3, 1, 2, two),
        plain(slashed, 3, 2, 1, one),
        plain(slashed, 3, 1, 2),
    ]
    return f"case when d = 'null' then null {' '.join(rows)} when d = 'None' then '0' else d end"


_CLEAN_DATE = "regexp_replace(regexp_replace({0}, '\\s*#[0-9]*\\s*$', ''), '\\s*$', '')"


@query(
    "whois_date",
    f"select event_id, {_date_case()} as epoch from (select event_id, {_CLEAN_DATE.format('text')} as d from v_dates)",
)
def _(t):
    return t("v_dates").select("event_id", wh.whois_date(F.col("text")).alias("epoch"))


@query(
    "whois_report",
    _MULTI + _FIRST.replace("vals as", "raw_vals as", 1) + f""",
    dated as (select *, tag in ('created', 'updated', 'expires', 'registered') as dt, {_CLEAN_DATE.format('value')} as d from raw_vals),
    vals as materialized (select ip, tag, case when dt then epoch || ' ' || value else value end as value from (select *, {_date_case()} as epoch from dated) where not dt or epoch is not null)
    """ + _RENAMED[len(_FIRST):] + " select ip, tag, value from renamed",
)
def _(t):
    return wh.whois_report(_values(t))



