"""Process scoring: globs, rules, network outliers, PowerShell, log4j strings."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.catalog import PROC, query
from queryset.views import lit
from sparkhunt.functions import globs, log4shell as l4, powershell as ps, rules as ru
from sparkhunt.names import c
from sparkhunt.operators import aggregates as agg
from sparkhunt.operators.joins import guid_totals
from sparkhunt.plans import process_scoring as sc

# -- globs and rules --------------------------------------------------------------------------


def _like(pattern: str) -> str:
    escaped = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    body = escaped.replace("*", "%").replace("?", "_")
    return f"coalesce(command_line like {lit('%' + body)} escape chr(92), false)".replace("chr(92)", "'\\'") \
        if "'" not in body else f"coalesce(command_line like {lit('%' + body)} escape '\\', false)"


GLOBS = " + ".join(f"cast({_like(p)} as int)" for p in globs.published_patterns())


@query("glob_score", f"select id, {GLOBS} as score from v_process")
def _(t):
    return t("v_process").select("id", globs.glob_score(F.col("command_line")).alias("score"))


_NAMES = {v: k for k, v in PROC.items()}


def _rule_sql(node) -> str:
    for kind, word in (("any", " or "), ("all", " and ")):
        if kind in node:
            return "(" + word.join(_rule_sql(n) for n in node[kind]) + ")"
    x = f"coalesce({_NAMES.get(node['name'], node['name'])}, '')"
    v = lit(node["value"])
    return {
        "contains": f"contains({x}, {v})",
        "equal_to": f"{x} = {v}",
        "not_equal_to": f"{x} <> {v}",
        "matches_regex": f"regexp_matches({x}, {v})",
    }[node["operator"]]


def _score_sql() -> str:
    parts = []
    for rule in ru.shipped_rules():
        value = rule["actions"][0]["params"] if rule["actions"][0]["name"] == "increment_property" else rule["actions"][1]["params"]
        parts.append(f"case when {_rule_sql(rule['conditions'])} then {float(value['value'])} else 0.0 end")
    return "cast(" + " + ".join(parts) + " as double)"


RULES = _score_sql()


def _technique_sql() -> str:
    pages = []
    for rule in ru.shipped_rules():
        for action in rule["actions"]:
            if action["name"] == "append_to_property":
                pages.append(f"case when {_rule_sql(rule['conditions'])} then {lit(action['params']['value'])} end")
    return f"array_to_string(list_sort(list_distinct([x for x in [{', '.join(pages)}] if x is not null])), ' ')"


@query("score_rules", f"select id, {RULES} as score, {_technique_sql()} as techniques from v_process")
def _(t):
    scored = ru.score_rules(t("v_process", **PROC), keep_techniques=True)
    return scored.select("id", F.col("x_suspicious_score").alias("score"), "techniques")


CUSTOM_RULES = [
    {
        "conditions": {"all": [{"name": "pid", "operator": "greater_than", "value": 500},
                               {"any": [{"name": "pid", "operator": "less_than_or_equal_to", "value": 900},
                                        {"name": "command_line", "operator": "starts_with", "value": "wget"}]}]},
        "actions": [{"name": "set_property", "params": {"name": "level", "value": 2}},
                    {"name": "decrement_property", "params": {"name": "x_suspicious_score", "value": 0.5}}],
    },
    {
        "conditions": {"all": [{"name": "level", "operator": "equal_to", "value": 2}]},
        "actions": [{"name": "increment_property", "params": {"name": "x_suspicious_score", "value": 3}}],
    },
]


@query(
    "rules_compile",
    """select id, case when hit then 2 end as level, case when hit then 2.5e0 else 0.0e0 end as score from
       (select id, pid > 500 and (pid <= 900 or starts_with(coalesce(command_line, ''), 'wget')) as hit from v_process)""",
)
def _(t):
    scored = ru.score_rules(t("v_process", **PROC), CUSTOM_RULES)
    return scored.select("id", "level", F.col("x_suspicious_score").alias("score"))


for _name, _fn, _test in (
    ("rule_contains", ru.rule_contains, "contains(x, 'net')"),
    ("rule_equal_to", ru.rule_equal_to, "x = 'net'"),
    ("rule_not_equal_to", ru.rule_not_equal_to, "x <> 'net'"),
    ("rule_matches_regex", ru.rule_matches_regex, "regexp_matches(x, 'net')"),
):

    @query(_name, f"select id, {_test} as hit from (select id, coalesce(command_line, '') as x from v_process)")
    def _(t, fn=_fn):
        return t("v_process").select("id", fn(F.col("command_line"), "net").alias("hit"))


_OPS = {"equal_to": "=", "greater_than": ">", "greater_than_or_equal_to": ">=", "less_than": "<", "less_than_or_equal_to": "<="}


@query(
    "rule_numeric_ops",
    "select id, " + ", ".join(f"coalesce(key_len {s} 36, false) as {n}" for n, s in _OPS.items())
    + " from (select id, length(key) as key_len from v_process)",
)
def _(t):
    x = F.length("key")
    return t("v_process").select("id", *[ru.rule_numeric_ops(n, x, 36).alias(n) for n in _OPS])


def _one_action(action: str, value, name: str):
    rule = {
        "conditions": {"any": [{"name": "command_line", "operator": "contains", "value": "chmod"}]},
        "actions": [{"name": action, "params": {"name": name, "value": value}}],
    }
    return lambda t: ru.score_rules(t("v_process", **PROC), [rule], keep_techniques=True)


_HIT = "contains(coalesce(command_line, ''), 'chmod')"


@query("rule_set_property", f"select id, case when {_HIT} then 7 else pid end as pid from v_process")
def _(t):
    return _one_action("set_property", 7, "pid")(t).select("id", "pid")


@query("rule_increment_property", f"select id, case when {_HIT} then 4.0e0 else 0.0e0 end as score from v_process")
def _(t):
    scored = _one_action("increment_property", 4, "x_suspicious_score")(t)
    return scored.select("id", F.col("x_suspicious_score").alias("score"))


@query("rule_decrement_property", f"select id, pid - case when {_HIT} then 3 else 0 end as pid from v_process")
def _(t):
    return _one_action("decrement_property", 3, "pid")(t).select("id", "pid")


@query(
    "rule_append_to_property",
    f"""select id, case when {_HIT} then array_to_string(list_sort(list_distinct([coalesce(x_guid, ''), 'T1'][case when x_guid is null then 2 else 1 end:])), ' ')
        else x_guid end as x_guid from v_process""",
)
def _(t):
    return _one_action("append_to_property", "T1", "x_guid")(t).select("id", "x_guid")


@query(
    "append_token",
    """select event_id, array_to_string(list_sort(list_distinct(['b', 'k' || cast(event_id % 3 as string), 'k1'])), ' ') as tokens from events""",
)
def _(t):
    text = F.concat(F.lit("b k"), (F.col("event_id") % 3).cast("string"))
    return t("events").select("event_id", ru.append_token(text, "k1").alias("tokens"))


@query("rule_register_operator", "select id, length(coalesce(command_line, '')) > 20 as hit from v_process")
def _(t):
    ru.rule_register_operator("longer_than", lambda x, v: F.length(F.coalesce(x, F.lit(""))) > int(v))
    rule = {
        "conditions": {"all": [{"name": "command_line", "operator": "longer_than", "value": "20"}]},
        "actions": [{"name": "increment_property", "params": {"name": "x_suspicious_score", "value": 1}}],
    }
    scored = ru.score_rules(t("v_process", **PROC), [rule])
    return scored.select("id", (F.col("x_suspicious_score") > 0).alias("hit"))


# -- network part and the whole analytic --------------------------------------------------------

_NETWORK = """
with net as (
  select p.*, case when coalesce(command_line, '') <> '' then coalesce(total, 0) else 0 end as network_susp_score
  from v_process p left join (select x_guid as g, cast(sum(x_opened_connection_count) as bigint) as total
    from v_process where x_guid is not null group by x_guid) s on p.x_guid = s.g),
bounds as (select avg(network_susp_score) - 3 * stddev_samp(network_susp_score) as lo,
  avg(network_susp_score) + 3 * stddev_samp(network_susp_score) as hi from net)
"""
_POINT = "case when network_susp_score < lo or network_susp_score > hi then 1.0e0 else 0.0e0 end"


@query("conn_sum_by_guid", "select x_guid, cast(sum(x_opened_connection_count) as bigint) as connections from v_process group by x_guid")
def _(t):
    return agg.conn_sum_by_guid(t("v_process"))


@query("conn_nunique_by_guid", "select x_guid, count(distinct connection_ref) as connections from v_process group by x_guid")
def _(t):
    return agg.conn_nunique_by_guid(t("v_process", connection_ref="opened_connection_ref_0.id"))


@query("score_network_outliers", _NETWORK + f"select id, network_susp_score, {_POINT} as score from net, bounds")
def _(t):
    scored = sc.score_network_outliers(t("v_process", **PROC))
    return scored.select("id", "network_susp_score", F.col("x_suspicious_score").alias("score"))


_TOTAL = _NETWORK + f"select id, {GLOBS} + {_POINT} + {RULES} as score from net, bounds"


def _scored(t):
    scored = sc.suspicious_process_score(t("v_process", **PROC))
    return scored.select("id", F.col("x_suspicious_score").alias("score"))


@query("suspicious_process_score", _TOTAL)
def _(t):
    return _scored(t)


@query("score_rank", _NETWORK + f"select id, {GLOBS} + {_POINT} + {RULES} as score from net, bounds order by score desc, id limit 100")
def _(t):
    return agg.score_rank(_scored(t), 100, "score")


@query(
    "score_normalize",
    _NETWORK + f""", s as (select id, {GLOBS} + {_POINT} + {RULES} as score from net, bounds)
    select id, round((score - lo) / (hi - lo), 6) as score from s, (select min(score) as lo, max(score) as hi from s)""",
)
def _(t):
    scaled = agg.score_normalize(_scored(t), "score")
    return scaled.select("id", F.round("score", 6).alias("score"))


# -- PowerShell -------------------------------------------------------------------------------------

_S = ps.BASE64.replace("'", "''")
_ENC = f"'(?i)-enc(odedcommand)? *{_S}'"
_COM = "'" + ps.COMMAND_ARGUMENT.replace("'", "''") + "'"
_B64 = "'^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$'"


def _decode16(x: str) -> str:
    """ASCII text of base64 UTF-16, NULL when it is neither."""
    raw = f"hex(from_base64({x}))"
    return (
        f"case when regexp_matches({x}, {_B64}) and regexp_full_match({raw}, '(?:[0-7][0-9A-F]00)+') "
        f"then decode(from_hex(regexp_replace({raw}, '(..)00', '\\1', 'g'))) end"
    )


_PS = f"""
with enc as (select event_id, id, command_line,
  case when regexp_matches(command_line, {_ENC}) then regexp_extract(command_line, {_ENC}, 2) end as encoded,
  case when regexp_matches(command_line, {_COM}) then regexp_extract(command_line, {_COM}, 1) end as plain from v_script),
code as (select *, case when encoded = 'abc' then 'abc' else coalesce({_decode16('encoded')}, encoded) end as decoded from enc),
picked as (select *, coalesce(decoded, plain) as code from code),
"""
_SEG = "'(" + ps._SEGMENT.replace("'", "''") + ")'"
_TICK = "regexp_replace(s, '`([^abefnrtuv0])', '\\1', 'g')"
_PS_NORM = _PS + f"""
segmented as (select *, array_to_string(list_transform(regexp_extract_all(code, {_SEG}, 1), lambda s:
  case when s[1] = chr(39) then s when s[1:2] = '."' then lower(replace({_TICK}, '"', '')) when s[1] = '"' then {_TICK} else lower(s) end), '') as joined from picked),
chars as (select *, array_to_string(list_transform(regexp_extract_all(joined, '(\\[char\\][0-9]+|\\[|[^\\[]+)', 1), lambda p:
  case when regexp_full_match(p, '\\[char\\][0-9]+') then chr(39) || chr(cast(regexp_extract(p, '([0-9]+)', 1) as int)) || chr(39) else p end), '') as unchar from segmented),
norm as (select *, trim(replace(unchar, chr(39) || ' + ' || chr(39), '')) as normal from chars)
"""
_CALL = "'" + ps.BASE64_CALL.replace("'", "''") + "'"
_NOTE = f"""case when regexp_matches(l, {_CALL}) then l || coalesce('  # ' || {_decode16(f"regexp_extract(l, {_CALL}, 1)")}, '') else l end"""
_PS_LAYOUT = _PS_NORM + """,
broken as (select event_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(normal,
  '\\s*\\{\\s*', ' {' || chr(10), 'g'), '\\s*\\}\\s*', chr(10) || '}' || chr(10), 'g'), ';\\s*', ';' || chr(10), 'g'), chr(10)),
  lambda s: trim(s)), lambda s: s not in ('', ';')) as lines from norm where normal is not null),
line as (select event_id, unnest(lines) as l, unnest(range(len(lines))) as n from broken),
run as (select *, sum(case when ends_with(l, '{') then 1 when l = '}' then -1 else 0 end) over (partition by event_id order by n) as s from line),
low as (select *, s - least(0, min(s) over (partition by event_id order by n)) as after from run),
depth as (select *, case when ends_with(l, '{') then after - 1 else after end as d from low),
laid as (select event_id, coalesce(string_agg(repeat('    ', cast(d as int)) || l, chr(10) order by n), '') as layout from depth group by event_id)
"""


@query("ps_extract_encoded", _PS.rstrip().rstrip(",") + " select event_id, encoded from enc")
def _(t):
    return t("v_script").select("event_id", ps.ps_extract_encoded(c("command_line")).alias("encoded"))


@query("ps_decode_base64", _PS.rstrip().rstrip(",") + " select event_id, decoded from code")
def _(t):
    encoded = ps.ps_extract_encoded(c("command_line"))
    return t("v_script").select("event_id", ps.ps_decode_base64(encoded).alias("decoded"))


@query("ps_extract_command", _PS.rstrip().rstrip(",") + " select event_id, plain from enc")
def _(t):
    return t("v_script").select("event_id", ps.ps_extract_command(c("command_line")).alias("plain"))


def _code():
    decoded = ps.ps_decode_base64(ps.ps_extract_encoded(c("command_line")))
    return ps.ps_pick_code(decoded, ps.ps_extract_command(c("command_line")))


@query("ps_pick_code", _PS.rstrip().rstrip(",") + " select event_id, code from picked")
def _(t):
    return t("v_script").select("event_id", _code().alias("code"))


@query("ps_normalize", _PS_NORM + " select event_id, normal from norm")
def _(t):
    return t("v_script").select("event_id", ps.ps_normalize(_code()).alias("normal"))


@query(
    "ps_annotate_base64",
    _PS_NORM + f" select event_id, array_to_string(list_transform(string_split(normal, chr(10)), lambda l: {_NOTE}), chr(10)) as noted from norm",
)
def _(t):
    return t("v_script").select("event_id", ps.ps_annotate_base64(ps.ps_normalize(_code())).alias("noted"))


@query("ps_layout", _PS_LAYOUT + " select event_id, layout from laid")
def _(t):
    laid = t("v_script").select("event_id", ps.ps_layout(ps.ps_normalize(_code())).alias("layout"))
    return laid.where("layout <> ''")


@query(
    "ps_report",
    _PS_LAYOUT + f""", noted as (select n.event_id, id, array_to_string(list_transform(string_split(coalesce(layout, ''), chr(10)), lambda l: {_NOTE}), chr(10)) as x
      from norm n left join laid using (event_id) where normal is not null)
    select r as row, noted.id, replace(replace(replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;') as text
    from noted join (select event_id, row_number() over (order by event_id) as r from v_script) o using (event_id)""",
)
def _(t):
    return sc.ps_report(t("v_script"), key="event_id")


# -- log4j substitutions ---------------------------------------------------------------------------

_INNER = "'" + l4.INNERMOST + "'"
_ALLOWED = "'" + l4.ALLOWED_REST.replace("\\z", "$") + "'"
_ERROR = "'" + l4.LOOKUP_ERROR + "'"


def _resolve_columns(inner: str) -> str:
    """Nested selects that add prefix, rest and value for a column with the inner text."""
    return f"""
  (select *, case when not regexp_matches(rest, {_ALLOWED}) then null else
    case kind when 'base64' then try(decode(from_base64(tail))) when 'lower' then lower(tail)
      when 'jndi' then prefix || ':' || tail when 'sys' then '' else tail end end as value
   from (select *, lower(coalesce(prefix, '')) as kind,
      case when contains(rest, ':-') then string_split(rest, ':-')[-1] else rest end as tail
   from (select *, regexp_replace(case when strpos({inner}, ':') > 0 then substr({inner}, strpos({inner}, ':') + 1) else {inner} end, '^-', '') as rest,
      case when strpos({inner}, ':') > 0 then substr({inner}, 1, strpos({inner}, ':') - 1) end as prefix
   """


def _check(source: str) -> str:
    """Recursive CTE st over ``source`` (id, text): the state of the loop per turn."""
    return f"""
with recursive src as ({source}),
st(id, i, s, done, res, parse_ok) as (
  select id, 0, text, not contains(text, '$' || '{{'), cast(null as string), true from src where text is not null
  union all
  select id, i + 1,
    case when whole = '' or value is null or starts_with(lower(value), 'jndi:') then s
      else regexp_replace(substr(s, 1, strpos(s, whole) - 1), '\\$$', '') || value || substr(s, strpos(s, whole) + length(whole)) end,
    whole = '' or value is null or starts_with(lower(value), 'jndi:'),
    case when whole = '' then null when value is null then s when starts_with(lower(value), 'jndi:') then substr(value, 6) end,
    whole = '' or value is not null
  from {_resolve_columns("inside")}
   from (select *, substr(whole, 3, length(whole) - 3) as inside from (select *, regexp_extract(s, {_INNER}, 0) as whole from st where not done) a) b) c) d) e
),
found as (select src.id, case when regexp_matches(text, {_ERROR}) then text else res end as exploit,
  case when regexp_matches(text, {_ERROR}) or text is null then true else parse_ok end as parse_ok
  from src left join (select * from st where done) f using (id))
"""


_URL3 = "url_decode(url_decode(url_decode(value)))"
_SRC_URL = f"select page_id as id, {_URL3} as text from v_url"


@query("l4s_unquote3", f"select page_id, {_URL3} as text from v_url")
def _(t):
    return t("v_url").select("page_id", l4.l4s_unquote3(c("value")).alias("text"))


@query(
    "l4s_innermost",
    f"select page_id, nullif(regexp_extract({_URL3}, {_INNER}, 0), '') as inner_text from v_url",
)
def _(t):
    return t("v_url").select("page_id", l4.l4s_innermost(l4.l4s_unquote3(c("value"))).alias("inner_text"))


@query(
    "l4s_resolve_one",
    f"select page_id, value as resolved from {_resolve_columns('inside')} from (select page_id, substr(w, 3, length(w) - 3) as inside from "
    f"(select page_id, regexp_extract({_URL3}, {_INNER}, 0) as w from v_url) q where w <> '') r) x) y) z",
)
def _(t):
    inner = l4.l4s_innermost(l4.l4s_unquote3(c("value")))
    found = t("v_url").select("page_id", inner.alias("w")).where("w is not null")
    return found.select("page_id", l4.l4s_resolve_one(c("w")).alias("resolved"))


@query("l4s_check_string", _check("select event_id as id, user_agent as text from v_http") + "select id, exploit, parse_ok from found")
def _(t):
    agent = c("user_agent")
    return t("v_http").select(
        F.col("event_id").alias("id"), l4.l4s_check_string(agent).alias("exploit"), l4.l4s_parse_ok(agent).alias("parse_ok")
    )


_PAYLOAD = f"""select page_id as id, case when payload_bin <> '!!not base64' then url_decode(url_decode(url_decode(decode(from_base64(
   case when payload_bin = '!!not base64' then '' else payload_bin end))))) end as text from v_artifact"""


@query("l4s_payload", _check(_PAYLOAD) + "select id, exploit from found")
def _(t):
    return t("v_artifact").select(F.col("page_id").alias("id"), l4.l4s_payload(c("payload_bin")).alias("exploit"))


_BODY = "regexp_replace(regexp_replace(exploit, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.\\-]*:', '')"
_SPLIT = f"""
, part as (select id, exploit, body, starts_with(body, '//') as net, regexp_replace(regexp_extract(body, '^//([^/?]*)', 1), '^.*@', '') as hp,
   case when starts_with(body, '//') then regexp_replace(body, '^//[^/?]*', '') else body end as rest
   from (select *, {_BODY} as body from found) b)
select id, exploit, case when net then nullif(lower(regexp_extract(hp, '^([^:]*)', 1)), '') end as hostname,
  case when net then try_cast(nullif(regexp_extract(hp, ':([0-9]{{1,5}})$', 1), '') as int) end as port,
  regexp_extract(rest, '^([^?]*)', 1) as path, regexp_extract(rest, '\\?(.*)$', 1) as query from part
"""


@query("l4s_detect", _check(_SRC_URL) + _SPLIT.replace("regexp_extract(rest, '^([^?]*)', 1) as path", "case when exploit is not null then regexp_extract(rest, '^([^?]*)', 1) end as path").replace("regexp_extract(rest, '\\?(.*)$', 1) as query", "case when exploit is not null then regexp_extract(rest, '\\?(.*)$', 1) end as query"))
def _(t):
    found = l4.l4s_detect(t("v_url"))
    return found.select(F.col("page_id").alias("id"), "exploit", "hostname", "port", "path", "query")


@query(
    "l4s_split_url",
    "with found as (select event_id as id, url as exploit from v_http)" + _SPLIT,
)
def _(t):
    parts = t("v_http").select(F.col("event_id").alias("id"), F.col("url").alias("exploit"), l4.l4s_split_url(c("url")).alias("p"))
    return parts.select("id", "exploit", "p.*")


@query("filter_has_exploit", _check(_SRC_URL) + "select id, exploit from found where exploit is not null")
def _(t):
    found = l4.filter_has_exploit(l4.l4s_detect(t("v_url")))
    return found.select(F.col("page_id").alias("id"), "exploit")


_BOTH = _check(
    "select event_id * 2 as id, url_decode(url_decode(url_decode(url))) as text from v_http "
    "union all select event_id * 2 + 1, user_agent from v_http"
)


@query(
    "exploit_coverage",
    _BOTH + """, h as (select floor(id / 2) as k, max(case when id % 2 = 0 then exploit end) as u, max(case when id % 2 = 1 then exploit end) as a from found group by 1)
    select count(*) as total, count(*) filter (u is not null or a is not null) as matched, count(u) as matched_url, count(a) as matched_ua from h""",
)
def _(t):
    return l4.exploit_coverage(t("v_http"))


@query(
    "exploit_misses",
    _BOTH + "select cast(floor(id / 2) as bigint) as event_id from found group by 1 having count(exploit) = 0",
)
def _(t):
    return l4.exploit_misses(t("v_http")).select("event_id")
