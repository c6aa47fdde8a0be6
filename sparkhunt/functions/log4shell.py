"""Nested ``${...}`` substitutions in log text and the JNDI target they hide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkhunt.names import c, let

# The substitution language.
INNERMOST = r"\$\{((?:[^$}]|\$+[^${}])*\$*)\}"
ALLOWED_REST = r"^[A-Za-z0-9/._\-: =#@$]+\z"
LOOKUP_ERROR = r"^[^\n]*Error looking up JNDI resource \[ldap://[^\n]+/[^\n]*\]"

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def _unquote(text: Column) -> Column:
    """Percent-decode once; plus signs and malformed escapes stay as they are."""

    def once(t: Column) -> Column:
        plus = F.replace(t, F.lit("+"), F.lit("%2B"))
        safe = F.regexp_replace(plus, "%(?![0-9A-Fa-f]{2})", "%25")
        return F.when(t.contains("%"), F.url_decode(safe)).otherwise(t)

    return let(text, once)


def l4s_unquote3(text: Column) -> Column:
    """Percent-decode three times, the depth seen in the wild."""
    for _ in range(3):
        text = _unquote(text)
    return text


def l4s_innermost(text: Column) -> Column:
    """First substitution that contains no other, with its braces; NULL when none."""
    return F.when(text.rlike(INNERMOST), F.regexp_extract(text, INNERMOST, 0))


def _resolve(inner: Column) -> Column:
    """Value of the text between the braces; NULL when it does not parse."""
    cut = F.position(F.lit(":"), inner)
    parts = F.struct(
        F.when(cut > 0, F.substring(inner, F.lit(1), cut - 1)).alias("prefix"),
        F.regexp_replace(
            F.when(cut > 0, F.substring(inner, cut + 1, F.length(inner))).otherwise(inner), "^-", ""
        ).alias("rest"),
    )

    def value(p: Column) -> Column:
        rest = F.substring_index(p["rest"], ":-", -1)
        kind = F.coalesce(F.lower(p["prefix"]), F.lit(""))
        text = (
            F.when(kind == "base64", F.decode(F.try_to_binary(rest, F.lit("base64")), "UTF-8"))
            .when(kind == "lower", F.lower(rest))
            .when(kind == "jndi", F.concat(p["prefix"], F.lit(":"), rest))
            .when(kind == "sys", F.lit(""))
            .otherwise(rest)
        )
        return F.when(p["rest"].rlike(ALLOWED_REST), text)

    return let(parts, value)


def l4s_resolve_one(substitution: Column) -> Column:
    """Resolve one ``${...}`` text; NULL when it does not parse."""
    inner = lambda s: F.substring(s, F.lit(3), F.length(s) - 3)
    return let(let(substitution, inner), _resolve)


def _step(state: Column) -> Column:
    """One turn: resolve the innermost substitution of ``state.s`` and splice it in."""
    text = state["s"]

    def splice(f: Column) -> Column:
        start = F.position(f["whole"], f["text"])
        before = F.regexp_replace(F.substring(f["text"], F.lit(1), start - 1), r"\$\z", "")
        after = F.substring(f["text"], start + F.length(f["whole"]), F.length(f["text"]))
        bad, jndi = f["value"].isNull(), F.lower(f["value"]).startswith("jndi:")
        done = f["whole"].isNull() | bad | jndi
        return F.struct(
            F.when(done, f["text"]).otherwise(F.concat(before, f["value"], after)).alias("s"),
            done.alias("done"),
            F.when(f["whole"].isNull(), F.lit(None).cast("string"))
            .when(bad, f["text"])
            .when(jndi, F.substring(f["value"], F.lit(6), F.length(f["value"])))
            .alias("out"),
            (f["whole"].isNull() | ~bad).alias("parse_ok"),
        )

    found = let(
        F.struct(text.alias("text"), l4s_innermost(text).alias("whole")),
        lambda g: let(
            F.struct(g["text"], g["whole"], l4s_resolve_one(g["whole"]).alias("value")), splice
        ),
    )
    return F.when(state["done"], state).otherwise(found)


def l4s_check_state(text: Column) -> Column:
    """Struct (s, done, out, parse_ok) after resolving ``text`` to a fixed point.

    A turn shortens the text by at least three characters (the braces and the dollar),
    so length / 3 + 1 turns always suffice.
    """
    start = F.struct(
        text.alias("s"),
        F.lit(False).alias("done"),
        F.lit(None).cast("string").alias("out"),
        F.lit(True).alias("parse_ok"),
    )
    turns = F.sequence(F.lit(1), F.floor(F.length(text) / 3).cast("int") + 1)
    return F.aggregate(turns, start, lambda state, _: _step(state))


def l4s_check_string(text: Column) -> Column:
    """JNDI target of an exploit attempt, or NULL.

    A logged lookup error is returned whole, and so is a text with a substitution that
    does not parse (see :func:`l4s_parse_ok`).
    """
    return let(
        text,
        lambda t: F.when(t.rlike(LOOKUP_ERROR), t).when(
            t.contains("${"), l4s_check_state(t)["out"]
        ),
    )


def l4s_parse_ok(text: Column) -> Column:
    """False when the finding only rests on a substitution that does not parse."""
    return let(
        text,
        lambda t: F.when(
            ~t.rlike(LOOKUP_ERROR) & t.contains("${"), l4s_check_state(t)["parse_ok"]
        ).otherwise(F.lit(True)),
    )


def l4s_check_url(text: Column) -> Column:
    return let(l4s_unquote3(text), l4s_check_string)


def l4s_original(payload: Column) -> Column:
    """Text of a base64 payload; NULL when it is not base64."""
    return F.decode(F.try_to_binary(payload, F.lit("base64")), "UTF-8")


def l4s_payload(payload: Column) -> Column:
    return l4s_check_url(l4s_original(payload))


def l4s_split_url(url: Column) -> Column:
    """Struct (hostname, port, path, query) of a URL-like text."""
    return let(F.regexp_replace(F.regexp_replace(url, "#.*$", ""), _SCHEME, ""), _split_body)


def _split_body(body: Column) -> Column:
    has_host = body.startswith("//")
    host_part = F.when(has_host, F.regexp_extract(body, "^//([^/?]*)", 1))
    host_port = F.regexp_replace(host_part, "^.*@", "")
    hostname = F.lower(F.regexp_extract(host_port, r"^(\[[^\]]*\]|[^:]*)", 1))
    port = F.regexp_extract(host_port, r":([0-9]{1,5})$", 1)
    rest = F.when(has_host, F.regexp_replace(body, "^//[^/?]*", "")).otherwise(body)
    return F.struct(
        F.nullif(F.regexp_replace(hostname, r"[\[\]]", ""), F.lit("")).alias("hostname"),
        F.when(port != "", port.cast("int")).alias("port"),
        F.regexp_extract(rest, r"^([^?]*)", 1).alias("path"),
        F.regexp_extract(rest, r"\?(.*)$", 1).alias("query"),
    )


def l4s_detect(df: DataFrame, keep_parse_ok: bool = False) -> DataFrame:
    """Add ``exploit`` and its URL parts from whatever text columns the table has.

    ``value`` is tried first, then every request header column; a ``payload_bin``
    column replaces both and adds the decoded ``original``.
    """
    findings: list[Column] = []
    texts: list[Column] = []
    extra: list[Column] = []
    if "value" in df.columns:
        findings.append(l4s_check_url(c("value")))
        texts.append(l4s_unquote3(c("value")))
    for name in df.columns:
        if "request_header" in name.lower():
            findings.append(l4s_check_string(c(name)))
            texts.append(c(name))
        elif name == "payload_bin":
            findings, texts = [l4s_payload(c(name))], [l4s_unquote3(l4s_original(c(name)))]
            extra.append(l4s_original(c(name)).alias("original"))
            break
    exploit = F.coalesce(*findings) if findings else F.lit(None).cast("string")
    if keep_parse_ok and texts:
        ok = F.coalesce(*[F.when(f.isNotNull(), l4s_parse_ok(t)) for f, t in zip(findings, texts)])
        extra.append(ok.alias("parse_ok"))
    kept = [c(n) for n in df.columns if n != "exploit"]
    found = df.select(*kept, *extra, exploit.alias("exploit"))
    parts = found.withColumn(
        "__url", F.when(F.col("exploit").isNotNull(), l4s_split_url(F.col("exploit")))
    )
    return parts.select("*", "__url.*").drop("__url")


def exploit_coverage(df: DataFrame, url: str = "url", agent: str = "user_agent") -> DataFrame:
    """How many records hold an exploit, in the URL or in the user agent."""
    hit = df.select(
        l4s_check_url(c(url)).isNotNull().alias("u"), l4s_check_string(c(agent)).isNotNull().alias("a")
    )
    return hit.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("u") | F.col("a")).alias("matched"),
        F.count_if("u").alias("matched_url"),
        F.count_if("a").alias("matched_ua"),
    )


def exploit_misses(df: DataFrame, url: str = "url", agent: str = "user_agent") -> DataFrame:
    """Records without any finding."""
    return df.where(l4s_check_url(c(url)).isNull() & l4s_check_string(c(agent)).isNull())


def filter_has_exploit(df: DataFrame, attr: str = "exploit") -> DataFrame:
    return df.where(c(attr).isNotNull())


HEADER_ATTR = "extensions.'http-request-ext'.request_header.'User-Agent'"
