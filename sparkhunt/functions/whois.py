"""Whois text: line rules, values, dates, domain keys."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkhunt.functions.whois_rules import COUNTRY_CODES, LINE_RULES, MONTHS, TAG_RENAMES
from sparkhunt.names import c, let
from sparkhunt.operators.lookup import unsent
from sparkhunt.operators.ordering import next_at_or_after, running_sum
from sparkhunt.session import cut_lineage, discard

WRAP, JOIN, SERVER_LIST = "+wrap", "@join", "@nslist"
_BLOCK_RULES = 12
#: Lines of a record whose name servers are put together at once.
_LIST_LINES = 10_000
DATE_TAGS = ("created", "updated", "expires", "registered")
RULE_SCHEMA = "rule_no int, regex string, tag string, result string, flags string"


def whois_country_map(name: Column) -> Column:
    """Upper-case a country and shorten the names in the country table."""
    upper = F.upper(name)
    codes = F.create_map(*[F.lit(x) for pair in COUNTRY_CODES for x in pair])
    return F.coalesce(F.try_element_at(codes, upper), upper)


def _rule_number(line: Column, rules: Sequence[tuple]) -> Column:
    """Number of the first rule that matches; NULL when none does.

    A block of rules is first tried as one alternation, and its rules one by one only
    when that matches.
    """

    def first_of(branches: list[tuple[Column, Column]]) -> Column:
        out = F.when(*branches[0])
        for condition, value in branches[1:]:
            out = out.when(condition, value)
        return out

    numbered = [(at, rule[0]) for at, rule in enumerate(rules, start=1)]
    blocks = [numbered[i : i + _BLOCK_RULES] for i in range(0, len(numbered), _BLOCK_RULES)]
    return first_of(
        [
            (
                line.rlike("|".join(f"(?:{regex})" for _, regex in block)),
                first_of([(line.rlike(regex), F.lit(at)) for at, regex in block]),
            )
            for block in blocks
        ]
    )


def _value(rule: Column, line: Column) -> Column:
    """Value of a rule: the template with %1..%7 filled from the match, then flags."""
    value = F.when(rule["result"] == "%", "").otherwise(rule["result"])
    for group in range(1, 8):
        mark = f"%{group}"
        found = F.call_function("regexp_extract", line, rule["regex"], F.lit(group))
        used = F.when(rule["result"].contains(mark), found).otherwise(F.lit(""))
        value = F.replace(value, F.lit(mark), used)
    for flag, change in (("U", F.upper), ("L", F.lower), ("M", whois_country_map)):
        value = let(value, _when_flag(rule["flags"].contains(flag), change))
    return value


def _when_flag(present: Column, change):
    return lambda v: F.when(present, change(v)).otherwise(v)


def match_lines(df: DataFrame, line: str, rules: Sequence[tuple] = LINE_RULES) -> DataFrame:
    """Add rule_no, tag, value and flags of the first rule that matches ``line``.

    The rules are tried once per line: the rule number leaves a generator, which later
    filters and projections cannot repeat.  The lambda keeps a hundred patterns out of
    the generated code of the stage, which would exceed the size the JVM compiles.
    """
    table = [{"regex": r[0], "tag": r[1], "result": r[2], "flags": r[3]} for r in rules]
    constant = F.from_json(
        F.lit(json.dumps(table)), "array<struct<regex: string, tag: string, result: string, flags: string>>"
    )
    found = F.transform(F.array(c(line)), lambda text: _rule_number(text, rules))
    numbered = df.select("*", F.explode(found).alias("rule_no"))
    ruled = numbered.withColumn("__rule", F.try_element_at(constant, F.col("rule_no")))
    return ruled.select(
        *[c(n) for n in numbered.columns],
        F.col("__rule.tag").alias("tag"),
        F.when(F.col("rule_no").isNotNull(), _value(F.col("__rule"), c(line))).alias("value"),
        F.col("__rule.flags").alias("flags"),
    )


def rules_from_table(rules_df: DataFrame) -> list[tuple]:
    """A rule table as the list :func:`match_lines` takes.

    Every rule becomes one branch of an expression: rules are written by hand, and their
    number does not grow with the lines.
    """
    rows = rules_df.orderBy("rule_no").collect()
    return [(r["regex"], r["tag"], r["result"] or "", r["flags"] or "") for r in rows]


def clean_line(line: Column) -> Column:
    """Drop trailing blanks and one final dot."""
    return F.regexp_replace(F.regexp_replace(line, r"\s*\z", ""), r"\.\z", "")


def _glued(matched: DataFrame, key: str, rules: Sequence[tuple]) -> DataFrame:
    """(key, line_no, n, line and its rule) of lines that take in the ones after them.

    An unfinished line takes the next one, once after a wrap rule, again and again while
    the result still asks to be joined.  Every unfinished line is completed as if it were
    free; of lines that overlap the first one counts, then the first one after its end.
    A line leaves the loop with its last round, so what is kept follows the lines.
    """
    lines = matched.select(c(key), F.col("line_no").alias("__at"), F.col("raw").alias("__next"))
    longer = matched.where(F.col("tag").isin(WRAP, JOIN)).select(
        c(key), "line_no", F.lit(1).alias("n"), "line", "rule_no", "tag", "value", "flags", F.lit(False).alias("wrapped")
    )
    done: list[DataFrame] = []
    while True:
        asks = F.coalesce((F.col("tag") == JOIN) | ((F.col("tag") == WRAP) & ~F.col("wrapped")), F.lit(False))
        step = longer.where(asks).withColumn("__at", F.col("line_no") + F.col("n")).join(unsent(lines), [key, "__at"], "left")
        kept = ["n", "line", "rule_no", "tag", "value", "flags"]
        ended = longer.where(~asks).select(c(key), "line_no", *kept)
        at_end = step.where(F.col("__next").isNull() & (F.col("n") > 1)).select(c(key), "line_no", *kept)
        done.append(cut_lineage(ended.unionByName(at_end)))
        gap = F.when(F.col("tag") == WRAP, " ").otherwise("")
        text = step.where("__next is not null").select(
            c(key), "line_no", (F.col("n") + 1).alias("n"), F.concat("line", gap, "__next").alias("line"),
            (F.col("wrapped") | (F.col("tag") == WRAP)).alias("wrapped"),
        )
        longer = cut_lineage(match_lines(text, "line", rules))
        if longer.isEmpty():
            break
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.join(unsent(_free_heads(whole, key)), [key, "line_no"], "left_semi")


def _free_heads(spans: DataFrame, key: str) -> DataFrame:
    """(key, line_no) of the spans of ``n`` lines that are taken from the first one on, each
    the first at or after the end of the one before.

    Every span points to the one that would follow it.  Pointers are doubled round by
    round, and what is reached so far is carried over them: a chain of any length takes a
    logarithm of rounds, all equi-joins on (key, line).
    """
    follows = spans.select(c(key), F.col("line_no").cast("long").alias("line_no"), (F.col("line_no") + F.col("n")).cast("long").alias("__end"))
    jumps = cut_lineage(next_at_or_after(follows, key, "line_no", "__end", "__next").where("__next is not null"))
    reached = cut_lineage(follows.groupBy(c(key)).agg(F.min("line_no").alias("line_no")))
    while not jumps.isEmpty():
        ahead = reached.join(unsent(jumps), [key, "line_no"]).select(c(key), F.col("__next").alias("line_no"))
        further = cut_lineage(reached.unionByName(ahead).distinct())
        onward = jumps.select(c(key), F.col("line_no").alias("__next"), F.col("__next").alias("__far"))
        doubled = cut_lineage(jumps.join(unsent(onward), [key, "__next"]).select(c(key), "line_no", F.col("__far").alias("__next")))
        discard(reached, jumps)
        reached, jumps = further, doubled
    return reached


def whois_multiline(
    lines_df: DataFrame, key: str = "ip", rules: Sequence[tuple] = LINE_RULES
) -> DataFrame:
    """Lines after gluing wrapped lines and turning server lists into ``ns`` rows.

    Result: (key, line_no, line, tag, value, flags); lines without a rule are left out.
    Unfinished lines meet their successors by equi-joins on the next line number, server
    lists are cut into segments by a chunked running count.  A flush-left line without a
    label ends a strict list and is read by its own rule; a second line that opens a list
    opens a new one.
    """
    raw = lines_df.select(
        c(key), "line_no", F.col("line").alias("raw"), clean_line(F.col("line")).alias("line")
    )
    matched = cut_lineage(match_lines(raw, "line", rules))
    glue = _glued(matched, key, rules)
    glued = glue.select(c(key), "line_no", F.struct("line", "rule_no", "tag", "value", "flags").alias("glued"))
    after = F.sequence(F.col("line_no") + 1, F.col("line_no") + F.col("n") - 1)
    taken = glue.select(c(key), F.explode(after).alias("line_no"), F.lit(True).alias("used"))
    own = F.struct("line", "rule_no", "tag", "value", "flags")
    state = (
        matched.join(unsent(glued), [key, "line_no"], "left")
        .join(unsent(taken), [key, "line_no"], "left")
        .where(F.col("used").isNull())
        .select(c(key), "line_no", "raw", F.coalesce("glued", own).alias("m"))
    )
    starts = F.coalesce(F.col("m.tag") == SERVER_LIST, F.lit(False))
    segmented = running_sum(state, [key], "line_no", starts, "segment")
    blank = F.col("raw").rlike(r"^\s*\z")
    labelled = F.col("raw").rlike(r"^\S+:") | F.col("raw").contains("WHOIS lookup made")
    indented = F.col("raw").rlike(r"^\s+\S")
    classed = cut_lineage(
        segmented.select(
            "*",
            starts.alias("start"),
            (~starts & labelled).alias("label"),
            (~starts & blank).alias("blank"),
            (~starts & ~blank & ~labelled & ~indented).alias("flush_left"),
            (~starts & ~blank & ~labelled).alias("server"),
        )
    )
    in_list = classed.where(F.col("segment") > 0)
    heads = in_list.groupBy(c(key), F.col("segment")).agg(
        F.max(F.when(F.col("start"), F.col("m.value") != "")).alias("strict"),
        F.min(F.when(F.col("server"), F.col("line_no"))).alias("first_server"),
    )
    joined = in_list.join(unsent(heads), [key, "segment"])
    ends = joined.groupBy(c(key), F.col("segment")).agg(
        F.min(
            F.when(
                F.col("label")
                | (F.col("blank") & (F.col("line_no") > F.col("first_server")))
                | (F.col("flush_left") & F.col("strict")),
                F.col("line_no"),
            )
        ).alias("end")
    )
    servers = (
        in_list.where("server")
        .join(unsent(ends), [key, "segment"])
        .where(F.col("end").isNull() | (F.col("line_no") < F.col("end")))
        .select(
            c(key),
            "line_no",
            F.col("m.line").alias("line"),
            F.lit("ns").alias("tag"),
            F.regexp_extract("raw", r"^\s*(\S+)", 1).alias("value"),
            F.lit("").alias("flags"),
        )
    )
    listed = servers.select(c(key), "line_no", F.lit(True).alias("listed"))
    single = (
        classed.where(F.col("m.rule_no").isNotNull())
        .join(unsent(listed), [key, "line_no"], "left")
        .where(F.col("listed").isNull() & ~F.col("m.tag").isin(WRAP, JOIN))
        .select(
            c(key),
            "line_no",
            F.col("m.line").alias("line"),
            F.when(F.col("m.tag") == SERVER_LIST, "ns").otherwise(F.col("m.tag")).alias("tag"),
            F.when(F.col("m.tag").isin("ns", SERVER_LIST), F.lower("m.value"))
            .otherwise(F.col("m.value"))
            .alias("value"),
            F.col("m.flags").alias("flags"),
        )
        .where(F.col("value") != "")
    )
    return single.unionByName(servers)


def whois_parse(
    lines_df: DataFrame, rules_df: DataFrame | None = None, key: str = "ip"
) -> DataFrame:
    """(key, line_no, tag, value, flags, rule_no) of every line that matches a rule."""
    rules = LINE_RULES if rules_df is None else rules_from_table(rules_df)
    lines = lines_df.select(c(key), "line_no", clean_line(F.col("line")).alias("line"))
    return match_lines(lines, "line", rules).where("rule_no is not null").drop("line")


def first_wins_tag(parsed_df: DataFrame, key: str = "ip") -> DataFrame:
    """One value per tag: the first one, or the last one for rules with flags.

    The first value of an unflagged rule is kept until a flagged rule overwrites it.
    Name servers are a list: all of them, in line order, with commas between.
    """
    given = parsed_df.where((F.col("value") != "") & ~F.col("tag").isin(SERVER_LIST, WRAP, JOIN))
    rows = given.where("tag <> 'ns'")
    in_order = lambda at: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(at, "value"))), lambda s: s["value"]), ",").alias("value")
    part = F.expr(f"line_no div {_LIST_LINES}").alias("part")  # long lists are put together from parts
    parts = given.where("tag = 'ns'").groupBy(c(key), F.col("tag"), part).agg(in_order("line_no"))
    servers = parts.groupBy(c(key), F.col("tag")).agg(in_order("part"))
    flagged = F.col("flags") != ""
    picked = rows.groupBy(c(key), F.col("tag")).agg(
        F.max_by("value", F.when(flagged, F.col("line_no"))).alias("last_flagged"),
        F.min_by("value", F.when(~flagged, F.col("line_no"))).alias("first_plain"),
    )
    single = picked.select(c(key), "tag", F.coalesce("last_flagged", "first_plain").alias("value"))
    return single.unionByName(servers)


def whois_tag_rename(values_df: DataFrame, key: str = "ip") -> DataFrame:
    """Rename tags whose common name is missing; drop them when it is present."""
    targets = dict(TAG_RENAMES)
    renamed = F.col("tag")
    for old, new in TAG_RENAMES:
        renamed = F.when(F.col("tag") == old, new).otherwise(renamed)
    present = values_df.where(F.col("tag").isin(list(targets.values()))).select(
        c(key), F.col("tag").alias("__target"), F.lit(True).alias("__present")
    )
    return (
        values_df.withColumn("__target", renamed)
        .join(unsent(present), [key, "__target"], "left")
        .where((F.col("tag") == F.col("__target")) | F.col("__present").isNull())
        .select(c(key), F.col("__target").alias("tag"), "value")
    )


def sorted_tags(values_df: DataFrame, key: str = "ip") -> DataFrame:
    """``tag: value`` lines of a record in tag order.

    Tags come from the rule table, one value per tag, so a list stays that short.
    """
    line = F.concat(F.col("tag"), F.lit(": "), F.col("value"))
    return values_df.groupBy(c(key)).agg(
        F.array_join(F.array_sort(F.collect_set(line)), "\n").alias("tags")
    )


def whois_domain_key(name: Column) -> Column:
    """Registered domain of a host name; addresses and other names stay unchanged."""
    labels = F.split(name, r"\.")
    tail = lambda n: F.array_join(
        F.slice(labels, F.greatest(F.size(labels) - (n - 1), F.lit(1)), F.lit(n)), "."
    )
    return (
        F.when(name.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+\z"), name)
        .when(name.rlike(r"\.(com|edu)\z"), tail(2))
        .when(name.rlike(r"\.[^.\n][^.\n]\z"), tail(3))
        .otherwise(name)
    )


def _month(word: Column) -> Column:
    numbers = F.create_map(*[F.lit(x) for pair in MONTHS for x in pair])
    return F.try_element_at(numbers, F.lower(word))


def _epoch(year: Column, month: Column, day: Column) -> Column:
    text = F.format_string(
        "%04d-%02d-%02d", year.try_cast("int"), month.try_cast("int"), day.try_cast("int")
    )
    return F.unix_seconds(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))


def whois_date(text: Column) -> Column:
    """Epoch seconds as text for the date layouts of whois servers.

    ``null`` gives NULL, ``None`` gives 0, and a text in no known layout stays as is.
    """
    clean = F.regexp_replace(F.regexp_replace(text, r"\s*#[0-9]*\s*\z", ""), r"\s*\z", "")
    return let(clean, _date_of)


def _date_of(clean: Column) -> Column:
    def layout(regex: str, year: int, month: int, day: int, named: bool, when: Column | None = None):
        group = lambda n: F.regexp_extract(clean, regex, n)
        number = _month(group(month)) if named else group(month)
        usable = clean.rlike(regex)
        if named:
            usable = usable & number.isNotNull()
        if when is not None:
            usable = usable & when
        return usable, _epoch(group(year), number, group(day))

    # The date layouts, in their order.
    compact = r"^([0-9]{4})([0-9]{2})([0-9]{2})\s*"
    part = lambda n: F.regexp_extract(clean, compact, n).try_cast("int")
    sane = (
        (part(1) > 1990) & (part(1) < 2040) & part(2).between(1, 12) & part(3).between(1, 31)
    )
    slashed = r"^([0-9]+)[/\-.]([0-9]+)[/\-.]([0-9]{4})\s*"
    first_is_day = F.regexp_extract(clean, slashed, 1).try_cast("int") > 12
    second_is_day = F.regexp_extract(clean, slashed, 2).try_cast("int") > 12
    layouts = [
        layout(compact, 1, 2, 3, False, sane),
        layout(r"^([0-9]{4})[\-./]\s*([0-9]{2})[\-./]\s*([0-9]{2})\s*", 1, 2, 3, False),
        layout(r"^([0-9]{4})[\-./]\s*([0-9])[\-./]\s*([0-9]{2})\s*", 1, 2, 3, False),
        layout(r"^([0-9]{2})-([A-Za-z]+)-([0-9]{4})\s*", 3, 2, 1, True),
        layout(r"^[A-Z][a-z][a-z], ([A-Za-z]+) ([0-9]+), ([0-9]{4})\z", 3, 1, 2, True),
        layout(r"^([0-9]*) ([A-Za-z]+) ([0-9]{4})\s*", 3, 2, 1, True),
        layout(
            r"^[A-Z][a-z][a-z] ([A-Za-z]+) ([0-9]+) [0-9]{2}:[0-9]{2}:[0-9]{2} \S+ ([0-9]{4})\z",
            3, 1, 2, True,
        ),
        layout(r"^[A-Z][a-z][a-z] ([A-Za-z]+) ([0-9]+) ([0-9]{4})\z", 3, 1, 2, True),
        layout(r"^([0-9]{4})[\-.]([A-Za-z]+)[\-.]([0-9]+)\s*", 1, 2, 3, True),
        layout(r"^([0-9][0-9]?)-([A-Za-z]+)-([0-9]+)\s*", 3, 2, 1, True),
        layout(slashed, 3, 1, 2, False, second_is_day),
        layout(slashed, 3, 2, 1, False, first_is_day),
        layout(slashed, 3, 1, 2, False),
    ]
    value = F.when(clean == "null", F.lit(None).cast("string"))
    for usable, epoch in layouts:
        value = value.when(usable, epoch.cast("string"))
    return value.when(clean == "None", "0").otherwise(clean)


def whois_report(values_df: DataFrame, key: str = "ip") -> DataFrame:
    """Renamed tags; date tags carry the epoch seconds in front of the text."""
    dated = F.col("tag").isin(*DATE_TAGS)
    stamped = values_df.withColumn("__epoch", F.when(dated, whois_date(F.col("value"))))
    kept = stamped.where(~dated | F.col("__epoch").isNotNull()).select(
        c(key),
        "tag",
        F.when(dated, F.concat("__epoch", F.lit(" "), F.col("value"))).otherwise(F.col("value")).alias("value"),
    )
    return whois_tag_rename(kept, key)


def ptr_org_fields(line: Column) -> Column:
    """Text between the first and second colon, without leading blanks and final dot."""
    value = F.try_element_at(F.split(F.rtrim(line), ":"), F.lit(2))
    return F.regexp_replace(F.ltrim(value), r"\.\z", "")
