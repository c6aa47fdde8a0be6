"""PowerShell command lines: find the code, decode it, make it readable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkhunt.names import let

# Patterns that locate code in a command line.
BASE64 = r"'?([A-Za-z\d/\+]+={0,2})'?"
ENCODED_ARGUMENT = r"(?i)-enc(odedcommand)? *" + BASE64
COMMAND_ARGUMENT = r"-[Cc][Oo][Mm][Mm][Aa][Nn][Dd] *'(.*)'"
PADDED_BASE64 = r"^(?:[A-Za-z0-9/+]{4})*(?:[A-Za-z0-9/+]{2}==|[A-Za-z0-9/+]{3}=)?\z"
BASE64_CALL = r"\[convert\]::frombase64string\('" + BASE64 + r"'\)"

#: Text is cut into single-quoted strings, double-quoted strings (with a dot before
#: them, if any) and the code between them.
_SEGMENT = r"""'[^']*'|\.?"[^"]*"|[^'".]+|\.|'|\""""
_INDENT = "    "


def ps_extract_encoded(command: Column) -> Column:
    """Base64 argument of ``-enc`` / ``-encodedcommand``; NULL when there is none."""
    return F.when(command.rlike(ENCODED_ARGUMENT), F.regexp_extract(command, ENCODED_ARGUMENT, 2))


def _utf16_of_base64(text: Column) -> Column:
    """UTF-16 text of padded base64; NULL when it is neither.

    Bytes are little-endian unless a byte order mark says otherwise.
    """

    def decoded(raw: Column) -> Column:
        mark = F.hex(F.substring(raw, 1, 2))
        return (
            F.when(F.length(raw) % 2 == 1, F.lit(None).cast("string"))
            .when(mark == "FEFF", F.decode(F.substring(raw, F.lit(3), F.length(raw)), "UTF-16BE"))
            .when(mark == "FFFE", F.decode(F.substring(raw, F.lit(3), F.length(raw)), "UTF-16LE"))
            .otherwise(F.decode(raw, "UTF-16LE"))
        )

    return let(F.when(text.rlike(PADDED_BASE64), F.try_to_binary(text, F.lit("base64"))), decoded)


def ps_decode_base64(text: Column) -> Column:
    """Decoded UTF-16 text; the text itself when it cannot be decoded; NULL stays NULL."""
    return let(text, lambda t: F.coalesce(_utf16_of_base64(t), t))


def ps_extract_command(command: Column) -> Column:
    """Text between the quotes of ``-command '...'``; NULL when there is none."""
    return F.when(command.rlike(COMMAND_ARGUMENT), F.regexp_extract(command, COMMAND_ARGUMENT, 1))


def ps_pick_code(decoded: Column, plain: Column) -> Column:
    return F.coalesce(decoded, plain)


def _char_codes(text: Column) -> Column:
    """Replace every ``[char]NN`` by the quoted character."""
    pieces = F.regexp_extract_all(text, F.lit(r"(\[char\][0-9]+|\[|[^\[]+)"), F.lit(1))
    one = lambda p: F.when(
        p.rlike(r"^\[char\][0-9]+$"),
        F.concat(F.lit("'"), F.char(F.regexp_extract(p, "([0-9]+)", 1).cast("int")), F.lit("'")),
    ).otherwise(p)
    return F.array_join(F.transform(pieces, one), "")


def ps_normalize(code: Column) -> Column:
    """Undo letter case, back-tick, ``[char]`` and string-concatenation tricks.

    Code outside quotes is lower-cased; in double quotes a back-tick goes unless it
    starts a real escape; a quoted member name after a dot loses its quotes.
    """

    def segment(s: Column) -> Column:
        plain = F.regexp_replace(s, "`([^abefnrtuv0])", "$1")
        return (
            F.when(s.startswith("'"), s)
            .when(s.startswith('."'), F.lower(F.replace(plain, F.lit('"'), F.lit(""))))
            .when(s.startswith('"'), plain)
            .otherwise(F.lower(s))
        )

    joined = F.array_join(
        F.transform(F.regexp_extract_all(code, F.lit(f"({_SEGMENT})"), F.lit(1)), segment), ""
    )
    return F.trim(F.replace(_char_codes(joined), F.lit("' + '"), F.lit("")))


def ps_annotate_base64(code: Column) -> Column:
    """Append the decoded text to lines that call ``[convert]::frombase64string``."""

    def line_note(line: Column) -> Column:
        decoded = _utf16_of_base64(F.regexp_extract(line, BASE64_CALL, 1))
        note = F.coalesce(F.concat(F.lit("  # "), decoded), F.lit(""))
        return F.when(line.rlike(BASE64_CALL), F.concat(line, note)).otherwise(line)

    return F.array_join(F.transform(F.split(code, "\n"), line_note), "\n")


def ps_layout(code: Column) -> Column:
    """One statement per line, indented by brace depth."""
    broken = F.regexp_replace(code, r"\s*\{\s*", " {\n")
    broken = F.regexp_replace(broken, r"\s*\}\s*", "\n}\n")
    broken = F.regexp_replace(broken, r";\s*", ";\n")
    lines = F.filter(F.transform(F.split(broken, "\n"), lambda s: F.trim(s)), lambda s: ~s.isin("", ";"))
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("out"))

    def place(state: Column, line: Column) -> Column:
        closing = line == "}"
        depth = F.when(closing, F.greatest(state["depth"] - 1, F.lit(0))).otherwise(state["depth"])
        text = let(depth, lambda d: F.concat(F.repeat(F.lit(_INDENT), d), line))
        return F.struct(
            (depth + line.endswith("{").cast("int")).alias("depth"),
            F.array_append(state["out"], text).alias("out"),
        )

    return F.aggregate(lines, start, place, lambda state: F.array_join(state["out"], "\n"))


def ps_deobfuscate(command: Column) -> Column:
    """Readable code of a command line; NULL when it carries no code."""
    decoded = ps_decode_base64(ps_extract_encoded(command))
    code = ps_pick_code(decoded, ps_extract_command(command))
    return ps_annotate_base64(ps_layout(ps_normalize(code)))


def html_escape(text: Column) -> Column:
    """Replace the five characters that mean something in HTML."""
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text
