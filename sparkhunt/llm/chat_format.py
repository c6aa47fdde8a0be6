"""Chat formatting of typed content parts.

A visitor flattens the parts of a turn into one string in which images, sounds and
documents are ordered placeholders; each placeholder is recorded with its place, its
reference and the number of tokens it stands for.  Control strings inside texts are
escaped with backslashes, so turns, placeholders and the loss mask can be read back.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparkhunt.llm.common import batches
from sparkhunt.names import c

PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
#: What marks turns and placeholders, and therefore is escaped inside texts.
OPEN, CLOSE, PLACE = "### ", "</turn>", "<|"
_ESCAPE = re.compile(r"\\|###|</turn>|<\|")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\])*?)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def text_part(text: Column) -> Column:
    """The parts of a turn that is one text."""
    none = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), none.alias("ref"), none.alias("width"), none.alias("height"), none.alias("seconds"), none.alias("pages"))).cast(PARTS)


@dataclass
class TokenCosts:
    """Tokens that an attachment stands for."""

    image_patch: int = 28  # pixels a side for one token
    audio_per_second: float = 25.0
    document_per_page: int = 512


@dataclass
class PartVisitor:
    """Flattens the parts of one turn."""

    costs: TokenCosts
    loss: bool
    out: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        kind = part["kind"] or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def _put(self, text: str) -> int:
        start = self.length
        self.out.append(text)
        self.length += len(text)
        return start

    def visit_text(self, part: dict) -> None:
        text = escape(part["text"] or "")
        start = self._put(text)
        if self.loss and text:
            self.spans.append({"start": start, "end": self.length})

    def _place(self, part: dict, kind: str, tokens: int) -> None:
        number = len(self.attachments)
        start = self._put(f"<|{kind} {number}|>")
        self.attachments.append({"number": number, "kind": kind, "ref": part["ref"], "start": start, "tokens": tokens})

    def visit_image(self, part: dict) -> None:
        side = self.costs.image_patch
        self._place(part, "image", math.ceil((part["width"] or 0) / side) * math.ceil((part["height"] or 0) / side))

    def visit_audio(self, part: dict) -> None:
        self._place(part, "audio", math.ceil((part["seconds"] or 0.0) * self.costs.audio_per_second))

    def visit_document(self, part: dict) -> None:
        self._place(part, "document", (part["pages"] or 0) * self.costs.document_per_page)

    def visit_other(self, part: dict) -> None:
        raise ValueError(f"unknown kind of part: {part['kind']}")


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_ATTACHED = T.ArrayType(
    T.StructType([T.StructField("number", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("ref", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("tokens", T.LongType())])
)


def format_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: Column | None = None, trained: str = "assistant", costs: TokenCosts | None = None
) -> DataFrame:
    """One row per turn: the ids, ``formatted``, ``loss`` spans, ``attachments``, ``placeholder_tokens``.

    A conversation's text is the ``formatted`` strings of its rows in the order of
    (turn, formatted); the spans are characters of the row's own string, so a
    conversation of any length is formatted without being brought together.  ``parts``
    has the type ``PARTS`` (default: the column ``text`` as one text part).  Null texts,
    roles and lists count as empty, a part without a kind is a text; null ids stay null
    and form a conversation of their own; a repeated row is a repeated turn; an empty
    table gives no row; other columns are not read.  Only texts of the role ``trained``
    get loss spans.
    """
    costs = costs or TokenCosts()
    given = text_part(c("text")) if parts is None else parts.cast(PARTS)
    rows = turns.select(c(conv).cast("long").alias("conv"), c(turn).cast("long").alias("turn"), F.coalesce(c(role), F.lit("")).alias("role"), given.alias("parts"))
    schema = T.StructType(
        [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("formatted", T.StringType()), T.StructField("loss", _SPAN), T.StructField("attachments", _ATTACHED), T.StructField("placeholder_tokens", T.LongType())]
    )
    arrow = to_arrow_schema(schema)

    def one(conv_id, number, who, content) -> dict:
        visitor = PartVisitor(costs, who == trained)
        visitor._put(f"{OPEN}{escape(who).replace(':', chr(92) + ':')}: ")
        for part in content or []:
            visitor.visit(part or {"kind": "text", "text": None})
        visitor._put(f"{CLOSE}\n")
        tokens = sum(a["tokens"] for a in visitor.attachments)
        return {"conv_id": conv_id, "turn": number, "formatted": "".join(visitor.out), "loss": visitor.spans, "attachments": visitor.attachments, "placeholder_tokens": tokens}

    def run(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (one(*r) for b in batch_iter for r in zip(*(x.to_pylist() for x in b.columns), strict=True))
        yield from batches(rows, arrow, weigh=lambda r: len(r["formatted"]))

    return rows.mapInArrow(run, schema)


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn; placeholders stay as they are."""
    match = _TURN.fullmatch(formatted)
    if match is None:
        raise ValueError("not a formatted turn")
    return unescape(match[1]), unescape(match[2])


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from :func:`format_turns` rows: ``n_turns``,
    ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``.

    Rows are sorted by conversation and turn and streamed through running digests, so a
    conversation is never held in memory, however long it is.
    """
    ordered = formatted.select("conv_id", "turn", "formatted", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    arrow = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations():
            at, row, turns, loss = object(), None, None, None
            for part in parts:
                for conv, _, text, spans in zip(*(x.to_pylist() for x in part.columns), strict=True):
                    if conv != at:
                        if row is not None:
                            yield row | {"turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()}
                        at, row = conv, {"conv_id": conv, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
                        turns, loss = hashlib.sha256(), hashlib.sha256()
                    role, body = read_turn(text)
                    turns.update(f"{role}\n{body}\n".encode())
                    for span in spans:
                        learned = unescape(text[span["start"] : span["end"]])
                        row["loss_chars"] += len(learned)
                        loss.update(learned.encode())
                    row["n_turns"] += 1
                    row["formatted_chars"] += len(text)
            if row is not None:
                yield row | {"turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()}

        yield from batches(conversations(), arrow)

    return ordered.mapInArrow(run, schema)
