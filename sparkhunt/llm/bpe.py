"""Byte-level BPE through the tokenizers library, each distinct piece encoded once.

A single space between two characters that are not white space always starts a new
pre-token, and pre-tokens are encoded independently.  So a text is cut there, the library
encodes every distinct piece once per worker, and the pieces' ids are strung together:
the same ids and character offsets as for the whole text at a fraction of the time.

This holds for tokenizers that split like that; the file is looked at, and with another
normalizer, splitter or model, and for texts with the string of a special token, the
library encodes the whole text.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

_BREAK = re.compile(r"(?<=\S) (?=\S)")
#: A piece without white space, in Python's and the library's sense, but for the space in front.
_PLAIN = r"^ ?[^\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$"
#: New pieces that the library gets as the lines of one text.
LINES = 32


class _Rows(dict):
    """Row numbers of pieces; a new piece gets the next number and waits to be encoded."""

    def __init__(self, front: str, waiting: list[str]):
        super().__init__()
        self._front, self._waiting, self.start = front, waiting, 0

    def __missing__(self, piece: str) -> int:
        self[piece] = row = self.start + len(self._waiting)
        self._waiting.append(self._front + piece)
        return row


class PieceEncoder:
    """Encodes texts with the tokenizer file at ``path``; keeps about ``most`` pieces,
    of these those that come again when others need the place."""

    def __init__(self, path: str, offsets: bool = False, most: int = 750_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self._cut = parts_at_spaces(json.load(file))
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._offsets, self._most = offsets, most
        lone = self._tokenizer.encode("\n", add_special_tokens=False)
        self._break = lone.ids[0] if self._cut and not offsets and lone.tokens == ["Ċ"] else None
        self._clear()

    def _clear(self) -> None:
        self._waiting: list[str] = []
        # a text's first piece stands as it is, the others have a space in front
        self._heads, self._rest = _Rows("", self._waiting), _Rows(" ", self._waiting)
        self._rows = self._used = 0
        self._first, self._count = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self._size, self._odd = np.zeros(1024, np.int32), np.zeros(1024, bool)
        self._met = np.zeros(1024, np.int32)  # in so many batches
        self._ids = np.zeros(8192, np.uint32)
        self._spans = np.zeros((8192, 2) if self._offsets else (0, 2), np.uint32)

    def _forget(self) -> None:
        """Drop the pieces met in one batch only, or in so few that half of ``most`` stay."""
        least, met = 2, self._met[: self._rows]
        while np.count_nonzero(met >= least) > self._most // 2:
            least += 1
        stays = met >= least
        count, kept = self._count[: self._rows][stays], stays.tolist()
        to, ends = (np.cumsum(stays) - 1).tolist(), np.cumsum(count, dtype=np.int64)
        self._used = int(ends[-1]) if len(ends) else 0
        take = np.repeat(self._first[: self._rows][stays] - (ends - count), count) + np.arange(self._used)
        self._ids[: self._used] = self._ids[take]
        if self._offsets:
            self._spans[: self._used] = self._spans[take]
        for name in ("_size", "_odd"):
            held = getattr(self, name)
            held[: len(count)] = held[: self._rows][stays]
            held[len(count) :] = 0
        self._rows = len(count)
        self._count[: self._rows], self._first[: self._rows] = count, ends - count
        self._met[: self._rows], self._met[self._rows :] = 1, 0
        for rows in (self._heads, self._rest):
            few = [(piece, to[row]) for piece, row in rows.items() if kept[row]]
            rows.clear()
            rows.update(few)
            rows.start = self._rows

    @staticmethod
    def _grown(array: np.ndarray, need: int) -> np.ndarray:
        if len(array) < need:
            more = np.zeros((max(need, 2 * len(array)) - len(array), *array.shape[1:]), array.dtype)
            array = np.concatenate([array, more])
        return array

    def _encode_waiting(self) -> None:
        new = self._waiting
        if not new:
            return
        for name in ("_first", "_count", "_size", "_odd", "_met"):
            setattr(self, name, self._grown(getattr(self, name), self._rows + len(new)))
        for at in range(0, len(new), 8192):
            some = new[at : at + 8192]
            plain = pc.match_substring_regex(pa.array(some, pa.string()), _PLAIN).to_numpy(zero_copy_only=False)
            as_lines = self._lines([some[i] for i in np.flatnonzero(plain)]) if self._break is not None else None
            if as_lines is None:
                self._keep(np.arange(len(some)), *self._singly(some))
            else:
                self._keep(np.flatnonzero(plain), *as_lines)
                self._keep(rest := np.flatnonzero(~plain), *self._singly([some[i] for i in rest]))
            if self._offsets:
                self._size[self._rows : self._rows + len(some)] = np.fromiter(map(len, some), np.int32, len(some))
            # white space, but for the space in front, at an end of the piece
            for i in np.flatnonzero(~plain).tolist():
                p = some[i]
                self._odd[self._rows + i] = not (bare := p.strip()) or len(p) - len(bare) != (p[0] == " ")
            self._rows += len(some)
        new.clear()
        self._heads.start = self._rest.start = self._rows

    def _keep(self, rows: np.ndarray, ids: np.ndarray, counts: np.ndarray, spans: np.ndarray | None) -> None:
        """Keep the ids of new pieces, whose ``rows`` count from the first row not yet filled."""
        end = self._used + len(ids)
        self._ids = self._grown(self._ids, end)
        self._ids[self._used : end] = ids
        if spans is not None:
            self._spans = self._grown(self._spans, end)
            self._spans[self._used : end] = spans
        self._count[self._rows + rows], self._first[self._rows + rows] = counts, self._used + np.cumsum(counts) - counts
        self._used = end

    def _singly(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Ids, how many each piece has, and offsets if asked for."""
        codes = (self._tokenizer.encode_batch if self._offsets else self._tokenizer.encode_batch_fast)(pieces, add_special_tokens=False)
        counts = np.fromiter(map(len, codes), np.int32, len(pieces))
        n = int(counts.sum())
        ids = np.fromiter(chain.from_iterable(c.ids for c in codes), np.uint32, n)
        if not self._offsets:
            return ids, counts, None
        flat = chain.from_iterable(chain.from_iterable(c.offsets for c in codes))
        return ids, counts, np.fromiter(flat, np.uint32, 2 * n).reshape(-1, 2)

    def _lines(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, None] | None:
        """The same of pieces without white space, given to the library as lines of a few texts.

        A line break between characters that are not white space, or before a space and
        such a character, is a pre-token of its own, and no other token is that of a break.
        None if a special string is among the lines.
        """
        texts = ["\n".join(pieces[at : at + LINES]) + "\n" for at in range(0, len(pieces), LINES)]
        if any(mark in text for mark in self._special for text in texts):
            return None
        codes = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        flat = np.concatenate([np.zeros(0, np.uint32), *(np.array(c.ids, np.uint32) for c in codes)])
        broken = flat == self._break
        ends = np.flatnonzero(broken)
        return (flat[~broken], np.diff(ends, prepend=-1) - 1, None) if len(ends) == len(pieces) else None

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Ids of all texts (a string array without nulls) in one array, tokens per text,
        and (None unless asked for) the tokens' first and end characters inside their text."""
        if not self._cut:
            self._clear()
        elif self._rows > self._most:
            self._forget()
        if not len(texts):
            return self._ids[:0], np.zeros(0, np.int64), self._spans[:0].astype(np.int64) if self._offsets else None
        parts = pc.split_pattern(texts, " ")
        pieces = parts.value_lengths().to_numpy().astype(np.int64)
        first = np.cumsum(pieces) - pieces
        # each distinct piece of the batch is looked up once
        flat = parts.flatten().dictionary_encode()
        names, codes = np.array(_strings(flat.dictionary), object), flat.indices.to_numpy()
        inside = np.full(len(codes), self._cut)
        inside[first] = False
        used = np.flatnonzero(np.bincount(codes[inside], minlength=len(names)))
        known = np.zeros(len(names), np.int64)
        known[used] = np.fromiter(map(self._rest.__getitem__, names[used]), np.int64, len(used))
        row = known[codes]
        row[first] = np.fromiter(map(self._heads.__getitem__, names[codes[first]]), np.int64, len(first))
        self._encode_waiting()
        self._met[known[used]] += 1
        self._met[row[first]] += 1
        whole = self._whole(texts)
        # spaces beside other white space
        odd = ~whole & (pieces > 1) & np.logical_or.reduceat(self._odd[row], first)
        if whole.any() or odd.any():
            rows = np.split(row, first[1:])
            for i in np.flatnonzero(whole).tolist():
                rows[i] = np.array([self._heads[texts[i].as_py()]])
            for i in np.flatnonzero(odd).tolist():
                rows[i] = self._row_numbers(_BREAK.split(texts[i].as_py()))
            self._encode_waiting()
            row, pieces = np.concatenate(rows), np.fromiter(map(len, rows), np.int64, len(rows))
        counts = self._count[row].astype(np.int64)
        ends = np.cumsum(counts)
        take = np.repeat(self._first[row] - (ends - counts), counts) + np.arange(int(ends[-1]))
        last = np.cumsum(pieces)
        upto = np.concatenate([[0], ends])
        lengths = upto[last] - upto[last - pieces]
        if not self._offsets:
            return self._ids[take], lengths, None
        begin = np.concatenate([[0], np.cumsum(self._size[row])])
        inside = begin[:-1] - np.repeat(begin[last - pieces], pieces)
        return self._ids[take], lengths, self._spans[take].astype(np.int64) + np.repeat(inside, counts)[:, None]

    def _whole(self, texts: pa.Array) -> np.ndarray:
        """Which texts the library has to see as a whole."""
        out = np.full(len(texts), not self._cut)
        for mark in self._special:
            out |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        return out

    def _row_numbers(self, pieces: list[str]) -> np.ndarray:
        head, *rest = pieces
        return np.array([self._heads[head], *map(self._rest.__getitem__, rest)], np.int64)


def _strings(pieces: pa.Array) -> list[str]:
    """The values of a string array without spaces in them; many times faster than one by one."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), " ")
    return joined[0].as_py().split(" ")


def parts_at_spaces(file: dict) -> bool:
    """Whether a tokenizer file describes byte-level BPE whose words begin at their space."""
    splitter, model = file.get("pre_tokenizer") or {}, file.get("model") or {}
    plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
    same = not model.get("dropout") and not file.get("truncation") and not file.get("padding")
    return bool(file.get("normalizer") is None and plain and model.get("type") == "BPE" and same)
