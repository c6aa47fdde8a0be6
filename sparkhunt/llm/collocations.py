"""Phrase collocations from suffix subtrees of bounded size, one group of prefixes a task.

The suffixes of all texts, cut off after five words, form one large tree.  It is parted
vertically: prefixes are single words, longer where a word begins more suffixes than the
memory budget, and prefixes are packed into groups whose suffixes fit the budget.  Each
group's subtree is built on its own, level by level, and a phrase's count is the sum of
the leaves below its node.  Nodes under the least count are not grown further.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkhunt.llm.common import with_settings
from sparkhunt.names import c
from sparkhunt.operators.lookup import fits_broadcast, lookup_join
from sparkhunt.operators.ordering import row_positions, running_sum
from sparkhunt.session import cut_lineage

DEPTH = 5
#: Lower case for A-Z, a space between words, a line end between pieces.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32()), ("f", pa.int64())])
_PACKED = pa.schema([("grp", pa.int64()), ("lang", pa.string()), ("packed", pa.binary())])
_TEXT_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Texts:
    """The words of some texts of one language, as numbers, and the pieces they are in."""

    def __init__(self, lang: str):
        self.lang, self.numbers = lang, _Numbers()
        self._ids, self._pieces, self._last, self.size = [], [], 0, 0

    def add(self, texts: list[bytes]) -> None:
        data = b"\n".join(texts).translate(_FOLD)
        words = data.split()
        raw = np.frombuffer(data, np.uint8)
        ends = raw == 10
        gap = ends | (raw == 32)
        begins = ~gap
        begins[1:] &= gap[:-1]
        pieces = np.cumsum(ends, dtype=np.int64)[begins] + self._last
        self._last += int(ends.sum()) + 1
        self._ids.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self._pieces.append(pieces)
        self.size += len(words)

    def ids(self) -> np.ndarray:
        return np.concatenate(self._ids)


class _Known:
    """The frequent words of each language, most frequent first, and pairs that are frequent.

    Where they are too many to send around (``words`` None), texts keep numbers of their own.
    """

    def __init__(self, words: dict[str, list[bytes]] | None, pairs: dict[str, np.ndarray] | None = None):
        self.words, self.pairs, self._numbers = words, pairs, {}

    def numbers(self, texts: _Texts) -> tuple[dict[bytes, int], list[bytes]]:
        if self.words is None:
            return texts.numbers, list(texts.numbers)
        names = self.words.get(texts.lang, [])
        if texts.lang not in self._numbers:
            self._numbers[texts.lang] = {w: i for i, w in enumerate(names)}
        return self._numbers[texts.lang], names

    def windows(self, texts: _Texts, depth: int) -> np.ndarray:
        """(depth, suffixes) word numbers, -1 after the piece's end and from an infrequent
        word or pair on."""
        ids, pieces = texts.ids(), np.concatenate(texts._pieces)
        if self.words is not None:
            numbers, _ = self.numbers(texts)
            own = np.fromiter((numbers.get(w, -1) for w in texts.numbers), np.int32, len(texts.numbers))
            ids = own[ids]
        out = np.full((depth, len(ids)), -1, np.int32)
        out[0] = ids
        follows = pieces[1:] == pieces[:-1]
        if self.pairs is not None:
            pairs = self.pairs.get(texts.lang, np.zeros(0, np.int64))
            wanted = ids[:-1].astype(np.int64) << 32 | ids[1:]
            at = np.minimum(np.searchsorted(pairs, wanted), max(len(pairs) - 1, 0))
            follows &= (pairs[at] == wanted) if len(pairs) else False
        for k in range(1, depth):
            n = max(len(ids) - k, 0)
            more = (out[k - 1, :n] >= 0) & follows[k - 1 :]
            out[k, :n] = np.where(more, ids[k:], -1)
        return out


def _read(parts: Iterator[pa.RecordBatch], most: int = 4_000_000) -> Iterator[_Texts]:
    """Texts by language, handed on when ``most`` words or a quarter as many different ones are held."""
    held: dict[str, _Texts] = {}
    for part in parts:
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
            texts.setdefault(lang, []).append(text)
        for lang, some in texts.items():
            one = held.setdefault(lang, _Texts(lang))
            one.add(some)
            if one.size >= most or len(one.numbers) >= most // 4:
                yield held.pop(lang)
    yield from held.values()


class _HotPrefixes:
    """The prefixes too frequent for one group, by depth, in the numbers of a language."""

    def __init__(self, hot: list[list[tuple[str, bytes]]], its_lang: str, numbers: dict[bytes, int]):
        self._width, known = len(numbers) + 1, {b"": 0}
        self.phrases, self._keys, self._nodes = [b""], [], []
        for level in hot:
            keys, nodes, seen = [], [], {}
            for lang, phrase in level:
                head, _, word = phrase.rpartition(b" ")
                if lang == its_lang and head in known and word in numbers:
                    keys.append(known[head] * self._width + numbers[word])
                    seen[phrase] = len(self.phrases)
                    nodes.append(len(self.phrases))
                    self.phrases.append(phrase)
            order = np.argsort(np.array(keys, np.int64))
            self._keys.append(np.array(keys, np.int64)[order])
            self._nodes.append(np.array(nodes, np.int64)[order])
            known = seen

    def walk(self, windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each depth: the suffixes that have a word there below a hot prefix (the empty
        one always is), that prefix's node, and whether the prefix with the word is hot."""
        rows, nodes = np.arange(windows.shape[1]), np.zeros(windows.shape[1], np.int64)
        for depth in range(len(windows)):
            word = windows[depth, rows]
            rows, nodes, word = rows[word >= 0], nodes[word >= 0], word[word >= 0]
            if depth >= len(self._keys) or not len(self._keys[depth]):
                yield rows, nodes, np.zeros(len(rows), bool)
                return
            keys, wanted = self._keys[depth], nodes * self._width + word
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hot = keys[at] == wanted
            yield rows, nodes, hot
            rows, nodes = rows[hot], self._nodes[depth][at[hot]]


def _counted(lang: str, phrases: list[bytes], k: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    text = pa.array(phrases, pa.binary()).cast(pa.string())
    n = len(phrases)
    whole = pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), text, pa.array([k] * n, pa.int32()), pa.array(counts, pa.int64())], schema=_COUNTED)
    for at in range(0, n, 50_000):
        yield whole.slice(at, 50_000)


def _count_words(rows: DataFrame) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _read(parts):
            counts = np.bincount(texts.ids(), minlength=len(texts.numbers))
            yield from _counted(texts.lang, list(texts.numbers), 1, counts)

    return _summed(rows.mapInArrow(run, "lang string, phrase string, k int, f long"))


def _summed(counted: DataFrame) -> DataFrame:
    with with_settings(counted.sparkSession, _TEXT_ROWS):
        return cut_lineage(counted.groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f")))


def _count_extensions(rows: DataFrame, hot: list[list[tuple[str, bytes]]], known: _Known) -> DataFrame:
    """Counts of the prefixes with one word more than the deepest hot ones."""
    depth = len(hot)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _read(parts):
            windows, (numbers, names) = known.windows(texts, depth + 1), known.numbers(texts)
            prefixes = _HotPrefixes(hot, texts.lang, numbers)
            steps = list(prefixes.walk(windows))
            if len(steps) > depth and len(steps[depth][0]):
                suffixes, nodes, _ = steps[depth]
                keys, counts = np.unique(nodes * len(names) + windows[depth, suffixes], return_counts=True)
                phrases = [prefixes.phrases[k // len(names)] + b" " + names[k % len(names)] for k in keys.tolist()]
                yield from _counted(texts.lang, phrases, depth + 1, counts)

    return _summed(rows.mapInArrow(run, "lang string, phrase string, k int, f long"))


def _hash(lang: str, prefix: bytes) -> int:
    """The same number as Spark's ``xxhash64`` of language, line end and prefix."""
    value = xxhash.xxh64_intdigest(lang.encode() + b"\n" + prefix, seed=42)
    return value - (1 << 64) if value >> 63 else value


def _packed_groups(prefixes: DataFrame, budget: int) -> list[int]:
    """First hashes of the groups: prefixes by hash, cut where the suffixes reach the budget."""
    hashed = prefixes.select(F.xxhash64(F.concat_ws("\n", "lang", "phrase")).alias("h"), "f", F.lit(0).alias("all"))
    upto = running_sum(row_positions(hashed, ["h"]), ["all"], "pos", F.col("f"), "upto")
    firsts = upto.groupBy(F.expr(f"(upto - f) div {budget}").alias("g")).agg(F.min("h").alias("h"))
    return sorted(r.h for r in firsts.select("h").collect())


def _pack(columns: np.ndarray, counts: np.ndarray, route: np.ndarray, names: list[bytes] | None, packer: zstandard.ZstdCompressor) -> bytes:
    """Sorted suffixes of one group as bytes; with the words they use if those have no common numbers."""
    words = b""
    if names is not None:
        used, columns = np.unique(np.append(columns, -1), return_inverse=True)
        columns = columns[:-1].reshape(-1, len(counts)) - 1
        words = b"\n".join(names[i] for i in used[1:].tolist())
    depth, n = columns.shape
    planes = np.ascontiguousarray(columns + 1, "<u4").view(np.uint8).reshape(depth, n, 4).transpose(0, 2, 1).tobytes()
    head = np.array([depth, n, len(words)], "<i8").tobytes()
    return packer.compress(head + words + planes + counts.astype("<u4").tobytes() + route.astype(np.uint8).tobytes())


def _unpack(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Words if there are any, (depth, n) numbers from 1 (0: none), counts, routes."""
    data = zstandard.ZstdDecompressor().decompress(data)
    depth, n, length = np.frombuffer(data[:24], "<i8").tolist()
    at = 24 + length
    planes = np.frombuffer(data, np.uint8, 4 * depth * n, at).reshape(depth, 4, n).transpose(0, 2, 1)
    numbers = np.ascontiguousarray(planes).view("<u4").reshape(depth, n).astype(np.int32)
    at += 4 * depth * n
    return data[24 : 24 + length].split(b"\n") if length else [], numbers, np.frombuffer(data, "<u4", n, at), np.frombuffer(data, np.uint8, n, at + 4 * n)


def _deal_suffixes(rows: DataFrame, bounds: list[int], hot: list[list[tuple[str, bytes]]], known: _Known, depth: int, least_words: int) -> DataFrame:
    """(grp, lang, packed): suffixes of ``least_words`` or more, equal ones counted, by group."""
    limits = np.array(bounds[1:], np.int64)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for texts in _read(parts):
            windows, (numbers, names) = known.windows(texts, depth), known.numbers(texts)
            windows = windows[:, windows[least_words - 1] >= 0]
            if not windows.shape[1]:
                continue
            prefixes = _HotPrefixes(hot, texts.lang, numbers)
            group, route = np.full(windows.shape[1], -1, np.int64), np.zeros(windows.shape[1], np.uint8)
            for step, (suffixes, nodes, is_hot) in enumerate(prefixes.walk(windows)):
                keys, own = np.unique(nodes * len(names) + windows[step, suffixes], return_inverse=True)
                heads = (prefixes.phrases[k // len(names)] + b" " + names[k % len(names)] if step else names[k] for k in keys.tolist())
                hashes = np.fromiter((_hash(texts.lang, x) for x in heads), np.int64, len(keys))
                # a suffix that is a hot prefix and no more is counted already
                group[suffixes] = np.where(is_hot, -1, np.searchsorted(limits, hashes, side="right")[own])
                route[suffixes] = step + 1
            columns, group, route = windows[:, group >= 0], group[group >= 0], route[group >= 0]
            if not len(group):
                continue
            order = np.lexsort((*columns[::-1], group))
            columns, group, route = columns[:, order], group[order], route[order]
            new = np.ones(len(group), bool)
            new[1:] = (columns[:, 1:] != columns[:, :-1]).any(axis=0)
            starts = np.flatnonzero(new)
            counts = np.diff(np.append(starts, len(group)))
            columns, group, route = columns[:, starts], group[starts], route[starts]
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            for low, high in zip(cuts, cuts[1:]):
                packed = _pack(columns[:, low:high], counts[low:high], route[low:high], names if known.words is None else None, packer)
                yield pa.RecordBatch.from_pydict({"grp": [int(group[low])], "lang": [texts.lang], "packed": [packed]}, _PACKED)

    return rows.mapInArrow(run, "grp long, lang string, packed binary")


def subtree_counts(parts: list[bytes], least: int, least_words: int, names: list[bytes] | None) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(k, phrases, counts) of the nodes of one group's subtree with ``least`` or more.

    Nodes above their suffixes' prefix, or of fewer than ``least_words``, are not whole in
    the group and left out, but grown.
    """
    numbers, columns, counts, routes = _Numbers(), [], [], []
    for data in parts:
        words, own, n, route = _unpack(data)
        columns.append(np.array([-1, *map(numbers.__getitem__, words)], np.int32)[own] if words else own - 1)
        counts.append(n)
        routes.append(route)
    columns, counts, routes = np.concatenate(columns, axis=1), np.concatenate(counts).astype(np.float64), np.concatenate(routes)
    names = list(numbers) if names is None else names
    width = len(names)
    used, node = np.unique(columns[0], return_inverse=True)
    phrases = [names[i] for i in used.tolist()]
    for depth in range(1, len(columns)):
        go_on = columns[depth] >= 0
        columns, counts, routes, node = columns[:, go_on], counts[go_on], routes[go_on], node[go_on]
        if not len(node):
            return
        keys, first, own = np.unique(node.astype(np.int64) * width + columns[depth], return_index=True, return_inverse=True)
        totals = np.bincount(own, counts, len(keys)).astype(np.int64)  # sums under 2**53 are exact
        whole = routes[first] <= depth + 1
        stay = (totals >= least) | ~whole
        number = np.cumsum(stay) - 1
        kept = keys[stay].tolist()
        phrases = [phrases[k // width] + b" " + names[k % width] for k in kept]
        if depth + 1 >= least_words:
            out = np.flatnonzero(whole[stay])
            yield depth + 1, [phrases[i] for i in out.tolist()], totals[stay][out]
        keep = stay[own]
        columns, counts, routes, node = columns[:, keep], counts[keep], routes[keep], number[own[keep]]


def _grow(dealt: DataFrame, groups: int, least: int, least_words: int, known: _Known) -> DataFrame:
    ordered = dealt.repartition(groups, "grp").sortWithinPartitions("grp", "lang")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            names = None if known.words is None or not held else known.words[at[1]]
            for k, phrases, counts in subtree_counts(held, least, least_words, names) if held else ():
                yield from _counted(at[1], phrases, k, counts)

        for part in parts:
            for group, lang, packed in zip(*(x.to_pylist() for x in part.columns), strict=True):
                if (group, lang) != at:
                    yield from done()
                    at, held = (group, lang), []
                held.append(packed)
        yield from done()

    return ordered.mapInArrow(run, "lang string, phrase string, k int, f long")


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, budget: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all phrases of one to five words with ``f >= least``, and (lang, n).

    Counts cover all texts.  A group holds the suffixes of its prefixes, ``budget`` to
    twice as many; a prefix with more is extended by a word, up to the whole depth, so no
    word is too frequent.  What the driver holds are the groups' bounds (all words by
    ``budget``) and the prefixes above the budget, at most five times as many.  The range
    is elastic: pairs are counted first, then suffixes whose pairs are frequent are read
    to the whole depth.  Frequent words and pairs end a suffix early only where they are
    small enough to be sent around; the counts are the same either way.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(c(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(c(text), F.lit("")).alias("text"))
    single = _count_words(rows)
    sizes = cut_lineage(single.groupBy("lang").agg(F.sum("f").alias("n")))
    frequent = cut_lineage(single.where(F.col("f") >= least))
    known = _Known(None)
    if fits_broadcast(frequent.select("lang", "phrase")):
        words: dict[str, list[bytes]] = {}
        for r in frequent.orderBy("lang", F.desc("f"), "phrase").select("lang", "phrase").toLocalIterator():
            words.setdefault(r.lang, []).append(r.phrase.encode())
        known = _Known(words)
    hot: list[list[tuple[str, bytes]]] = []
    level, prefixes, counted = (single if known.words is None else frequent), [], [frequent]
    while True:
        over = [(r.lang, r.phrase.encode()) for r in level.where(F.col("f") > budget).select("lang", "phrase").collect()]
        prefixes.append(level.where(F.col("f") <= budget))
        if not over:
            break
        hot.append(over)
        if len(hot) > 1:
            counted.append(level.where((F.col("f") > budget) & (F.col("f") >= least)))
        if len(hot) == DEPTH:
            break
        level = _count_extensions(rows, hot, known)
    parts = prefixes[0]
    for more in prefixes[1:]:
        parts = parts.unionByName(more)
    bounds = _packed_groups(parts, budget)
    found = counted[0]
    for more in counted[1:]:
        found = found.unionByName(more)

    def grown(depth: int, least_words: int, known: _Known) -> DataFrame:
        with with_settings(spark, _TEXT_ROWS):
            dealt = _deal_suffixes(rows, bounds, hot, known, depth, least_words)
            return cut_lineage(_grow(dealt, max(len(bounds), 1), least, least_words, known))

    pairs = found.where("k = 2").unionByName(grown(2, 2, known))
    few = None
    if known.words is not None and fits_broadcast(pairs.select("lang", "phrase")):
        at = {g: {w: i for i, w in enumerate(some)} for g, some in known.words.items()}
        keys: dict[str, list[int]] = {}
        for r in pairs.select("lang", "phrase").toLocalIterator():
            a, b = r.phrase.encode().split(b" ")
            keys.setdefault(r.lang, []).append(at[r.lang][a] << 32 | at[r.lang][b])
        few = {g: np.sort(np.array(x, np.int64)) for g, x in keys.items()}
    longer = grown(DEPTH, 3, _Known(known.words, few))
    return cut_lineage(found.where("k <> 2").unionByName(pairs).unionByName(longer)), sizes


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, best: int = 2000, budget: int = 1_000_000) -> DataFrame:
    """The ``best`` phrases of each language, by how much more often their words meet than by chance.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into pieces, these at
    spaces and tabs into words; a null text has none, a null language counts as ``und``.
    A phrase of two to five words within a piece counts ``a`` times, ``least`` at least.
    Cut in two, its parts count ``l`` and ``r`` times and give floor(1000 a n / (l r)) with
    the language's ``n`` words; the cut with the lowest score counts, of equal ones the
    first.  Phrases inside a longer one that occurs as often are left out.  Returns lang,
    rank (by score, ``a``, both falling, and phrase), phrase, a, l, r, n, score.  An empty
    table, and a language without such phrases, gives no row; other columns are not read.
    """
    found, sizes = phrase_counts(docs, text, lang, least, budget)
    small = fits_broadcast(found)
    phrases = found.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    parts = phrases.select("lang", "phrase", "a", "k", cut, "w").select(
        "lang", "phrase", "a", "cut", F.array_join(F.expr("slice(w, 1, cut)"), " ").alias("head"), F.array_join(F.expr("slice(w, cut + 1, k - cut)"), " ").alias("tail")
    )
    heads = found.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = found.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = lookup_join(lookup_join(parts, heads, ["lang", "head"], "inner", small), tails, ["lang", "tail"], "inner", small)
    scored = lookup_join(scored, sizes, "lang", "inner")
    wide = {x: f"cast({x} as decimal(19, 0))" for x in ("a", "n", "l", "r")}
    score = F.expr(f"(1000 * {wide['a']} * {wide['n']}) div ({wide['l']} * {wide['r']})")
    lowest = scored.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    # phrases inside longer ones: from 2 to k - 1 words, at every place
    inside = F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(w, i, m), ' '))))")
    longer = phrases.where("k > 2").select("lang", F.explode(inside).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    alone = lowest.join(longer, ["lang", "phrase"], "left").where("longest is null or longest < a")
    rows = alone.select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score", F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("part"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's best are among the best of its parts, so no task sorts a whole language
    few = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= best)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
