"""Collocations and repeated byte strings against brute force, and their odd cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkhunt.llm import collocations, suffix_repeats
from tests.llm.helpers import docs_table

LANGS = "doc_id long, lang string, text string, phrase string, f long, n long, `a.b` string"
RNG = random.Random(5)


def with_langs(spark, rows):
    return spark.createDataFrame([(i, g, t, "p", 1, 2, "x") for i, (g, t) in enumerate(rows)], LANGS)


def brute_phrases(rows, least):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = [x for x in re.split("[ \t]+", piece) if x]
            sizes[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(5, len(w) - i) + 1):
                    counts[lang, tuple(w[i : i + k])] += 1
    return {x: n for x, n in counts.items() if n >= least}, sizes


def brute_collocations(rows, least, best):
    counts, sizes = brute_phrases(rows, least)
    inside = {}
    for (lang, w), a in counts.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                key = lang, w[i : i + k]
                inside[key] = max(inside.get(key, 0), a)
    found = {}
    for (lang, w), a in counts.items():
        if len(w) > 1 and inside.get((lang, w), 0) < a:
            cuts = [(1000 * a * sizes[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    out = []
    for lang, some in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(some)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def mixed_texts(n=60):
    vocabulary = ["a", "b", "The", "of", "é", "x\x01", "\x00", "ß", "ab", "\x1c"]
    rows = []
    for i in range(n):
        w = RNG.choices(vocabulary, [9, 6, 5, 4, 3, 2, 1, 1, 1, 1], k=RNG.randrange(80))
        text = "".join(x + RNG.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " ;"]) for x in w)
        rows.append((RNG.choice(["en", "en", None, "und", "d e"]), text))
    return [*rows, ("en", None), ("en", ""), (None, " \t.,"), ("one", "a"), ("en", "zz " * 20_000), ("en", "q" * 50_000)]


@pytest.mark.parametrize("budget", [1_000_000, 60, 7, 1])
def test_collocations_against_brute_force(spark, budget):
    rows = mixed_texts()
    got = collocations.collocations(with_langs(spark, rows), least=5, best=30, budget=budget)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 5, 30)


def test_counts_without_the_words_sent_around(spark, monkeypatch):
    monkeypatch.setattr(collocations, "fits_broadcast", lambda df: False)
    rows = mixed_texts()
    found, sizes = collocations.phrase_counts(with_langs(spark, rows), least=3, budget=200)
    want, n = brute_phrases(rows, 3)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in found.collect()} == want
    assert {r.lang: r.n for r in sizes.collect()} == {g: x for g, x in n.items() if x}


def test_counts_past_64_bits_and_empty_tables(spark):
    assert collocations.collocations(with_langs(spark, [])).count() == 0
    assert collocations.collocations(with_langs(spark, [("en", "a b"), (None, None)])).count() == 0
    big = spark.sql("select (1000 * cast(9e12 as decimal(19,0)) * cast(2e14 as decimal(19,0))) div (cast(9e12 as decimal(19,0)) * cast(9e12 as decimal(19,0))) s").first()[0]
    assert big == 1000 * 9 * 10**12 * 2 * 10**14 // (81 * 10**24)


def test_the_hash_of_a_prefix_is_the_one_of_spark(spark):
    assert spark.sql("select xxhash64(concat_ws('\n', 'en', 'é x'))").first()[0] == collocations._hash("en", "é x".encode())


def brute_removed(rows):
    """Text by (key, text) -> kept bytes and spans, windows in the order of key, text, start."""
    texts = {(r[0], r[1] or "") for r in rows}
    tie = lambda t: int(__import__("hashlib").sha256(t.encode()).hexdigest()[:15], 16)
    seen, out = set(), {}
    for key, text in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1]))):
        data = text.encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(data[p : p + 100])
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        out[key, text] = (bytes(b for b, g in zip(data, gone) if not g), list(zip(edges[::2].tolist(), edges[1::2].tolist())))
    return out


def cleaned(spark, rows, **more):
    return suffix_repeats.remove_repeats(docs_table(spark, rows), **more)


def check_removed(spark, rows, **more):
    got = cleaned(spark, rows, **more)
    assert got.columns == ["doc_id", "n_bytes", "spans", "kept"]
    want = brute_removed(rows)
    wanted = Counter((r[0], len((r[1] or "").encode()), tuple(want[r[0], r[1] or ""][1]), want[r[0], r[1] or ""][0]) for r in rows)
    assert Counter((r.doc_id, r.n_bytes, tuple((s.start, s.stop) for s in r.spans or ()), bytes(r.kept)) for r in got.collect()) == wanted


def passage_texts():
    word = lambda: "".join(RNG.choices("abcdeé ", k=RNG.randrange(2, 9)))
    passages = ["".join(word() for _ in range(n)) for n in (18, 19, 25, 60, 400)]
    rows = []
    for i in range(70):
        parts = ["".join(word() for _ in range(RNG.randrange(30)))]
        for _ in range(RNG.randrange(3)):
            p = RNG.choice(passages)
            if RNG.random() < 0.4:
                at = RNG.randrange(len(p))
                p = p[:at] + "#" + p[at + 1 :]
            parts += [p, "".join(word() for _ in range(RNG.randrange(12)))]
        rows.append((RNG.choice([i, i, 1000 - i, 3, None]), "".join(parts)))
    rows += [(70, None), (71, ""), (72, "x" * 99), (73, "x" * 100), (74, "x" * 3000), (75, "ab" * 800), (76, "x" * 101)]
    return rows + rows[:6] + [(2000 + i, "k" + passages[3] + str(i)) for i in range(40)]


@pytest.mark.parametrize("bucket_rows", [5_000, 3, 1])
def test_repeats_against_brute_force(spark, bucket_rows):
    check_removed(spark, passage_texts(), bucket_rows=bucket_rows)


def test_repeats_in_tables_without_any(spark):
    check_removed(spark, [])
    check_removed(spark, [(1, None), (None, "")])
    check_removed(spark, [(1, "short"), (2, "short")])


def test_a_long_text_is_worked_on_in_slices(spark, monkeypatch):
    base = "".join(RNG.choices("abcdefgh ", k=3000))
    whole = base + "|" + base[500:2500] + "!" + "".join(RNG.choices("xyz", k=400_000)) + base[:1000]
    check_removed(spark, [(1, whole), (0, base[700:1200])])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=400), max_size=4), st.integers(100, 700))
def test_windows_and_their_numbers(texts, width):
    texts = [t * 2 for t in texts]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    before, suffix_repeats._SLICE = suffix_repeats._SLICE, width
    try:
        found = list(suffix_repeats.anchors(data, offsets))
    finally:
        suffix_repeats._SLICE = before
    starts = [int(s) for _, low, n, _ in found for a, k in zip(low, n) for s in range(a, a + k)]
    inside = [p for t, low in zip(texts, offsets) for p in range(low, low + len(t) - 99)]
    assert sorted(starts) == inside
    if inside:
        whole = data.tobytes()
        windows = [whole[p : p + 100] for p in inside]
        counts, number = Counter(windows), suffix_repeats.refine(data, np.array(inside))
        assert all((counts[w] == 1) == (x < 0) for w, x in zip(windows, number.tolist()))
        assert len({x for x in number.tolist() if x >= 0}) == sum(n > 1 for n in counts.values())
        anchor = {}
        for h, low, n, ahead in found:
            for a, k, x, g in zip(low, n, ahead, h):
                for s in range(a, a + k):
                    assert anchor.setdefault(whole[s : s + 100], (a + x - s, g)) == (a + x - s, g)
