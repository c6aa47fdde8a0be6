import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkhunt.llm import token_counts, wavelet
from sparkhunt.llm.bpe import PieceEncoder, parts_at_spaces
from sparkhunt.session import scratch_path
from tests.llm.helpers import docs_table

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
PIECES = PieceEncoder(PATH, offsets=True, most=200)
ODD = ["", " ", "  a", "a  b", "a   b", "a \n b", "\n", "a\n", "it's we'll 'S", " <|endoftext|> x", "ß　x   y", "a\tb \tc", "🙂 👩‍👩 x", "a ", "a\x1c b \x85 c"]


def check_same(texts):
    ids, lengths, spans = PIECES.encode(pa.array(texts, pa.string()))
    at = 0
    for text, n in zip(texts, lengths.tolist(), strict=True):
        code = WHOLE.encode(text, add_special_tokens=False)
        assert ids[at : at + n].tolist() == code.ids
        assert list(map(tuple, spans[at : at + n].tolist())) == code.offsets
        at += n
    assert at == len(ids)


def test_pieces_give_the_ids_of_whole_texts():
    check_same(ODD)
    check_same([])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tab'sé🙂.,1　\x1c", max_size=30), max_size=5))
def test_pieces_give_the_ids_of_any_text(texts):
    check_same(texts)


def test_special_strings_are_what_the_library_makes_of_them():
    check_same(["see <|endoftext|> here", "<|endoftext|>", "a<|endoftext|><|endoftext|> b  c", "<|endoftext| >"])
    assert 50256 in PIECES.encode(pa.array(["see <|endoftext|> here"]))[0]


def test_a_file_that_splits_otherwise_is_given_whole_texts(tmp_path):
    plain = json.load(open(PATH, encoding="utf-8"))
    assert parts_at_spaces(plain)
    lower = {**plain, "normalizer": {"type": "Lowercase"}}
    prefixed = {**plain, "pre_tokenizer": {**plain["pre_tokenizer"], "add_prefix_space": True}}
    unsplit = {**plain, "pre_tokenizer": {**plain["pre_tokenizer"], "use_regex": False}}
    for i, other in enumerate((lower, prefixed, unsplit)):
        assert not parts_at_spaces(other)
        path = tmp_path / f"{i}.json"
        path.write_text(json.dumps(other), encoding="utf-8")
        whole, pieces = Tokenizer.from_file(str(path)), PieceEncoder(str(path), offsets=True)
        for _ in range(2):
            ids, lengths, spans = pieces.encode(pa.array(["One Two three", "x", "", " One"]))
            codes = [whole.encode(t, add_special_tokens=False) for t in ("One Two three", "x", "", " One")]
            assert ids.tolist() == [x for c in codes for x in c.ids] and lengths.tolist() == [len(c.ids) for c in codes]
            assert list(map(tuple, spans.tolist())) == [x for c in codes for x in c.offsets]


class Counting:
    """The tokenizer; counts the strings given to it."""

    def __init__(self, tokenizer):
        self._tokenizer, self.seen = tokenizer, []

    def encode_batch_fast(self, some, **how):
        self.seen += some
        return self._tokenizer.encode_batch_fast(some, **how)


def test_new_pieces_go_to_the_library_as_lines_of_few_texts():
    plain = PieceEncoder(PATH, most=300)
    plain._tokenizer = library = Counting(plain._tokenizer)
    text = " ".join(f"w{i}x" for i in range(2000))
    assert plain.encode(pa.array([text]))[0].tolist() == WHOLE.encode(text).ids
    assert len(library.seen) < 80
    for some in (ODD, ["<|endoftext|>", "a", "b"], ["a\nb c\n d", "ends\x85 \u2028 é\u3000 x\x1c", "'s 't a's"], [text, *ODD]):
        ids, lengths, _ = plain.encode(pa.array(some, pa.string()))
        codes = [WHOLE.encode(t, add_special_tokens=False).ids for t in some]
        assert lengths.tolist() == list(map(len, codes)) and ids.tolist() == [x for c in codes for x in c]


def test_pieces_that_come_again_are_not_encoded_again():
    plain, spans = PieceEncoder(PATH, most=160), PieceEncoder(PATH, offsets=True, most=160)
    plain._tokenizer = library = Counting(plain._tokenizer)
    often = " ".join(f"often{i}" for i in range(25))
    for i in range(12):
        some = [f"{often} " + " ".join(f"once{i}x{j}" for j in range(40)), "  a  b\n", often]
        codes = [WHOLE.encode(t, add_special_tokens=False) for t in some]
        for encoder in (plain, spans):
            ids, lengths, places = encoder.encode(pa.array(some))
            assert ids.tolist() == [x for c in codes for x in c.ids] and lengths.tolist() == [len(c.ids) for c in codes]
        assert list(map(tuple, places.tolist())) == [x for c in codes for x in c.offsets]
    given = "\n".join(library.seen)
    assert given.count("once3x7") == 1 and given.count("often7") == 1


def test_sections_share_the_tokens_of_the_whole_text(spark):
    rows = [(1, "one two\nthree\n\nfour"), (2, None), (3, ""), (4, "\n"), (5, "wordwordword " * 3000), (1, "one two\nthree\n\nfour")]
    docs = docs_table(spark, rows)
    out = token_counts.attribute_tokens(docs, token_counts.line_sizes(F.col("text")), PATH).collect()
    for key, text in rows:
        times = sum(r[0] == key for r in rows)
        mine = [r for r in out if r.doc_id == key]
        assert sum(r.n_tokens for r in mine) == times * len(WHOLE.encode(text or "", add_special_tokens=False).ids)
        assert sum(r.n_chars for r in mine) == times * len(text or "")
        assert len(mine) == times * ((text or "").count("\n") + 1)
    assert token_counts.attribute_tokens(docs_table(spark, []), token_counts.line_sizes(F.col("text")), PATH).count() == 0


def test_a_token_across_borders_goes_where_the_rule_says():
    spans, ends = np.array([[0, 3], [3, 9], [9, 9]]), np.array([3, 4, 4, 9])
    assert token_counts.allocate(spans, ends, "first")[0].tolist() == [0, 1, 3]
    assert token_counts.allocate(spans, ends, "last")[0].tolist() == [0, 3, 3]
    owner, crosses = token_counts.allocate(spans, ends, "most")
    assert owner.tolist() == [0, 3, 3] and crosses.tolist() == [False, True, False]
    assert token_counts.allocate(np.array([[0, 2]]), np.array([1, 2]), "most")[0].tolist() == [0]


@pytest.mark.parametrize("n, top", [(0, 5), (1, 1), (7, 2), (70_000, 50_256), (300_000, 70_000)])
def test_wavelet_answers(spark, n, top):
    rng = np.random.default_rng(n)
    ids = (rng.integers(0, top, n) * (rng.random(n) < 0.6)).astype(np.uint32)
    folder = scratch_path(spark, "w")
    name = wavelet.write_shard(folder, "s", ids, np.array([4]), np.array([n]), np.array([False]))
    shard = wavelet.WaveletShard(folder, name, cached_blocks=64)
    assert (shard.tokens() == ids).all() and shard.n == n
    for at in rng.integers(0, n, 20).tolist() if n else []:
        token = int(ids[at])
        assert shard.access(at) == token
        assert shard.count(token) == int((ids == token).sum())
        low, high = sorted(rng.integers(0, n + 1, 2).tolist())
        assert shard.count(token, low, high) == int((ids[low:high] == token).sum())
        if token:
            assert list(shard.locate(token))[:5] == np.flatnonzero(ids == token)[:5].tolist()
    assert shard.count(1 << 20) == 0
    assert [x.tolist() for x in shard.documents()] == [[4], [n], [False]]


def test_shards_hold_all_documents_in_order(spark):
    rows = [(5, "b c <|endoftext|> d"), (3, None), (None, "n"), (4, ""), (2, "long text " * 20_000), (5, "b c"), (5, "a")]
    folder = scratch_path(spark, "w")
    manifest = wavelet.write_tokens(docs_table(spark, rows), folder, PATH, shard_tokens=1000)
    out = sorted(wavelet.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    want, at = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*WHOLE.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert [tuple(r) for r in out] == want
    assert manifest.agg(F.sum("n_tokens")).first()[0] == at
    assert wavelet.count_token(spark, folder, 2).agg(F.sum("n")).first()[0] == len(rows)
    empty = scratch_path(spark, "w")
    wavelet.write_tokens(docs_table(spark, []), empty, PATH)
    assert wavelet.read_tokens(spark, empty).count() == 0
