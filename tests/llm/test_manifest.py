"""The Merkle manifest against a plain one, and its odd cases."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sparkhunt.llm import merkle
from sparkhunt.session import scratch_path

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, leaf string, root string, pos string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_hash(row, text):
    values = [row[0], row[3], row[2], row[4], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def brute(rows):
    groups = {}
    for row in rows:
        leaf = row_hash(row, row[1])
        start = leaf
        if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None:
            start = row_hash(row, row[1].translate(str.maketrans(UPPER, LOWER)))
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf, start))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels([r[2] for r in sorted(groups[g])]) for g in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for number, (name, tree) in enumerate(zip(names, trees, strict=True)):
        for at, (some, key, leaf, held) in enumerate(sorted(groups[name])):
            proof, place, whole = "", at, [*tree[:-1], None, *top[:-1]]
            for level in whole:
                if level is None:
                    place = number
                    continue
                low = place // 8 * 8
                run = level[low : low + 8]
                before, after = "".join(run[: place - low]), "".join(run[place - low + 1 :])
                proof, held, place = proof + before + after, sha(before + held + after), place // 8
            out.append((key if some else None, leaf, tree[-1][0], top[-1][0], sha(proof), held, held == top[-1][0]))
    return sorted(out, key=repr)


def verified(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "y", "z", "p") for r in rows], SCHEMA)
    forged = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = merkle.verify(docs, FIELDS, {"text": F.translate("text", UPPER, LOWER)}, forged)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def doc(key, text, lang="en", source="s", n=1):
    return (key, text, lang, source, n)


@pytest.mark.parametrize(
    "rows",
    [
        [doc(1, "Only")],
        [doc(i, "Same Text") for i in range(8)],
        [doc(i, f"Text {i} É") for i in range(9)] + [doc(3, "Text 3 É")],
        [doc(i, "T" * (i % 3), f"l{i % 11}") for i in range(40)],
        [doc(None, None, None, None, None), doc(4, None, None), doc(5, "", ""), doc(6, "A: b", "é", None), doc(6, "A: b", "z")] * 2,
        [doc(i, "Long Text " * 30_000 if i == 7 else "T", "en" if i % 5 else None) for i in range(130)],
    ],
    ids=["one", "one full run", "a run of one", "many groups", "nulls and repeats", "long text"],
)
def test_every_leaf_against_a_plain_tree(spark, rows):
    got = verified(spark, rows)
    assert got == brute(rows)


def test_an_empty_table_has_no_tree(spark):
    assert verified(spark, []) == []


def test_tampering_is_seen_where_it_changes_something(spark):
    rows = [doc(i, "Upper" if i % 2 else "lower") for i in range(200)]
    for key, *_, good in verified(spark, rows):
        assert good == (zlib.crc32(str(key).encode()) % 3 != 0 or key % 2 == 0)


def test_the_kept_tables_link_leaves_to_the_root(spark):
    docs = spark.createDataFrame([(*doc(i, f"t{i}", f"l{i % 3}"), "x", "y", "z", "p") for i in range(70)], SCHEMA)
    leaf = merkle.field_hash([F.col(f) for f in FIELDS])
    tree = merkle.build_tree(docs, "doc_id", "lang", leaf, leaf)
    folder = scratch_path(spark, "manifest")
    merkle.manifest(tree, folder)
    nodes = {r.node: r for r in spark.read.parquet(f"{folder}/nodes").collect()}
    leaves = spark.read.parquet(f"{folder}/leaves").collect()
    assert len(leaves) == 70 and spark.conf.get("spark.sql.cteRecursionRowLimit") == "1000000"
    for r in leaves:
        held, parent, place = bytes(r.leaf), r.parent, r.place
        while parent is not None:
            node = nodes[parent]
            assert bytes(node.run)[32 * place : 32 * place + 32] == held
            held = hashlib.sha256(bytes(node.run).hex().encode()).digest()
            parent, place = node.parent, node.place
        assert held.hex() == tree.root
