import random

import numpy as np
import pytest

from sparkhunt.llm import decontaminate, lsh_forest
from tests.llm.helpers import brute_classes, brute_leaks, docs_table


def texts(seed, n_groups, copies, length):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n_groups):
        base = rng.choices(vocabulary, k=rng.randint(length // 2, length))
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            out.append(" ".join(own))
    return out


def test_depth_follows_recall():
    assert lsh_forest.matching_depth(32, 8, 0.8, 0.999) == 7
    assert lsh_forest.matching_depth(32, 8, 0.8, 0.9) == 8
    assert lsh_forest.matching_depth(1, 8, 0.8, 0.999) == 1


def test_shingles_of_short_and_empty_texts():
    flat, sizes = np.arange(1, 12, dtype=np.int64), np.array([0, 6, 1, 4, 0])
    hashes, counts = lsh_forest.shingle_hashes(flat, sizes)
    assert counts.tolist() == [0, 2, 1, 1, 0] and len(set(hashes.tolist())) == 4


@pytest.mark.parametrize("chunk", [3, 256])
def test_links_and_classes_agree_with_all_pairs(spark, chunk):
    rows = [(i * 3, t) for i, t in enumerate(texts(1, 25, 12, 80))]
    rows += [(1000, None), (1001, ""), (1002, "!!"), (1003, "two words"), (1004, "Two, words"), (1005, "two words more"), (0, rows[0][1]), (None, rows[0][1]), (None, "lone text of six words here"), (2000, "x " * 50_000)]
    rows += [(3000 + i, "copy of one and the same text") for i in range(40)]
    out = lsh_forest.jaccard_join(docs_table(spark, rows), chunk=chunk).collect()
    order = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(tuple, out), key=order) == sorted(brute_classes(rows), key=order)


def test_one_of_each_class_stays(spark):
    rows = [(i, t) for i, t in enumerate(texts(2, 10, 6, 60))] + [(903, "same"), (902, "same"), (902, "same"), (None, "same"), (None, "only null")]
    docs = docs_table(spark, rows)
    out = lsh_forest.one_of_each(docs)
    assert out.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    classes = {c for _, c, _ in brute_classes(rows)}
    assert sorted(k for k, _ in kept if k is not None) == sorted(c for c in classes if c is not None)
    assert [t for k, t in kept if k is None] == ["only null"]
    assert lsh_forest.one_of_each(docs_table(spark, [])).count() == 0


@pytest.fixture(scope="module")
def leaky():
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([5, 12, 30, 55])))) for i in range(12)]
    items += [(20, None), (21, "too few words"), (22, items[3][1]), (None, "item without a number has six words")]
    rows = []
    for i in range(60):
        body = rng.choices(vocabulary, k=rng.randint(0, 120))
        passage = (items[rng.randrange(12)][1]).split()
        if i % 3 == 0:
            for _ in range(i % 4):
                passage[rng.randrange(len(passage))] = "edited"
        at = rng.randint(0, len(body))
        rows.append((i, " ".join(body[:at] + (passage if i % 2 else passage + passage) + body[at:]).upper() if i % 5 else " ".join(body)))
    rows += [(100, None), (101, ""), (None, items[0][1]), (7, rows[7][1]), (102, "x, " * 30_000 + items[2][1]), (103, "item without a number has six words")]
    return rows, items


def test_leaks_agree_with_all_windows(spark, leaky):
    rows, items = leaky
    bench = spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, similarity string")
    out = decontaminate.leaks(docs_table(spark, rows), bench).collect()
    assert {(r.id, r.item, r.start_word, round(r.similarity, 9)) for r in out} == brute_leaks(rows, items)
    assert len(out) > 20


def test_windows_that_no_shared_beginning_places(spark):
    rng = random.Random(9)
    vocabulary = [f"u{i}" for i in range(5000)]
    item = rng.choices(vocabulary, k=200)
    short = [rng.sample(vocabulary, 9) for _ in range(150)]
    pairs = [(rng.sample(vocabulary, 2) * 20)[:20] for _ in range(30)]
    items = [(0, " ".join(item))] + [(1000 + i, " ".join(x)) for i, x in enumerate(short)] + [(5000 + i, " ".join(x)) for i, x in enumerate(pairs)]
    filler = lambda n: rng.choices([f"f{i}" for i in range(5000)], k=n)
    rows = [(0, " ".join(filler(30) + item[100:] + item[:100] + filler(30)))]  # halves in the other order
    rows += [(1000 + i, " ".join(filler(20) + x[: 8])) for i, x in enumerate(short)]
    rows += [(5000 + i, " ".join(filler(20) + x[: 19])) for i, x in enumerate(pairs)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.leaks(docs_table(spark, rows), bench).collect()
    found = {(r.id, r.item, r.start_word, round(r.similarity, 9)) for r in out}
    assert found == brute_leaks(rows, items)
    assert {(k, k) for k, _ in rows} <= {(a, b) for a, b, *_ in found}


def test_repetitive_texts_and_several_texts_of_an_item(spark):
    rng = random.Random(12)
    few = ["a", "b", "c"]
    items = [(i, " ".join(rng.choices(few, k=rng.choice([5, 8, 14, 30])))) for i in range(25)]
    items += [(3, items[9][1]), (30, "a " * 40), (31, items[4][1])]
    rows = [(i, " ".join(rng.choices(few, k=rng.randint(0, 60)))) for i in range(60)] + [(100, "a " * 500), (101, "A, " * 30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.leaks(docs_table(spark, rows), bench).collect()
    assert {(r.id, r.item, r.start_word, round(r.similarity, 9)) for r in out} == brute_leaks(rows, items)
    assert len(out) > 30


def test_only_shingles_between_windows_are_sent_on(spark):
    words = [f"p{i}" for i in range(104)]
    rows = spark.createDataFrame([(k, " ".join(words), h) for k, h in ((1, 5), (1, 5), (None, 5), (2, 5))], "id long, text string, text_hash long")
    windows = spark.createDataFrame([(1, 5, 10, 20), (1, 5, 10, 33), (1, 5, 4, 24), (None, 5, 10, 95)], "id long, text_hash long, n long, start long")
    out = sorted((r.id or 0, r.text_hash, r.pos) for r in decontaminate._near_windows(rows, windows).collect())
    assert out == [(0, 5, p) for p in range(95, 100)] + [(1, 5, p) for p in range(20, 43)]


def test_clean_documents_stay(spark, leaky):
    rows, items = leaky
    docs = docs_table(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.decontaminate(docs, bench)
    bad = {k for k, *_ in brute_leaks(rows, items)}
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(k for k, _ in rows if k not in bad)
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == len(rows)
    assert decontaminate.leaks(docs_table(spark, []), bench).count() == 0


def test_blocks_reach_every_fingerprint_in_the_radius(spark):
    from pyspark.sql import functions as F

    rng = random.Random(6)
    pairs = []
    for _ in range(200):
        a, b = rng.getrandbits(64), 0
        for bit in rng.sample(range(64), decontaminate.RADIUS):
            b |= 1 << bit
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        pairs.append((signed(a), signed(a ^ b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    probes = F.flatten(F.transform(decontaminate._blocks(F.col("a")), lambda x: F.transform(decontaminate._near_values(x["block"], x["value"]), lambda v: F.struct(x["block"].alias("block"), v.cast("int").alias("value")))))
    assert df.where(~F.arrays_overlap(probes, decontaminate._blocks(F.col("b")))).count() == 0
