import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sparkhunt.session import scratch_path
from tests.llm.helpers import brute_classes, brute_leaks

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after = {k for k, _ in rows(stages[0])}, {k for k, _ in rows(stages[1])}
    assert after <= before and stages[1].columns == COLUMNS
    clean = [k for k in before if labels.get(k) == 0]
    assert sum(k in after for k in clean) >= 0.95 * len(clean)


def test_one_document_of_each_group_stays(stages):
    before, after = rows(stages[1]), rows(stages[2])
    classes = {key: cls for key, cls, _ in brute_classes(before)}
    assert sorted(k for k, _ in after) == sorted(set(classes.values())) and stages[2].columns == COLUMNS


def test_leaking_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before, after = rows(stages[2]), rows(stages[3])
    bad = {key for key, *_ in brute_leaks(before, items)}
    assert sorted(k for k, _ in after) == sorted(k for k, _ in before if k not in bad) and stages[3].columns == COLUMNS


def test_the_mix_repeats_whole_documents(stages):
    before, after = set(rows(stages[3])), Counter(rows(stages[4]))
    assert set(after) <= before and max(after.values()) <= 3 and stages[4].columns == COLUMNS


def test_shards_hold_what_was_mixed(spark, stages):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, at = [], 0
    for key, text in sorted(rows(stages[4])):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, stages[5].collect()), key=lambda r: r[1]) == want


def test_the_pipeline_of_an_empty_table_is_empty(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.count() == 0
