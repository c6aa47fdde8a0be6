"""From raw documents to token shards, in five stages.

Every stage gets what the one before has written, works on all of it and returns the
columns of ``documents``; the last one returns what it reads back from its shards.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkhunt.llm import decontaminate, lsh_forest, mixing, pu_toxicity, wavelet
from sparkhunt.llm.common import table
from sparkhunt.session import scratch_path

#: Arrow batches of few rows, since texts may be long.
BATCH_ROWS = "512"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return pu_toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more, the smallest id stays."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return lsh_forest.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shard by shard."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return mixing.mixed_rows(docs)


def token_binary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of all rows; one result row per row, read from the shards."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    shards = scratch_path(spark, "tokens")
    wavelet.write_tokens(docs, shards, public_tokenizers.path("byte_bpe_50k.json"))
    return wavelet.read_tokens(spark, shards)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_binary", token_binary),
]

#: The classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
