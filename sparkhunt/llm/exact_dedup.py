"""Exact deduplication against a persistent index of digests (SQL functions only)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkhunt.llm.common import own_name
from sparkhunt.names import c
from sparkhunt.operators.lookup import totals_join
from sparkhunt.session import cut_lineage


class DigestIndex:
    """SHA-256 digests of all texts seen so far, bucketed and sorted by digest.

    The index is a Parquet table at ``location`` (a shared folder); a later session
    attaches it again by naming the same location and number of buckets.  It holds one
    row per text: ``digest``, ``keep_id`` (the document that stays) and ``batch``.
    """

    def __init__(self, spark: SparkSession, location: str, buckets: int = 64, id_type: str = "bigint"):
        self.spark, self.location, self.buckets = spark, location, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"create table {self.name} (digest binary, keep_id {id_type}, batch string) using parquet "
            f"clustered by (digest) sorted by (digest) into {buckets} buckets location '{location}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def ingest(self, docs: DataFrame, key: str = "doc_id", text: str = "text", batch: str | None = None) -> DataFrame:
        """Append the new texts of ``docs`` and tell for every row of it what stays.

        Texts are equal when identical; a null text counts as empty.  Of equal new texts
        the row with the largest key stays (null keys come last; of rows that repeat the
        key, one).  A text of an earlier batch is dropped in favour of that batch's row.

        Returns one row per row of ``docs``: the key, ``keep_id``, ``group_size`` (rows of
        this batch with the text), ``kept`` and ``text_sha256``.  Other columns of
        ``docs`` are not read, whatever they are called.

        Texts are reduced to digests and pre-aggregated, so that the sort-merge anti-join
        sees one row per text; the index side is read in its buckets, without a shuffle.
        Digests that many rows share are salted when the verdict is joined back.
        """
        batch = batch or uuid.uuid4().hex
        rows = cut_lineage(
            docs.select(
                c(key).alias("id"),
                F.unhex(F.sha2(F.coalesce(c(text), F.lit("")), 256)).alias("digest"),
                F.monotonically_increasing_id().alias("row"),  # fixed once written
            )
        )
        new = rows.groupBy("digest").agg(
            F.max(F.struct("id", "row")).alias("keeper"), F.count(F.lit(1)).alias("n")
        )
        known = self.rows()
        unseen = new.join(known.select("digest").hint("merge"), "digest", "left_anti").select(
            "digest", F.col("keeper.id").alias("keep_id"), F.lit(batch).alias("batch")
        )
        self._append(unseen)
        verdicts = cut_lineage(
            new.join(self.rows().hint("merge"), "digest").select(
                "digest",
                "keep_id",
                F.when(F.col("batch") == batch, F.col("keeper.row")).alias("kept_row"),
                F.col("n").alias("group_size"),
                "n",
            )
        )
        return totals_join(rows, verdicts, ["digest"], "n", how="inner").select(
            F.col("id").alias(key),
            "keep_id" if key.lower() != "keep_id" else F.col("keep_id").alias(own_name("keep_id", [key])),
            "group_size",
            F.coalesce(F.col("kept_row") == F.col("row"), F.lit(False)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def _append(self, unseen: DataFrame) -> None:
        spread = unseen.repartition(self.buckets, "digest").sortWithinPartitions("digest")
        spread.write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
