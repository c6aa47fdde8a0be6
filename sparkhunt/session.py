"""Session defaults and the reliable checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this library relies on.  Sizes (executors, memory) stay with
#: the cluster; the shuffle partition count is left to adaptive execution.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("sparkhunt")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sparkhunt-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table below the shared checkpoint folder and read it back.

    Used between rounds of iterative jobs and where several branches read one result.
    It stays there until :func:`discard`.  A table, unlike ``checkpoint()``, does not carry the constraints of its plan on to
    the next round, where they would multiply.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


def as_table(df: DataFrame) -> DataFrame:
    """``df`` itself where :func:`cut_lineage` gave it, else written now."""
    return df if getattr(df, "written_at", None) else cut_lineage(df)


def discard(*tables: DataFrame | None) -> None:
    """Delete tables of :func:`cut_lineage` that nothing reads any more.

    For rounds of a loop, once what follows from them is written itself.
    """
    for table in tables:
        path = getattr(table, "written_at", None)
        if path is not None:
            where = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(table.sparkSession._jsc.sc().hadoopConfiguration()).delete(where, True)


def fixed_partitions(df: DataFrame) -> DataFrame:
    """Checkpoint ``df``: the same rows in the same partitions however often it is read."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder for a written table."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
