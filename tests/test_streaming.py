"""Windowed counts and stateless scoring on a stream of files."""

from pyspark.sql import functions as F

from sparkhunt.functions.globs import glob_score
from sparkhunt.streaming.incremental import stream_hourly_histogram, stream_time_series


def _run(df, name, mode):
    query = df.writeStream.outputMode(mode).format("memory").queryName(name).start()
    query.processAllAvailable()
    query.stop()
    return df.sparkSession.table(name)


def test_stream_counts_equal_batch_counts(spark, tmp_path):
    rows = spark.range(500).select(
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 97).alias("ts"),
        F.when(F.col("id") % 5 == 0, "python -m http.server").otherwise("ls").alias("command_line"),
    )
    rows.write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))

    hours = _run(stream_hourly_histogram(stream(), "ts"), "hours", "complete")
    got = {(r["hour"], r["bin"]): r["n"] for r in hours.groupBy("hour", "bin").agg(F.sum("n").alias("n")).collect()}
    batch = rows.groupBy(F.hour("ts").alias("h"), F.floor(F.minute("ts") / 10).cast("int").alias("b")).count()
    assert got == {(r["h"], r["b"]): r["count"] for r in batch.collect()}

    series = _run(stream_time_series(stream(), "ts", F.count(F.lit(1)), "1 hour"), "series", "complete")
    assert series.agg(F.sum("value")).first()[0] == 500

    scored = _run(stream().select(glob_score(F.col("command_line")).alias("s")), "scored", "append")
    assert scored.where("s > 0").count() == 100
