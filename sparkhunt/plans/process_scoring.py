"""Suspicious-process scoring: command globs, network outliers, rules."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkhunt.functions.globs import glob_score
from sparkhunt.functions.powershell import html_escape, ps_deobfuscate
from sparkhunt.functions.rules import score_rules
from sparkhunt.names import c
from sparkhunt.operators.filters import outlier_mask
from sparkhunt.operators.joins import guid_totals
from sparkhunt.operators.lookup import totals_join
from sparkhunt.operators.ordering import row_positions
from sparkhunt.session import cut_lineage

_COUNTS = ("x_opened_connection_count", "opened_connection_ref_0.id")


def _has_command(df: DataFrame) -> Column:
    return F.coalesce(c("command_line"), F.lit("")) != ""


def _bounds(totals: DataFrame, key: str, k: float) -> Column:
    """mean -/+ k standard deviations of the row scores, from per-process totals.

    Every row of a process has the same total, so row sums follow from the number of
    rows with a command line; the rows themselves need not be joined for this.
    """
    x = F.when(c(key).isNotNull(), F.col("connections")).otherwise(F.lit(0)).cast("double")
    m = F.col("__active")
    whole = totals.agg((F.sum(x * m) / F.sum("__rows")).alias("mean")).select("mean").scalar()
    known = totals.withColumn("__mean", whole)
    # squared distances from the mean: nothing cancels, however many rows there are
    away = (x - F.col("__mean")) ** 2 * m + F.col("__mean") ** 2 * (F.col("__rows") - m)
    sums = known.agg(F.sum("__rows").cast("double").alias("n"), F.sum(away).alias("away"), F.max("__mean").alias("mean"))
    mean = F.col("mean")
    variance = F.col("away") / F.nullif(F.col("n") - 1, F.lit(0.0))
    cutoff = F.when(variance.isNotNull(), F.sqrt(F.greatest(variance, F.lit(0.0))) * k)
    return sums.select(
        F.struct((mean - cutoff).alias("lower"), (mean + cutoff).alias("upper")).alias("v")
    ).scalar()


def score_network_outliers(df: DataFrame, k: float = 3, key: str = "x_guid") -> DataFrame:
    """Add ``network_susp_score`` and one point for rows beyond k standard deviations.

    The score is the number of connections of the row's process, 0 without a command
    line or process id.  Tables without connection counts are returned unchanged.
    """
    if "x_suspicious_score" not in df.columns:
        df = df.withColumn("x_suspicious_score", F.lit(0.0))
    if key not in df.columns or not any(n in df.columns for n in _COUNTS):
        return df
    totals = cut_lineage(guid_totals(df, key))  # read for the join, its hot keys and the bounds
    known = totals.where(c(key).isNotNull()).drop("__active")
    joined = totals_join(df, known, [key], "__rows")
    score = F.when(_has_command(df), F.coalesce("connections", F.lit(0))).otherwise(F.lit(0))
    scored = joined.withColumn("network_susp_score", score.cast("long")).drop("connections")
    outlier = outlier_mask(
        F.col("network_susp_score"), F.col("__bounds.lower"), F.col("__bounds.upper")
    )
    point = F.when(F.coalesce(outlier, F.lit(False)), 1.0).otherwise(0.0)
    return (
        scored.withColumn("__bounds", _bounds(totals, key, k))
        .withColumn("x_suspicious_score", c("x_suspicious_score") + point)
        .drop("__bounds")
    )


def suspicious_process_score(
    df: DataFrame,
    rules: Iterable[dict] | None = None,
    patterns: Sequence[str] | None = None,
    keep_techniques: bool = False,
) -> DataFrame:
    """Add ``x_suspicious_score``: glob hits, network outliers and rule scores."""
    globs = glob_score(c("command_line"), patterns) if "command_line" in df.columns else F.lit(0)
    scored = df.withColumn("x_suspicious_score", globs.cast("double"))
    if "command_line" in df.columns:
        scored = score_network_outliers(scored)
    return score_rules(scored, rules, keep_techniques)


def powershell_deobfuscate(df: DataFrame) -> DataFrame:
    """Add ``x_psd_deobfuscated``: readable code of PowerShell command lines."""
    return df.withColumn("x_psd_deobfuscated", ps_deobfuscate(c("command_line")))


def ps_report(df: DataFrame, key: str = "id") -> DataFrame:
    """(row, id, text) of the rows with code: 1-based row number and escaped code."""
    source = df if "x_psd_deobfuscated" in df.columns else powershell_deobfuscate(df)
    oid = F.coalesce(c("id"), F.lit("")) if "id" in df.columns else F.lit("")
    narrow = source.select(c(key).alias("__key"), oid.alias("id"), "x_psd_deobfuscated")
    return (
        row_positions(narrow, ["__key"], "pos")
        .where(F.col("x_psd_deobfuscated").isNotNull())
        .select((F.col("pos") + 1).alias("row"), "id", html_escape(F.col("x_psd_deobfuscated")).alias("text"))
    )
