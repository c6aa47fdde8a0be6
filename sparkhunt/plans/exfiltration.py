"""Exfiltration: traffic category and how unusual the time of a connection is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkhunt.functions.ipaddr import (
    ORGANISATION_NETWORK,
    SENSITIVE_ADDRESSES,
    exfil_probability,
    traffic_category,
)
from sparkhunt.names import c
from sparkhunt.operators.joins import hour_model_join


def exfiltration(
    df: DataFrame,
    model_df: DataFrame,
    sensitive=SENSITIVE_ADDRESSES,
    org_net: str = ORGANISATION_NETWORK,
) -> DataFrame:
    """Add ``x_possible_exfil_op`` and ``x_exfil_op_probability``."""
    category = traffic_category(c("src_ref.value"), c("dst_ref.value"), sensitive, org_net)
    joined = hour_model_join(df.withColumn("x_possible_exfil_op", category), model_df)
    return joined.withColumn(
        "x_exfil_op_probability", exfil_probability(F.col("n"), F.col("total"))
    ).drop("hour", "bin", "n", "total")
