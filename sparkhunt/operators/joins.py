"""Joins between entity tables and with lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkhunt.functions.intel import (
    INDICATOR_FIELDS,
    IP_FIELDS,
    sans_fields,
    xfe_fields,
)
from sparkhunt.functions.ipaddr import in_ranges, ip_key, key_ranges
from sparkhunt.functions.timeparts import iso_timestamp
from sparkhunt.functions.whois import ptr_org_fields
from sparkhunt.names import c, let
from sparkhunt.operators.filters import entity_type_dispatch
from sparkhunt.operators.lookup import fits_broadcast, lookup_join, lookup_joins, totals_join
from sparkhunt.session import as_table, cut_lineage


def assemble_auth_requests(
    observations: DataFrame, users: DataFrame, connections: DataFrame
) -> DataFrame:
    """Authentication requests: user, connection and time of one observation id."""
    joined = users.join(connections, "id").join(observations.select("id", "first_observed"), "id")
    return joined


def linked_entities(df: DataFrame, other_df: DataFrame, on: str = "id") -> DataFrame:
    """Entities of ``other_df`` seen in the same observation as a row of ``df``."""
    return other_df.join(df.select(c(on)), on, "left_semi")


def guid_totals(df: DataFrame, key: str = "x_guid") -> DataFrame:
    """Connections per process id, its rows, and its rows with a command line.

    Sums an opened-connection count, or counts distinct connection references when the
    table has those instead.
    """
    if "x_opened_connection_count" in df.columns:
        total = F.sum(c("x_opened_connection_count"))
    else:
        total = F.count_distinct(c("opened_connection_ref_0.id"))
    command = c("command_line") if "command_line" in df.columns else F.lit(None)
    return df.groupBy(c(key)).agg(
        total.cast("long").alias("connections"),
        F.count(F.lit(1)).alias("__rows"),
        F.count_if(F.coalesce(command, F.lit("")) != "").alias("__active"),
    )


def guid_totals_backjoin(df: DataFrame, key: str = "x_guid") -> DataFrame:
    """Add ``connections``, the total of the row's process id; 0 without an id."""
    totals = cut_lineage(guid_totals(df, key).where(c(key).isNotNull()).drop("__active"))
    joined = totals_join(df, totals, [key], "__rows")
    return joined.withColumn("connections", F.coalesce("connections", F.lit(0)))


def attach_train_clusters(
    test_df: DataFrame, src_df: DataFrame, usr_df: DataFrame, dst_df: DataFrame
) -> DataFrame:
    """Cluster numbers of source, user and destination; NULL for unseen ones."""
    return lookup_joins(test_df, cluster_sides(src_df, usr_df, dst_df), "left")


def cluster_sides(src_df: DataFrame, usr_df: DataFrame, dst_df: DataFrame) -> list[tuple[DataFrame, str, bool]]:
    """The cluster tables as lookups: written, if they are not yet, and measured once."""
    tables = (("source", "c_src", src_df), ("username", "c_usr", usr_df), ("destination", "c_dst", dst_df))
    sides = [(as_table(table).select(key, cluster), key) for key, cluster, table in tables]
    return [(side, key, fits_broadcast(side)) for side, key in sides]


def train_clusters_inner(
    train_df: DataFrame, src_df: DataFrame, usr_df: DataFrame, dst_df: DataFrame
) -> DataFrame:
    return lookup_joins(train_df, cluster_sides(src_df, usr_df, dst_df), "inner")


def benign_triplets(train_df: DataFrame) -> DataFrame:
    """Distinct (user, source, destination) clusters seen in training, with status."""
    return train_df.select("c_usr", "c_src", "c_dst", "status").distinct()


def fill_unmatched(df: DataFrame) -> DataFrame:
    """Unmatched rows are malicious; unknown clusters become -1."""
    clusters = {n: F.coalesce(F.col(n), F.lit(-1)) for n in ("c_usr", "c_src", "c_dst")}
    return df.withColumns({**clusters, "status": F.coalesce("status", F.lit("malicious"))})


def triplet_novelty_join(test_df: DataFrame, triplets_df: DataFrame) -> DataFrame:
    """Status of the test rows: that of their triplet in training, else malicious."""
    triplets = as_table(triplets_df)
    small = fits_broadcast(triplets)
    # hot triplets are looked for in what the cluster lookups gave, so that is written first
    rows = test_df.drop("status") if small else as_table(test_df).drop("status")
    return fill_unmatched(lookup_join(rows, triplets, ["c_usr", "c_src", "c_dst"], small=small))


def writeback_by_id(observations: DataFrame, result_df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return observations.join(result_df.select("id", *[c(n) for n in cols]), "id")


# -- threat intelligence ----------------------------------------------------------------


def intel_ip_enrich(
    df: DataFrame,
    intel_df: DataFrame,
    attrs: Sequence[str] = ("src_ref.value", "dst_ref.value"),
) -> DataFrame:
    """Add reputation fields ``x_{attr}_{field}`` for each address column present."""
    parsed = intel_df.select("ip", sans_fields(F.col("doc")).alias("__f")).where("__f is not null")
    parsed = cut_lineage(parsed.groupBy("ip").agg(F.min("__f").alias("__f")))  # one answer per address
    small = fits_broadcast(parsed)
    fields = lambda attr: parsed.select(
        F.col("ip").alias(attr), *[F.col(f"__f.{n}").alias(f"x_{attr}_{n}") for n in IP_FIELDS]
    )
    return lookup_joins(df, [(fields(a), a, small) for a in attrs if a in df.columns])


def intel_observable_enrich(df: DataFrame, intel_df: DataFrame) -> DataFrame:
    """Add ``x_xfe_*`` fields by entity type: address, URL / domain or file hash."""
    fields = intel_df.select(
        F.col("endpoint").alias("x_endpoint"),
        F.col("observable").alias("x_observable"),
        xfe_fields(F.col("doc"), F.col("endpoint")).alias("__f"),
    ).select(
        "x_endpoint",
        "x_observable",
        *[F.col(f"__f.{n}").alias(f"x_xfe_{n}") for n in INDICATOR_FIELDS],
    )
    found = [n for n in fields.columns if n not in ("x_endpoint", "x_observable")]
    one = fields.groupBy("x_endpoint", "x_observable").agg(F.min(F.struct(*found)).alias("f"))
    fields = cut_lineage(one.select("x_endpoint", "x_observable", "f.*"))  # one answer per observable
    joined = lookup_join(entity_type_dispatch(df), fields, ["x_endpoint", "x_observable"])
    return joined.drop("x_endpoint", "x_observable")


def ip_domain_enrich(
    df: DataFrame, ptr_df: DataFrame, whois_df: DataFrame, attr: str = "dst_ref.value"
) -> DataFrame:
    """Add the reverse DNS name and the whois organisation of an address; '' if unknown.

    ``ptr_df`` has (ip, ptr), ``whois_df`` (ip, organization).  Values are cut at a colon.
    """
    cut = lambda name: ptr_org_fields(F.concat(F.lit("x:"), c(name)))
    names = ptr_df.groupBy("ip").agg(F.max(cut("ptr")).alias("x_domain_name"))
    organisations = whois_df.groupBy("ip").agg(
        F.max(cut("organization")).alias("x_domain_organization")
    )
    lookup = cut_lineage(names.join(organisations, "ip", "full").withColumnRenamed("ip", attr))
    new = ("x_domain_name", "x_domain_organization")
    return lookup_join(df.drop(*new), lookup, attr).withColumns(
        {n: F.coalesce(n, F.lit("")) for n in new}
    )


def hostname_resolve(df: DataFrame, dns_df: DataFrame, attr: str = "hostname") -> DataFrame:
    """Add ``addr`` from a DNS snapshot; NULL for names it does not hold."""
    answers = dns_df.groupBy(F.col("hostname").alias(attr)).agg(F.min("addr").alias("addr"))
    return lookup_join(df, cut_lineage(answers), attr)


# -- address ranges ------------------------------------------------------------------------

def cidr_membership(df: DataFrame, attr: str, networks: Sequence[str], name: str = "in_network") -> DataFrame:
    """Flag rows whose address lies in one of the networks (merged into ranges first)."""
    return df.withColumn(name, let(ip_key(c(attr)), lambda key: in_ranges(key, key_ranges(networks))))


def hour_model_join(df: DataFrame, model_df: DataFrame, ts: str = "first_observed") -> DataFrame:
    """Add the ten-minute bin, its count ``n`` and the count ``total`` of its hour.

    The model has one row per hour and bin, at most 144.
    """
    time = iso_timestamp(c(ts))
    cells = model_df.where(F.col("hour").between(0, 23) & F.col("bin").between(0, 5))
    cells = cells.groupBy("hour", "bin").agg(F.sum("n").alias("n"))
    totals = cells.groupBy("hour").agg(F.sum("n").alias("total"))
    table = cells.join(F.broadcast(totals), "hour")
    binned = df.withColumn("hour", F.hour(time)).withColumn(
        "bin", F.floor((F.minute(time) * 60 + F.second(time)) / 600).cast("int")
    )
    return binned.join(F.broadcast(table), ["hour", "bin"], "left")
