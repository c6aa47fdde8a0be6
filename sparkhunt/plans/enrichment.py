"""Log4shell detection with name resolution, and markers for addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkhunt.functions.log4shell import l4s_detect
from sparkhunt.names import c
from sparkhunt.operators.filters import drop_falsy, traffic_ip_list
from sparkhunt.operators.geo import ip_geolocate
from sparkhunt.operators.joins import hostname_resolve


def log4shell(df: DataFrame, dns_df: DataFrame | None = None) -> DataFrame:
    """Find exploits, split their URL and look the host up in a DNS snapshot."""
    found = l4s_detect(df)
    return found if dns_df is None else hostname_resolve(found, dns_df)


def pin_ips(df: DataFrame, blocks_df: DataFrame) -> DataFrame:
    """(ip, latitude, longitude) markers of an address or traffic table.

    Rows are chosen by their entity type: the value of addresses, both ends of traffic.
    """
    parts = []
    if "value" in df.columns:
        addresses = df.where(c("type") == "ipv4-addr") if "type" in df.columns else df
        parts.append(addresses.select(c("value").alias("ip")).distinct())
    if {"src_ref.value", "dst_ref.value"} <= set(df.columns):
        traffic = df.where(c("type") == "network-traffic") if "type" in df.columns else df
        parts.append(traffic_ip_list(traffic))
    ips = parts[0]
    for part in parts[1:]:
        ips = ips.unionAll(part)
    places = ip_geolocate(ips, blocks_df, "ip")
    return drop_falsy(ips, "ip").join(places, "ip").select("ip", "latitude", "longitude")


def whois_organization(values_df: DataFrame, key: str = "ip") -> DataFrame:
    """(ip, organization) from parsed whois values."""
    return values_df.where("tag = 'organization'").select(
        c(key).alias("ip"), F.col("value").alias("organization")
    )
