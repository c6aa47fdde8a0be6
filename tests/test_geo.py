"""Location of addresses in nested blocks against a search through all of them."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from sparkhunt.functions.ipaddr import address_key
from sparkhunt.operators import geo

RNG = random.Random(3)


def brute(ips, spans):
    """The place of each address: of the blocks that hold it the last to start, then the first to end."""
    out = {}
    for text in ips:
        try:
            key = address_key(ipaddress.ip_address(text))
        except ValueError:
            continue
        held = [(low, geo._reversed(high), place) for low, high, place in spans if low <= key <= high]
        if held:
            first = max(held)[:2]
            out[text] = min(p for *b, p in held if tuple(b) == first)
    return out


def located(spark, ips, blocks, parts=1):
    addresses = spark.createDataFrame([(i, 1.0) for i in ips], "ip string, latitude double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(parts == 1).lower())
    try:
        rows = geo.ip_geolocate(addresses, blocks, "ip").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r.ip for r in rows}) == len(rows)
    return {r.ip: (r.latitude, r.longitude) for r in rows}


@pytest.mark.parametrize("parts", [1, 8])
def test_nested_networks_of_both_versions(spark, parts):
    """Three levels and more of nesting, and one block that holds most of the addresses."""
    nets = ["0.0.0.0/0", "10.0.0.0/8", "10.0.0.0/8", "10.128.0.0/9", "10.128.4.0/22", "10.128.4.8/29", "10.128.4.9", "255.255.255.255/32", "::/0", "2001:db8::/33", "2001:db8::/32"]
    nets += [f"10.{RNG.randrange(256)}.{RNG.randrange(256)}.{RNG.randrange(256)}/{RNG.randrange(8, 33)}" for _ in range(400)]
    nets += [f"2001:db8:{RNG.randrange(16):x}::{RNG.randrange(65536):x}/{RNG.randrange(32, 129)}" for _ in range(200)]
    rows = [(n, float(i % 50), float(i % 7)) for i, n in enumerate(nets)]
    spans = [(address_key(x[0]), address_key(x[-1]), r[1:]) for r in rows for x in [ipaddress.ip_network(r[0], strict=False)]]
    ips = [f"10.{RNG.choice([128, RNG.randrange(256)])}.{RNG.choice([4, RNG.randrange(256)])}.{RNG.randrange(256)}" for _ in range(700)]
    ips += [f"2001:db8:{RNG.randrange(20):x}::{RNG.randrange(65536):x}" for _ in range(300)]
    ips += ["0.0.0.0", "255.255.255.255", "9.255.255.255", "11.0.0.0", "::", "2001:DB8::1", "2001:db8:0::1", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "", "x", None, "10.0.0"]
    bad = [(None, 1.0, 1.0), ("x/8", 1.0, 1.0), ("10.0.0.0/33", 1.0, 1.0), ("10.0.0.0/a", 1.0, 1.0), ("::/129", 1.0, 1.0)]
    blocks = spark.createDataFrame([(*r, "k", 4) for r in rows + bad], "network string, latitude double, longitude double, key string, high int")
    assert located(spark, ips, blocks, parts) == brute([i for i in ips if i], spans)


@pytest.mark.parametrize("parts", [1, 8])
def test_blocks_that_cross(spark, parts):
    spans = [(a, a + RNG.choice([0, 5, 300, 5000]), float(i), 0.0) for i in range(250) for a in [RNG.randrange(9000)]] + [(0, 9000, -1.0, 0.0)]
    blocks = spark.createDataFrame(spans, "start_ip long, end_ip long, latitude double, longitude double")
    ips = [str(ipaddress.ip_address(i)) for i in range(0, 15_000, 7)]
    keyed = [(f"4{a:08x}", f"4{z:08x}", (x, y)) for a, z, x, y in spans]
    assert located(spark, ips, blocks, parts) == brute(ips, keyed)


def test_ends_as_text_and_odd_tables(spark):
    rows = [("1.0.0.0", "1.0.0.255", 1.0, 1.0), ("::1", "::ff", 2.0, None), ("9.0.0.0", "1.0.0.0", 3.0, 3.0), ("1.0.0.0", "::2", 4.0, 4.0), (None, "1.1.1.1", 5.0, 5.0)]
    blocks = spark.createDataFrame(rows, "start_ip string, end_ip string, latitude double, longitude double")
    assert located(spark, ["1.0.0.7", "::7", "1.0.1.0", "9.0.0.0"], blocks) == {"1.0.0.7": (1.0, 1.0), "::7": (2.0, None)}
    assert located(spark, ["1.0.0.7"], blocks.limit(0)) == {}
    assert located(spark, [], blocks) == {}


def test_pieces_are_disjoint_and_few(spark):
    """A wide block is not cut into its /16s: pieces are at most twice the blocks."""
    rows = [("16.0.0.0/4", 1.0, 1.0)] + [(f"17.{i}.0.0/24", 2.0, 2.0) for i in range(100)]
    pieces = geo.flatten_blocks(spark.createDataFrame(rows, "network string, latitude double, longitude double"))
    ends = [(r.low, r.high) for r in pieces.orderBy("low").collect()]
    assert len(ends) == 201 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    assert pieces.where(F.col("low") > F.col("high")).count() == 0
