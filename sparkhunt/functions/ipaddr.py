"""IP addresses as longs or sortable keys, address classes and traffic categories."""

from __future__ import annotations

import ipaddress
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkhunt.names import let

# Address blocks that count as private, and two addresses that do not.
PRIVATE_NETWORKS = (
    "0.0.0.0/8",
    "10.0.0.0/8",
    "127.0.0.0/8",
    "169.254.0.0/16",
    "172.16.0.0/12",
    "192.0.0.0/24",
    "192.0.2.0/24",
    "192.168.0.0/16",
    "198.18.0.0/15",
    "198.51.100.0/24",
    "203.0.113.0/24",
    "240.0.0.0/4",
)
PRIVATE_EXCEPTIONS = ("192.0.0.9", "192.0.0.10")

# The same for IPv6.
PRIVATE_NETWORKS_6 = (
    "::1/128",
    "::/128",
    "::ffff:0:0/96",
    "64:ff9b:1::/48",
    "100::/64",
    "2001::/23",
    "2001:db8::/32",
    "2002::/16",
    "fc00::/7",
    "fe80::/10",
)
PRIVATE_EXCEPTIONS_6 = (
    "2001:1::1/128",
    "2001:1::2/128",
    "2001:3::/32",
    "2001:4:112::/48",
    "2001:20::/28",
    "2001:30::/28",
)

# Defaults of the traffic categories.
SENSITIVE_ADDRESSES = ("9.59.150.142",)
ORGANISATION_NETWORK = "9.0.0.0/8"
ORGANISATION_NAME = "IBM"

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PATTERN = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def ipv4_long(text: Column) -> Column:
    """Address as a number; NULL for anything that is not dotted IPv4."""
    octets = F.transform(F.split(text, r"\."), lambda o: o.cast("long"))
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda acc, o: acc * 256 + o)
    return F.when(text.rlike(IPV4_PATTERN), number)


def merged_ranges(networks: Iterable[str]) -> list[tuple[int, int]]:
    """Inclusive number ranges of CIDR blocks, merged where they touch."""
    spans = sorted(
        (int(n.network_address), int(n.broadcast_address))
        for n in (ipaddress.IPv4Network(text) for text in networks)
    )
    merged: list[tuple[int, int]] = []
    for low, high in spans:
        if merged and low <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def in_ranges(number: Column, ranges: Sequence[tuple]) -> Column:
    hit = F.lit(False)
    for low, high in ranges:
        hit = hit | number.between(F.lit(low), F.lit(high))
    return hit


_GROUP = "[0-9a-f]{1,4}"
_GROUPS = rf"(?:{_GROUP}(?::{_GROUP})*)?"
_IPV6_PATTERN = rf"^(?:(?:{_GROUP}:){{7}}{_GROUP}|{_GROUPS}::{_GROUPS})$"


def ip_key(text: Column) -> Column:
    """An address as text that sorts like the address: ``4`` or ``6`` and its hex digits.

    NULL for anything that is neither dotted IPv4 nor IPv6; a zone (``%eth0``) is dropped.
    """
    digits = lambda number, n: F.lpad(F.lower(F.hex(number)), n, "0")

    def version6(t: Column) -> Column:
        present = lambda part: F.filter(F.split(part, ":"), lambda g: g != "")
        gap = t.contains("::")
        left = present(F.substring_index(t, "::", 1))
        right = F.when(gap, present(F.substring_index(t, "::", -1))).otherwise(F.array().cast("array<string>"))
        groups = let(
            F.struct(left.alias("l"), right.alias("r"), gap.alias("gap")),
            lambda p: F.when(
                ~p["gap"] | (F.size(p["l"]) + F.size(p["r"]) < 8),  # a gap stands for one group at least
                F.concat(p["l"], F.array_repeat(F.lit("0"), F.lit(8) - F.size(p["l"]) - F.size(p["r"])), p["r"]),
            ),
        )
        whole = F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), "")
        key = F.concat(F.lit("6"), whole)
        return F.when(t.rlike(_IPV6_PATTERN), let(key, lambda k: F.when(F.length(k) == 33, k)))

    def tail(t: Column) -> Column:
        """Writes a dotted end as two groups."""
        number = ipv4_long(F.regexp_extract(t, r":([0-9.]+)$", 1))
        return let(
            F.struct(t.alias("t"), digits(number, 8).alias("h")),
            lambda p: F.when(p["h"].isNull(), p["t"]).otherwise(
                F.concat(F.regexp_extract(p["t"], r"^(.*:)[0-9.]+$", 1), F.substring(p["h"], 1, 4), F.lit(":"), F.substring(p["h"], 5, 4))
            ),
        )

    plain = let(F.lower(F.regexp_replace(text, "%[^%]+$", "")), lambda t: F.when(t.contains("."), tail(t)).otherwise(t))
    return F.when(text.contains(":"), let(plain, version6)).otherwise(
        let(ipv4_long(text), lambda n: F.concat(F.lit("4"), digits(n, 8)))
    )


def address_key(address) -> str:
    """The key of an ``ipaddress`` address."""
    return f"4{int(address):08x}" if address.version == 4 else f"6{int(address):032x}"


def key_ranges(networks: Iterable[str]) -> list[tuple[str, str]]:
    """Inclusive key ranges of IPv4 and IPv6 blocks, sorted and merged."""
    spans = sorted((address_key(n[0]), address_key(n[-1])) for n in map(ipaddress.ip_network, networks))
    merged: list[tuple[str, str]] = []
    for low, high in spans:
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def ip_is_private(text: Column) -> Column:
    return let(ip_key(text), _key_is_private)


def _key_is_private(key: Column) -> Column:
    mapped = "6" + "0" * 20 + "ffff"  # an IPv4 address in IPv6 clothes counts as that

    def test(k: Column) -> Column:
        exceptions = [(address_key(a), address_key(a)) for a in map(ipaddress.ip_address, PRIVATE_EXCEPTIONS)]
        return in_ranges(k, key_ranges([*PRIVATE_NETWORKS, *PRIVATE_NETWORKS_6])) & ~in_ranges(
            k, [*exceptions, *key_ranges(PRIVATE_EXCEPTIONS_6)]
        )

    return let(F.when(key.startswith(mapped), F.concat(F.lit("4"), F.substring(key, 26, 8))).otherwise(key), test)


def traffic_category(
    src: Column,
    dst: Column,
    sensitive: Sequence[str] = SENSITIVE_ADDRESSES,
    org_net: str = ORGANISATION_NETWORK,
    org_name: str = ORGANISATION_NAME,
) -> Column:
    """Direction of a connection, e.g. ``Private->External``.

    A source that fits no class and talks to an inside address gives ``Unknown-``
    without the arrow head; this matches the published labels.
    """
    organisation = key_ranges([org_net])
    secret = [address_key(ipaddress.ip_address(a)) for a in sensitive]

    def side(key: Column) -> Column:
        return F.struct(
            key.isin(secret).alias("sensitive"),
            _key_is_private(key).alias("private"),
            in_ranges(key, organisation).alias("inside"),
        )

    def label(ends: Column) -> Column:
        s, d = ends["src"], ends["dst"]
        public = ~d["private"] & ~d["inside"]
        origin = (
            F.when(s["sensitive"], "Sensitive->")
            .when(s["private"], "Private->")
            .when(s["inside"], f"{org_name}->")
            .when(public, "External->")
            .otherwise("Unknown-")
        )
        target = F.when(public, "External").when(d["inside"], org_name).otherwise("Unknown")
        known = s["private"].isNotNull() & d["private"].isNotNull()
        return F.when(known, F.concat(origin, target))

    ends = F.struct(let(ip_key(src), side).alias("src"), let(ip_key(dst), side).alias("dst"))
    return let(ends, label)


def exfil_probability(n: Column, total: Column) -> Column:
    """1 - share of the hour's traffic seen in this ten-minute bin; NULL for a silent hour."""
    return F.lit(1.0) - F.try_divide(n.cast("double"), total.cast("double"))
