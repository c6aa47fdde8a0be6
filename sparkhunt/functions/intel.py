"""Fields of threat-intelligence documents (JSON text per indicator)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkhunt.names import let

IP_DOC = (
    "ip struct<attacks: bigint, ascountry: string, asname: string, "
    "threatfeeds: map<string, struct<firstseen: string, lastseen: string>>>"
)
_INDICATOR = (
    "cats: map<string, string>, score: double, geo: struct<country: string>, "
    "history: array<struct<asns: map<string, struct<removed: boolean, Company: string>>>>, "
    "risk: string, family: array<string>"
)
INDICATOR_DOC = (
    f"struct<{_INDICATOR}, result: struct<{_INDICATOR}>, malware: struct<{_INDICATOR}>>"
)

# Which document part and which fields belong to an entity type.
ENDPOINT_OF_TYPE = {
    "ipv4-addr": "ipr",
    "ipv6-addr": "ipr",
    "domain-name": "url",
    "url": "url",
    "file": "malware",
}
IP_FIELDS = ("attacks", "ascountry", "asname", "threatfeeds", "firstseen", "lastseen")
INDICATOR_FIELDS = ("cats", "score", "geo", "company", "risk", "family")


def feed_span(feeds: Column) -> Column:
    """Struct (firstseen, lastseen): earliest and latest date over all feeds."""
    records = F.map_values(feeds)
    day = lambda text: F.date_format(text.cast("date"), "yyyy-MM-dd")
    return F.struct(
        day(F.array_min(F.transform(records, lambda r: r["firstseen"].cast("date")))).alias("firstseen"),
        day(F.array_max(F.transform(records, lambda r: r["lastseen"].cast("date")))).alias("lastseen"),
    )


def parse_ip_doc(doc: Column) -> Column:
    return F.from_json(doc, IP_DOC)["ip"]


def sans_fields(doc: Column) -> Column:
    """Attack count, AS country and name, feed names and the span they were seen in."""
    return let(parse_ip_doc(doc), _ip_fields)


def _ip_fields(ip: Column) -> Column:
    feeds = ip["threatfeeds"]
    span = feed_span(feeds)
    return F.when(
        ip.isNotNull(),
        F.struct(
            F.coalesce(ip["attacks"], F.lit(0)).alias("attacks"),
            ip["ascountry"].alias("ascountry"),
            ip["asname"].alias("asname"),
            F.when(feeds.isNotNull(), F.array_join(F.map_keys(feeds), ",")).alias("threatfeeds"),
            F.when(feeds.isNotNull(), span["firstseen"]).alias("firstseen"),
            F.when(feeds.isNotNull(), span["lastseen"]).alias("lastseen"),
        ),
    )


def _company(doc: Column) -> Column:
    last = F.try_element_at(doc["history"], F.lit(-1))
    present = F.filter(
        F.map_values(last["asns"]),
        lambda a: ~F.coalesce(a["removed"], F.lit(False)) & (F.coalesce(a["Company"], F.lit("")) != ""),
    )
    return F.try_element_at(F.transform(present, lambda a: a["Company"]), F.lit(1))


def parse_indicator_doc(doc: Column, endpoint: Column) -> Column:
    """The document part that belongs to an endpoint (url and malware are wrapped)."""
    parts = ("cats", "score", "geo", "history", "risk", "family")
    return let(
        F.from_json(doc, INDICATOR_DOC),
        lambda whole: F.when(endpoint == "url", whole["result"])
        .when(endpoint == "malware", whole["malware"])
        .otherwise(F.struct(*[whole[n].alias(n) for n in parts])),
    )


def xfe_company(doc: Column) -> Column:
    """Company of the first AS still announced in the newest history entry."""
    return let(F.from_json(doc, INDICATOR_DOC), _company)


def xfe_fields(doc: Column, endpoint: Column) -> Column:
    """Fields of an indicator document; those of other entity types are NULL."""
    return let(parse_indicator_doc(doc, endpoint), lambda d: _indicator_fields(d, endpoint))


def _indicator_fields(d: Column, endpoint: Column) -> Column:
    address, known = endpoint == "ipr", endpoint.isin("ipr", "url")
    names = F.map_keys(d["cats"])
    return F.struct(
        F.when(known & (F.size(names) > 0), names).alias("cats"),
        F.when(known, d["score"]).alias("score"),
        F.when(address, d["geo"]["country"]).alias("geo"),
        F.when(address, _company(d)).alias("company"),
        F.when(endpoint == "malware", d["risk"]).alias("risk"),
        F.when(endpoint == "malware", d["family"]).alias("family"),
    )


def endpoint_of_type(entity_type: Column) -> Column:
    """Endpoint for each row's entity type; NULL for types without a lookup."""
    endpoint = F.lit(None).cast("string")
    for kind, name in ENDPOINT_OF_TYPE.items():
        endpoint = F.when(entity_type == kind, name).otherwise(endpoint)
    return endpoint
