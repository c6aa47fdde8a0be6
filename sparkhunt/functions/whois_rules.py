"""Fixed values of whois parsing: line rules, country codes, tag renames, months."""

from __future__ import annotations

# Fixed values: (pattern, tag, result, flags), tried in this order.  ``%1`` is the first
# captured group.  Tags ``+wrap``, ``@join`` and ``@nslist`` take in following lines.
# Flags: U upper case, L lower case, M country table, X last value wins.
LINE_RULES = (
    (r"^\s*Registrant:\s*$", "+wrap", "", ""),
    (r"^\s*Registrant:\s*Name:\s*(.*)$", "registrant", "%1", ""),
    (r"^\s*Registrant:\s*([^:]*)\s*$", "registrant", "%1", ""),
    (r"^\s*Registrant\s\[(\d+)\]:", "registrant", "%1", ""),
    (r"^\s*Registrar:\s*$", "+wrap", "", ""),
    (r"^\s*Registrar:\s*Website:\s*(.*)", "registrar", "%1", ""),
    (r"^\s*No match for ", "error", "NXDOMAIN", ""),
    (r"^%ERROR:.* no entries found", "error", "NXDOMAIN", ""),
    (r"^\s*the Domain Name you apply can not be", "error", "UNAVAILABLE", ""),
    (r"^\s*Name Server\s*\.+\s*(\S+)", "@nslist", "%1", ""),
    (r"^\s*Registrar IANA ID:\s*(\d+)", "ianaid", "%1", ""),
    (r"^\s*Sponsoring Registrar IANA ID:\s*(\d+)", "ianaid", "%1", ""),
    (r"^\s*Registrar:\s*Name:\s*(\S+.*)", "registrar", "%1", ""),
    (r"^\s*Registrar:\s*(\S+.*)", "registrar", "%1", ""),
    (r"^\s*Name Server:\s*(\S+.*)", "ns", "%1", ""),
    (r"^\s*Updated Date\s*:\s*(\S+.*)", "updated", "%1", ""),
    (r"^\s*Updated:\s*(\S+.*)", "updated", "%1", ""),
    (r"^\s*Creation Date\s*:\s*(\S+.*)", "created", "%1", ""),
    (r"^\s*Expiration Date\s*:\s*(\S+.*)", "expires", "%1", ""),
    (r"^\s*Registration Date\s*:\s*(\S+.*)", "registered", "%1", ""),
    (r"^\s*RegDate:\s*(\S+.*)", "registered", "%1", ""),
    (r"^\s*Registration Time\s*:\s*(\S+)", "registered", "%1", ""),
    (r"^\s*Expiration Time\s*:\s*(\S+)", "expires", "%1", ""),
    (r"^\s*Domain record activated:\s*(\S+)", "created", "%1", ""),
    (r"^\s*Domain record last updated:\s*(\S+)", "updated", "%1", ""),
    (r"^\s*Domain expires:\s*(\S+)", "expires", "%1", ""),
    (r"^nserver:\s*(\S+).*", "ns", "%1", ""),
    (r"^registrar:\s*(\S+.*)", "registrar", "%1", ""),
    (r"^created:\s*(\S+.*)", "created", "%1", ""),
    (r"^free-date:\s*(\S+.*)", "expires", "%1", ""),
    (r"^\s*Creation Date\.*\s(\S+.*)", "created", "%1", ""),
    (r"^\s*Registration Date\.*.*\s(\S+.*)", "registered", "%1", ""),
    (r"^\s*Expiry Date\.*\s(\S+.*)", "expires", "%1", ""),
    (r"^\s*Name Server\.*\s(\S+.*)", "ns", "%1", ""),
    (r"^\s*Registrar Name:\s(\S+.*)", "registrar", "%1", ""),
    (r"^\s*Created [Oo]n\.*:\s*(\S+.*)", "created", "%1", ""),
    (r"^\s*Expires [Oo]n\.*:\s*(\S+.*)", "expires", "%1", ""),
    (r"^\s*Record last updated on\.*:* (\S+.*)", "updated", "%1", ""),
    (r"^\s*\[Querying (.*)\]$", "whois", "%1", "X"),
    (r"^\s*Record last updated at\.*:* (\S+.*)", "updated", "%1", ""),
    (r"^\s*Last Updated On:\s*(\S+.*)", "updated", "%1", ""),
    (r"^\s*Last-update\s*(.*)$", "updated", "%1", ""),
    (r"^\s*Valid-date\s*(.*)$", "expires", "%1", ""),
    (r"^\s*Last Modified:\s*(\S+)", "updated", "%1", ""),
    (r"^\s*Sponsoring Registrar:\s*(\S+.*)", "registrar", "%1", ""),
    (r"^\s*Sponsoring Registrar\s*\.*\s*(\S+.*)", "registrar", "%1", ""),
    (r"^\s*Domain servers in listed order:", "@nslist", "%", ""),
    (r"^\s*DNS Servers:\s*$", "@nslist", "%", ""),
    (r"^\s*Primary server\.*:\s*(\S+.*)", "ns", "%1", ""),
    (r"^\s*Secondary server\.*:\s*(\S+.*)", "ns", "%1", ""),
    (r"^\s*Domain created:\s*(\S+.*)", "created", "%1", ""),
    (r"^\s*Last modified\s*:\s*(\S+.*)", "updated", "%1", ""),
    (r"^\s*Current Registar:\s*(\S+.*)", "registrar", "%1", ""),
    (r"^\s*Registration Service Provided By: (\S+.*)", "registrar", "%1", ""),
    (r"^\s*Name Servers:\s*$", "@nslist", "%", ""),
    (r"^\s*Creation date:\s*(\S+.*)", "created", "%1", ""),
    (r"^\s*Expiration date:\s*(\S+.*)", "expires", "%1", ""),
    (r"^\s*Registered on:\s*(\S+)", "registered", "%1", ""),
    (r"^\s*Registered through:\s*(\S+.*)", "registrar", "%1", ""),
    (r"^\s*Created by Registrar:\s*(\S+.*)", "registrar", "%1", ""),
    (r"^\s*Domain Registration Date:\s*(\S+.*)", "registered", "%1", ""),
    (r"^\s*Domain Expiration Date:\s*(\S+.*)", "expires", "%1", ""),
    (r"^\s*Domain Last Updated Date:\s*(\S+.*)", "updated", "%1", ""),
    (r"^\s*Record expires on (\S+.*)", "expires", "%1", ""),
    (r"^\s*CountryCode:\s*(\S+)", "registrant-country", "%1", "UM"),
    (r"^\s*Registrant Country:\s*(.*)$", "registrant-country", "%1", "UM"),
    (r"^\s*Registrant Country Code\s*:*\.*\s*(.+)$", "registrant-country", "%1", "UM"),
    (r"^\s*[cC]ountry\s*:*\.*\s*(.*)$", "registrant-country", "%1", "UM"),
    (r"^\s*Owner Country\s*(.*)$", "registrant-country", "%1", "UM"),
    (r"^\s*Record created on\s*:*\s*(\S+.*)", "created", "%1", ""),
    (r"^\s*Database last updated on\s*:*\s*(\S+)", "updated", "%1", ""),
    (r"^\s*\**\s*Domain Servers:\s*$", "@nslist", "%", ""),
    (r"^\s*Domain Created:\s*(\S+.*)", "created", "%1", ""),
    (r"^\s*Domain Last Updated:\s*(\S+.*)", "updated", "%1", ""),
    (r"^\s*Domain Currently Expires:\s*(\S+.*)", "expires", "%1", ""),
    (r"^\s*Current Nameservers:\s*$", "@nslist", "%", ""),
    (r"^\s*Nameserver\s*:\s*(\S+.*)$", "ns", "%1", ""),
    (r"^\s*Domain Name Servers\s*$", "@nslist", "%", ""),
    (r"^\s*Nameserver Information:", "@nslist", "%", ""),
    (r"^\s*Domain Name Server\s*:\s*$", "@nslist", "%", ""),
    (r"^\s*Name servers\s*:\s*$", "@nslist", "%", ""),
    (r"^\s*Organi[zs]ation Name\.+\s*(\S+.*)$", "organization", "%1", ""),
    (r"^\s*Organi[zs]ation:\s*(\S+.*)$", "organization", "%1", ""),
    (r"^\s*org-name:\s*(\S+.*)$", "organization", "%1", ""),
    (r"^\s*Owner Organi[zs]ation\s*:\s*(\S+.*)$", "organization", "%1", ""),
    (r"^\s*Registrant Name:\s*(\S+.*)", "registrant", "%1", ""),
    (r"^\s*Registrant Name\s*\.+\s*(\S+.*)", "registrant", "%1", ""),
    (r"^\s*Registrant Organization:\s*(\S+.*)", "organization", "%1", ""),
    (r"^\s*Registrant Organization\s*\.+\s*(\S+.*)", "organization", "%1", ""),
    (r"^\s*Registrar:\s*$", "@join", "%", ""),
    (r"^\s*Create Date\s*:\s*(\S.*)$", "created", "%1", ""),
    (r"^\s*Update Date\s*:\s*(\S.*)$", "updated", "%1", ""),
    (r"^\s*last-modified\s*:\s*(\S.*)$", "updated", "%1", ""),
    (r"^\s*source:\s*(\S.*)$", "source", "%1", ""),
    (r"^\s*Expire Date\s*:\s*(\S.*)$", "expires", "%1", ""),
    (r"^\s*Created On\s*:\s*(\S.*)$", "created", "%1", ""),
    (r"^\s*Create\s*:\s*(\S*)", "created", "%1", ""),
    (r"^\s*Update\s*:\s*(\S*)", "updated", "%1", ""),
    (r"^\s*Expired\s*:\s*(\S*)", "expires", "%1", ""),
    (r"^\s*QueryTimes\s*:\s*(\d+)", "queried", "%1", ""),
    (r"^\s*Domain Create Date\s*:\s*(\S+)", "created", "%1", ""),
    (r"^\s*Domain Create Date\s*\.+\s*(\S+)", "created", "%1", ""),
    (r"^\s*Expiration Date\s*\.+\s*(\S+)", "expires", "%1", ""),
    (r".*Expiration Date\s*:\s*(\S+)", "expires", "%1", ""),
    (r"^\[Registrant\] *(.*)$", "registrant", "%1", ""),
    (r"^\[Name Server\] *(.*)", "ns", "%1", ""),
    (r"^\[Created on\] *(.*)", "created", "%1", ""),
    (r"^\[Expires on\] *(.*)", "expires", "%1", ""),
    (r"^\[Last Updated\] *(.*)", "updated", "%1", ""),
    (r"^\s*Registered [Oo]n: *(.*)$", "registered", "%1", ""),
    (r"^\s*Domain created on (.*)$", "created", "%1", ""),
    (r"^\s*Domain expires on (.*)$", "expires", "%1", ""),
    (r"^\s*Last updated on (.*)$", "updated", "%1", ""),
    (r"^\s*Domain Name Commencement Date: (.*)", "created", "%1", ""),
    (r"^\s*Expiry [Dd]ate:\s*(.*)", "expires", "%1", ""),
    (r".*Expiry [Dd]ate:\s*(.*)", "expires", "%1", ""),
    (r"^\s*Company Name: (.*)$", "organization", "%1", ""),
    (r"^\s*Name Servers Information:", "@nslist", "%", ""),
    (r"^\s*registration:\s*(.*)$", "created", "%1", ""),
    (r"^\s*renewal:\s*(.*)$", "expires", "%1", ""),
    (r"^\s*[Nn]server:\s*([^ ]*)", "ns", "%1", ""),
    (r"^\s*[cC]hanged:\s*([^:]*)", "updated", "%1", ""),
    (r"^\s*Registered:\s*(.*)", "created", "%1", ""),
    (r"^\s*Nameservers:", "@nslist", "%", ""),
    (r"^\s*Registered Date\s*:\s*(.*)$", "created", "%1", ""),
    (r"^\s*Last Updated Date\s*:\s*(.*)$", "updated", "%1", ""),
    (r"^\s+Host Name\s+:\s+(.*)", "ns", "%1", ""),
    (r"^\s*Registrant\s+:\s+(.*)", "registrant", "%1", ""),
    (r"^\s*creation_date:\s*([^ ]*)", "created", "%1", ""),
    (r"^\s*expiration_date:\s*([^ ]*)", "expires", "%1", ""),
    (r"^\s*last_update:\s*([^ ]*)", "updated", "%1", ""),
    (r"^nameserver:\s*([^ ]*)", "ns", "%1", ""),
    (r"^registrant-organization:\s*(.*)$", "registrant", "%1", ""),
    (r"^registrant-country:\s*(.*)", "registrant-country", "%1", ""),
    (r"^\s*Last updated:\s*(.*)$", "updated", "%1", ""),
    (r"^\s*modified:\s*(.*)$", "updated", "%1", ""),
    (r"^\s*expires:\s*(.*)$", "expires", "%1", ""),
    (r"^\s*changed:\s*(\S+)", "updated", "%1", ""),
    (r"^\s*Registrar Registration Expiration Date:\s*(\S+)", "expires", "%1", ""),
    (r"^\s*Registry Expiry Date:\s*(\S+)", "expires", "%1", ""),
    (r"^\s*Updated Date:\s*(\S+)", "updated", "%1", ""),
    (r"^\s*First registration date:\s*$", "+wrap", "", ""),
    (r"^\s*First registration date:\s*(\S+)", "created", "%1", ""),
    (r"^[Nn]et[Nn]ame:\s*(\S+)", "netname", "%1", ""),
    (r"^route:\s*(.*)", "cidr", "%1", ""),
    (r"^origin:\s*(\S+)", "asn", "%1", ""),
    (r"^OriginAS:\s*(\S+)", "asn", "%1", ""),
    (r"^CIDR:\s*(.*)$", "cidr", "%1", ""),
    (r"^descr:\s*(.*)$", "description", "%1", ""),
)

# Country names and the codes that replace them.
COUNTRY_CODES = (
    ("UNITED STATES", "US"),
    ("CHINA", "CN"),
    ("NETHERLANDS", "NL"),
    ("UNITED KINGDOM", "UK"),
    ("PANAMA", "PA"),
    ("GERMANY", "DE"),
    ("MALAYSIA", "MY"),
    ("REPUBLIC OF KOREA", "KO"),
    ("UNITED ARAM EMIRATES", "UA"),
    ("POLAND", "PL"),
    ("SPAIN", "ES"),
    ("MEXICO", "MX"),
    ("CROATIA/HRVATSKA", "HR"),
    ("KOR", "KO"),
    ("PORTUGAL", "PT"),
    ("AUSTRALIA", "AU"),
)

# Tags that take another name when that name is missing.
TAG_RENAMES = (
    ("whois", "registrar"),
    ("registered", "created"),
)

# Month names.
MONTHS = (
    ("jan", 1),
    ("feb", 2),
    ("mar", 3),
    ("apr", 4),
    ("may", 5),
    ("jun", 6),
    ("jul", 7),
    ("aug", 8),
    ("sep", 9),
    ("oct", 10),
    ("nov", 11),
    ("dec", 12),
    ("january", 1),
    ("february", 2),
    ("march", 3),
    ("april", 4),
    ("june", 6),
    ("july", 7),
    ("august", 8),
    ("september", 9),
    ("october", 10),
    ("november", 11),
    ("december", 12),
)
