"""Client addresses: picking the right one and ordering them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: address grammar ------------------------------------------------
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_H = "[0-9a-fA-F]{1,4}"
# Eight groups, or fewer around one "::"; a dotted tail stands for two groups.
_V6 = "|".join(
    [rf"(?:{_H}:){{6}}(?:{_H}:{_H}|{_V4})"]
    + [
        (rf"{_H}(?::{_H}){{{left - 1}}}" if left else "")
        + "::(?:"
        + (rf"{_H}(?::{_H}){{0,{6 - left}}}" if left < 7 else "")
        + (rf"|(?:{_H}:){{0,{5 - left}}}{_V4}" if left < 6 else "")
        + ")?"
        for left in range(8)
    ]
)
_ZONE = "(?:%[^%]+)?"
IPV4 = rf"^{_V4}$"
IPV6 = rf"^(?:{_V6}){_ZONE}$"
# An address at the start, alone or as v4:port.
ADDRESS = rf"^({_V4}(?=$|:[^:]*$)|(?:{_V6}){_ZONE}(?=$))"
QUOTES = r'^"+|"+$'
BRACKETS = r"^\[([^\]]*)\].*$"
DOTTED_TAIL = r"^(.*:)(\d+)\.(\d+)\.(\d+)\.(\d+)$"
MAPPED_PREFIX = "00000000000000000000ffff"
# --- end of fixed values ------------------------------------------------------------


def is_ip(text: Column) -> Column:
    return text.rlike(IPV4) | text.rlike(IPV6)


def _ipv4_hex(text: Column, pattern: str = r"^(\d+)\.(\d+)\.(\d+)\.(\d+)$", first: int = 1, form: str = "%02x%02x%02x%02x") -> Column:
    octets = [F.regexp_extract(text, pattern, i).try_cast("int") for i in range(first, first + 4)]
    return F.format_string(form, *octets)


def _ipv6_hex(text: Column) -> Column:
    """32 hex digits of a valid IPv6 text."""
    bare = F.lower(F.regexp_replace(text, "%.*$", ""))
    groups = F.when(
        bare.contains("."),
        F.concat(
            F.regexp_extract(bare, DOTTED_TAIL, 1),
            _ipv4_hex(bare, DOTTED_TAIL, 2, "%02x%02x:%02x%02x"),
        ),
    ).otherwise(bare)
    # Eight groups have seven colons; "::" stands for as many zero groups as are missing.
    colons = F.length(F.regexp_replace(groups, "[^:]", ""))
    whole = F.replace(groups, F.lit("::"), F.concat(F.lit(":"), F.repeat(F.lit("0:"), F.lit(8) - colons)))
    return F.array_join(F.transform(F.split(whole, ":"), lambda g: F.lpad(g, 4, "0")), "")


def ip_key(text: Column) -> Column:
    """32 hex digits whose text order is the address order; IPv4 in its mapped place."""
    return F.when(text.rlike(IPV4), F.concat(F.lit(MAPPED_PREFIX), _ipv4_hex(text))).when(
        text.rlike(IPV6), _ipv6_hex(text)
    )


def clean_ip(text: Column) -> Column:
    """One header item as an address, or NULL: quotes, [v6] brackets and v4:port undone."""
    inner = F.regexp_replace(F.regexp_replace(F.trim(text), QUOTES, ""), BRACKETS, "$1")
    return F.nullif(F.regexp_extract(inner, ADDRESS, 1), F.lit(""))


def client_ip(forwarded_for: Column, real_ip: Column, peer: Column) -> Column:
    """First usable forwarded address, else the proxy's, else the peer's, else ''."""
    forwarded = F.filter(
        F.transform(F.split(forwarded_for, ","), clean_ip), lambda ip: ip.isNotNull()
    )
    return F.coalesce(
        F.try_element_at(forwarded, F.lit(1)), clean_ip(real_ip), clean_ip(peer), F.lit("")
    )
