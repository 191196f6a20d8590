"""Column functions: addresses, protocols, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowloom.sources.convert import PROTOCOLS


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ipv4_to_string(n: Column | str) -> Column:
    n = _column(n).cast("long")
    return F.concat_ws(".", *(F.shiftright(n, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)))


def ipv4_to_long(text: Column | str) -> Column:
    """Fails on texts that are not four numbers; octets are weighted, not checked for range."""
    text = _column(text)
    parts = F.split(text, r"\.")
    value = sum((F.get(parts, F.lit(k)).cast("long") * (1 << s) for k, s in ((1, 16), (2, 8), (3, 0))), F.get(parts, F.lit(0)).cast("long") * (1 << 24))
    return F.when(F.size(parts) == 4, value).when(text.isNotNull(), F.raise_error(F.concat(F.lit("Invalid IPv4: "), text)).cast("long"))


def try_ipv4_to_long(text: Column | str) -> Column:
    """null where ipv4_to_long fails."""
    parts = F.split(_column(text), r"\.")
    value = sum((F.get(parts, F.lit(k)).try_cast("long") * (1 << s) for k, s in ((1, 16), (2, 8), (3, 0))), F.get(parts, F.lit(0)).try_cast("long") * (1 << 24))
    return F.when(F.size(parts) == 4, value)


def protocol_to_name(n: Column | str) -> Column:
    n = _column(n)
    names = F.create_map(*(F.lit(x) for k, v in PROTOCOLS.items() for x in (k, v)))
    return F.coalesce(F.element_at(names, n.cast("int")), n.cast("string"))


def protocol_to_number(name: Column | str) -> Column:
    """Names are as listed, upper case; other texts must be numbers."""
    name = _column(name)
    numbers = F.create_map(*(F.lit(x) for k, v in PROTOCOLS.items() for x in (v, k)))
    number = F.coalesce(F.element_at(numbers, name).cast("short"), name.try_cast("short"))
    return F.when(number.isNotNull() | name.isNull(), number).otherwise(F.raise_error(F.concat(F.lit("Failed to convert "), name, F.lit(" for protocol"))).cast("short"))


def uuid_for_string(text: Column | str) -> Column:
    """The MD5 UUID (version 3) of the text's bytes, without a namespace."""
    h = F.md5(_column(text).cast("binary"))
    part = lambda a, n: F.substring(h, a, n)
    variant = F.lower(F.hex(F.conv(part(17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)))
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-3"), part(14, 3), F.lit("-"), variant, part(19, 2), F.lit("-"), part(21, 12))
