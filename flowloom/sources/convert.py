"""Numbers as text and back: IPv4 addresses and IP protocols."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Names of IP protocols by number.  88 is not what IANA assigns, and kept.
PROTOCOLS = {
    1: "ICMP",
    3: "GGP",
    6: "TCP",
    8: "EGP",
    12: "PUP",
    17: "UDP",
    20: "HMP",
    27: "RDP",
    46: "RSVP",
    47: "GRE",
    50: "ESP",
    51: "AH",
    66: "RVD",
    88: "IGMP",
    89: "OSPF",
}
_NUMBERS = {name: number for number, name in PROTOCOLS.items()}


def ipv4_to_string(n: int) -> str:
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def ipv4_to_long(text: str) -> int:
    """Octets are weighted, not checked for range."""
    parts = text.split(".")
    if len(parts) != 4:
        raise ValueError(f"Invalid IPv4: {text}")
    return sum(int(p) << s for p, s in zip(parts, (24, 16, 8, 0), strict=True))


def protocol_to_name(n: int) -> str:
    return PROTOCOLS.get(n, str(n))


def protocol_to_number(name: str) -> int:
    if name in _NUMBERS:
        return _NUMBERS[name]
    try:
        number = int(name)
    except ValueError:
        number = 1 << 15
    if not -(1 << 15) <= number < 1 << 15:
        raise ValueError(f"Failed to convert {name} for protocol")
    return number


TO_TEXT = {"ipv4": ipv4_to_string, "protocol": protocol_to_name}
TO_NUMBER = {"ipv4": ipv4_to_long, "protocol": protocol_to_number}


def canonical_number(conversion: str, text: str) -> int | None:
    """The number that is shown as exactly this text, if there is one."""
    try:
        number = TO_NUMBER[conversion](text)
    except ValueError:
        return None
    return number if number >= 0 and TO_TEXT[conversion](number) == text else None


@lru_cache(maxsize=1)
def _octets() -> pa.Array:
    return pa.array([str(k) for k in range(256)])


@lru_cache(maxsize=1)
def _protocols() -> pa.Array:
    return pa.array([protocol_to_name(k) for k in range(256)])


def shown(values: np.ndarray, conversion: str) -> pa.Array:
    """A whole column as text, through tables of 256 entries."""
    if conversion == "protocol":
        return _protocols().take(pa.array(values.astype(np.uint8)))
    octets = [_octets().take(pa.array((values.astype(np.uint32) >> np.uint32(s)).astype(np.uint8))) for s in (24, 16, 8, 0)]
    return pc.binary_join_element_wise(*octets, ".")
