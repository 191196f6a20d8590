"""Writes flow captures, as inputs of tests and queries.  The engine itself has no sink for them."""

from __future__ import annotations

import struct
import zlib

import numpy as np

from flowloom.sources.schema import RECORD_SIZES, V5, V7

INTERFACES = {5: V5, 7: V7}


def encode_records(columns: dict[str, np.ndarray], version: int = 5, little: bool = False, size: int | None = None) -> bytes:
    """Records from arrays by SQL name; fields without an array are 0."""
    interface = INTERFACES[version]
    n = size if size is not None else len(next(iter(columns.values())))
    out = np.zeros(n, interface.dtype(little))
    for name, values in columns.items():
        out[interface.column(name).column.name] = values
    return out.tobytes().ljust(n * RECORD_SIZES[version], b"\0")


def tlv(tag: int, value: bytes, little: bool = False) -> bytes:
    return struct.pack(("<" if little else ">") + "HH", tag, len(value)) + value


def header_v3(version: int = 5, little: bool = False, compressed: bool = False, capture: tuple[int, int] | None = (0, 0), comments: str | None = "flow-gen", hostname: str | None = None, n_flows: int | None = None, extra: bytes = b"") -> bytes:
    """A header of tagged attributes; extra is more of them, as bytes."""
    order = "<" if little else ">"
    body = tlv(0x2, struct.pack(order + "H", version), little)
    if capture is not None:
        body += tlv(0x6, struct.pack(order + "I", capture[0]), little) + tlv(0x7, struct.pack(order + "I", capture[1]), little)
    body += tlv(0x8, struct.pack(order + "I", 0x1 | (0x2 if compressed else 0)), little)
    if n_flows is not None:
        body += tlv(0xA, struct.pack(order + "I", n_flows), little)
    for tag, text in ((0xF, hostname), (0x10, comments)):
        if text is not None:
            body += tlv(tag, text.encode() + b"\0", little)
    body += extra
    return b"\xcf\x10" + bytes([1 if little else 2, 3]) + struct.pack(order + "I", len(body) + 8) + body


def header_v1(version: int = 5, little: bool = False, compressed: bool = False, capture: tuple[int, int] = (0, 0), hostname: str = "", comments: str = "flow-gen", n_flows: int = 0) -> bytes:
    """A static header."""
    order = "<" if little else ">"
    numbers = struct.pack(order + "H7I", version, capture[0], capture[1], 0x1 | (0x2 if compressed else 0), 0, n_flows, 0, 0)
    return b"\xcf\x10" + bytes([1 if little else 2, 1]) + numbers + hostname.encode().ljust(68, b"\0") + comments.encode().ljust(256, b"\0")


def capture(columns: dict[str, np.ndarray], version: int = 5, little: bool = False, level: int | None = None, stream: int = 3, **header) -> bytes:
    """A whole file; level is that of zlib, None for plain records."""
    size = len(next(iter(columns.values()))) if columns else 0
    records = encode_records(columns, version, little, size)
    make = header_v3 if stream == 3 else header_v1
    return make(version, little, level is not None, **header) + (records if level is None else zlib.compress(records, level))


def sample(version: int = 5, n: int = 1000) -> dict[str, np.ndarray]:
    """The records of the published samples, by their rule."""
    i = np.arange(n, dtype=np.int64)
    out = {
        "srcip": i,
        "dstip": 4294901760 + i,
        "input": i % 65536,
        "output": (65280 + i) % 65536,
        "packets": i + 1,
        "octets": i + 1,
        "first_flow": i,
        "last_flow": 4294901760 + i,
        "srcport": i % 65536,
        "dstport": (65280 + i) % 65536,
        "protocol": np.full(n, 17),
        "tos": i % 256 if version == 5 else 0 * i,
        "src_as": i % 65536,
        "dst_as": (65280 + i) % 65536,
    }
    if version == 7:
        out["router_sc"] = i
    return out
