"""Headers of flow captures: four bytes of metadata, then a static header (stream 1) or tagged attributes (stream 3)."""

from __future__ import annotations

import struct
from dataclasses import asdict, dataclass, field
from typing import BinaryIO

MAGIC = b"\xcf\x10"
LITTLE, BIG = 1, 2
#: Size of a whole header of stream 1, and of its texts.
STATIC_SIZE, HOSTNAME_SIZE, COMMENTS_SIZE = 358, 68, 256
DONE, COMPRESS, MULTIPLE, STREAMING, TRANSLATED, PRELOADED = 0x1, 0x2, 0x4, 0x8, 0x10, 0x20


class CorruptHeader(OSError):
    """The file is no flow capture."""


class UnsupportedCapture(NotImplementedError):
    """The file is one that cannot be read."""


@dataclass
class FlowHeader:
    """A header.  fields has a bit for each attribute that the file had, in order of the tags from 0x1 on."""

    stream_version: int = 0
    little_endian: bool = False
    header_size: int = 0
    flow_version: int = 0
    capture_start: int = 0
    capture_end: int = 0
    flags: int = 0
    rotation: int = 0
    n_flows: int = 0
    n_lost: int = 0
    n_misordered: int = 0
    n_corrupt: int = 0
    n_resets: int = 0
    vendor: int = 0
    exporter_ip: int = 0
    agg_version: int = 0
    agg_method: int = 0
    hostname: str | None = None
    comments: str | None = None
    interface_names: list[tuple[int, int, str]] = field(default_factory=list)
    interface_aliases: list[tuple[int, list[int], str]] = field(default_factory=list)
    fields: int = 0
    is_valid: bool = True

    @property
    def is_compressed(self) -> bool:
        return bool(self.flags & COMPRESS)

    def has(self, tag: int) -> bool:
        return bool(self.fields >> (tag - 1) & 1)

    @property
    def time_range(self) -> tuple[int, int] | None:
        """First and last second of the capture, where the header has both and they make sense."""
        if self.has(0x6) and self.has(0x7) and 0 < self.capture_end and self.capture_start <= self.capture_end:
            return self.capture_start, self.capture_end
        return None

    def as_dict(self) -> dict:
        return asdict(self) | {"is_compressed": self.is_compressed}


def corrupt_header() -> FlowHeader:
    """What stands for the header of a file that has none."""
    return FlowHeader(is_valid=False)


def read_fully(f: BinaryIO, n: int) -> bytes:
    """n bytes, fewer only at the end of the file."""
    out = b""
    while len(out) < n and (more := f.read(n - len(out))):
        out += more
    return out


#: Tags of plain numbers: the attribute and its format.
_NUMBERS = {
    0x1: ("vendor", "H"),
    0x2: ("flow_version", "H"),
    0x3: ("agg_version", "B"),
    0x4: ("agg_method", "B"),
    0x5: ("exporter_ip", "I"),
    0x6: ("capture_start", "I"),
    0x7: ("capture_end", "I"),
    0x8: ("flags", "I"),
    0x9: ("rotation", "I"),
    0xA: ("n_flows", "I"),
    0xB: ("n_lost", "I"),
    0xC: ("n_misordered", "I"),
    0xD: ("n_corrupt", "I"),
    0xE: ("n_resets", "I"),
}
_TEXTS = {0xF: "hostname", 0x10: "comments"}


def _terminated(raw: bytes) -> str:
    if not raw or raw[-1]:
        raise UnsupportedCapture("Char sequence is not null-terminated")
    return raw[:-1].decode("utf-8", "replace")


def _tagged(header: FlowHeader, body: bytes, order: str) -> None:
    at = 0
    while len(body) - at >= 4:
        tag, size = struct.unpack_from(order + "HH", body, at)
        value, at = body[at + 4 : at + 4 + size], at + 4 + size
        if at > len(body):
            break  # a length beyond the header ends it
        try:
            if tag in _NUMBERS:
                name, kind = _NUMBERS[tag]
                setattr(header, name, struct.unpack_from(order + kind, value)[0])
            elif tag in _TEXTS:
                setattr(header, _TEXTS[tag], _terminated(value))
            elif tag == 0x11:
                ip, index = struct.unpack_from(order + "IH", value)
                header.interface_names.append((ip, index, _terminated(value[6:])))
            elif tag == 0x12:
                ip, n = struct.unpack_from(order + "IH", value)
                header.interface_aliases.append((ip, list(struct.unpack_from(f"{order}{n}H", value, 6)), _terminated(value[6 + 2 * n :])))
            else:
                continue
        except struct.error as e:
            raise CorruptHeader(f"Corrupt NetFlow file. Attribute {tag:#x} is too short") from e
        header.fields |= 1 << (tag - 1)


def _static(header: FlowHeader, body: bytes, order: str) -> None:
    names = ("flow_version", "capture_start", "capture_end", "flags", "rotation", "n_flows", "n_lost", "n_misordered")
    for name, value in zip(names, struct.unpack_from(order + "H7I", body), strict=True):
        setattr(header, name, value)
    text = body[30:]
    header.hostname = text[:HOSTNAME_SIZE].decode("utf-8", "replace")
    header.comments = text[HOSTNAME_SIZE : HOSTNAME_SIZE + COMMENTS_SIZE].decode("utf-8", "replace")
    for tag in (0x2, 0x6, 0x7, 0x8, 0x9, 0xA, 0xB, 0xC, 0xF, 0x10):
        header.fields |= 1 << (tag - 1)


def parse_header(f: BinaryIO) -> FlowHeader:
    """Reads the header and leaves the file at the first byte behind it."""
    start = read_fully(f, 4)
    if len(start) < 4 or start[:2] != MAGIC:
        raise CorruptHeader("Corrupt NetFlow file. Wrong magic number")
    if start[2] not in (LITTLE, BIG):
        raise CorruptHeader(f"Could not recognize byte order {start[2]}")
    if start[3] not in (1, 3):
        raise UnsupportedCapture(f"Unsupported stream version {start[3]}")
    header = FlowHeader(stream_version=start[3], little_endian=start[2] == LITTLE)
    order = "<" if header.little_endian else ">"
    if header.stream_version == 1:
        body = read_fully(f, STATIC_SIZE - 4)
        if len(body) < STATIC_SIZE - 4:
            raise CorruptHeader("Corrupt NetFlow file. Header is cut off")
        header.header_size = STATIC_SIZE
        _static(header, body, order)
        return header
    size = read_fully(f, 4)
    if len(size) < 4:
        raise CorruptHeader("Corrupt NetFlow file. Header is cut off")
    header.header_size = struct.unpack(order + "i", size)[0]
    if header.header_size <= 0:
        raise CorruptHeader(f"Corrupt NetFlow file. Wrong header size {header.header_size}")
    want = max(0, header.header_size - 8)
    body = read_fully(f, want)
    if len(body) < want:
        raise CorruptHeader("Corrupt NetFlow file. Header is cut off")
    header.header_size = max(8, header.header_size)
    _tagged(header, body, order)
    return header
