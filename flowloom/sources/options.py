"""Options of the source."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass

MIN_BUFFER, DEFAULT_BUFFER, MAX_BUFFER = 32768, 1048576, 2**31 - 1
SPLIT_SIZE = 128 << 20

#: Sizes by unit, as Spark writes them.
_UNITS = {"": 0, "b": 0, "k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30, "t": 40, "tb": 40, "p": 50, "pb": 50}


def byte_string(text: str) -> int:
    """Bytes of a size such as 1024, 10K or 3Mb."""
    if text is None:
        raise TypeError("Size is None")
    m = re.fullmatch(r"(\d+)([a-z]*)", text.strip().lower())
    if not m or m[2] not in _UNITS:
        raise ValueError(f"Size must be given as bytes, kibibytes, mebibytes or so on (such as 50b, 100k or 250m), not as {text}")
    return int(m[1]) << _UNITS[m[2]]


def buffer_size(text: str) -> int:
    size = byte_string(text)
    if size > MAX_BUFFER:
        raise ValueError(f"Cannot set buffer length of {size} bytes, > maximum buffer size {MAX_BUFFER}")
    if size < MIN_BUFFER:
        raise ValueError(f"Cannot set buffer length of {size} bytes, < minimum buffer size {MIN_BUFFER}")
    return size


@dataclass(frozen=True)
class FlowOptions:
    """stringify and pushdown are off only if the option is exactly "false"."""

    version: str | None = None
    stringify: bool = True
    buffer: int = DEFAULT_BUFFER
    pushdown: bool = True
    ignore_corrupt: bool = False
    columns: tuple[str, ...] | None = None
    where: str | None = None
    split_size: int = SPLIT_SIZE

    @classmethod
    def of(cls, options: Mapping[str, str]) -> FlowOptions:
        low = {k.lower(): v for k, v in options.items()}
        columns = low.get("columns")
        return cls(
            version=low.get("version"),
            stringify=low.get("stringify") != "false",
            buffer=buffer_size(low["buffer"]) if "buffer" in low else DEFAULT_BUFFER,
            pushdown=low.get("predicate-pushdown") != "false",
            ignore_corrupt=str(low.get("ignorecorruptfiles", "false")).lower() == "true",
            columns=tuple(json.loads(columns) if columns.startswith("[") else [c.strip() for c in columns.split(",") if c.strip()]) if columns is not None else None,
            where=low.get("where"),
            split_size=byte_string(low["splitsize"]) if "splitsize" in low else SPLIT_SIZE,
        )

    def __str__(self) -> str:
        return f"FlowOptions(stringify={self.stringify}, buffer={self.buffer}, pushdown={self.pushdown})"
