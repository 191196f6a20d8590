"""Records of flow captures as numpy arrays, in blocks of bounded size."""

from __future__ import annotations

import logging
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np

from .header import CorruptHeader, FlowHeader, UnsupportedCapture, corrupt_header, parse_header, read_fully
from .options import DEFAULT_BUFFER
from .predicate import Predicate
from .schema import FlowColumn, Interface

log = logging.getLogger(__name__)


class CorruptRecord(ValueError):
    """The data behind the header ends within a record, or cannot be inflated."""


def open_header(f: BinaryIO, ignore_corrupt: bool = False) -> FlowHeader:
    """The header; with ignore_corrupt, one that is not valid if the file has none."""
    try:
        return parse_header(f)
    except (CorruptHeader, UnsupportedCapture) as e:
        if not ignore_corrupt:
            raise
        log.warning("Header ignored: %s", e)
        return corrupt_header()


def _inflated(f: BinaryIO, size: int) -> Iterator[bytes]:
    """The inflated stream.  A stream that is cut off or damaged raises after everything before that was given."""
    inflate, given = zlib.decompressobj(), False
    while not inflate.eof:
        block = f.read(size)
        if not block:
            raise CorruptRecord("Unexpected EOF" if given else "Unexpected EOF when reading first bytes of the compressed stream")
        while block:
            try:
                out = inflate.decompress(block, size)
            except zlib.error as e:
                # Byte by byte, what comes before the damage comes out.
                raise CorruptRecord(f"Unexpected EOF, {e}") from e
            given = given or bool(out)
            if out:
                yield out
            block = inflate.unconsumed_tail


def blocks(f: BinaryIO, header: FlowHeader, record_size: int, buffer: int = DEFAULT_BUFFER, ignore_corrupt: bool = False, n_records: int | None = None) -> Iterator[bytes]:
    """Whole records as bytes, about buffer bytes at a time.  f is at the first record wanted; n_records ends earlier."""
    left, rest = n_records, b""
    size = max(record_size, buffer)

    def plain() -> Iterator[bytes]:
        wanted = None if n_records is None else n_records * record_size
        while block := read_fully(f, size if wanted is None else min(size, wanted)):
            yield block
            wanted = None if wanted is None else wanted - len(block)

    source = _inflated(f, size) if header.is_compressed else plain()
    try:
        for block in source:
            block = rest + block
            whole = len(block) // record_size
            if left is not None:
                whole = min(whole, left)
                left -= whole
            if whole:
                yield block[: whole * record_size]
            rest = block[whole * record_size :]
            if left == 0:
                return
        if rest:
            raise CorruptRecord(f"Failed to read record: {len(rest)} < {record_size}")
    except CorruptRecord as e:
        if not ignore_corrupt:
            raise
        log.warning("Rest of the file ignored: %s", e)


def arrays(f: BinaryIO, header: FlowHeader, interface: Interface, columns: list[FlowColumn], predicate: Predicate | None = None, buffer: int = DEFAULT_BUFFER, ignore_corrupt: bool = False, n_records: int | None = None) -> Iterator[np.ndarray]:
    """Structured arrays of the columns, and of those that the predicate needs, with the records for which it holds."""
    need = list(columns) + sorted((c for c in (predicate.columns() if predicate else set()) if c not in columns), key=lambda c: c.offset)
    dtype = interface.dtype(header.little_endian, need)
    for block in blocks(f, header, interface.record_size, buffer, ignore_corrupt, n_records):
        records = np.frombuffer(block, dtype)
        yield records[predicate.mask(records)] if predicate else records
