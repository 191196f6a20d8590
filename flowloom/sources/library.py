"""Reading one capture without Spark.

    with open(path, "rb") as f:
        reader = FlowReader(f)
        reader.header.flow_version
        for row in reader.records([column("srcip"), column("srcport")], where=gt(column("srcport"), 10)):
            ...
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import BinaryIO

from .decode import arrays, open_header
from .header import FlowHeader
from .options import DEFAULT_BUFFER
from .predicate import Bounds, Predicate, Strategy, plan
from .schema import V5, V7, FlowColumn, Interface

BY_VERSION = {5: V5, 7: V7}


def column(name: str, version: int = 5) -> FlowColumn:
    """A physical column by its SQL or internal name."""
    own = BY_VERSION[version].columns
    found = next((c.column for c in own if c.name == name or c.column.name == name), None)
    if found is None:
        raise LookupError(f"Interface does not have information about column {name}")
    return found


class FlowReader:
    """A capture that is open: its header, and its records once."""

    def __init__(self, f: BinaryIO, buffer: int = DEFAULT_BUFFER, ignore_corrupt: bool = False):
        self.f, self.buffer, self.ignore_corrupt = f, buffer, ignore_corrupt
        self.header: FlowHeader = open_header(f, ignore_corrupt)

    def interface(self) -> Interface:
        if self.header.flow_version not in BY_VERSION:
            raise NotImplementedError(f"Version {self.header.flow_version} is not supported")
        return BY_VERSION[self.header.flow_version]

    def strategy(self, where: Predicate | None = None, statistics: Bounds | None = None) -> Strategy:
        bounds = dict(statistics or {})
        if self.header.time_range and "unix_secs" not in bounds:
            bounds["unix_secs"] = self.header.time_range
        return plan(where, bounds)

    def records(self, columns: list[FlowColumn], where: Predicate | None = None, statistics: Bounds | None = None) -> Iterator[tuple]:
        """A tuple for each record: the columns in the order given, repeated ones repeated."""
        if columns is None:
            raise ValueError("Columns are None")
        if not self.header.is_valid:
            return
        interface, strategy = self.interface(), self.strategy(where, statistics)
        if strategy.kind == "skip":
            return
        for records in arrays(self.f, self.header, interface, columns, strategy.predicate, self.buffer, self.ignore_corrupt):
            yield from zip(*(records[c.name].tolist() for c in columns), strict=True) if columns else (() for _ in range(len(records)))
