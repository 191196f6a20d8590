"""Columns of flow records: what is on disk, what it is called, and how it is shown."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

import numpy as np

#: Kinds of physical columns by name: bytes on disk, numpy kind, values that they can have by default.  All but the
#: first are read unsigned and widened by one step.
KINDS = {
    "byte": (1, "i1", (-128, 127)),
    "short": (1, "u1", (0, 32767)),
    "int": (2, "u2", (0, 2**31 - 1)),
    "long": (4, "u4", (0, 2**63 - 1)),
}
#: The same as read.
WIDE = {"byte": "i1", "short": "i2", "int": "i4", "long": "i8"}


@dataclass(frozen=True)
class FlowColumn:
    """A column in a record.  Equality is by kind, name and offset; the domain does not count."""

    kind: str
    name: str
    offset: int
    low: int | None = field(default=None, compare=False)
    high: int | None = field(default=None, compare=False)

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"Unsupported kind of column {self.kind}")
        if self.offset < 0:
            raise ValueError(f"Wrong offset {self.offset}")
        if self.domain[0] > self.domain[1]:
            raise ValueError(f"Wrong domain of column {self.name}: {self.domain[0]} > {self.domain[1]}")

    @property
    def size(self) -> int:
        return KINDS[self.kind][0]

    @property
    def domain(self) -> tuple[int, int]:
        low, high = KINDS[self.kind][2]
        return (low if self.low is None else self.low, high if self.high is None else self.high)

    def dtype(self, order: str) -> str:
        return order + KINDS[self.kind][1]


@dataclass(frozen=True)
class MappedColumn:
    """A column of the table: its SQL name, where it is, and its conversion to text ("ipv4", "protocol" or none)."""

    name: str
    column: FlowColumn
    statistics: bool = False
    conversion: str | None = None


@dataclass(frozen=True)
class Interface:
    """The columns of one version of records."""

    name: str
    version: int
    record_size: int
    columns: tuple[MappedColumn, ...]

    def __post_init__(self):
        if not self.columns:
            raise ValueError(f"Columns are empty for {self.name}")
        for what, values in (("SQL names", [c.name for c in self.columns]), ("internal columns", [c.column.name for c in self.columns])):
            if len(set(values)) != len(values):
                raise AssertionError(f"Found duplicate {what} in {self.name}: {', '.join(values)}")

    @cached_property
    def by_name(self) -> dict[str, MappedColumn]:
        return {c.name: c for c in self.columns}

    def column(self, name: str) -> MappedColumn:
        if name not in self.by_name:
            raise LookupError(f"Interface does not have information about column {name}")
        return self.by_name[name]

    @property
    def first(self) -> MappedColumn:
        return self.columns[0]

    @property
    def first_option(self) -> MappedColumn | None:
        return next(iter(self.columns), None)

    @property
    def statistics_columns(self) -> list[MappedColumn]:
        return [c for c in self.columns if c.statistics]

    def dtype(self, little: bool, columns: list[FlowColumn] | None = None) -> np.dtype:
        """The record as numpy reads it; only the given columns, if any are given."""
        own = list({c.name: c for c in (columns if columns is not None else [c.column for c in self.columns])}.values())
        order = "<" if little else ">"
        return np.dtype({"names": [c.name for c in own], "formats": [c.dtype(order) for c in own], "offsets": [c.offset for c in own], "itemsize": self.record_size})

    def sql_schema(self, stringify: bool = True, columns: list[str] | None = None):
        """The StructType; fields are never null."""
        from pyspark.sql import types as T

        kinds = {"byte": T.ByteType, "short": T.ShortType, "int": T.IntegerType, "long": T.LongType}
        chosen = [self.column(n) for n in columns] if columns is not None else self.columns
        return T.StructType([T.StructField(c.name, T.StringType() if stringify and c.conversion else kinds[c.column.kind](), False) for c in chosen])


# Fixed values of the record formats, in order of offset: SQL name, internal name, offset, kind, conversion, whether it
# has statistics, the versions that have it.
_FIELDS = (
    ("unix_secs", "unix_secs", 0, "long", None, True, (5, 7)),
    ("unix_nsecs", "unix_nsecs", 4, "long", None, False, (5, 7)),
    ("sysuptime", "sys_uptime", 8, "long", None, False, (5, 7)),
    ("exaddr", "export_ip", 12, "long", "ipv4", False, (5, 7)),
    ("srcip", "srcip", 16, "long", "ipv4", True, (5, 7)),
    ("dstip", "dstip", 20, "long", "ipv4", True, (5, 7)),
    ("nexthop", "nexthop", 24, "long", "ipv4", False, (5, 7)),
    ("input", "input", 28, "int", None, False, (5, 7)),
    ("output", "output", 30, "int", None, False, (5, 7)),
    ("packets", "packets", 32, "long", None, False, (5, 7)),
    ("octets", "octets", 36, "long", None, False, (5, 7)),
    ("first_flow", "first", 40, "long", None, False, (5, 7)),
    ("last_flow", "last", 44, "long", None, False, (5, 7)),
    ("srcport", "srcport", 48, "int", None, True, (5, 7)),
    ("dstport", "dstport", 50, "int", None, True, (5, 7)),
    ("protocol", "protocol", 52, "short", "protocol", True, (5, 7)),
    ("tos", "tos", 53, "short", None, False, (5, 7)),
    ("tcp_flags", "tcp_flags", 54, "short", None, False, (5, 7)),
    ("flags", "flags", 55, "short", None, False, (7,)),
    ("engine_type", "engine_type", 56, "short", None, False, (5, 7)),
    ("engine_id", "engine_id", 57, "short", None, False, (5, 7)),
    ("src_mask", "src_mask", 58, "short", None, False, (5, 7)),
    ("dst_mask", "dst_mask", 59, "short", None, False, (5, 7)),
    ("src_as", "src_as", 60, "int", None, False, (5, 7)),
    ("dst_as", "dst_as", 62, "int", None, False, (5, 7)),
    ("router_sc", "router_sc", 64, "long", "ipv4", False, (7,)),
)
RECORD_SIZES = {5: 64, 7: 68}


def _columns(version: int) -> tuple[MappedColumn, ...]:
    return tuple(MappedColumn(name, FlowColumn(kind, own, offset), statistics, conversion) for name, own, offset, kind, conversion, statistics, versions in _FIELDS if version in versions)


V5 = Interface("version5", 5, RECORD_SIZES[5], _columns(5))
V7 = Interface("version7", 7, RECORD_SIZES[7], _columns(7))
