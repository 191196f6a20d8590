"""A provider of other columns over version 5, for tests."""

from flowloom.sources.registry import FlowProvider
from flowloom.sources.schema import V5, Interface, MappedColumn


class DefaultProvider(FlowProvider):
    def create_interface(self):
        return Interface("own", 5, 64, (MappedColumn("source", V5.column("srcip").column, conversion="ipv4"), MappedColumn("port", V5.column("srcport").column)))
