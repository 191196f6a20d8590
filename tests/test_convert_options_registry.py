"""Conversions, options, and the registry of providers."""

import numpy as np
import pytest

from flowloom.sources import registry
from flowloom.sources.convert import PROTOCOLS, canonical_number, ipv4_to_long, ipv4_to_string, protocol_to_name, protocol_to_number, shown
from flowloom.sources.options import FlowOptions, byte_string
from flowloom.sources.schema import V5, FlowColumn, Interface, MappedColumn

IPS = {0: "0.0.0.0", 1: "0.0.0.1", 257: "0.0.1.1", 4294902759: "255.255.3.231", 3232235777: "192.168.1.1", 2**32 - 1: "255.255.255.255"}


@pytest.mark.parametrize(("n", "text"), IPS.items())
def test_ipv4(n, text):
    assert ipv4_to_string(n) == text and ipv4_to_long(text) == n and shown(np.array([n]), "ipv4").to_pylist() == [text]


@pytest.mark.parametrize("text", ["", "1.2.3", "1.2.3.4.5", "a.b.c.d"])
def test_ipv4_malformed(text):
    with pytest.raises(ValueError):
        ipv4_to_long(text)


def test_ipv4_octets_are_not_checked():
    assert ipv4_to_long("256.0.0.1") == (256 << 24) + 1 and canonical_number("ipv4", "256.0.0.1") is None and canonical_number("ipv4", "010.0.0.1") is None


def test_protocols():
    assert len(PROTOCOLS) == 15
    for k in range(256):
        assert protocol_to_number(protocol_to_name(k)) == k
    assert shown(np.arange(256), "protocol").to_pylist() == [protocol_to_name(k) for k in range(256)]
    for bad in ("udp", "Tcp", "", "99999"):
        with pytest.raises(ValueError, match="Failed to convert"):
            protocol_to_number(bad)
    assert canonical_number("protocol", "6") is None and canonical_number("protocol", "TCP") == 6 and canonical_number("protocol", "200") == 200


@pytest.mark.parametrize(("text", "size"), [("77", 77), ("3k", 3072), ("3KB", 3072), ("12m", 12 << 20), ("5mb", 5 << 20), ("2G", 2 << 30), ("2gb", 2 << 30)])
def test_byte_strings(text, size):
    assert byte_string(text) == size


@pytest.mark.parametrize("text", ["mb", "many", "1.5", "-7k", "-7", "", "7 apples"])
def test_bad_byte_strings(text):
    with pytest.raises(ValueError):
        byte_string(text)


def test_no_byte_string():
    with pytest.raises(TypeError):
        byte_string(None)


def test_options():
    o = FlowOptions.of({})
    assert (o.stringify, o.buffer, o.pushdown, o.ignore_corrupt) == (True, 1048576, True, False)
    assert "stringify=True" in str(o)
    assert FlowOptions.of({"stringify": "false"}).stringify is False and FlowOptions.of({"stringify": "no"}).stringify is True
    assert FlowOptions.of({"predicate-pushdown": "false"}).pushdown is False and FlowOptions.of({"predicate-pushdown": "x"}).pushdown is True
    assert FlowOptions.of({"buffer": "32Kb"}).buffer == 32768
    with pytest.raises(ValueError, match="< minimum"):
        FlowOptions.of({"buffer": "10Kb"})
    with pytest.raises(ValueError, match="> maximum"):
        FlowOptions.of({"buffer": "3Gb"})


class DefaultProvider(registry.FlowProvider):
    def create_interface(self):
        return Interface("own", 5, 64, (MappedColumn("source", V5.column("srcip").column),))


class NoProvider:
    pass


class NullProvider(registry.FlowProvider):
    def create_interface(self):
        return None


def test_registry():
    assert registry.create_interface(5) is V5 and registry.create_interface("7").version == 7
    assert registry.create_interface(__name__).name == "own" and registry.create_interface(f"{__name__}.DefaultProvider").name == "own"
    with pytest.raises(LookupError, match="Failed to find"):
        registry.create_interface(8)
    with pytest.raises(LookupError, match="Failed to find"):
        registry.create_interface("no.such.module")
    with pytest.raises(NotImplementedError):
        registry.create_interface(f"{__name__}.NoProvider")
    with pytest.raises(ValueError):
        registry.create_interface(f"{__name__}.NullProvider")
    registry.register_provider("mine", DefaultProvider)
    assert registry.create_interface("mine").first.name == "source"


def test_consistency():
    a, b = FlowColumn("long", "a", 0), FlowColumn("long", "b", 4)
    with pytest.raises(ValueError, match="Columns are empty"):
        Interface("x", 5, 64, ())
    with pytest.raises(AssertionError):
        Interface("x", 5, 64, (MappedColumn("p", a), MappedColumn("p", b)))
    with pytest.raises(AssertionError):
        Interface("x", 5, 64, (MappedColumn("p", a), MappedColumn("q", a)))
    with pytest.raises(LookupError, match="does not have information about column"):
        V5.column("none")
    assert [c.name for c in V5.statistics_columns] == ["unix_secs", "srcip", "dstip", "srcport", "dstport", "protocol"]
