"""Headers: both streams, all attributes, and what is wrong with a file."""

import io
import struct

import pytest

from flowloom.sources.decode import open_header
from flowloom.sources.header import CorruptHeader, UnsupportedCapture, parse_header
from flowloom.testing.flowgen import header_v1, header_v3, tlv


@pytest.mark.parametrize("little", [False, True])
@pytest.mark.parametrize("version", [5, 7, 8])
def test_tagged(little, version):
    h = parse_header(io.BytesIO(header_v3(version, little, True, (10, 20), "flow-gen", "host", 99)))
    assert (h.stream_version, h.little_endian, h.flow_version, h.capture_start, h.capture_end) == (3, little, version, 10, 20)
    assert h.is_compressed and h.comments == "flow-gen" and h.hostname == "host" and h.n_flows == 99 and h.is_valid
    assert h.time_range == (10, 20)


@pytest.mark.parametrize("little", [False, True])
def test_static(little):
    raw = header_v1(5, little, False, (1, 2), "h", "c", 3)
    assert len(raw) == 358
    h = parse_header(io.BytesIO(raw))
    assert (h.stream_version, h.flow_version, h.capture_start, h.capture_end, h.n_flows, h.header_size) == (1, 5, 1, 2, 3, 358)
    assert len(h.hostname) == 68 and len(h.comments) == 256 and h.hostname.startswith("h\0")  # not trimmed


@pytest.mark.parametrize("little", [False, True])
def test_every_attribute(little):
    o = "<" if little else ">"
    extra = b"".join(
        [
            tlv(0x1, struct.pack(o + "H", 7), little),
            tlv(0x3, b"\x02", little),
            tlv(0x4, b"\x03", little),
            *(tlv(t, struct.pack(o + "I", 1000 + t), little) for t in (0x5, 0x9, 0xB, 0xC, 0xD, 0xE)),
            tlv(0x11, struct.pack(o + "IH", 167772161, 4) + b"eth0\0", little),
            tlv(0x12, struct.pack(o + "IHHH", 167772162, 2, 5, 6) + b"both\0", little),
            tlv(0x77, b"unknown", little),
        ]
    )
    h = parse_header(io.BytesIO(header_v3(5, little, extra=extra)))
    assert (h.vendor, h.agg_version, h.agg_method, h.exporter_ip, h.rotation) == (7, 2, 3, 1005, 1009)
    assert (h.n_lost, h.n_misordered, h.n_corrupt, h.n_resets) == (1011, 1012, 1013, 1014)
    assert h.interface_names == [(167772161, 4, "eth0")]
    assert h.interface_aliases == [(167772162, [5, 6], "both")]
    assert h.has(0x11) and h.has(0x12) and not h.has(0xF)


def test_overrunning_attribute_ends_the_header():
    h = parse_header(io.BytesIO(header_v3(5, extra=struct.pack(">HH", 0xF, 500) + b"x")))
    assert h.hostname is None and h.comments == "flow-gen"


def test_missing_terminator():
    with pytest.raises(UnsupportedCapture, match="not null-terminated"):
        parse_header(io.BytesIO(header_v3(5, extra=tlv(0xF, b"host"))))


@pytest.mark.parametrize(
    ("raw", "error", "text"),
    [
        (b"", CorruptHeader, "Wrong magic number"),
        (b"\xcf\x10\x01", CorruptHeader, "Wrong magic number"),
        (b"\xcf\x11\x01\x03", CorruptHeader, "Wrong magic number"),
        (b"\xcf\x10\x03\x03", CorruptHeader, "byte order 3"),
        (b"\xcf\x10\x01\x7f", UnsupportedCapture, "Unsupported stream version 127"),
        (b"\xcf\x10\x02\x03\xff\xff\xff\xff", CorruptHeader, "Wrong header size"),
        (b"\xcf\x10\x02\x03\x00\x00\x00\xff", CorruptHeader, "cut off"),
        (b"\xcf\x10\x02\x01\x00", CorruptHeader, "cut off"),
    ],
)
def test_corrupt(raw, error, text):
    with pytest.raises(error, match=text):
        parse_header(io.BytesIO(raw))
    assert not open_header(io.BytesIO(raw), ignore_corrupt=True).is_valid


@pytest.mark.parametrize(("capture", "wanted"), [(None, None), ((0, 0), None), ((5, 1), None), ((3, 9), (3, 9))])
def test_time_range_is_used_only_if_it_makes_sense(capture, wanted):
    assert parse_header(io.BytesIO(header_v3(5, capture=capture))).time_range == wanted


def test_flags():
    assert not parse_header(io.BytesIO(header_v3(5))).is_compressed
    assert parse_header(io.BytesIO(header_v3(5, compressed=True))).is_compressed
