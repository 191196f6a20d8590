"""Records: golden rows, both orders of bytes, every cut of a file."""

import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowloom.sources.decode import CorruptRecord
from flowloom.sources.library import FlowReader, column
from flowloom.sources.predicate import eq, ge, gt, is_in, le, lt
from flowloom.sources.schema import RECORD_SIZES, V5, V7
from flowloom.testing.flowgen import INTERFACES, capture, header_v3, sample

NAMES = ["srcip", "dstip", "srcport", "dstport", "octets"]


def rows(raw, names=NAMES, version=5, **kw):
    ignore = kw.pop("ignore_corrupt", False)
    reader = FlowReader(io.BytesIO(raw), kw.pop("buffer", 32768), ignore)
    return list(reader.records([column(n, version) for n in names], **kw))


def expected(n=1000):
    s = sample(5, n)
    return list(zip(*(s[c].tolist() for c in NAMES), strict=True))


@pytest.mark.parametrize("version", [5, 7])
@pytest.mark.parametrize("little", [False, True])
@pytest.mark.parametrize("level", [None, 1, 9])
@pytest.mark.parametrize("stream", [1, 3])
def test_golden(version, little, level, stream):
    got = rows(capture(sample(version), version, little, level, stream), version=version)
    assert got == expected()
    assert got[0] == (0, 4294901760, 0, 65280, 1) and got[999] == (999, 4294902759, 999, 743, 1000)


def test_record_sizes_and_columns():
    assert (len(V5.columns), len(V7.columns)) == (24, 26)
    assert RECORD_SIZES == {5: 64, 7: 68}
    assert [c.name for c in V7.columns if c.name not in V5.by_name] == ["flags", "router_sc"]


@pytest.mark.parametrize("version", [5, 7])
@pytest.mark.parametrize("little", [False, True])
def test_unsigned_fields(version, little):
    """Every field at its largest value."""
    interface = INTERFACES[version]
    most = {c.name: np.array([256**c.column.size - 1]) for c in interface.columns}
    got = rows(capture(most, version, little), [c.name for c in interface.columns], version)
    assert got == [tuple(int(v[0]) for v in most.values())]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**32 - 1), st.integers(0, 65535), st.integers(0, 255)), max_size=40), st.booleans(), st.booleans())
def test_random_records(values, little, compressed):
    columns = {n: np.array([v[i] for v in values], np.int64) for i, n in enumerate(("srcip", "srcport", "tos"))}
    raw = capture(columns, 5, little, 6 if compressed else None)
    assert rows(raw, ["srcip", "srcport", "tos"]) == values


@pytest.mark.parametrize("cut", range(0, 5 * 64 + 1))
def test_plain_cut_at_every_byte(cut):
    head, body = header_v3(5), capture(sample(5, 5))[-320:]
    raw = head + body[:cut]
    assert len(rows(raw, ignore_corrupt=True)) == cut // 64
    if cut % 64:
        with pytest.raises(CorruptRecord, match=f"Failed to read record: {cut % 64} < 64"):
            rows(raw)
    else:
        assert len(rows(raw)) == cut // 64


def test_compressed_cut_at_every_byte():
    whole = capture(sample(5, 60), level=9)
    start = len(header_v3(5, compressed=True))
    for cut in range(start, len(whole)):
        held = zlib.decompressobj()
        n = len(held.decompress(whole[start:cut])) // 64
        assert len(rows(whole[:cut], ignore_corrupt=True)) == n
        with pytest.raises(CorruptRecord):
            rows(whole[:cut])


def test_damaged_block():
    raw = bytearray(capture(sample(5, 1000), level=9))
    raw[-400] ^= 0xFF
    with pytest.raises(CorruptRecord):
        rows(bytes(raw))
    assert len(rows(bytes(raw), ignore_corrupt=True)) < 1000


@pytest.mark.parametrize("level", [None, 2, 9])
def test_empty(level):
    assert rows(capture({"srcip": np.zeros(0, np.int64)}, level=level)) == []


def test_small_buffer_of_the_library_is_not_checked():
    assert rows(capture(sample(5), level=9), buffer=30000) == expected()


def test_projection_order_and_repeats():
    assert rows(capture(sample(5, 3)), ["dstport", "srcip", "dstport"]) == [(65280 + i, i, 65280 + i) for i in range(3)]


def test_no_columns_still_counts():
    assert rows(capture(sample(5, 7)), []) == [()] * 7


@pytest.mark.parametrize(
    ("where", "wanted"),
    [
        (eq(column("dstport"), 200), [456]),
        (lt(column("srcport"), 5), list(range(5))),
        (ge(column("srcip"), 11) & le(column("srcip"), 25), list(range(11, 26))),
        (is_in(column("srcip"), [1, 5, 2000]), [1, 5]),
        (~gt(column("srcip"), 2), [0, 1, 2]),
        (eq(column("srcip"), 1) | eq(column("srcport"), 9), [1, 9]),
        (gt(column("octets"), 2**40), []),
    ],
)
def test_filters_on_columns_that_are_not_read(where, wanted):
    assert [r[0] for r in rows(capture(sample(5)), ["srcip"], where=where)] == wanted


def test_unsupported_version_and_strategies():
    raw = capture(sample(5, 2), capture=(100, 200))
    reader = FlowReader(io.BytesIO(raw))
    secs = column("unix_secs")
    assert reader.strategy().kind == "full"
    assert reader.strategy(gt(secs, 200)).kind == "skip"
    assert reader.strategy(gt(secs, 50)).kind == "full"
    assert reader.strategy(gt(secs, 150)).kind == "filter"
    assert reader.strategy(gt(column("srcport"), 9), {"srcport": (10, 20)}).kind == "full"
    with pytest.raises(NotImplementedError):
        list(FlowReader(io.BytesIO(header_v3(8))).records([secs]))
