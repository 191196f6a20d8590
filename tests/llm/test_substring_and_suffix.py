"""Repeated windows of words and of bytes, against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from flowloom.llm._common import Workspace, window_hashes
from flowloom.llm._exchange import Chunk, unframe
from flowloom.llm._exchange import frame as framed
from flowloom.llm.substring_dedup import substring_dedup
from flowloom.llm.suffix_dedup import Anchors, ask_anchors, ask_suffixes, parted, radix_groups, suffix_dedup

LAST = 1 << 62


def brute_words(rows, window):
    """As the contract says; rows without doc_id are later than all others."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    ids = [LAST if i is None else i for i, _ in rows]
    first = {}
    for i, w in zip(ids, words, strict=True):
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, LAST), i)
    out = []
    for (i, _), own, w in zip(rows, ids, words, strict=True):
        gone, seen = [False] * len(w), set()
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if first[key] < own or key in seen:
                gone[k : k + window] = [True] * window
            seen.add(key)
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return Counter(out)


def brute_bytes(rows, depth):
    data = [(t or "").encode() for _, t in rows]
    ids = [LAST if i is None else i for i, _ in rows]
    first = {}
    for i, b in zip(ids, data, strict=True):
        for k in range(len(b) - depth + 1):
            first[b[k : k + depth]] = min(first.get(b[k : k + depth], LAST), i)
    out = []
    for (i, _), own, b in zip(rows, ids, data, strict=True):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - depth + 1):
            if first[b[k : k + depth]] < own:
                gone[k : k + depth] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) > 0).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window", [20, 6])
def test_words(docs, rows, ws, window):
    got = substring_dedup(docs, ws, window).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == brute_words(rows, window)
    assert all(sum(s.end - s.begin for s in r.spans) == r.n_removed for r in got)


@pytest.mark.parametrize(("depth", "crowd"), [(50, 2048), (50, 1), (20, 3)])
def test_bytes(docs, rows, ws, depth, crowd):
    got = suffix_dedup(docs, ws, depth, crowd).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got) == brute_bytes(rows, depth)


def test_many_chunks_and_buckets(docs, rows, spark):
    """Nothing depends on where documents and hashes lie; a doc_id of the greatest number is one."""
    small = {"chunk_bytes": 4000, "bucket_bytes": 6000}
    own = [*rows, ((1 << 63) - 1, "alpha beta " * 30), ((1 << 63) - 1, "zeta " * 30)]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(own[-2:], "doc_id long, text string"))
    words = substring_dedup(table, Workspace(spark, "test"), 20, **small).collect()
    # In the brute force both it and rows without doc_id are last; texts are such that none of these share a window first.
    late = [(i if i != (1 << 63) - 1 else LAST, t) for i, t in own]
    want = Counter({(i if i != LAST else (1 << 63) - 1, *x): n for (i, *x), n in brute_words(late, 20).items()})
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in words) == want
    got = suffix_dedup(table, Workspace(spark, "test"), 50, **small).collect()
    want = Counter({(i if i != LAST else (1 << 63) - 1, *x): n for (i, *x), n in brute_bytes(late, 50).items()})
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got) == want


def test_words_of_any_length(spark, ws):
    """Words longer than the table of places, and one of a megabyte, beside each other and over white space of all kinds."""
    long = ["a" * n for n in (63, 64, 65, 200)] + ["b" + "a" * 63, "a" * 63 + "b", "x" * 1_000_000]
    rows = [(1, " ".join(long * 4)), (2, "\t".join(long * 4) + "\x0b"), (3, "\n" + "\x0c\r".join(reversed(long * 4))), (4, "é" * 40 + " " + " ".join(long * 3))]
    got = substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), ws, 20).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == brute_words(rows, 20)


def test_empty_tables(empty, ws):
    assert substring_dedup(empty, ws).collect() == []


def test_empty_tables_of_bytes(empty, ws):
    assert suffix_dedup(empty, ws).collect() == []


def test_radix_groups_are_the_equal_windows():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    for depth in (7, 8, 13):
        at = np.arange(len(data) - depth + 1)
        who, group = radix_groups(data, at, depth)
        want = {}
        for k in at:
            want.setdefault(bytes(data[k : k + depth]), []).append(int(k))
        got = {}
        for w, g in zip(who.tolist(), group.tolist(), strict=True):
            got.setdefault(g, []).append(w)
        assert sorted(map(sorted, got.values())) == sorted(v for v in want.values() if len(v) > 1)


def test_parts_of_a_sort_are_the_whole():
    rng = np.random.default_rng(7)
    data = np.concatenate([rng.integers(97, 100, 4000), np.full(900, 97)]).astype(np.uint8)
    at = np.arange(len(data) - 9)
    parts = list(parted(data, at, 300))
    assert len(parts) > 3 and sorted(np.concatenate(parts).tolist()) == at.tolist()
    of = [{bytes(data[at[k] : at[k] + 2]) for k in p} for p in parts]
    assert sum(map(len, of)) == len(set().union(*of))


def test_buckets_are_of_like_size():
    """An anchor is the gram of least hash, yet no bucket gets many times its share of grams, or of spans to sort."""
    rng = np.random.default_rng(11)
    data = rng.integers(32, 127, 400_000).astype(np.uint8)
    chunk = Chunk(0, np.arange(100), np.arange(101) * 4000, data, np.zeros(100, bool), np.zeros(0, np.int64))
    buckets = 40
    asked = {b: len(unframe(body)[0]) for b, body in ask_anchors(50, 40)(chunk, {}, buckets)}
    assert len(asked) == buckets and max(asked.values()) < 1.5 * sum(asked.values()) / buckets
    part = {(0, b): framed(np.full(n, 2, np.uint8)) for b, n in asked.items()}
    sent = {b: unframe(body) for b, body in ask_suffixes(50, 40)(chunk, part, buckets)}
    sizes = [len(x[2]) for x in sent.values()]
    assert len(sizes) == buckets and max(sizes) < 1.5 * sum(sizes) / buckets
    assert sum(len(x[0]) for x in sent.values()) == len(Anchors(chunk, 50, 40).gram)


def test_window_hashes_depend_on_the_window_alone():
    rng = np.random.default_rng(2)
    s = rng.integers(0, 3, 500).astype(np.uint64)
    for length in (1, 2, 3, 10, 20, 50):
        h = window_hashes(s, length)
        assert len(h) == len(s) - length + 1
        by = {}
        for k in range(len(h)):
            by.setdefault(s[k : k + length].tobytes(), set()).add(int(h[k]))
        assert all(len(v) == 1 for v in by.values()) and len({x for v in by.values() for x in v}) == len(by)


def test_frames():
    arrays = [np.arange(5, dtype=np.uint64) << np.uint64(40), np.zeros(0, np.uint8), np.array([-1, 7], np.int32)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(unframe(framed(*arrays)), arrays, strict=True))
