"""Substring dedup by fixed-block anchors.

Words are the runs of other characters than [\\x20\\x09-\\x0D], unchanged.  A repeat of WINDOW words holds at least
one whole block of BLOCK words that is aligned in the earlier document, as BLOCK is half of WINDOW.  So the
non-overlapping blocks of all documents are indexed, and every rolling window of BLOCK words probes them (round 0).
Where a probe hits a block that occurs elsewhere too, the repeat is extended: all windows of WINDOW words around the
hit are looked up by 96 bits, a hash of 64 of the whole window and one of 32 of its halves, both from 64-bit hashes of
its words (the words themselves are not compared again), and the smallest document that has them is found (round 1).
Runs of repeated windows are the maximal exact repeats; their words go.

A window goes if its words also start in a document of smaller doc_id, or earlier in the same row.  Rows of equal
doc_id are not earlier than each other; rows without doc_id are later than all others.  A null text has no words;
texts of fewer than WINDOW words lose nothing; texts of any length are read whole.  Repeated rows are documents of one
doc_id.  An empty table gives none.  Only doc_id and text are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Workspace, documents, gathered, mix, window_hashes
from ._exchange import BUCKET_BYTES, CHUNK_BYTES, Answers, Chunk, Exchange, bits_back, deltas, dealt, frame, hash_bits, small_ids, starts_of, undeltas, unframe

WINDOW = 20
BLOCK = 10


#: What each byte adds to a word's hash at each of its first TABLED places; longer words are hashed one by one.
TABLED = 64
_TABLE = mix(np.arange(1, 256 * TABLED + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_LENGTH = np.uint64(0xA24BAED4963EE407)


class Words:
    """The words of texts that lie one behind the other: where each begins and ends, its hash of 64 bits, its document,
    and how many words follow in it, itself included."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        n = len(data)
        inside = ~_IS_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[starts] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:n]
        last[:-1] &= ~inside[1:] | edge[1:n]
        self.data = data
        self.begins, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.starts = np.searchsorted(self.begins, starts)
        counts = np.diff(self.starts)
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.left = np.repeat(self.starts[1:], counts) - np.arange(len(self.begins))
        self.symbols = self._hashes(first, inside)

    def _hashes(self, first: np.ndarray, inside: np.ndarray) -> np.ndarray:
        if not len(self.begins):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.begins
        at = np.flatnonzero(inside)
        place = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        np.minimum(place, TABLED - 1, out=place)
        place <<= 8
        place |= self.data[at]
        sums = np.cumsum(_TABLE[place])
        upto = sums[np.cumsum(lengths) - 1]
        hashes = mix(np.diff(upto, prepend=np.uint64(0)) + lengths.astype(np.uint64) * _LENGTH)
        for i in np.flatnonzero(lengths > TABLED):
            hashes[i] = xxhash.xxh3_64_intdigest(self.data[self.begins[i] : self.ends[i]].tobytes())
        return hashes

    def joined(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the kept words of each document joined by one blank, and where each document begins."""
        some = np.flatnonzero(keep)
        lengths = self.ends[some] - self.begins[some] + 1
        out = gathered(np.append(self.data, np.uint8(32)), self.begins[some], lengths)
        ends = np.cumsum(lengths)
        out[ends - 1] = 32
        docs = np.searchsorted(some, self.starts)  # of the kept words, the first of each document
        bounds = np.concatenate([[0], ends])[docs]
        last = np.flatnonzero(np.diff(docs) > 0)
        out = np.delete(out, bounds[last + 1] - 1)
        return out, bounds - np.concatenate([[0], np.cumsum(np.diff(docs) > 0)])

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Where windows inside one document start, and their hashes."""
        at = np.flatnonzero(self.left >= length)
        return at, window_hashes(self.symbols, length)[at]


def _probes(words: Words, block: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of probes in order of hash, which of them begin a new hash, and for each hash: itself, whether a block has it here, whether it is here more than once."""
    at, hashes = words.windows(block)
    hashes &= np.uint64(((1 << bits) - 1) << (64 - bits))
    order = np.argsort(hashes)
    at, hashes = at[order], hashes[order]
    first = starts_of(hashes)
    begins = np.flatnonzero(first)
    is_block = (at - words.starts[words.doc[at]]) % block == 0
    if not len(begins):
        return at, first, hashes, np.zeros(0, bool), np.zeros(0, bool)
    return at, first, hashes[begins], np.logical_or.reduceat(is_block, begins), np.diff(np.append(begins, len(at))) > 1


def _windows(words: Words, doc_ids: np.ndarray, hit: np.ndarray, window: int, block: int):
    """The windows around hits, ordered by hash, doc_id, row and place: hash, check, doc_id, row, place."""
    near = np.concatenate([[0], np.cumsum(hit)])
    at = np.flatnonzero(words.left >= window)
    at = at[near[at + window - block + 1] > near[at]]
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64), at
    hashes = window_hashes(words.symbols, window)[at]
    halves = window_hashes(words.symbols, block)
    check = (mix(halves[at] * np.uint64(0x9FB21C651E98DF25) + halves[at + window - block] * np.uint64(0xD1342543DE82EF95)) >> np.uint64(32)).astype(np.uint32)
    rows = words.doc[at]
    order = np.lexsort((at, doc_ids[rows], check, hashes))
    at, rows = at[order], rows[order]
    return hashes[order], check[order], doc_ids[rows], rows, at


def ask_blocks(block: int, bits: int):
    def ask(chunk: Chunk, _: Answers, buckets: int) -> Iterator[tuple[int, bytes]]:
        _, _, hashes, is_block, many = _probes(Words(chunk.data, chunk.starts), block, bits)
        flags = is_block.astype(np.uint8) + 2 * many.astype(np.uint8)
        for bucket, where in dealt(hashes, buckets):
            yield bucket, frame(deltas(hashes[where] >> np.uint64(64 - bits)), flags[where])

    return ask


def answer_blocks(_: int, bodies: list[bytes]) -> list[bytes]:
    """A bit for each hash: a block has it, and it occurs more than once."""
    parts = [unframe(b) for b in bodies]
    hashes, flags = np.concatenate([undeltas(p[0]) for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(hashes)
    first = starts_of(hashes[order])
    begins = np.flatnonzero(first)
    hit = (np.bitwise_or.reduceat(flags[order], begins) & 1 > 0) & (np.add.reduceat(1 + (flags[order] >> 1).astype(np.int64), begins) > 1)
    out = np.zeros(len(hashes), bool)
    out[order] = hit[np.cumsum(first) - 1]
    ends = np.cumsum([len(p[0]) for p in parts])
    return [np.packbits(out[e - len(p[0]) : e]).tobytes() for e, p in zip(ends, parts, strict=True)]


def _hits(words: Words, answers: Answers, block: int, bits: int, buckets: int) -> np.ndarray:
    at, first, hashes, _, _ = _probes(words, block, bits)
    hit = np.zeros(len(words.symbols), bool)
    if len(at):
        hit[at] = bits_back(answers, 0, dealt(hashes, buckets), len(hashes))[np.cumsum(first) - 1]
    return hit


def ask_windows(window: int, block: int, bits: int):
    def ask(chunk: Chunk, answers: Answers, buckets: int) -> Iterator[tuple[int, bytes]]:
        words = Words(chunk.data, chunk.starts)
        hashes, check, ids, _, _ = _windows(words, chunk.doc_ids, _hits(words, answers, block, bits, buckets), window, block)
        begins = np.flatnonzero(starts_of(hashes, check))
        hashes, check, ids = hashes[begins], check[begins], ids[begins]
        for bucket, where in dealt(hashes, buckets):
            yield bucket, frame(deltas(hashes[where]), check[where], small_ids(ids[where]))

    return ask


def answer_windows(_: int, bodies: list[bytes]) -> list[bytes]:
    """A bit for each window: a smaller document has it."""
    parts = [unframe(b) for b in bodies]
    hashes, check, ids = np.concatenate([undeltas(p[0]) for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2].astype(np.int64) for p in parts])
    order = np.lexsort((check, hashes))
    first = starts_of(hashes[order], check[order])
    least = np.minimum.reduceat(ids[order], np.flatnonzero(first))
    out = np.zeros(len(hashes), bool)
    out[order] = least[np.cumsum(first) - 1] < ids[order]
    ends = np.cumsum([len(p[0]) for p in parts])
    return [np.packbits(out[e - len(p[0]) : e]).tobytes() for e, p in zip(ends, parts, strict=True)]


def covered(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Which of n places the runs that start here cover."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths, -1)
    return np.cumsum(edges[:-1]) > 0


def runs_of(mask: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where maximal runs of true begin and end; a run ends where the row does."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.concatenate([[True], rows[1:] != rows[:-1]])
    begins = np.flatnonzero(mask & (edge | ~np.concatenate([[False], mask[:-1]])))
    ends = np.flatnonzero(mask & (np.concatenate([edge[1:], [True]]) | ~np.concatenate([mask[1:], [False]]))) + 1
    return begins, ends


def span_lists(begins: np.ndarray, ends: np.ndarray, rows: np.ndarray, starts: np.ndarray, n: int) -> pa.Array:
    """Spans of each row, counted from its start."""
    own = rows[begins]
    per = np.bincount(own, minlength=n)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), pa.StructArray.from_arrays([pa.array(begins - starts[own], pa.int64()), pa.array(ends - starts[own], pa.int64())], names=["begin", "end"]))


def substring_dedup(docs: DataFrame, ws: Workspace, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row for each document: doc_id, n_words, n_removed, spans (words removed, from begin to before end), kept (text)."""
    block = window // 2
    exchange = Exchange(docs, ws, chunk_bytes, bucket_bytes)
    bits, buckets = hash_bits(exchange.n_bytes // 5), exchange.buckets
    exchange.round(ask_blocks(block, bits), answer_blocks)
    exchange.round(ask_windows(window, block, bits), answer_windows)

    def make(chunk: Chunk, answers: Answers) -> Iterator[pa.RecordBatch]:
        words, n = Words(chunk.data, chunk.starts), len(chunk.doc_ids)
        hashes, check, ids, rows, at = _windows(words, chunk.doc_ids, _hits(words, answers, block, bits, buckets), window, block)
        gone = np.zeros(len(words.symbols), bool)
        if len(at):
            first = starts_of(hashes, check)
            begins, group = np.flatnonzero(first), np.cumsum(first) - 1
            smaller = bits_back(answers, 1, dealt(hashes[begins], buckets), len(begins))
            again = np.concatenate([[False], (group[1:] == group[:-1]) & (rows[1:] == rows[:-1])])
            gone = covered(len(gone), at[smaller[group] | (ids > ids[begins][group]) | again], window)
        removed = np.bincount(words.doc[gone], minlength=n)
        kept, bounds = words.joined(~gone)
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(kept.tobytes())]).cast(pa.binary()).cast(pa.string())
        spans = span_lists(*runs_of(gone, words.doc), words.doc, words.starts, n)
        columns = [chunk.ids, pa.array(np.diff(words.starts)), pa.array(removed, pa.int64()), spans, kept]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    return exchange.result(make, "doc_id long, n_words long, n_removed long, spans array<struct<begin: long, end: long>>, kept string", ["doc_id", "n_words", "n_removed", "spans", "kept"])


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(documents(spark, sf_dir), Workspace(spark, "op1"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: The contract in SQL: all windows, and for each whether it is the first of its words.  Texts are cut into blocks that overlap.
OP1_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
parts AS (SELECT doc_id, b, words[b + 1:b + 119] AS part FROM (SELECT doc_id, words, unnest(range(0, len(words) - 19, 100)) AS b FROM d WHERE len(words) >= 20)),
starting AS (SELECT doc_id, b, part, unnest(range(1, least(101, len(part) - 18))) AS i FROM parts WHERE len(part) >= 20),
ranked AS (SELECT doc_id, b + i AS s, row_number() OVER (PARTITION BY array_to_string(part[i:i + 19], ' ') ORDER BY doc_id, b + i) AS nth FROM starting),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM ranked WHERE nth > 1),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
