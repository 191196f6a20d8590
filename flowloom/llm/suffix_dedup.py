"""Suffix-array dedup by a depth-limited radix sort.

A suffix counts only through its first DEPTH bytes, its window.  Repeated windows are what a suffix array, sorted
through that depth, has as groups of equal suffixes; only those that may be in such a group are ever sorted:

Round 0 is a filter.  Each window holds DEPTH - GRAM + 1 grams; its anchor is the one of least hash, the leftmost of
these.  Windows with one anchor are a run, and the bytes of the run are its span.  Grams are dealt to buckets by a
scrambled hash, since least hashes lie close together.  Every chunk sends each distinct
(hash of the anchor's gram, hash of the span) once, with its smallest document, after it has compared the bytes of spans
that are equal within it.  Back comes whether the anchor's gram is nowhere else, so that no window of the run is either.

Round 1.  All other spans are sent as bytes, and their windows are sorted by most-significant-digit passes of eight
bytes: each pass orders the suffixes of every group by their next digit, and suffixes alone in their group leave.
After the pass that reaches DEPTH, groups hold exactly the equal windows, and each is told whether a smaller document
has it.  Spans of equal bytes are sorted once.  Spans whose gram very many chunks have would fill one task; their windows are dealt one by one by their own
hash, each distinct one once for each chunk.

A byte goes if a window that covers it also starts in a document of smaller doc_id.  Rows without doc_id come after
all others; rows of equal doc_id, and repeated rows, do not count for each other.  A null text is empty; nothing of a
text of fewer than DEPTH bytes goes; texts of any length are read whole.  An empty table gives none.  Only doc_id and
text are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Workspace, documents, gathered, mix, spread
from ._exchange import BUCKET_BYTES, CHUNK_BYTES, Answers, Chunk, Exchange, bits_back, deltas, dealt, frame, hash_bits, small_ids, starts_of, undeltas, unframe
from .substring_dedup import covered, runs_of, span_lists

DEPTH = 50
#: Spans of one gram, from different chunks, beyond which their windows are dealt one by one.
CROWD = 2048
#: Suffixes that are sorted at once.
PART_OF_SORT = 1 << 20
UNIQUE, WHOLE, PART, CROWDED = 0, 1, 2, 3
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[0] = 1
    return np.cumprod(out, out=out)


def _window_hashes(data: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of all windows of each length, from one prefix sum of the bytes' numbers times powers modulo 2^64."""
    sums = np.zeros(len(data) + 1, np.uint64)
    terms = _powers(_ODD, len(data))
    terms *= _BYTE[data]
    np.cumsum(terms, out=sums[1:])
    del terms
    back = _powers(_ODD_BACK, len(data))
    out = []
    for length in lengths:
        h = sums[length:] - sums[: len(sums) - length]
        h *= back[: len(h)]
        out.append(mix(h))
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of so many values, where its least value is by the upper 32 bits; the leftmost of equal ones."""
    best = values & np.uint64(0xFFFFFFFF00000000)
    best |= np.arange(len(values), dtype=np.uint64)
    size = 1
    while size < width:
        step = min(size, width - size)
        best = np.minimum(best[: len(best) - step], best[step:])
        size += step
    return (best & np.uint64(0xFFFFFFFF)).astype(np.int64)


class Anchors:
    """The runs of a chunk's windows with the same anchor, ordered by gram, span, doc_id and place."""

    def __init__(self, chunk: Chunk, depth: int, bits: int):
        gram = depth // 2 - 1
        lengths = np.diff(chunk.starts)
        n = len(chunk.data)
        self.doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        ok = np.zeros(n, bool)
        if n >= depth:
            ok[: n - depth + 1] = self.doc[: n - depth + 1] == self.doc[depth - 1 :]
        starts = np.flatnonzero(ok)
        if not len(starts):
            self.windows = np.zeros(0, np.uint64)
            self.gram = self.span = np.zeros(0, np.uint64)
            self.begin = self.count = self.ids = np.zeros(0, np.int64)
            return
        grams, self.windows = _window_hashes(chunk.data, (gram, depth))
        anchors = _least(grams, depth - gram + 1)[starts]
        edge = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (self.doc[starts[1:]] != self.doc[starts[:-1]])])
        first = np.flatnonzero(edge)
        begin, anchor = starts[first], anchors[first]
        count = np.diff(np.append(first, len(starts)))
        high = np.uint64(((1 << bits) - 1) << (64 - bits))
        # Anchors are least hashes, so most of them are small: they are scrambled, or the first buckets would get nearly all.
        own = mix(grams[anchor]) & high
        span = self.windows[begin] * np.uint64(0x9FB21C651E98DF25) + self.windows[begin + count - 1] * np.uint64(0xD1342543DE82EF95)
        span += (count * 256 + anchor - begin).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        span = mix(span)
        ids = chunk.doc_ids[self.doc[begin]]
        order = np.argsort(own, kind="stable")
        many = starts_of(own[order])
        many = np.append(~many[1:], False) | ~many
        some = order[many]  # the rest are alone with their gram
        order[many] = some[np.lexsort((some, ids[some], span[some], own[some]))]
        self.gram, self.span, self.begin, self.count, self.ids = own[order], span[order], begin[order], count[order], ids[order]


def ask_anchors(depth: int, bits: int):
    def ask(chunk: Chunk, _: Answers, buckets: int) -> Iterator[tuple[int, bytes]]:
        a = Anchors(chunk, depth, bits)
        first = np.flatnonzero(starts_of(a.gram, a.span)) if len(a.gram) else []
        gram = a.gram[first]
        for bucket, where in dealt(gram, buckets):
            yield bucket, frame(deltas(gram[where] >> np.uint64(64 - bits)))

    return ask


def answer_anchors(crowd: int):
    def answer(_: int, bodies: list[bytes]) -> list[bytes]:
        """For each gram and span of a chunk: whether other chunks, or other spans, have the gram."""
        parts = [unframe(b) for b in bodies]
        gram = np.concatenate([undeltas(p[0]) for p in parts])
        order = np.argsort(gram)
        new = starts_of(gram[order])
        sizes = np.diff(np.append(np.flatnonzero(new), len(gram)))[np.cumsum(new) - 1]
        out = np.zeros(len(gram), np.uint8)
        out[order] = np.where(sizes < 2, UNIQUE, np.where(sizes > crowd, CROWDED, PART))
        ends = np.cumsum([len(p[0]) for p in parts])
        return [frame(out[e - len(p[0]) : e]) for e, p in zip(ends, parts, strict=True)]

    return answer


class Verdicts:
    """What round 0 says of each run, and the windows to be sorted in round 1."""

    def __init__(self, a: Anchors, answers: Answers, buckets: int, chunk: Chunk, depth: int):
        n = len(a.gram)
        first = starts_of(a.gram, a.span) if n else np.zeros(0, bool)
        begins = np.flatnonzero(first)
        codes = np.zeros(len(begins), np.uint8)
        for bucket, where in dealt(a.gram[begins], buckets):
            codes[where] = unframe(answers[0, bucket])[0]
        group = np.cumsum(first) - 1
        self.code = codes[group] if n else codes
        if n:
            # In a chunk, a span that a smaller document has as a whole: after a look at the bytes.
            again = np.flatnonzero(~first)
            sizes = a.count[again] + depth - 1
            here, there = a.begin[again], a.begin[begins][group[again]]
            for k in range(0, len(again), 1 << 14):
                own = slice(k, k + (1 << 14))
                if not np.array_equal(gathered(chunk.data, here[own], sizes[own]), gathered(chunk.data, there[own], sizes[own])):
                    raise RuntimeError("two spans of one chunk have equal hashes and different bytes")
            self.code = np.where(a.ids > a.ids[begins][group], WHOLE, self.code)
        self.first, self.group, self.begins = first, group, begins
        #: The first run of each span to be sorted, in order of gram.
        self.part = np.flatnonzero(first & (self.code == PART))
        #: The windows of crowded grams, ordered by hash: places of all, and which are the first of theirs, smallest doc_id first.
        crowded = np.flatnonzero(first & (self.code == CROWDED))
        at = np.repeat(a.begin[crowded], a.count[crowded]) + spread(a.count[crowded])
        ids = np.repeat(a.ids[crowded], a.count[crowded])
        order = np.lexsort((ids, a.windows[at]))
        self.crowd_at, self.crowd_ids = at[order], ids[order]
        hashes = a.windows[self.crowd_at]
        self.crowd_first = starts_of(hashes) if len(hashes) else np.zeros(0, bool)
        self.crowd_hash = hashes[self.crowd_first]


def ask_suffixes(depth: int, bits: int):
    """Bodies of runs: how many windows each has, its document, its bytes.  Buckets of crowded windows follow those of spans."""

    def ask(chunk: Chunk, answers: Answers, buckets: int) -> Iterator[tuple[int, bytes]]:
        a = Anchors(chunk, depth, bits)
        v = Verdicts(a, answers, buckets, chunk, depth)
        for bucket, where in dealt(a.gram[v.part], buckets):
            runs = v.part[where]
            yield bucket, frame(a.count[runs].astype(np.int32), small_ids(a.ids[runs]), gathered(chunk.data, a.begin[runs], a.count[runs] + depth - 1))
        at, ids = v.crowd_at[v.crowd_first], v.crowd_ids[v.crowd_first]
        for bucket, where in dealt(v.crowd_hash, buckets):
            yield buckets + bucket, frame(np.ones(len(at[where]), np.int32), small_ids(ids[where]), gathered(chunk.data, at[where], np.full(len(at[where]), depth)))

    return ask


def radix_groups(data: np.ndarray, at: np.ndarray, depth: int, digit: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes that start at these places, sorted through depth by most-significant-digit passes.

    Returns those that are equal to another through depth (as positions in at), and their group: equal suffixes have
    the same number.  A pass orders the suffixes of every group by their next digit; those alone in a group leave."""
    who, group = np.arange(len(at), dtype=np.int32), np.zeros(len(at), np.int32)
    for begin in range(0, depth, digit):
        width = min(digit, depth - begin)
        value = np.zeros(len(who), np.uint64)
        for k in range(width):
            value <<= np.uint64(8)
            value |= data[at[who] + (begin + k)]
        order = np.argsort(value) if not begin else np.lexsort((value, group))
        who, group, value = who[order], group[order], value[order]
        if not len(who):
            break
        new = starts_of(group, value)
        sizes = np.diff(np.append(np.flatnonzero(new), len(who)))
        group = (np.cumsum(new) - 1).astype(np.int32)
        stay = sizes[group] > 1
        who, group = who[stay], group[stay]
    return who, group


def parted(data: np.ndarray, at: np.ndarray, most: int = PART_OF_SORT) -> Iterator[np.ndarray]:
    """The first pass, by two bytes: positions in at of suffixes that begin in one range of these, about most of them at a
    time, so that the passes behind it hold no more than that (or all that begin alike)."""
    if len(at) <= most:
        yield np.arange(len(at))
        return
    first = data[at].astype(np.uint16) << np.uint16(8) | data[at + 1]
    ends = np.cumsum(np.bincount(first, minlength=1 << 16))
    low, before = 0, 0
    while before < len(at):
        high = max(low + 1, int(np.searchsorted(ends, before + most, side="right")))
        if ends[high - 1] > before:
            yield np.flatnonzero((first >= low) & (first < high))
        low, before = high, int(ends[high - 1])


def answer_suffixes(depth: int):
    def answer(_: int, bodies: list[bytes]) -> list[bytes]:
        """A bit for each window: a smaller document has it."""
        parts = [unframe(b) for b in bodies]
        count = np.concatenate([p[0] for p in parts]).astype(np.int64)
        ids = np.concatenate([p[1].astype(np.int64) for p in parts])
        data = np.concatenate([p[2] for p in parts])
        windows = [int(p[0].sum()) for p in parts]
        del parts
        # Spans of equal bytes are sorted once, for the smallest document that has them; for the others all is settled.
        ends, raw, seen = np.cumsum(count + depth - 1).tolist(), data.tobytes(), {}
        same = np.fromiter((seen.setdefault(raw[e - n : e], k) for k, (e, n) in enumerate(zip(ends, (count + depth - 1).tolist(), strict=True))), np.int64, len(count))
        del raw, seen
        least = ids.copy()
        np.minimum.at(least, same, ids)
        own = np.flatnonzero(same == np.arange(len(count)))
        out = np.repeat(ids > least[same], count)
        run = np.repeat(own, count[own])
        place = spread(count[own])
        at = (np.array(ends, np.int64) - count - depth + 1)[run] + place
        hit = np.zeros(len(at), bool)
        for some in parted(data, at):
            who, group = radix_groups(data, at[some], depth)
            if len(who):
                who = some[who]
                of = least[run[who]]
                first = np.minimum.reduceat(of, np.flatnonzero(starts_of(group)))
                hit[who] = first[group_number(group)] < of
        # What holds for the smallest document that has a span holds for the others.
        of_own = np.cumsum(count[own]) - count[own]
        back = np.searchsorted(own, same)
        out |= hit[np.repeat(of_own[back], count) + spread(count)]
        bounds = np.cumsum(windows)
        return [np.packbits(out[e - n : e]).tobytes() for e, n in zip(bounds, windows, strict=True)]

    return answer


def group_number(group: np.ndarray) -> np.ndarray:
    """Ascending groups numbered from 0 without gaps."""
    return np.cumsum(starts_of(group)) - 1


def repeated(chunk: Chunk, answers: Answers, depth: int, bits: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes of the chunk go; the document of each byte."""
    a = Anchors(chunk, depth, bits)
    if not len(a.gram):
        return np.zeros(len(chunk.data), bool), a.doc
    v = Verdicts(a, answers, buckets, chunk, depth)
    whole = np.flatnonzero(v.code == WHOLE)
    starts, lengths = [a.begin[whole]], [a.count[whole] + depth - 1]
    if len(v.part):
        counts = a.count[v.part]
        ends = np.cumsum(counts)
        hit = np.zeros(int(ends[-1]), bool)
        for bucket, where in dealt(a.gram[v.part], buckets):
            low, high = int(ends[where.start] - counts[where.start]), int(ends[where.stop - 1])
            hit[low:high] = np.unpackbits(np.frombuffer(answers[1, bucket], np.uint8), count=high - low).astype(bool)
        # other runs of the same span and the same doc_id share its verdict
        place = np.full(len(v.begins), -1)
        place[v.group[v.part]] = np.arange(len(v.part))
        same = np.flatnonzero(v.code == PART)
        k = place[v.group[same]]
        n = a.count[same]
        flags = hit[np.repeat((ends - counts)[k], n) + spread(n)]
        at = np.repeat(a.begin[same], n) + spread(n)
        starts.append(at[flags])
    if len(v.crowd_hash):
        hit = np.zeros(len(v.crowd_hash), bool)
        for bucket, where in dealt(v.crowd_hash, buckets):
            hit[where] = np.unpackbits(np.frombuffer(answers[1, buckets + bucket], np.uint8), count=where.stop - where.start).astype(bool)
        least = v.crowd_ids[v.crowd_first]
        same = np.flatnonzero(v.code == CROWDED)
        n = a.count[same]
        at = np.repeat(a.begin[same], n) + spread(n)
        k = np.searchsorted(v.crowd_hash, a.windows[at])
        starts.append(at[hit[k] | (np.repeat(a.ids[same], n) > least[k])])
    lengths += [np.full(len(s), depth) for s in starts[1:]]
    return covered(len(chunk.data), np.concatenate(starts), np.concatenate(lengths)), a.doc


def suffix_dedup(docs: DataFrame, ws: Workspace, depth: int = DEPTH, crowd: int = CROWD, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row for each document: doc_id, n_bytes, n_removed, spans (bytes removed, from begin to before end), kept (bytes)."""
    exchange = Exchange(docs, ws, chunk_bytes, bucket_bytes)
    bits, buckets = min(48, hash_bits(exchange.n_bytes // 10)), exchange.buckets
    exchange.round(ask_anchors(depth, bits), answer_anchors(crowd))
    exchange.round(ask_suffixes(depth, bits), answer_suffixes(depth))

    def make(chunk: Chunk, answers: Answers) -> Iterator[pa.RecordBatch]:
        gone, doc = repeated(chunk, answers, depth, bits, buckets)
        lengths = np.diff(chunk.starts)
        left = np.concatenate([[0], np.cumsum(~gone)])[chunk.starts]
        data = chunk.data[~gone]
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(left.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())
        spans = span_lists(*runs_of(gone, doc), doc, chunk.starts, len(lengths))
        yield pa.RecordBatch.from_arrays([chunk.ids, pa.array(lengths), pa.array(lengths - np.diff(left)), spans, kept], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return exchange.result(make, "doc_id long, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary", ["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(documents(spark, sf_dir), Workspace(spark, "op10"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: The contract in SQL, over bytes in hexadecimal; texts are cut into blocks that overlap, so that no long text is walked for each window.
OP10_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (SELECT doc_id, b, substr(h, 2 * b + 1, 2098) AS part FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2, 1000)) AS b FROM d)),
windows AS (SELECT doc_id, b + i AS s, substr(part, 2 * i + 1, 100) AS k FROM (SELECT doc_id, b, part, unnest(range(0, least(1000, len(part) // 2 - 49))) AS i FROM blocks WHERE len(part) >= 100)),
hits AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY k) AS least FROM windows) WHERE least < doc_id),
edges AS (SELECT doc_id, s, coalesce(s - lag(s) OVER w > 50, true) AS begins, least(50, coalesce(lead(s) OVER w - s, 50)) AS n FROM hits WINDOW w AS (PARTITION BY doc_id ORDER BY s)),
spans AS (SELECT doc_id, span, min(s) AS b, max(s) + 50 AS e, sum(n) AS n FROM (SELECT *, sum(CAST(begins AS INT)) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM edges) GROUP BY doc_id, span),
totals AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id),
gaps AS (SELECT doc_id, b AS till, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS since FROM spans
  UNION ALL SELECT d.doc_id, len(h) // 2, coalesce(x.e, 0) FROM d LEFT JOIN (SELECT doc_id, max(e) AS e FROM spans GROUP BY doc_id) AS x ON d.doc_id = x.doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (till - since)), '' ORDER BY since) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN totals USING (doc_id)
"""
