"""Benchmark decontamination by the q-gram lemma.

Texts are compared in normal form: lower case, white space runs as one blank.  Benchmark items are cut into passages
of PASSAGE characters that overlap by half (an item of fewer characters is one passage), each with a budget of
edits.  A region within E edits of a passage of L characters shares at least L + 1 - Q - Q * E of its q-grams with
it, on diagonals that differ by E at most.  So the shared q-grams of every document are counted in overlapping bands
of diagonals; bands that meet the bound are retained and verified by a banded alignment, which finds the fewest
edits between the passage and any part of the region.

Where a document holds none of an item's passages, every other stretch of PASSAGE characters of the item is tried: the
item's shared q-grams are counted in the same bands, the stretches that meet the bound are aligned, and the one of
fewest edits counts as one passage.  So a leak of PASSAGE characters is found at any offset in its item.

The benchmark is a stated query set.  It is read in blocks of bounded size, each of which passes over all
documents once.  Null and empty texts match nothing; texts of any length are searched whole; empty tables give none.  An item of fewer than Q characters in normal form is found where
a document holds the whole of it, without an edit.  Rows of one item_id are one item with several texts; a null doc_id or item_id passes through.  Rows of contaminated() are by doc_id, one for each row of documents that
leaks as long as the benchmark is one block; other columns, whatever their names, pass through decontamination_stage.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Workspace, documents, lean, slices, sole, spread, texts

Q = 12
PASSAGE = 100
#: Edits for each character of a passage.
BUDGET = 0.06
#: Characters of benchmark in a block.
BLOCK_CHARS = 8 << 20
#: Shared q-grams of documents and passages held at once.
POSTINGS = 1 << 22


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def passages(text: str, length: int = PASSAGE, q: int = Q, budget: float = BUDGET) -> list[tuple[str, int]]:
    """The passages of an item, each with its budget: no more edits than the lemma can bear."""
    text = normal(text)
    if len(text) < q:
        return []
    if len(text) <= length:
        cut = [text]
    else:
        cut = [text[a : a + length] for a in range(0, len(text) - length, length // 2)] + [text[-length:]]
    return [(p, max(0, min(int(budget * len(p)), (len(p) - q) // q))) for p in dict.fromkeys(cut)]


_BASE, _BACK = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of an odd number modulo 2^64 and of its inverse, at least."""
    if len(_powers[0]) < n:
        size = max(1 << 20, n)
        for k, base in enumerate((_BASE, _BACK)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all q-grams, from prefix sums; equal hashes only ever cost time, as alignment reads the characters."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(codes))
    sums = np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95) * up[: len(codes)], dtype=np.uint64)
    h = sums[q - 1 :].copy()
    h[1:] -= sums[: n - 1]
    h *= down[:n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Postings:
    """For each q-gram its units (passages or items, in order) and offsets in them."""

    def __init__(self, first: np.ndarray, counts: np.ndarray, unit: np.ndarray, offset: np.ndarray, units: int):
        self.first, self.counts, self.unit, self.offset, self.units = first, counts, unit, offset, units
        self.ordered = np.repeat(np.arange(len(counts)), counts) * units + unit

    def parts(self, doc: np.ndarray, at: np.ndarray, k: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Document, unit, offset and diagonal of all that the places at have in common with units.  A q-gram that very
        many units have meets many places: then some units at a time, so that about so many are held at once."""
        blocks = min(max(1, self.units), 1 + int(self.counts[k].sum()) // most)
        bounds = np.arange(blocks + 1) * self.units // blocks
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            if blocks == 1:
                first, n = self.first[k], self.counts[k]
            else:
                first = np.searchsorted(self.ordered, k * self.units + low)
                n = np.searchsorted(self.ordered, k * self.units + high) - first
            place = np.repeat(first, n) + spread(n)
            offset = self.offset[place]
            yield np.repeat(doc, n), self.unit[place], offset, np.repeat(at, n) - offset


class Index:
    """The q-grams of all passages: sorted hashes, and for each its passages and offsets."""

    FILTER_BITS = 22

    def __init__(self, items: list[tuple[int | None, str]], q: int, length: int, budget: float):
        self.q = q
        found = [(item, p, e) for item, text in items for p, e in passages(text, length, q, budget)]
        self.items = [x[0] for x in found]
        self.codes = [symbols(x[1]) for x in found]
        self.lengths = np.array([len(c) for c in self.codes], np.int64)
        self.edits = np.array([x[2] for x in found], np.int64)
        self.least = self.lengths + 1 - q - q * self.edits
        hashes = np.concatenate([*(grams(c, q) for c in self.codes), np.zeros(0, np.uint64)])
        n = np.maximum(self.lengths - q + 1, 0)
        passage, offset = np.repeat(np.arange(len(found)), n), spread(n)
        order = np.argsort(hashes, kind="stable")
        self.hashes, first, self.counts = np.unique(hashes[order], return_index=True, return_counts=True)
        self.passages = Postings(first, self.counts, passage[order], offset[order], len(found))
        # Items of more than one passage as a whole: for each hash its items and offsets.
        whole = [(item, symbols(t)) for item, t in dict.fromkeys((item, normal(text)) for item, text in items) if len(t) > length >= q]
        self.length, self.most = length, max(0, min(int(budget * length), (length - q) // q))
        self.whole_items, self.whole_codes = [x[0] for x in whole], [x[1] for x in whole]
        n = np.array([len(c) + 1 - q for c in self.whole_codes], np.int64)
        at = np.searchsorted(self.hashes, np.concatenate([*(grams(c, q) for c in self.whole_codes), np.zeros(0, np.uint64)]))
        order = np.argsort(at, kind="stable")
        counts = np.bincount(at, minlength=len(self.hashes))
        self.wholes = Postings(np.cumsum(counts) - counts, counts, np.repeat(np.arange(len(whole)), n)[order], spread(n)[order], len(whole))
        self.filter = np.zeros(1 << self.FILTER_BITS, bool)
        self.filter[(self.hashes >> np.uint64(64 - self.FILTER_BITS)).astype(np.int64)] = True

    def shared(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places whose q-gram a passage has, and which."""
        at = np.flatnonzero(self.filter[(hashes >> np.uint64(64 - self.FILTER_BITS)).astype(np.int64)])
        k = np.searchsorted(self.hashes, hashes[at])
        k[k == len(self.hashes)] = 0
        ok = self.hashes[k] == hashes[at] if len(self.hashes) else np.zeros(0, bool)
        return at[ok], k[ok]


def retained(index: Index, doc: np.ndarray, at: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, passages and lowest diagonals of the bands that meet the bound.  at: places within the documents."""
    found = [_bands(index, doc, passage, diagonal) for doc, passage, _, diagonal in index.passages.parts(doc, at, k, POSTINGS)]
    return tuple(np.concatenate([x[i] for x in found]) for i in range(3))


def _bands(index: Index, doc: np.ndarray, passage: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = index.edits[passage] + 1
    out = []
    for shift in (0, 1):  # bands of 2 * width diagonals, every width diagonals
        band = (diagonal + shift * width) // (2 * width)
        order = np.lexsort((band, passage, doc))
        d, p, b = doc[order], passage[order], band[order]
        if not len(d):
            continue
        begins = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (p[1:] != p[:-1]) | (b[1:] != b[:-1])]))
        counts = np.diff(np.append(begins, len(d)))
        good = begins[counts >= index.least[p[begins]]]
        out.append((d[good], p[good], b[good] * 2 * width[order][good] - shift * width[order][good]))
    return tuple(np.concatenate([x[i] for x in out]) if out else np.zeros(0, np.int64) for i in range(3))


def exact(region: np.ndarray, passage: np.ndarray) -> int:
    """Where the passage first stands in the region as it is, or -1."""
    whole, part = region.tobytes(), passage.tobytes()
    k = whole.find(part)
    while k >= 0 and k % passage.itemsize:
        k = whole.find(part, k + 1)
    return k // passage.itemsize if k >= 0 else -1


def align(text: np.ndarray, passage: np.ndarray, low: int, width: int, edits: int) -> tuple[int, int, int]:
    """The fewest edits between the passage and a part of the text, on diagonals from low - edits to low + width + edits;
    where that part begins (at the earliest) and ends.  Edits beyond the budget count as one more than it."""
    cells = width + 2 * edits + 1
    base = low - edits
    far = edits + 1
    if (at := exact(text[max(0, base) : max(0, base + cells + len(passage) - 1)], passage)) >= 0:
        at += max(0, base)
        return 0, at, at + len(passage)
    span = np.arange(cells)
    costs = np.where((base + span >= 0) & (base + span <= len(text)), 0, far)  # any start is free
    begin = base + span
    for j in range(len(passage)):
        place = base + j + span
        inside = (place >= 0) & (place < len(text))
        same = np.zeros(cells, bool)
        same[inside] = text[place[inside]] == passage[j]
        step = np.where(inside, costs + ~same, far)
        down = np.append(costs[1:] + 1, far)  # a character of the passage without one of the text
        origin = np.where(step <= down, begin, np.append(begin[1:], 0))
        best = np.minimum(np.minimum(step, down), far)
        slope = best - span  # characters of the text without one of the passage
        lowest = np.minimum.accumulate(slope)
        source = np.maximum.accumulate(np.where(slope == lowest, span, 0))
        costs, begin = np.minimum(lowest + span, far), origin[source]
        if costs.min() >= far:
            return far, 0, 0
    k = int(costs.argmin())
    return int(costs[k]), int(max(0, begin[k])), int(min(len(text), base + k + len(passage)))


def stretches(index: Index, doc: np.ndarray, at: np.ndarray, k: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """Documents, whole items, lowest diagonals of the bands in which a stretch meets the bound, and where such stretches begin."""
    for part in index.wholes.parts(doc, at, k, POSTINGS):
        yield from _stretches(index, *part)


def _stretches(index: Index, doc: np.ndarray, item: np.ndarray, offset: np.ndarray, diagonal: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
    width, inner = index.most + 1, index.length - index.q
    least = inner + 1 - index.q * index.most
    for shift in (0, 1):
        band = (diagonal + shift * width) // (2 * width)
        order = np.lexsort((offset, band, item, doc))
        d, p, b, o = doc[order], item[order], band[order], offset[order]
        if len(d):
            fresh = np.append(True, (d[1:] != d[:-1]) | (p[1:] != p[:-1]) | (b[1:] != b[:-1]) | (o[1:] != o[:-1]))
            d, p, b, o = d[fresh], p[fresh], b[fresh], o[fresh]
        i = np.arange(max(0, len(d) - least + 1))
        j = i + least - 1
        i = i[(d[i] == d[j]) & (p[i] == p[j]) & (b[i] == b[j]) & (o[j] - o[i] <= inner)]
        if not len(i):
            continue
        cuts = np.flatnonzero((d[i][1:] != d[i][:-1]) | (p[i][1:] != p[i][:-1]) | (b[i][1:] != b[i][:-1])) + 1
        for some in np.split(i, cuts):
            x = some[0]
            begin = np.maximum(0, o[some + least - 1] - inner)
            end = np.minimum(o[some], len(index.whole_codes[p[x]]) - index.length)
            sizes = np.maximum(end + 1 - begin, 0)
            starts = np.unique(np.repeat(begin, sizes) + spread(sizes))
            yield int(d[x]), int(p[x]), int(b[x] * 2 * width - shift * width), starts


def fewest(text: np.ndarray, item: np.ndarray, length: int, low: int, width: int, edits: int, starts: np.ndarray) -> np.ndarray:
    """For stretches of the item, the edits that align() finds; low is a diagonal of the whole item."""
    span = np.arange(width + 2 * edits + 1)
    base, far = (starts + low - edits)[:, None] + span, edits + 1
    costs = np.where((base >= 0) & (base <= len(text)), 0, far)
    last = np.full((len(starts), 1), far)
    for j in range(length):
        place = base + j
        inside = (place >= 0) & (place < len(text))
        same = inside & (text[np.clip(place, 0, len(text) - 1)] == item[starts + j][:, None])
        step = np.where(inside, costs + ~same, far)
        best = np.minimum(np.minimum(step, np.concatenate([costs[:, 1:] + 1, last], axis=1)), far)
        costs = np.minimum(np.minimum.accumulate(best - span, axis=1) + span, far)
        if costs.min() >= far:
            break
    return costs.min(axis=1)


class Search:
    """The benchmark's passages in a list of texts.  items: (item_id, text)."""

    def __init__(self, items: list[tuple[int | None, str]], q: int, length: int, budget: float):
        self.length, self.index = length, Index(items, q, length, budget)
        short: dict[int, list] = {}
        for item, text in items:
            if 0 < (n := len(normal(text))) < q:
                short.setdefault(n, []).append((item, text))
        self.short = [Index(some, n, length, budget) for n, some in sorted(short.items())]

    def __call__(self, some: list[str]) -> dict[tuple[int, int | None], list]:
        """For each text (by its place) and item found in it: edits, begin and end of the best region, and the passages found."""
        index = self.index
        codes = [symbols(normal(t)) for t in some]
        sizes = np.fromiter(map(len, codes), np.int64, len(codes))
        starts = np.cumsum(sizes) - sizes
        flat = np.concatenate([*codes, np.zeros(0, np.uint32)])

        def hits(index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            at, k = index.shared(grams(flat, index.q))
            doc = np.searchsorted(starts, at, side="right") - 1
            inside = at - starts[doc] + index.q <= sizes[doc]
            return doc[inside], (at - starts[doc])[inside], k[inside]

        doc, at, k = hits(index)
        found: dict[tuple[int, int | None], list] = {}
        for d, p, low in zip(*(x.tolist() for x in retained(index, doc, at, k)), strict=True):
            e = int(index.edits[p])
            cost, begin, end = align(codes[d], index.codes[p], low, 2 * (e + 1), e)
            if cost <= e:
                best = found.setdefault((d, index.items[p]), [cost, begin, end, set()])
                best[:3] = min(best[:3], [cost, begin, end])
                best[3].add(p)
        passed, e, width = set(found), index.most, 2 * (index.most + 1)
        for d, w, low, begins in stretches(index, doc, at, k):
            if (d, index.whole_items[w]) in passed:
                continue
            for a in range(0, len(begins), 512):
                own = begins[a : a + 512]
                costs = fewest(codes[d], index.whole_codes[w], self.length, low, width, e, own)
                if costs.min() <= e:
                    s = int(own[costs.argmin()])
                    place = list(align(codes[d], index.whole_codes[w][s : s + self.length], low + s, width, e))
                    best = found.setdefault((d, index.whole_items[w]), [*place, {-1}])
                    best[:3] = min(best[:3], place)
        for few in self.short:
            for d, a, j in zip(*(x.tolist() for x in hits(few)), strict=True):
                for p in few.passages.unit[few.passages.first[j] : few.passages.first[j] + few.counts[j]].tolist():
                    if np.array_equal(codes[d][a : a + few.q], few.codes[p]):
                        best = found.setdefault((d, few.items[p]), [0, a, a + few.q, set()])
                        best[:3] = min(best[:3], [0, a, a + few.q])
                        best[3].add(-1 - few.q)
        return found


@dataclass(frozen=True)
class Block:
    """A block of the benchmark, sent to the executors once; each worker makes its search of it."""

    name: str
    items: Broadcast

    def search(self, q: int, length: int, budget: float) -> Search:
        return sole((self.name, q, length, budget), lambda: Search(list(self.items.value), q, length, budget))


def block_count(benchmark: DataFrame, block_chars: int) -> int:
    total = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    return max(1, math.ceil(total / block_chars))


def block(benchmark: DataFrame, k: int, many: int) -> Block:
    """The k-th of so many blocks of the benchmark."""
    items = benchmark.filter("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(many)) == k).orderBy("item_id", "text").collect()
    return Block(uuid.uuid4().hex, benchmark.sparkSession.sparkContext.broadcast(tuple((r[0], r[1]) for r in own)))


def leaks(docs: DataFrame, own: Block, q: int = Q, length: int = PASSAGE, budget: float = BUDGET) -> DataFrame:
    """doc_id, item_id, edits, begin, end, n_passages for each document and item with a passage in it: the best of its
    regions, in characters of the text in normal form, and how many of the item's passages were found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = own.search(q, length, budget)
        for batch in slices(batches, "text", 1 << 20):
            if found := search(texts(batch.column("text"))):
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[d], item, cost, begin, end, len(ps)) for (d, item), (cost, begin, end, ps) in found.items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "item_id", "edits", "begin", "end", "n_passages"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, item_id long, edits long, begin long, end long, n_passages long")


def contaminated(docs: DataFrame, benchmark: DataFrame, ws: Workspace, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """leaks() over the whole benchmark.  Of several blocks, the driver and the executors hold one at a time."""
    many, parts = block_count(benchmark, block_chars), []
    for k in range(many):
        own = block(benchmark, k, many)
        parts.append(leaks(docs, own))
        if many > 1:
            parts[k] = ws.table(parts[k], f"leaks{k}")
            own.items.destroy()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if many > 1:
        best = F.min(F.struct("edits", "begin", "end"))
        out = out.groupBy("doc_id", "item_id").agg(best.alias("b"), F.sum("n_passages").alias("n_passages")).select("doc_id", "item_id", "b.edits", "b.begin", "b.end", "n_passages")
    return out


def clean(docs: DataFrame, own: Block, q: int = Q, length: int = PASSAGE, budget: float = BUDGET) -> DataFrame:
    """The rows of docs that hold no passage of the block, as they are."""
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = own.search(q, length, budget)
        for batch in slices(batches, "text", 1 << 20):
            stay = np.ones(batch.num_rows, bool)
            stay[[d for d, _ in search(texts(batch.column(text)))]] = False
            yield batch.filter(pa.array(stay))

    return docs.mapInArrow(lean(run), docs.schema)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), Workspace(spark, "op3"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows that hold a passage of the benchmark, each by itself: rows may share a doc_id or have none."""
    ws, benchmark = Workspace(spark, "clean"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    many = block_count(benchmark, BLOCK_CHARS)
    for k in range(many):
        own = block(benchmark, k, many)
        docs = clean(docs, own)
        if many > 1:
            docs = ws.table(docs, f"clean{k}")
            own.items.destroy()
    return docs
