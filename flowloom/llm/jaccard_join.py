"""N-gram Jaccard join by universe partitioning.

A document's set holds its distinct shingles of SHINGLE words (one of all words where there are fewer).  Two sets
link when NUMERATOR / DENOMINATOR of their union or more is common; then their sizes and the size D of their symmetric
difference satisfy D <= (n1 + n2) * (DEN - NUM) / (DEN + NUM).  Sizes fall into bands so wide that linked sets lie in one band or in
neighbours.  For each band the universe of shingles is hashed into m segments, somewhat more than D can be.

Pigeonhole: let the larger set y give each segment a threshold t of -1 (not used), 0 or 1, such that the t + 1 add
up to more than D.  Then a linked x agrees with y in some segment within t: equal subsets for 0, and one shingle more
or less for 1, which the one-deletion neighbourhoods of a few segments find.  Every set indexes all segments of its
own band and of the next.

Allocation by cost: first all signatures are counted (an exchange, which tells each how many different sets share
it, and each set which chunk speaks for it); then every y takes the thresholds of least cost, at first the segments that it shares with no one.  So sets
without near copies have no candidates, and empty or common segments are passed over.

Candidates are never all pairs of a group.  Equal sets are one class.  Sets that share signatures, directly or by way
of others, are a group, and its pivot is the set that shares most.  Every set of the group is verified against the
pivot, which also yields its difference from it.  What links with the pivot is one component.  A set y that does not
can link with a set z of its group only if their differences dy and dz have (|dy| + |dz| - D) / 2 elements in common,
at least one.  So both have such an element among their rarest, and the differences are indexed by these, by element
and size; elements that no other set of the group has take part in no pair, and sets with more than D of them drop
out.  First every set meets the least set at each of its elements, and the best of these is verified; then, of what
is left in different components, all.  Every test is an exact count, on 64-bit hashes of shingles.

Nulls: a null text has no words, and is linked with nothing, like an empty one.  Rows without doc_id are documents
like others; component_id is the smallest doc_id that there is in the component, null if none.  Rows of equal
doc_id are documents of their own, and so are repeated rows.  An empty table gives none.  Only doc_id and text are
read; other columns, whatever their names, pass through near_dedup_stage.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Workspace, documents, lean, mix, numbered, one_fits, spread, window_hashes
from ._exchange import BUCKET_BYTES, CHUNK_BYTES, Answers, Chunk, Exchange, bits_back, deltas, dealt, frame, hash_bits, starts_of, undeltas, unframe
from .substring_dedup import Words

SHINGLE = 4
NUMERATOR, DENOMINATOR = 85, 100
#: Segments for each unit of difference that linked sets may have.  The more there are, the more of a set's own
#: segments no other set shares: one that differs from all others by much more than the bound then has no candidates.
SLACK = 1.6
#: Runs into which the way back from sets to documents is divided.
RUNS = 64
#: Members of a group for each copy of its pivot.
SHARE = 512
#: Classes into which the sizes of differences fall, from one bound to the next.
CLASSES = 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_A, _B, _C = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD1342543DE82EF95), np.uint64(0xA24BAED4963EE407)


class Bands:
    """Band k holds the sizes from low[k] to before low[k + 1]; most[k] is the largest difference of linked sets, m[k] the number of segments, wide[k] how many have one-deletion neighbourhoods."""

    def __init__(self, numerator: int, denominator: int, largest: int):
        self.numerator, self.denominator = numerator, denominator
        low = [1]
        while low[-1] <= largest or len(low) < 3:
            low.append(low[-1] * denominator // numerator + 1)
        low.append(low[-1] * denominator // numerator + 1)
        self.low = np.array(low)
        self.most = np.array([self.difference(2 * (b - 1)) for b in low[1:]])
        self.m = np.array([0 if d == 0 else math.ceil(SLACK * (d + 1)) + 1 for d in self.most])
        self.wide = np.minimum(self.m, 2 + self.m // 32)

    def difference(self, both):
        """The largest symmetric difference of linked sets of so many shingles together."""
        return both * (self.denominator - self.numerator) // (self.denominator + self.numerator)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, side="right") - 1


@lru_cache(maxsize=4)
def bands(numerator: int, denominator: int, bits: int) -> Bands:
    return Bands(numerator, denominator, 1 << bits)


class Sets:
    """The shingle sets of a chunk's documents: hashes, ordered within each; where each starts; its key of 16 bytes."""

    def __init__(self, chunk: Chunk, shingle: int):
        words = Words(_LOWER[chunk.data], chunk.starts)
        counts = np.diff(words.starts)
        at, hashes = words.windows(shingle)
        docs = [words.doc[at]]
        found = [hashes]
        for n in range(1, shingle):
            short = np.flatnonzero(counts == n)
            if len(short):
                found.append(mix(window_hashes(words.symbols, n)[words.starts[short]] * _A + np.uint64(n)))
                docs.append(short)
        doc, hashes = np.concatenate(docs), np.concatenate(found)
        order = np.argsort(hashes)
        order = order[np.argsort(doc[order].astype(np.uint16 if len(counts) < 1 << 16 else np.int64), kind="stable")]
        doc, hashes = doc[order], hashes[order]
        if len(doc):
            new = starts_of(doc, hashes)
            doc, hashes = doc[new], hashes[new]
        self.doc, self.hashes = doc, hashes
        self.sizes = np.bincount(doc, minlength=len(counts)).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        high, low = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.uint64)
        np.add.at(high, doc, mix(hashes * _B + _C))
        np.add.at(low, doc, mix(hashes * _C + _A))
        high = mix(high + self.sizes.astype(np.uint64) * _A)
        self.high, self.low = high, low
        self.keys = np.stack([high, low], axis=1).astype(">u8").view("S16").ravel() if len(counts) else np.zeros(0, "S16")

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The first document of each set that is not empty, ordered by the set's hash, and that hash."""
        some = np.flatnonzero(self.sizes > 0)
        keys, first = np.unique(self.high[some], return_index=True)
        return some[first], keys

    def shingles(self, i: int) -> np.ndarray:
        return self.hashes[self.starts[i] : self.starts[i + 1]]

    def key(self, i: int) -> bytes:
        return self.keys[i].ljust(16, b"\0")


class Signatures:
    """The signatures of the first document of each set in a chunk.

    Parallel arrays over segments (set, band step 0 or 1, segment, full: the signature of the subset) and over
    deletions (segment row, gone: the signature without one shingle)."""

    def __init__(self, sets: Sets, b: Bands):
        own = np.sort(sets.distinct()[0])
        band = b.of(sets.sizes[own])
        row_doc, row_step, row_segment, row_full, row_wide, del_row, del_gone = [], [], [], [], [], [], []
        rows = 0
        element = mix(sets.hashes * _C + _B)
        for step in (0, 1):
            use = b.m[band + step] > 0
            docs, k = own[use], band[use] + step
            if not len(docs):
                continue
            m = b.m[k]
            offset = np.cumsum(m) - m
            n = sets.sizes[docs]
            which = np.repeat(np.arange(len(docs)), n)
            value = element[np.repeat(sets.starts[docs], n) + spread(n)]
            seed = mix(value + (k[which].astype(np.uint64) + np.uint64(1)) * _A)
            segment = (((seed >> np.uint64(32)) * m[which].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            sums = np.zeros(int(m.sum()), np.uint64)
            np.add.at(sums, offset[which] + segment, value)
            number = spread(m)
            salt = (np.repeat(k, m).astype(np.uint64) << np.uint64(32)) * _B + number.astype(np.uint64) * _A
            row_doc.append(np.repeat(docs, m))
            row_step.append(np.full(len(sums), step, np.int8))
            row_segment.append(number)
            row_full.append(mix(sums + salt))
            wide = number < np.repeat(b.wide[k], m)
            row_wide.append(wide)
            place = offset[which] + segment
            some = np.flatnonzero(wide[place])
            del_row.append(rows + place[some])
            del_gone.append(mix(sums[place[some]] - value[some] + salt[place[some]]))
            rows += len(sums)
        join = lambda x, kind: np.concatenate([*x, np.zeros(0, kind)]).astype(kind)
        self.doc, self.step, self.full, self.wide = join(row_doc, np.int64), join(row_step, np.int8), join(row_full, np.uint64), join(row_wide, bool)
        self.del_row, self.gone = join(del_row, np.int64), join(del_gone, np.uint64)
        # Looked up in two domains: subsets, and subsets of the index without one shingle.
        w = np.flatnonzero(self.wide)
        domain = lambda h: mix(h + _C)
        self.wide_rows = w
        self.sig = np.concatenate([self.full, domain(self.gone), domain(self.full[w]), self.gone])
        self.owner = np.concatenate([self.doc, self.doc[self.del_row], self.doc[w], self.doc[self.del_row]])
        n, g = len(self.full), len(self.gone)
        self.parts = (slice(0, n), slice(n, n + g), slice(n + g, n + g + len(w)), slice(n + g + len(w), n + 2 * g + len(w)))


def _distinct(s: Signatures, sets: Sets, bits: int):
    """Signatures in order, truncated to bits: order, first of each, number of different sets, a set."""
    sig = s.sig & np.uint64(((1 << bits) - 1) << (64 - bits))
    high = sets.high[s.owner] >> np.uint64(16)
    order = np.argsort(sig)
    first = starts_of(sig[order]) if len(sig) else np.zeros(0, bool)
    begins = np.flatnonzero(first)
    if not len(begins):
        return order, first, sig, np.zeros(0, np.uint8), high
    many = np.repeat(np.diff(np.append(begins, len(sig))) > 1, np.diff(np.append(begins, len(sig))))
    some = order[many]
    order[many] = some[np.lexsort((high[some], sig[some]))]
    sig, high = sig[order], high[order]
    different = np.add.reduceat(starts_of(sig, high).astype(np.int64), begins)
    return order, first, sig[begins], np.minimum(different, 255).astype(np.uint8), high[begins]


def ask_signatures(shingle: int, num: int, den: int, bits: int):
    def ask(chunk: Chunk, _: Answers, buckets: int) -> Iterator[tuple[int, bytes]]:
        sets = Sets(chunk, shingle)
        _, _, sig, different, high = _distinct(Signatures(sets, bands(num, den, 40)), sets, bits)
        for bucket, where in dealt(sig, buckets):
            yield bucket, frame(deltas(sig[where] >> np.uint64(64 - bits)), high[where], different[where])
        docs, keys = sets.distinct()
        for bucket, where in dealt(keys, buckets):
            yield buckets + bucket, frame(keys[where], sets.low[docs[where]], np.array([chunk.number]), np.zeros(0, np.uint8))

    return ask


def answer_signatures(bucket: int, bodies: list[bytes]) -> list[bytes]:
    """For each signature, how many different sets share it: 0 for one, else about the logarithm.  For each set, whether
    this chunk is the first that has it, and so speaks for it."""
    parts = [unframe(b) for b in bodies]
    if len(parts[0]) == 4:
        sizes = [len(p[0]) for p in parts]
        keys, low, chunks = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.repeat(np.concatenate([p[2] for p in parts]), sizes)
        order = np.lexsort((chunks, low, keys))
        first = np.zeros(len(keys), np.uint8)
        first[order] = starts_of(keys[order], low[order])
        ends = np.cumsum(sizes)
        return [frame(first[e - n : e]) for e, n in zip(ends, sizes, strict=True)]
    sig, high, n = np.concatenate([undeltas(p[0]) for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]).astype(np.int64)
    order = np.lexsort((high, sig))
    first = starts_of(sig[order])
    begins = np.flatnonzero(first)
    sets = np.add.reduceat(starts_of(sig[order], high[order]).astype(np.int64) + n[order] - 1, begins)
    level = np.where(sets < 2, 0, 1 + np.floor(4 * np.log2(np.maximum(sets, 1)))).astype(np.uint8)
    out = np.zeros(len(sig), np.uint8)
    out[order] = level[np.cumsum(first) - 1]
    ends = np.cumsum([len(p[0]) for p in parts])
    return [frame(out[e - len(p[0]) : e]) for e, p in zip(ends, parts, strict=True)]


def allocate(need: int, equal: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Thresholds of least cost whose t + 1 add up to need.  equal: cost of t = 0; near: of t = 1 (infinite where it is not offered).

    Each unit is bought at its least price: the first of a segment at its cost for 0, the second at the rest; a
    segment whose second unit is cheaper than its first has both for the mean."""
    second = near - equal
    both = second < equal
    first_price = np.where(both, near / 2, equal)
    second_price = np.where(both, near / 2, second)
    prices = np.concatenate([first_price, second_price])
    unit = np.concatenate([np.zeros(len(equal)), np.ones(len(equal))])
    order = np.lexsort((unit, prices))[:need]
    t = np.full(len(equal), -1)
    np.add.at(t, order % len(equal), 1)
    return t


def choose(s: Signatures, sets: Sets, b: Bands, level: np.ndarray) -> np.ndarray:
    """The threshold of every row of the band of its own, -1 elsewhere."""
    price = np.where(level == 0, 0.0, 2.0 ** ((level - 1.0) / 4))
    full, _, probe_full, probe_gone = (price[p] for p in s.parts)
    near = np.full(len(s.full), np.inf)
    near[s.wide_rows] = full[s.wide_rows] + probe_full
    np.add.at(near, s.del_row, probe_gone)
    t = np.full(len(s.full), -1)
    shared = (full > 0) | (np.isfinite(near) & (near > 0))
    own = np.flatnonzero(s.step == 0)
    if not len(own):
        return t
    begins = np.flatnonzero(starts_of(s.doc[own]))
    for begin, end in zip(begins, [*begins[1:], len(own)], strict=True):
        rows = own[begin:end]
        if not shared[rows].any():
            continue
        need = int(b.difference(2 * sets.sizes[s.doc[rows[0]]])) + 1
        t[rows] = allocate(need, full[rows], near[rows])
    return t


class Shared:
    """What a chunk knows after round 0: its signatures that other sets share, of the sets that it speaks for, and
    which of them probe or are in the index."""

    def __init__(self, chunk: Chunk, answers: Answers, shingle: int, b: Bands, bits: int, buckets: int):
        self.sets = sets = Sets(chunk, shingle)
        s = Signatures(sets, b)
        order, first, sig, _, _ = _distinct(s, sets, bits)
        levels = np.zeros(len(sig), np.uint8)
        for bucket, where in dealt(sig, buckets):
            levels[where] = unframe(answers[0, bucket])[0]
        level = np.zeros(len(s.sig), np.uint8)
        level[order] = levels[np.cumsum(first) - 1] if len(sig) else 0
        docs, keys = sets.distinct()
        speaks = np.zeros(len(sets.sizes), bool)
        for bucket, where in dealt(keys, buckets):
            speaks[docs[where]] = unframe(answers[0, buckets + bucket])[0].astype(bool)
        t = choose(s, sets, b, level)
        full, gone, probe_full, probe_gone = s.parts
        probe = np.zeros(len(s.sig), bool)
        probe[full] = t >= 0
        probe[probe_full] = t[s.wide_rows] == 1
        probe[probe_gone] = t[s.del_row] == 1
        index = np.zeros(len(s.sig), bool)
        index[full] = index[gone] = True
        out = np.flatnonzero((level > 0) & (probe | index) & speaks[s.owner])
        out = out[np.argsort(s.sig[out], kind="stable")]
        self.sig, self.owner, self.probe, self.index = s.sig[out], s.owner[out], probe[out], index[out]
        self.first = starts_of(self.sig) if len(out) else np.zeros(0, bool)
        self.begins = np.flatnonzero(self.first)


def ask_live(shingle: int, num: int, den: int, bits: int):
    def ask(chunk: Chunk, answers: Answers, buckets: int) -> Iterator[tuple[int, bytes]]:
        own = Shared(chunk, answers, shingle, bands(num, den, 40), bits, buckets)
        if not len(own.begins):
            return
        flags = np.logical_or.reduceat(own.probe, own.begins).astype(np.uint8)
        high = own.sets.high[own.owner]
        flags |= 2 * (np.minimum.reduceat(high, own.begins) != np.maximum.reduceat(high, own.begins)).astype(np.uint8)
        for bucket, where in dealt(own.sig[own.begins], buckets):
            yield bucket, frame(own.sig[own.begins][where], flags[where])

    return ask


def answer_live(_: int, bodies: list[bytes]) -> list[bytes]:
    """A bit for each signature: a set probes it, and another set has it.  Every set is told of by one chunk alone."""
    parts = [unframe(b) for b in bodies]
    sig, flags = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(sig)
    first = starts_of(sig[order])
    begins = np.flatnonzero(first)
    any_flag = np.bitwise_or.reduceat(flags[order], begins)
    live = (any_flag & 1 > 0) & ((any_flag & 2 > 0) | (np.diff(np.append(begins, len(sig))) > 1))
    out = np.zeros(len(sig), bool)
    out[order] = live[np.cumsum(first) - 1]
    ends = np.cumsum([len(p[0]) for p in parts])
    return [np.packbits(out[e - len(p[0]) : e]).tobytes() for e, p in zip(ends, parts, strict=True)]


_ROLES = ["kind", "row", "doc_id", "set_key", "n", "sig", "probe", "index", "shingles"]


def near_sets(exchange: Exchange, shingle: int, num: int, den: int, bits: int) -> DataFrame:
    """Three kinds of rows.  doc: a document and its set.  sig: a signature by which the set may meet another, and
    whether it probes or is in the index.  set: a set that has such, once, with its shingles."""
    buckets = exchange.buckets

    def batch(kind: str, size: int, **columns: pa.Array) -> pa.RecordBatch:
        nothing = {"row": pa.int64(), "doc_id": pa.int64(), "set_key": pa.binary(), "n": pa.int64(), "sig": pa.int64(), "probe": pa.bool_(), "index": pa.bool_(), "shingles": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([kind] * size, pa.string()), *(columns.get(c, pa.nulls(size, t)) for c, t in nothing.items())], names=_ROLES)

    def make(chunk: Chunk, answers: Answers) -> Iterator[pa.RecordBatch]:
        own = Shared(chunk, answers, shingle, bands(num, den, 40), bits, buckets)
        sets = own.sets
        keys = [sets.key(i) for i in range(len(chunk.doc_ids))]
        rows = {"row": pa.array(chunk.rows)} if len(chunk.rows) else {}
        yield batch("doc", len(keys), **rows, doc_id=chunk.ids, set_key=pa.array(keys, pa.binary()), n=pa.array(sets.sizes))
        if not len(own.begins):
            return
        live = bits_back(answers, 1, dealt(own.sig[own.begins], buckets), len(own.begins))[np.cumsum(own.first) - 1]
        sig, owner, probe, index = own.sig[live], own.owner[live], own.probe[live], own.index[live]
        if not len(sig):
            return
        yield batch("sig", len(sig), set_key=pa.array([keys[i] for i in owner], pa.binary()), n=pa.array(sets.sizes[owner]), sig=pa.array(sig.view(np.int64)), probe=pa.array(probe), index=pa.array(index))
        held = np.unique(owner)
        yield batch("set", len(held), set_key=pa.array([keys[i] for i in held], pa.binary()), n=pa.array(sets.sizes[held]), shingles=pa.array([sets.shingles(i).tobytes() for i in held], pa.binary()))

    schema = "kind string, row long, doc_id long, set_key binary, n long, sig long, probe boolean, index boolean, shingles binary"
    return exchange.result(make, schema, _ROLES)


def beside(pairs: DataFrame, key: str, other: str, table: DataFrame, prefix: str) -> DataFrame:
    """pairs with the columns of table whose set_key is pairs' key, each named with the prefix.  A key may be in very
    many pairs: these are dealt by the key and a share of the other column, and the row of table goes to each share."""
    salted = pairs.withColumn("share", F.pmod(F.xxhash64(other), F.lit(64)))
    rows = table.select(F.col("set_key").alias(key), *(F.col(c).alias(prefix + c) for c in table.columns if c != "set_key"))
    copies = salted.select(key, "share").distinct().join(rows, key)
    return salted.join(copies, [key, "share"]).drop("share")


def differences(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """members (set_key, group, pivot, size) with n, whether the set links with its pivot, pivot_n, and how it differs
    from it: the shingles of one of both, those of the pivot in a domain of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            link, delta, n, m = [], [], [], []
            for x, y in zip(batch.column("shingles"), batch.column("pivot_shingles"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                more, less = np.setdiff1d(x, y, assume_unique=True), np.setdiff1d(y, x, assume_unique=True)
                common = len(x) - len(more)
                link.append(den * common >= num * (len(y) + len(more)))
                delta.append(np.concatenate([more, mix(less ^ _C)]).view(np.int64))
                n.append(len(x))
                m.append(len(y))
            ends = np.cumsum([0, *map(len, delta)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*delta, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([batch.column("set_key"), batch.column("group"), batch.column("size"), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(link, pa.bool_()), lists], names=["set_key", "group", "size", "n", "pivot_n", "link", "delta"])

    # A pivot may have very many members: its shingles go to one share for each SHARE of them.
    salted = members.withColumn("share", F.pmod(F.xxhash64("set_key"), F.ceil(F.col("size") / SHARE)))
    shingles = sets.select("set_key", "shingles")
    pivots = salted.select("pivot", "share").distinct().join(shingles.select(F.col("set_key").alias("pivot"), F.col("shingles").alias("pivot_shingles")), "pivot")
    both = salted.filter("set_key != pivot").join(shingles, "set_key").join(pivots, ["pivot", "share"]).select("set_key", "group", "size", "shingles", "pivot_shingles")
    return both.mapInArrow(lean(run), "set_key binary, group binary, size long, n long, pivot_n long, link boolean, delta array<long>")


def linked(pairs: DataFrame, deltas: DataFrame, num: int, den: int) -> DataFrame:
    """Those of pairs (a, b), of one group each, that link: by exact count of what is in one of both differences only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            link = []
            for x, y, n in zip(batch.column("a_delta"), batch.column("b_delta"), batch.column("both").to_pylist(), strict=True):
                away = len(np.setxor1d(x.values.to_numpy(), y.values.to_numpy(), assume_unique=True))
                link.append(den * (n - away) >= num * (n + away))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(link, pa.bool_()))

    own = deltas.select("set_key", "n", "delta")
    rows = beside(beside(pairs.select("a", "b"), "b", "a", own, "b_"), "a", "b", own, "a_")
    return rows.select("a", "b", "a_delta", "b_delta", (F.col("a_n") + F.col("b_n")).alias("both")).mapInArrow(lean(run), "a binary, b binary")


def components(edges: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """node, label (the smallest node of its component) for all nodes of edges (a, b), by contraction.

    Each round every node hooks onto its smallest neighbour, if smaller; pointers are halved until they end at
    roots; edges are drawn between roots.  At least half of the nodes that still have edges are hooked in each round."""
    edges = ws.table(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), f"{name}-edges")
    labels, k = None, 0
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("label"))
        hooks = ws.table(hooks, f"{name}-hooks{k}")
        j = 0
        while True:
            up = hooks.select(F.col("node").alias("label"), F.col("label").alias("upper"))
            jumped = ws.table(hooks.join(up, "label").select("node", F.col("upper").alias("label"), (F.col("upper") != F.col("label")).alias("moved")), f"{name}-jump{k}-{j}")
            moved = jumped.filter("moved").isEmpty()
            hooks, j = jumped.select("node", "label"), j + 1
            if moved:
                break
        if labels is None:
            labels = hooks
        else:
            over = hooks.select(F.col("node").alias("label"), F.col("label").alias("root"))
            labels = ws.table(labels.join(over, "label", "left").select("node", F.coalesce("root", "label").alias("label")), f"{name}-labels{k}")
        root_a, root_b = (hooks.select(F.col("node").alias(x), F.col("label").alias(f"root_{x}")) for x in ("a", "b"))
        drawn = edges.join(root_a, "a").join(root_b, "b").select(F.greatest("root_a", "root_b").alias("a"), F.least("root_a", "root_b").alias("b")).filter("a != b").distinct()
        k += 1
        edges = ws.table(drawn, f"{name}-edges{k}")
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def merged(labels: DataFrame, pairs: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """labels (set_key, label) after pairs (a, b) of sets that link."""
    of = lambda x: labels.select(F.col("set_key").alias(x), F.col("label").alias(f"label_{x}"))
    edges = pairs.join(of("a"), "a").join(of("b"), "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    roots = components(edges, ws, name).select(F.col("node").alias("label"), F.col("label").alias("upper"))
    return ws.table(labels.join(roots, "label", "left").select("set_key", F.coalesce("upper", "label").alias("label")), f"{name}-merged")


def grouped(rows: DataFrame, ws: Workspace) -> DataFrame:
    """set_key, group, pivot, size: sets that share signatures, directly or by way of others, are a group."""
    own = rows.filter("kind = 'sig'").select("sig", "set_key")
    sigs = own.groupBy("sig").agg(F.min("set_key").alias("least"), F.count(F.lit(1)).alias("many"))
    stars = ws.table(own.join(sigs, "sig").groupBy("set_key", "least").agg(F.sum("many").alias("weight")), "stars")
    groups = components(stars.select(F.col("set_key").alias("a"), F.col("least").alias("b")), ws, "groups")
    weights = stars.groupBy("set_key").agg(F.sum("weight").alias("weight"))
    members = weights.join(groups.select(F.col("node").alias("set_key"), F.col("label").alias("group")), "set_key")
    best = members.groupBy("group").agg(F.max(F.struct("weight", "set_key")).alias("best"), F.count(F.lit(1)).alias("size"))
    return ws.table(members.select("set_key", "group").join(best.select("group", F.col("best.set_key").alias("pivot"), "size"), "group"), "grouped")


def hard_rows(found: DataFrame, num: int, den: int) -> DataFrame:
    """The elements of differences by which sets of a group may yet meet: group, element, set_key, n, d (size of the
    difference), place (from the rarest on), link, least (the smallest difference of a set that does not link with the
    pivot), width (of a class of sizes).

    Sets that link differ by D at most in the size of their difference.  So a group falls into windows of two bands of
    such sizes each, and an element is as rare as it is within a window: sets that share little with the pivot, and
    have all of it in their difference, are in windows of their own."""
    bound = lambda both: F.floor(both * F.lit(den - num) / F.lit(den + num)).cast("long")
    most = bound(F.col("n") + F.floor(F.col("n") * den / num))
    sized = found.filter("size > 2").withColumn("d", F.size("delta").cast("long")).withColumn("most", most)
    of_group = sized.groupBy("group").agg(F.min(F.when(~F.col("link"), F.col("d"))).alias("least"), F.greatest(F.lit(1), F.max("most")).alias("reach"), F.greatest(F.lit(1), F.floor(bound(2 * F.max("pivot_n")) / CLASSES)).cast("long").alias("width"))
    band = F.floor(F.col("d") / F.col("reach")).cast("int")
    window = F.explode(F.when(band > 0, F.array(band, band - 1)).otherwise(F.array(band)))
    some = sized.join(of_group.filter("least IS NOT NULL"), "group").withColumn("window", window)
    some = some.withColumn("group", F.struct("group", "window")).select("group", "set_key", "n", "d", "link", "least", "width", "most", "delta")
    elements = some.select("group", "set_key", F.explode("delta").alias("element"))
    shared = elements.groupBy("group", "element").agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    # The difference is as large as its document at most.
    own = elements.join(shared, ["group", "element"]).groupBy("group", "set_key").agg(F.sort_array(F.collect_list(F.struct("many", "element"))).alias("own"))
    out = some.drop("delta").join(own, ["group", "set_key"])
    alone = F.col("d") - F.size("own")
    out = out.filter(alone <= F.col("most")).select("*", alone.alias("alone"), F.posexplode("own").alias("at", "entry"))
    place = F.col("at") + F.col("alone")
    return out.filter(place <= F.col("most")).select("group", F.col("entry.element").alias("element"), "set_key", "n", "d", place.alias("place"), "link", "least", "width", "most")


def meetings(hard: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Who probes and who is in the index, by group, element and class of size: the smaller difference probes for the
    classes of larger ones with which it can have enough in common.  Only where labels differ."""
    now = hard.join(labels, "set_key")
    of_class = lambda d: F.floor(d / F.col("width")).cast("long")
    low = F.when(F.col("link"), F.greatest("d", "least")).otherwise(F.col("d"))
    high = F.col("d") + F.col("most") - 2 * F.col("place")
    probes = now.withColumn("low", low).withColumn("high", high).filter("low <= high")
    probes = probes.select("group", "element", F.explode(F.sequence(of_class(F.col("low")), of_class(F.col("high")))).alias("class"), "set_key", "n", "d", "place", "link", "label")
    index = now.filter("NOT link OR d >= least").select("group", "element", of_class(F.col("d")).alias("class"), "set_key", "n", "d", "place", "link", "label")
    # Of one place, what has two labels.
    key = ["group", "element", "class"]
    of_index = index.groupBy(*key).agg(F.min("label").alias("x"), F.max("label").alias("y"))
    of_probes = probes.groupBy(*key).agg(F.min("label").alias("u"), F.max("label").alias("v"))
    places = of_index.join(of_probes, key).filter("NOT (x = y AND u = v AND x = u)").select(*key)
    return probes.join(places, key, "left_semi"), index.join(places, key, "left_semi")


def met(probes: DataFrame, index: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) that meet at an element early enough in both, with the number of such."""
    key = ["group", "element", "class"]
    other = index.select(*key, *(F.col(c).alias(f"other_{c}") for c in ("set_key", "n", "d", "place", "link", "label")))
    bound = F.floor((F.col("n") + F.col("other_n")) * (den - num) / (den + num))
    common = F.greatest(F.lit(1), F.ceil((F.col("d") + F.col("other_d") - bound) / 2))
    fits = F.lit(den) * F.least("n", "other_n") >= F.lit(num) * F.greatest("n", "other_n")
    ok = (F.col("label") != F.col("other_label")) & (F.col("d") <= F.col("other_d")) & ~(F.col("link") & F.col("other_link")) & fits & (F.col("place") <= F.col("d") - common) & (F.col("other_place") <= F.col("other_d") - common)
    rows = probes.join(other, key).filter(ok)
    return rows.groupBy(F.least("set_key", "other_set_key").alias("a"), F.greatest("set_key", "other_set_key").alias("b")).agg(F.count(F.lit(1)).alias("shared"))


def join_components(rows: DataFrame, ws: Workspace, num: int, den: int) -> DataFrame:
    """set_key, label over the sets that may link with others.  rows: of near_sets()."""
    sets = rows.filter("kind = 'set'")
    members = grouped(rows, ws)
    found = ws.table(differences(members, sets, num, den), "differences")
    of_pivots = members.select(F.col("pivot").alias("set_key"), F.col("pivot").alias("label")).distinct()
    labels = found.join(members.select("set_key", "pivot"), "set_key").select("set_key", F.when(F.col("link"), F.col("pivot")).otherwise(F.col("set_key")).alias("label"))
    labels = ws.table(labels.unionByName(of_pivots), "labels")
    hard = ws.table(hard_rows(found, num, den), "hard")
    if hard.isEmpty():
        return labels
    for name in ("best", "all"):
        probes, index = meetings(hard, labels)
        if name == "best":  # each with the least at every place, and the best of these
            index = index.groupBy("group", "element", "class").agg(F.min(F.struct("set_key", "n", "d", "place", "link", "label")).alias("p")).select("group", "element", "class", "p.*")
        pairs = met(probes, index, num, den)
        if name == "best":
            pairs = pairs.groupBy("b").agg(F.max(F.struct("shared", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
        both = ws.table(linked(pairs, found, num, den), f"linked-{name}")
        labels = merged(labels, both, ws, f"merge-{name}")
    return labels


def linked_documents(docs: DataFrame, ws: Workspace, shingle: int, numerator: int, denominator: int, row: str | None = None, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame]:
    """The documents: row (if docs has a column of that name), doc_id, set_key, n, run; and for each set that may link, its label."""
    exchange = Exchange(docs, ws, chunk_bytes, bucket_bytes, row)
    bits = min(56, hash_bits(exchange.n_bytes // 8) + 8)
    exchange.round(ask_signatures(shingle, numerator, denominator, bits), answer_signatures)
    exchange.round(ask_live(shingle, numerator, denominator, bits), answer_live)
    rows = ws.table(near_sets(exchange, shingle, numerator, denominator, bits), "near")
    exchange.close()
    labels = join_components(rows, ws, numerator, denominator)
    own = F.xxhash64("doc_id" if row is None else "row")
    return rows.filter("kind = 'doc'").select("row", "doc_id", "set_key", "n", F.pmod(own, F.lit(RUNS)).cast("int").alias("run")), labels


def jaccard_join(docs: DataFrame, ws: Workspace, shingle: int = SHINGLE, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id."""
    members, labels = linked_documents(docs, ws, shingle, numerator, denominator, None, chunk_bytes, bucket_bytes)
    # Down to the documents by (set, run), so that a set which a third of all documents have is spread.
    runs = members.filter("n > 0").groupBy("set_key", "run").agg(F.min("doc_id").alias("least"))
    by_set = runs.groupBy("set_key").agg(F.min("least").alias("least")).join(labels, "set_key", "left").withColumn("label", F.coalesce("label", "set_key"))
    by_set = ws.table(by_set, "by_set")
    least = by_set.groupBy("label").agg(F.min("least").alias("component_id"))
    of_set = by_set.join(least, "label").select("set_key", "component_id")
    of_run = runs.select("set_key", "run").join(of_set, "set_key")
    return members.join(of_run, ["set_key", "run"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir), Workspace(spark, "op7"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component, with all its columns: that of smallest doc_id (rows without one come last; of
    equal ones, the first).  Rows without words are each a component of their own."""
    ws, row = Workspace(spark, "near"), one_fits(docs.columns, "_row")
    rows = numbered(docs, ws, row)
    members, labels = linked_documents(rows, ws, SHINGLE, NUMERATOR, DENOMINATOR, row)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    sets = members.filter("n > 0").groupBy("set_key", "run").agg(first).groupBy("set_key").agg(F.min("first").alias("first"))
    kept = sets.join(labels, "set_key", "left").groupBy(F.coalesce("label", "set_key")).agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    kept = kept.unionByName(members.filter("n = 0").select(F.col("row").alias(row)))
    return rows.join(kept, row, "left_semi").select(*docs.columns)


#: The contract in SQL: all pairs that share a shingle, and what is reachable by links.
OP7_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[s:s + 3], ' ') AS k FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS s FROM d WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles AS a JOIN shingles AS b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (SELECT a AS doc_id, b AS other FROM ways UNION SELECT reached.doc_id, ways.b FROM reached JOIN ways ON reached.other = ways.a),
first AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(first.other, doc_id)) AS component_id FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN first USING (doc_id)
"""
