"""Byte-level BPE encoding and decoding with length-bucketed padded numpy matrices.

Distinct pieces of a batch are sorted into buckets by length; a bucket is a padded matrix of ids with a row for each
piece.  In each round every row looks its neighbouring pairs up in a hash table, merges the leftmost pair of minimum
rank, and closes the gap; rows without a pair that merges leave the matrix.  A piece that is in the vocabulary as a
whole is that token, as the ranks' library has it.

A piece of more than LONG bytes would need as many rounds as it has merges, each over its whole row.  Its pairs wait
in a heap instead, ordered by rank and place, and its ids are a linked list: the same merges in the same order.

A null text counts as empty; empty texts have no ids.  Texts of any length are encoded whole.  Rows are encoded each
by itself, so that repeated rows, and rows that share a doc_id or have none, all come back; an empty table gives none.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ._common import documents, gathered, lean, one_fits, slices, sole, texts
from ._pieces import SPLITS, PartCache

RANKS = "byte_bpe_multi_50k.tiktoken"
#: White space as the pattern means it; the regex module's own class has more.
_SPACE = "\t-\r \x85\xa0  -     　"
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_NONE = np.uint32(0xFFFFFFFF)
#: Cells of the largest matrix worked on at once.
CELLS = 1 << 20
#: Bytes of the longest piece that is a row of a matrix.
LONG = 512


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class PairTable:
    """Open addressing: the key is left id * 2^32 + right id, the value the rank of the merged token."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(8, int(len(keys)).bit_length() + 2)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, _EMPTY), np.full(1 << bits, _NONE)
        at, left = self._home(keys), np.arange(len(keys))
        self.steps = 0
        while len(left):
            self.steps += 1
            free = self.keys[at[left]] == _EMPTY
            slots, who = np.unique(at[left[free]], return_index=True)  # one of those that want the same slot gets it
            taken = left[free][who]
            self.keys[slots], self.values[slots] = keys[taken], values[taken]
            left = np.setdiff1d(left, taken, assume_unique=True)
            at[left] = (at[left] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The ranks, _NONE where a pair does not merge."""
        at = self._home(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], _NONE)
        left = np.flatnonzero((seen != keys) & (seen != _EMPTY))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            seen = self.keys[at[left]]
            hit = seen == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (seen != _EMPTY)]
        return out


class MatrixBpe:
    def __init__(self, ranks_path: str, pattern: str):
        import regex

        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{_SPACE}\p{{L}}\p{{N}}]").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]"))
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.table = PairTable(np.fromiter(pairs.keys(), np.uint64, len(pairs)), np.fromiter(pairs.values(), np.uint32, len(pairs)))
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.uint32)
        most = max(self.ranks.values()) + 1
        by_rank = [b""] * most
        for token, rank in self.ranks.items():
            by_rank[rank] = token
        self.token_bytes = np.frombuffer(b"".join(by_rank), np.uint8)
        self.token_lengths = np.fromiter(map(len, by_rank), np.int64, most)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths

    def merge(self, matrix: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Each row's ids after all its merges."""
        done: list[np.ndarray | None] = [None] * len(lengths)
        rows = np.arange(len(lengths))
        ranks = self._ranked(matrix, lengths)
        while len(rows):
            at = ranks.argmin(axis=1)  # the first, so the leftmost
            best = ranks[np.arange(len(rows)), at]
            over = best == _NONE
            if over.any():
                for i in np.flatnonzero(over):
                    done[rows[i]] = matrix[i, : lengths[i]].copy()
                keep = ~over
                rows, matrix, lengths, ranks, at, best = rows[keep], matrix[keep], lengths[keep], ranks[keep], at[keep], best[keep]
                if not len(rows):
                    break
                width = int(lengths.max())
                matrix, ranks = matrix[:, :width], ranks[:, : max(1, width - 1)]
            n, width = matrix.shape
            each = np.arange(n)
            matrix[each, at] = best
            source = np.arange(width - 1)[None, :] + (np.arange(width - 1)[None, :] > at[:, None])
            matrix = np.take_along_axis(matrix, source, axis=1)  # closes the gap
            lengths = lengths - 1
            if width == 2:
                ranks = np.full((n, 1), _NONE)
                continue
            ranks = np.take_along_axis(ranks, source[:, : width - 2] if width > 2 else source, axis=1)
            for offset in (0, -1):  # only the pairs beside the merged one are new
                column = at + offset
                ok = (column >= 0) & (column + 1 < lengths)
                i, c = each[ok], column[ok]
                ranks[i, c] = self.table.find(matrix[i, c].astype(np.uint64) << np.uint64(32) | matrix[i, c + 1].astype(np.uint64))
                gone = (column >= 0) & (column + 1 >= lengths) & (column < ranks.shape[1])
                ranks[each[gone], column[gone]] = _NONE
        return done

    def _ranked(self, matrix: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        n, width = matrix.shape
        if width < 2:
            return np.full((n, 1), _NONE)
        found = self.table.find((matrix[:, :-1].astype(np.uint64) << np.uint64(32) | matrix[:, 1:].astype(np.uint64)).ravel()).reshape(n, width - 1)
        found[np.arange(1, width)[None, :] >= lengths[:, None]] = _NONE
        return found

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The ids of one piece after all its merges, by a heap of pairs."""
        n = len(piece)
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].astype(np.uint64)
        found = self.table.find(ids[:-1] << np.uint64(32) | ids[1:])
        some = np.flatnonzero(found != _NONE)
        shift, mask = n.bit_length(), (1 << n.bit_length()) - 1
        heap = ((found[some].astype(np.int64) << shift) | some).tolist()
        heapq.heapify(heap)
        ranks = np.where(found == _NONE, -1, found.astype(np.int64)).tolist() + [-1]  # of the pair that begins here
        before, after, known = list(range(-1, n - 1)), list(range(1, n + 1)), self.ranks.get
        merged = ids.tolist()
        while heap:
            rank, at = divmod(heapq.heappop(heap), mask + 1)
            if ranks[at] != rank:
                continue  # one of the two is gone
            right = after[at]
            end = after[right]
            merged[at], merged[right], ranks[right], after[at] = rank, -1, -1, end
            if end < n:
                before[end] = at
            for a in (at, before[at]):
                if a >= 0:
                    b = after[a]
                    new = known(piece[a : after[b]]) if b < n else None
                    ranks[a] = -1 if new is None else new
                    if new is not None:
                        heapq.heappush(heap, new << shift | a)
        out = np.array(merged, np.int64)
        return out[out >= 0].astype(np.uint32)

    def pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        out: list = [None] * len(pieces)
        left = []
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = (whole,)
            elif len(piece) > LONG:
                out[i] = self.merge_long(piece)
            elif piece:
                left.append(i)
            else:
                out[i] = ()
        left.sort(key=lambda i: len(pieces[i]))
        begin = 0
        while begin < len(left):
            end, shortest = begin, len(pieces[left[begin]])
            while end < len(left) and (width := len(pieces[left[end]])) <= shortest + 3 + shortest // 8 and (end == begin or (end - begin + 1) * width <= CELLS):
                end += 1
            own = left[begin:end]
            lengths = np.fromiter((len(pieces[i]) for i in own), np.int64, len(own))
            matrix = np.zeros((len(own), int(lengths.max())), np.uint32)
            matrix[np.arange(matrix.shape[1])[None, :] < lengths[:, None]] = self.of_byte[np.frombuffer(b"".join(pieces[i] for i in own), np.uint8)]
            for i, ids in zip(own, self.merge(matrix, lengths), strict=True):
                out[i] = ids
            begin = end
        return out

    def encode(self, parts: list[str]) -> list[np.ndarray]:
        """The ids of each string."""
        distinct: dict[bytes, int] = {}
        own = [[distinct.setdefault(p.encode(), len(distinct)) for p in self.pattern.findall(s)] for s in parts]
        ids = self.pieces(list(distinct))
        return [ids[x[0]] if len(x) == 1 else [i for k in x for i in ids[k]] for x in own]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids."""
        return gathered(self.token_bytes, self.token_starts[ids], self.token_lengths[ids])


def _encoder(ranks_path: str, pattern: str) -> tuple[MatrixBpe, PartCache]:
    bpe = MatrixBpe(ranks_path, pattern)
    return bpe, PartCache(bpe.encode, parts=pattern in SPLITS)


def encode_decode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, ids_column: str | None = None) -> DataFrame:
    """docs with n_tokens, ids_sha256, decoded_sha256; and the ids themselves if ids_column names a column.

    The columns that docs has beside the text come first; a column of docs with one of those names is left out."""
    ranks_path, pattern = ranks_path or default_ranks(), pattern or default_pattern()
    kinds = {"n_tokens": ("long", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}
    if ids_column:
        kinds[ids_column] = ("array<int>", pa.list_(pa.int32()))
    own = [c for c in docs.columns if c != "text" and c not in kinds]
    text = one_fits(own, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = sole(("bpe", ranks_path, pattern), lambda: _encoder(ranks_path, pattern))
        for batch in slices(batches, text):
            ids, lengths = cache.encoded(texts(batch.column(text)))
            decoded = bpe.decode(ids)
            ends = np.cumsum(lengths)
            bytes_before = np.concatenate([[0], np.cumsum(bpe.token_lengths[ids])])
            raw, plain = memoryview(ids.astype("<u4").tobytes()), memoryview(decoded.tobytes())
            columns = {c: batch.column(c) for c in own} | {"n_tokens": pa.array(lengths), "ids_sha256": pa.array([hashlib.sha256(raw[4 * (e - n) : 4 * e]).hexdigest() for e, n in zip(ends, lengths, strict=True)], pa.string()), "decoded_sha256": pa.array([hashlib.sha256(plain[bytes_before[e - n] : bytes_before[e]]).hexdigest() for e, n in zip(ends, lengths, strict=True)], pa.string())}
            if ids_column:
                columns[ids_column] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([columns[c] for c in (*own, *kinds)], names=[*own, *kinds])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in own] + [f"`{c}` {k}" for c, (k, _) in kinds.items()])
    return docs.select(*own, docs["text"].alias(text)).mapInArrow(lean(run), schema)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(documents(spark, sf_dir).select("doc_id", "text"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: doc_id, n_tokens, the digests and the ids."""
    return encode_decode(docs.select("doc_id", "text"), ids_column="ids")
