"""Questions about all documents, asked by chunks of documents and answered by ranges of hashes.

Documents are packed once into chunks, rows of a table in the shared folder, so that a chunk is the same whoever reads
it.  In each round every chunk sends each bucket of hashes one packed body (sorted hashes, delta coded, equal ones
once), a task answers a bucket with a few bits for each entry in the order of the question, and the answers return to
the chunk, which puts its question again to know what the bits stand for.  No place is ever sent, a key that a third
of all rows share is one entry for each chunk, and a bucket is a fixed share of the hashes: buckets grow in number
with the input, not in size.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import NO_ID, Workspace, give_back, lean, slices, text_sizes, utf8

CHUNK_BYTES = 3 << 20
BUCKET_BYTES = 8 << 20


@lru_cache(maxsize=1)
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def frame(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as bytes: their byte planes, compressed, so that unused high bytes cost nothing."""
    out = [struct.pack("<i", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        raw = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
        body = _zstd()[0].compress(raw)
        out += [struct.pack("<3sqq", a.dtype.str[1:].encode(), len(a), len(body)), body]
    return b"".join(out)


def unframe(body: bytes) -> list[np.ndarray]:
    (n,), at, out = struct.unpack_from("<i", body), 4, []
    for _ in range(n):
        kind, length, size = struct.unpack_from("<3sqq", body, at)
        at += struct.calcsize("<3sqq")
        dtype = np.dtype("<" + kind.rstrip(b"\0").decode())
        raw = _zstd()[1].decompress(body[at : at + size], max_output_size=max(1, length * dtype.itemsize)) if length else b""
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, length).T).view(dtype).ravel() if length else np.zeros(0, dtype))
        at += size
    return out


def deltas(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def undeltas(a: np.ndarray) -> np.ndarray:
    return np.cumsum(a, dtype=a.dtype)


def starts_of(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where each group of equal keys begins, as a mask."""
    first = np.ones(len(sorted_keys[0]), bool)
    if len(first) > 1:
        first[1:] = False
        for k in sorted_keys:
            first[1:] |= k[1:] != k[:-1]
    return first


@dataclass
class Chunk:
    """Documents beside each other; doc_ids has NO_ID where there is none.  rows: the number of each, if it has one."""

    number: int
    doc_ids: np.ndarray
    starts: np.ndarray
    data: np.ndarray
    without: np.ndarray
    rows: np.ndarray

    @property
    def ids(self) -> pa.Array:
        return pa.array(self.doc_ids, mask=self.without)


_CHUNK = "chunk long, n_bytes long, n_docs long, doc_ids binary, body binary"


def pack(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, row: str | None = None) -> DataFrame:
    """docs as chunks of about so many bytes; a document is never divided.  row: the column that numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            data, starts = utf8(table.column("text"))
            ids = table.column("doc_id").combine_chunks()
            without = np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False))
            ids = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
            rows = table.column("row").to_numpy() if row else np.zeros(0, np.int64)
            columns = [pa.array([number]), pa.array([len(data)]), pa.array([len(ids)]), pa.array([frame(ids.astype(np.int64), deltas(starts), without, deltas(rows))], pa.binary()), pa.array([_zstd()[0].compress(data.tobytes())], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "n_bytes", "n_docs", "doc_ids", "body"])

        for part in slices(batches, "text", chunk_bytes):
            own = int(text_sizes(part.column("text")).sum())
            if held and size + own > chunk_bytes:
                yield packed()
                number, held, size = number + 1, [], 0
            held.append(part)
            size += own
        if held:
            yield packed()

    return docs.select("doc_id", "text", *([F.col(row).alias("row")] if row else [])).mapInArrow(lean(run), _CHUNK)


def _chunk(table: pa.Table | pa.RecordBatch, i: int) -> Chunk:
    ids, gaps, none, rows = unframe(table.column("doc_ids")[i].as_py())
    without = np.zeros(len(ids), bool)
    without[none] = True
    n = table.column("n_bytes")[i].as_py()
    data = np.frombuffer(_zstd()[1].decompress(table.column("body")[i].as_py(), max_output_size=max(1, n)), np.uint8) if n else np.zeros(0, np.uint8)
    return Chunk(table.column("chunk")[i].as_py(), ids, undeltas(gaps), data, without, undeltas(rows))


#: By round and bucket, what came back.
Answers = dict[tuple[int, int], bytes]
Ask = Callable[[Chunk, Answers, int], Iterator[tuple[int, bytes]]]
Answer = Callable[[int, list[bytes]], list[bytes]]


class Exchange:
    """Rounds of questions and answers over the chunks of a table of documents."""

    def __init__(self, docs: DataFrame, ws: Workspace, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES, row: str | None = None):
        self.ws = ws
        self.chunks = ws.table(pack(docs, chunk_bytes, row), "chunks", "none")
        self.n_bytes, self.n_docs = self.chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.coalesce(F.sum("n_docs"), F.lit(0))).first()
        self.buckets = max(1, math.ceil(self.n_bytes / bucket_bytes))
        self.answers: DataFrame | None = None
        self.rounds = 0

    def _over_chunks(self, make: Callable[[Chunk, Answers], Iterator[pa.RecordBatch]], schema: str, names: list[str]) -> DataFrame:
        """make() over each chunk with the answers that it has so far."""
        if self.answers is None:

            def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for i in range(batch.num_rows):
                        yield from make(_chunk(batch, i), {})

            return self.chunks.mapInArrow(lean(alone), schema)

        def both(left: pa.Table, right: pa.Table) -> pa.Table:
            found = {(r, b): body for r, b, body in zip(right.column("round").to_pylist(), right.column("bucket").to_pylist(), right.column("body").to_pylist(), strict=True)}
            batches = [x for i in range(left.num_rows) for x in make(_chunk(left, i), found)]
            give_back()
            return pa.Table.from_batches(batches) if batches else empty_table

        empty_table = pa.table({n: pa.array([], k) for n, k in zip(names, _kinds(schema), strict=True)})
        return self.chunks.groupBy("chunk").cogroup(self.answers.groupBy("chunk")).applyInArrow(both, schema)

    def round(self, ask: Ask, answer: Answer) -> None:
        number, buckets = self.rounds, self.buckets

        def questions(chunk: Chunk, answers: Answers) -> Iterator[pa.RecordBatch]:
            for bucket, body in ask(chunk, answers, buckets):
                yield pa.RecordBatch.from_arrays([pa.array([chunk.number]), pa.array([bucket], pa.int32()), pa.array([body], pa.binary())], names=["chunk", "bucket", "body"])

        def answered(table: pa.Table) -> pa.Table:
            bucket = table.column("bucket")[0].as_py()
            back = answer(bucket, table.column("body").to_pylist())
            give_back()
            return pa.table({"chunk": table.column("chunk"), "round": pa.array([number] * len(back), pa.int32()), "bucket": table.column("bucket"), "body": pa.array(back, pa.binary())})

        asked = self._over_chunks(questions, "chunk long, bucket int, body binary", ["chunk", "bucket", "body"])
        back = self.ws.table(asked.groupBy("bucket").applyInArrow(answered, "chunk long, round int, bucket int, body binary"), f"answers{number}")
        self.answers = back if self.answers is None else self.answers.unionByName(back)
        self.rounds += 1

    def close(self) -> None:
        """Drops the tables behind; a result must have been written before."""
        self.ws.drop("chunks")
        for k in range(self.rounds):
            self.ws.drop(f"answers{k}")

    def result(self, make: Callable[[Chunk, Answers], Iterator[pa.RecordBatch]], schema: str, names: list[str]) -> DataFrame:
        return self._over_chunks(make, schema, names)


def _kinds(schema: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    return [to_arrow_type(f.dataType) for f in StructType.fromDDL(schema).fields]


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the hashes, so that sorted hashes lie in ascending buckets."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def dealt(sorted_hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The buckets that sorted hashes lie in, and where."""
    if not len(sorted_hashes):
        return
    of = bucket_of(sorted_hashes, buckets)
    begins = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    for begin, end in zip(begins, [*begins[1:], len(of)], strict=True):
        yield int(of[begin]), slice(int(begin), int(end))


def hash_bits(n: int) -> int:
    """Bits of a hash with few false equals among n; those only cost time, as every caller looks again."""
    return min(64, max(40, math.ceil(math.log2(max(2, n))) + 11))


def small_ids(ids: np.ndarray) -> np.ndarray:
    """The narrower type that holds these identifiers."""
    return ids.astype(np.uint32) if len(ids) and 0 <= ids.min() and ids.max() < 1 << 32 else ids.astype(np.int64)


def bits_back(answers: Answers, number: int, buckets: Iterator[tuple[int, slice]], n: int) -> np.ndarray:
    """One bit for each of n entries, from the answers of a round."""
    out = np.zeros(n, bool)
    for bucket, where in buckets:
        out[where] = np.unpackbits(np.frombuffer(answers[number, bucket], np.uint8), count=where.stop - where.start).astype(bool)
    return out
