"""Token ids as flat binary files.

A shard is two files: NAME.bin, unsigned little-endian ids without any framing (16 bits where the vocabulary allows,
else 32), and NAME.idx, of little-endian 64-bit numbers: a magic number, the bytes of an id, the number of documents,
how many of them (the last) have no identifier, their identifiers, and one more offset into the .bin file than
documents.  Shards hold ascending doc_id: documents are range partitioned and sorted, encoded and written where they lie; a
prefix sum over the shards' counts, a few numbers for each shard, gives each its base.  Files are written under a
name of their own and renamed, so that a task that runs again replaces whole files by equal ones.

Texts are encoded as the library does by default: the string of a special token in a text is that token's id.  With
plain=True it is ordinary text, so that no document can forge one.

A null text counts as empty, and is the end id alone.  A null doc_id comes last.  Rows that share a doc_id stay
beside each other, ordered by text; range partitioning keeps one doc_id in one shard.  Texts of any length are encoded
whole.  An empty table gives no shards.  Only doc_id and text are read, whatever other columns there are.  Shards grow
in number with the input, SHARD_BYTES of text to each, so that a reader without a memory map holds a bounded one.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import NO_ID, Workspace, documents, lean, slices, sole, texts
from ._pieces import PartCache

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Bytes of text in a shard.
SHARD_BYTES = 128 << 20
MAGIC = 0x3153444958444D46


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _local(folder: str) -> str | None:
    """The path of a folder that the machine's own calls reach."""
    if folder.startswith("file:"):
        return "/" + folder[5:].lstrip("/")
    return None if "://" in folder else folder


class Folder:
    """A folder of shards, local or on a shared file system that pyarrow reaches."""

    def __init__(self, folder: str):
        self.local = _local(folder)
        self.fs, self.path = (pafs.LocalFileSystem(), self.local) if self.local else pafs.FileSystem.from_uri(folder)

    def make(self) -> None:
        self.fs.create_dir(self.path, recursive=True)

    def create(self, name: str):
        return self.fs.open_output_stream(f"{self.path}/{name}")

    def rename(self, a: str, b: str) -> None:
        self.fs.move(f"{self.path}/{a}", f"{self.path}/{b}")

    def mapped(self, name: str, dtype: str) -> np.ndarray:
        """The file as an array: memory-mapped where it is local."""
        if self.local:
            path = f"{self.local}/{name}"
            return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
        with self.fs.open_input_file(f"{self.path}/{name}") as f:
            return np.frombuffer(f.read(), dtype)


_WORD = re.compile("(?:(\\n)(?! ))?( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)")


def _shown() -> dict[int, int]:
    """The characters that byte-level models write bytes as: printable ones of Latin-1 as themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + k for k, b in enumerate(rest)}


_SHOWN = _shown()


def _word_is_piece(tokenizer) -> bool:
    """Whether this is a byte-level tokenizer by the usual pattern, with nothing before it."""
    said = json.loads(tokenizer.to_str())
    kind = said.get("pre_tokenizer") or {}
    return said.get("normalizer") is None and said["model"]["type"] == "BPE" and kind.get("type") == "ByteLevel" and bool(kind.get("use_regex", True)) and not kind.get("add_prefix_space")


def _cache(path: str, plain: bool = False) -> tuple[PartCache, int]:
    """The tokenizer behind a cache of parts, and the size of its vocabulary."""
    os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = "1", "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain
    added = tuple(x.content for x in tokenizer.get_added_tokens_decoder().values() if not (plain and x.special))

    # A word of Latin letters, with or without a blank before it, is one piece to the pattern of such tokenizers: the
    # library's model encodes it without the steps around it.  A line end before it is a piece of its own.
    # Texts with the string of an added token, and all texts of other tokenizers, go whole through the library.
    model, line_end = tokenizer.model, tokenizer.encode("\n", add_special_tokens=False).ids
    usual, blank = _word_is_piece(tokenizer), chr(_SHOWN[32])

    def encode(parts: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        others = []
        for s in parts:
            if usual and s[:1] == " " and s.isascii() and s[1:].isalpha():
                out.append([x.id for x in model.tokenize(blank + s[1:])])
            elif usual and (m := _WORD.fullmatch(s)):
                ids = [x.id for x in model.tokenize(m[2].encode().decode("latin-1").translate(_SHOWN))]
                out.append(line_end + ids if m[1] else ids)
            else:
                others.append((len(out), s))
                out.append([])
        for k in range(0, len(others), 2000):
            some = others[k : k + 2000]
            for (i, _), x in zip(some, tokenizer.encode_batch_fast([s for _, s in some], add_special_tokens=False), strict=True):
                out[i] = x.ids
        return out

    return PartCache(encode, parts=usual, whole=added), tokenizer.get_vocab_size()


def write_shards(docs: DataFrame, folder: str, shards: int, tokenizer: str | None = None, end_id: int = END_ID, plain: bool = False) -> DataFrame:
    """Writes the shards when it runs; one row for each: shard, n_docs, n_ids."""
    tokenizer = tokenizer or default_tokenizer()
    Folder(folder).make()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, vocabulary = sole(("tokens", tokenizer, plain), lambda: _cache(tokenizer, plain))
        width = 2 if max(vocabulary - 1, end_id) < 1 << 16 else 4
        context, out = TaskContext.get(), Folder(folder)
        shard = context.partitionId()
        name, own = f"shard-{shard:06d}", f".{shard:06d}-{context.taskAttemptId()}"
        doc_ids, lengths, without = [], [], 0
        with out.create(f"{own}.bin") as f:
            for batch in slices(batches, "text"):
                ids, n = cache.encoded(texts(batch.column("text")))
                with_end = np.full(len(ids) + len(n), end_id, f"<u{width}")
                with_end[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
                f.write(with_end.tobytes())
                without += batch.column("doc_id").null_count
                doc_ids.append(batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False))
                lengths.append(n + 1)
        if not doc_ids:
            return
        doc_ids, lengths = np.concatenate(doc_ids), np.concatenate(lengths)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        with out.create(f"{own}.idx") as f:
            f.write(np.concatenate([[MAGIC, width, len(doc_ids), without], doc_ids, offsets]).astype("<i8").tobytes())
        out.rename(f"{own}.bin", f"{name}.bin")
        out.rename(f"{own}.idx", f"{name}.idx")
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(doc_ids)], pa.int64()), pa.array([int(offsets[-1])], pa.int64())], names=["shard", "n_docs", "n_ids"])

    order = F.col("doc_id").asc_nulls_last()
    sorted_docs = docs.select("doc_id", "text").repartitionByRange(shards, order).sortWithinPartitions(order, "text")
    return sorted_docs.mapInArrow(lean(run), "shard int, n_docs long, n_ids long")


def bases(counts: DataFrame, group: int = 4096) -> DataFrame:
    """counts with base: the ids of all shards before each.  Prefix sums in two levels, so that no window takes all."""
    from pyspark.sql import Window

    blocks = counts.withColumn("block", F.floor(F.col("shard") / group))
    sums = blocks.groupBy("block").agg(F.sum("n_ids").alias("block_ids"))
    before = sums.select("block", (F.sum("block_ids").over(Window.partitionBy(F.lit(0)).orderBy("block")) - F.col("block_ids")).alias("block_base"))
    inner = blocks.withColumn("inner", F.sum("n_ids").over(Window.partitionBy("block").orderBy("shard")) - F.col("n_ids"))
    return inner.join(before, "block").select("shard", "n_docs", "n_ids", (F.col("inner") + F.col("block_base")).alias("base"))


def read_shards(counts: DataFrame, folder: str, partitions: int) -> DataFrame:
    """One row for each document, from the files: doc_id, start, n_tokens, ids_crc32.  counts: as bases() returns it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = Folder(folder)
        for batch in batches:
            for shard, base in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist(), strict=True):
                index = source.mapped(f"shard-{shard:06d}.idx", "<i8")
                magic, width, n, without = (int(x) for x in index[:4])
                if magic != MAGIC:
                    raise ValueError(f"shard {shard} is no index of this format")
                ids = source.mapped(f"shard-{shard:06d}.bin", f"<u{width}")
                doc_ids, offsets = index[4 : 4 + n], index[4 + n : 5 + 2 * n]
                for begin in range(0, n, 4096):
                    end = min(n, begin + 4096)
                    low = int(offsets[begin])
                    crcs = [zlib.crc32(ids[offsets[k] : offsets[k + 1]].astype("<u4")) for k in range(begin, end)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.asarray(doc_ids[begin:end]), pa.int64(), mask=np.arange(begin, end) >= n - without), pa.array(base + low + (np.asarray(offsets[begin:end]) - low)), pa.array(np.diff(offsets[begin : end + 1])), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return counts.select("shard", "base").repartition(partitions, "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws, docs = Workspace(spark, "op9"), documents(spark, sf_dir)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // SHARD_BYTES)
    folder = f"{ws.root}/tokens"
    counts = ws.table(write_shards(docs, folder, shards), "counts")
    return read_shards(bases(counts), folder, shards)
