"""What the operators of this package share: shared storage, batches of documents, vectorised hashes."""

from __future__ import annotations

import atexit
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words: the class [\x20\x09-\x0D].
SPACES = r"[\x20\x09-\x0D]"
#: Rows without a doc_id come after all others, beside one of this value, which stays itself in results.
NO_ID = np.iinfo(np.int64).max

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it; one of our own only where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share: a folder of the driver's own would not be read by them")
    if app not in _own:
        holder = tempfile.TemporaryDirectory(prefix="flowloom-")
        atexit.register(holder.cleanup)
        _own[app] = holder.name
    return "file://" + _own[app]


def give_back_driver(spark: SparkSession) -> None:
    """Returns memory that the driver's JVM has freed outside its heap to the system, as give_back() does for workers.

    What its compiler and its many threads take and free for each plan stays in the C library's arenas, and adds up over
    the queries of a session.  A JVM without that command goes on as before."""
    if (sc := spark.sparkContext)._jvm is None:
        return
    try:
        java, new = sc._jvm.java.lang, sc._gateway.new_array
        # By the public interface: the class behind it is closed to reflection.
        kinds = new(java.Class, 4)
        kinds[0], kinds[1], kinds[2], kinds[3] = (java.Class.forName(k) for k in ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;"))
        given = new(java.Object, 4)
        given[0], given[1] = sc._jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        java.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(java.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JError:
        pass


class Workspace:
    """Tables written to the shared folder.  They cut lineage, and outlive any executor."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self._remove, self.root)

    def _remove(self, path: str) -> None:
        try:
            sc = self.spark.sparkContext
            if sc._jsc is None:
                return
            target = sc._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001  the session may be gone at exit
            pass

    def table(self, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
        """Writes df and reads it back.  Spark deletes the shuffle files behind it as soon as it is written, and the driver gives back what it took for the plan."""
        was = self.spark.conf.get(_CLEAN, "false")
        self.spark.conf.set(_CLEAN, "true")
        try:
            df.write.option("compression", compression).parquet(f"{self.root}/{name}")
        finally:
            self.spark.conf.set(_CLEAN, was)
            give_back_driver(self.spark)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        self._remove(f"{self.root}/{name}")


_held: list[tuple[Hashable, Any]] = []


def sole(key: Hashable, make: Callable[[], Any]) -> Any:
    """make()'s value, kept by this worker until another key is asked for: a reused worker holds one model at a time."""
    if not _held or _held[0][0] != key:
        _held.clear()
        _held.append((key, make()))
    return _held[0][1]


@functools.lru_cache(maxsize=1)
def _libc() -> ctypes.CDLL | None:
    try:
        libc = ctypes.CDLL(None)
        libc.malloc_trim  # noqa: B018  not every C library has it
        return libc
    except (OSError, AttributeError):
        return None


def give_back() -> None:
    """Returns memory that is free to the system; a worker that is reused would else keep the most it ever took."""
    pa.default_memory_pool().release_unused()
    if libc := _libc():
        libc.malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, with memory given back at the end of each task."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def numbered(docs: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """docs, written once with a number of each row, by which a stage drops rows: a doc_id may be missing or repeated."""
    return ws.table(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def one_fits(columns: list[str], name: str) -> str:
    """A column name that does not clash with those given."""
    while name in columns:
        name = f"_{name}"
    return name


def text_sizes(column: pa.Array) -> np.ndarray:
    """Bytes of each text, 0 for null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with at most so many bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(text_sizes(batch.column(column)))
        begin, before = 0, 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin, before = end, int(ends[end - 1])


def texts(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts, and where each row starts (one more than rows); null counts as empty."""
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers, in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = left * _LEFT
    h += right * _RIGHT
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def window_hashes(symbols: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of all windows of so many 64-bit symbols, by doubling: no multiplication is linear in the window."""
    n = len(symbols) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, width, out, done = symbols, 1, None, 0
    while True:
        if length & width:
            part = power[done : done + n]
            out = part if out is None else _joined(out, part)
            done += width
        if 2 * width > length:
            return out.copy() if out is power else out
        power, width = _joined(power[: len(power) - width], power[width:]), 2 * width


def spread(lengths: np.ndarray) -> np.ndarray:
    """For runs of these lengths, each element's place in its run."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0, dtype=np.int64) - np.repeat(ends - lengths, lengths)


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat's pieces, one behind the other."""
    return flat[np.repeat(starts, lengths) + spread(lengths)]
