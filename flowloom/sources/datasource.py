"""Flow captures as a Spark data source, for batches and streams.

A file is one partition, or, if it is not compressed, one for each stretch of about splitSize bytes of whole
records.  Files whose partition columns or header's time range contradict the predicate get no partition.
"""

from __future__ import annotations

import base64
import glob
import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition

from .convert import shown
from .decode import arrays, open_header
from .header import FlowHeader
from .options import FlowOptions
from .predicate import Predicate, from_json, plan, settled
from .registry import create_interface
from .schema import FlowColumn, Interface, MappedColumn

NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"
BATCH_RECORDS = 65536
#: Files whose headers are read when a scan is planned.
HEADERS = 4096
NO_WRITE = "Write is not supported in this version of package"


def _remote(path: str) -> bool:
    return "://" in path


def _plain(path: str) -> str:
    return "/" + path[5:].lstrip("/") if path.startswith("file:") else path


def opened(path: str):
    """The file at a path: local, or on any file system that pyarrow knows.  Both can seek."""
    if not _remote(path):
        return open(path, "rb")
    fs, own = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(own)


def _hidden(name: str) -> bool:
    return name.startswith((".", "_")) and "=" not in name


@dataclass(frozen=True)
class FlowFile:
    path: str
    size: int
    modified: int
    keys: tuple[tuple[str, str], ...] = ()


def _under(root: str) -> list[FlowFile]:
    """The files at or under a root, with the key=value parts of their paths below it."""
    if _remote(root):
        fs, own = pafs.FileSystem.from_uri(root)
        prefix = root[: len(root) - len(own)] if root.endswith(own) else root.split("://")[0] + "://"
        info = fs.get_file_info(own)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(root)
        found = [info] if info.is_file else [x for x in fs.get_file_info(pafs.FileSelector(own, recursive=True)) if x.is_file]
        out = [(prefix + x.path, os.path.relpath(x.path, own), x.size, x.mtime_ns or 0) for x in found]
    elif os.path.isfile(root):
        out = [(root, os.path.basename(root), os.path.getsize(root), os.stat(root).st_mtime_ns)]
    else:
        out = []
        for folder, names, files in os.walk(root):
            names[:] = sorted(n for n in names if not _hidden(n))
            for f in sorted(files):
                path = os.path.join(folder, f)
                out.append((path, os.path.relpath(path, root), os.path.getsize(path), os.stat(path).st_mtime_ns))
    files = []
    for path, below, size, modified in out:
        *folders, name = below.split("/")
        if _hidden(name) or any(_hidden(x) for x in folders):
            continue
        files.append(FlowFile(path, size, modified, tuple(tuple(x.split("=", 1)) for x in folders if "=" in x)))
    return files


def listed(options: dict[str, str]) -> list[FlowFile]:
    """All files of the option path, or paths (a JSON list): files, folders or patterns."""
    paths = json.loads(options["paths"]) if "paths" in options else [options["path"]] if "path" in options else []
    if not paths:
        raise ValueError("Path is not specified")
    out = []
    for path in map(_plain, paths):
        roots = [path] if _remote(path) or not glob.has_magic(path) or os.path.exists(path) else sorted(glob.glob(path))
        if not roots or not _remote(path) and not all(map(os.path.exists, roots)):
            raise FileNotFoundError(f"[PATH_NOT_FOUND] Path does not exist: {path}")
        for root in roots:
            out += _under(root)
    return sorted(out, key=lambda f: f.path)


def partition_fields(files: list[FlowFile]) -> list[T.StructField]:
    """Columns from key=value folders: int, long or string, whatever holds all values."""
    values: dict[str, set[str]] = {}
    for f in files:
        for k, v in f.keys:
            values.setdefault(k, set()).add(v)
    out = []
    for k, own in values.items():
        own = own - {NO_PARTITION}
        whole = own and all(v.lstrip("-").isdigit() for v in own)
        kind = T.StringType() if not whole else T.IntegerType() if all(abs(int(v)) < 1 << 31 for v in own) else T.LongType()
        out.append(T.StructField(k, kind, True))
    return out


@dataclass
class Scan:
    """What the readers share: files, interface, options, columns in order."""

    files: list[FlowFile]
    interface: Interface
    options: FlowOptions
    keys: list[T.StructField] = field(default_factory=list)

    @property
    def columns(self) -> list[MappedColumn]:
        names = self.options.columns
        if names is None:
            return list(self.interface.columns)
        keyed = {k.name for k in self.keys}
        return [self.interface.column(n) for n in names if n not in keyed] or ([] if any(n in keyed for n in names) else [self.interface.first])

    def schema(self) -> T.StructType:
        named = [c.name for c in self.columns]
        fields = self.interface.sql_schema(self.options.stringify, named).fields
        return T.StructType(fields + [k for k in self.keys if k.name not in named])

    @property
    def where(self) -> Predicate | None:
        if not self.options.where:
            return None
        by_name = {c.column.name: c.column for c in self.interface.columns} | {c.name: c.column for c in self.interface.columns}
        by_name |= {c.name: c for c in map(key_column, self.keys)}
        return from_json(json.loads(self.options.where), by_name)


def infer_version(files: list[FlowFile], ignore_corrupt: bool = False) -> int | None:
    """The version in the header of the first file; none without files."""
    if not files:
        return None
    try:
        with opened(files[0].path) as f:
            header = open_header(f, ignore_corrupt)
    except OSError as e:
        raise OSError(f"Failed to infer version for provided NetFlow files using path '{files[0].path}', reason: {e}. Try specifying version manually") from e
    return header.flow_version if header.is_valid else None


def resolve(options: dict[str, str]) -> Scan:
    own, files = FlowOptions.of(options), listed(options)
    version = own.version
    if version is None:
        version = infer_version(files, own.ignore_corrupt) or 5
    return Scan(files, create_interface(version), own, partition_fields(files))


def key_value(text: str, kind: T.DataType):
    return None if text == NO_PARTITION else text if isinstance(kind, T.StringType) else int(text)


def key_column(k: T.StructField) -> FlowColumn:
    """A partition column of whole numbers, for predicates."""
    return FlowColumn("long", f"key {k.name}", 0)


@dataclass
class Stretch(InputPartition):
    """The records of a file whose place among its records is from first on, n of them or all.  A file that cannot be
    divided is read whole by its first stretch."""

    file: FlowFile
    first: int = 0
    n: int | None = None

    def __post_init__(self):
        super().__init__(None)


class FlowReaderBase:
    def __init__(self, scan: Scan):
        self.scan = scan

    def _predicate(self, file: FlowFile) -> Predicate | None:
        """The predicate for a file, whose partition columns have one value each."""
        where = self.scan.where
        if where is None or not self.scan.keys:
            return where
        keys = dict(file.keys)
        return settled(where, {key_column(k).name: key_value(keys.get(k.name, NO_PARTITION), k.dataType) for k in self.scan.keys if not isinstance(k.dataType, T.StringType)})

    def _plan(self, file: FlowFile, header: FlowHeader):
        bounds = {"unix_secs": header.time_range} if header.time_range else {}
        return plan(self._predicate(file), bounds)

    def _header(self, f: FlowFile) -> FlowHeader | None:
        """None where only the reading task should find out what is wrong."""
        try:
            with opened(f.path) as stream:
                return open_header(stream, True)
        except OSError:
            return None

    def stretches(self, files: list[FlowFile]) -> list[Stretch]:
        # Files that their partition columns rule out are not opened.
        files = [f for f in files if plan(self._predicate(f)).kind != "skip"]
        size = self.scan.interface.record_size
        each = max(1, self.scan.options.split_size // size)
        files = self._in_time(files)
        return [Stretch(f, k, each) if f.size > each * size else Stretch(f) for f in files for k in range(0, max(1, f.size // size), each)]

    def _in_time(self, files: list[FlowFile]) -> list[FlowFile]:
        """Without the files whose header says that no record can be in the time asked for.  Tasks look as well, so
        that only of HEADERS files, and only where a time is asked for, are headers read here."""
        where = self.scan.where
        if len(files) > HEADERS or where is None or all(c.name != "unix_secs" for c in where.columns()):
            return files
        with ThreadPoolExecutor(16) as pool:
            headers = list(pool.map(self._header, files))
        known = lambda h: h is not None and h.is_valid and h.flow_version == self.scan.interface.version
        return [f for f, h in zip(files, headers, strict=True) if not known(h) or self._plan(f, h).kind != "skip"]

    def read(self, partition: Stretch | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark asks once where there is no partition
            return
        try:
            yield from self._read(partition)
        except Exception as e:
            text = f"{e}, file={partition.file.path}"
            try:
                raise type(e)(text) from e
            except TypeError:
                raise OSError(text) from e

    def _read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        scan, options = self.scan, self.scan.options
        with opened(partition.file.path) as f:
            header = open_header(f, options.ignore_corrupt)
            if not header.is_valid:
                return
            if header.flow_version != scan.interface.version:
                raise ValueError(f"requirement failed: Expected version {scan.interface.version}, got {header.flow_version} for file {partition.file.path}")
            strategy = self._plan(partition.file, header)
            if strategy.kind == "skip":
                return
            n = partition.n
            if n is not None:
                size = scan.interface.record_size
                divided = not header.is_compressed and (partition.file.size - header.header_size) % size == 0
                if partition.first and (not divided or header.header_size + partition.first * size >= partition.file.size):
                    return
                n = n if divided else None
                if partition.first:
                    f.seek(header.header_size + partition.first * size)
            physical = [c.column for c in scan.columns]
            for records in arrays(f, header, scan.interface, physical or [scan.interface.first.column], strategy.predicate, options.buffer, options.ignore_corrupt, n):
                for k in range(0, len(records), BATCH_RECORDS):
                    yield self._batch(records[k : k + BATCH_RECORDS], partition.file)

    def _batch(self, records: np.ndarray, file: FlowFile) -> pa.RecordBatch:
        from .schema import WIDE

        columns, names = [], []
        for c in self.scan.columns:
            values = np.ascontiguousarray(records[c.column.name].astype(WIDE[c.column.kind]))
            columns.append(shown(values, c.conversion) if self.scan.options.stringify and c.conversion else pa.array(values))
            names.append(c.name)
        keys = dict(file.keys)
        for k in self.scan.keys:
            if k.name not in names:
                kind = {T.StringType: pa.string(), T.IntegerType: pa.int32(), T.LongType: pa.int64()}[type(k.dataType)]
                columns.append(pa.array([key_value(keys.get(k.name, NO_PARTITION), k.dataType)] * len(records), kind))
                names.append(k.name)
        return pa.RecordBatch.from_arrays(columns, names=names)


class FlowBatchReader(FlowReaderBase, DataSourceReader):
    def partitions(self):
        return self.stretches(self.scan.files)


def _seen(offset: dict) -> np.ndarray:
    """The files of an offset, as hashes in order."""
    return np.cumsum(np.frombuffer(zlib.decompress(base64.b64decode(offset["seen"])), "<u8"), dtype=np.uint64)


def _offset(hashes: np.ndarray) -> dict:
    own = np.unique(hashes.astype("<u8"))
    return {"n": len(own), "seen": base64.b64encode(zlib.compress(np.diff(own, prepend=own.dtype.type(0)).tobytes(), 6)).decode()}


class FlowStreamReader(FlowReaderBase, DataSourceStreamReader):
    """New files as they come, whatever their times; the offset is the set of the files seen, as 64-bit hashes of their paths."""

    def __init__(self, scan: Scan, raw: dict[str, str]):
        super().__init__(scan)
        self.raw = raw

    @staticmethod
    def _hash(file: FlowFile) -> int:
        return int.from_bytes(hashlib.blake2b(file.path.encode(), digest_size=8).digest(), "little")

    def _listed(self) -> dict[int, FlowFile]:
        return {self._hash(f): f for f in listed(self.raw)}

    def initialOffset(self) -> dict:
        return _offset(np.zeros(0, np.uint64))

    def latestOffset(self) -> dict:
        return _offset(np.fromiter(self._listed(), np.uint64))

    def partitions(self, start: dict, end: dict):
        files = self._listed()
        new = np.setdiff1d(_seen(end), _seen(start), assume_unique=True).tolist()
        return self.stretches(sorted((files[h] for h in new if h in files), key=lambda f: f.path))

    def commit(self, end: dict) -> None:
        pass


class FlowSource(DataSource):
    """Format "netflow": reads captures of version 5 and 7, and writes nothing."""

    @classmethod
    def name(cls) -> str:
        return "netflow"

    def __eq__(self, other) -> bool:
        return isinstance(other, FlowSource)

    def __hash__(self) -> int:
        return hash(FlowSource)

    def _scan(self) -> Scan:
        return resolve(dict(self.options))

    def schema(self) -> T.StructType:
        return self._scan().schema()

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return FlowBatchReader(self._scan())

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return FlowStreamReader(self._scan(), dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        raise NotImplementedError(NO_WRITE)
