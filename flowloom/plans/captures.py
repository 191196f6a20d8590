"""Flow captures made from the lineitem table, so that SQL over that table says what queries over captures must return.

Files are range partitioned by time and written by the tasks that hold their records, to the folder that all
executors share; each has its first and last second in its header.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from flowloom.testing.flowgen import capture

#: name: version, little endian, zlib level, stream version.
LAYOUTS = {
    "v5": (5, False, None, 3),
    "v5_little": (5, True, None, 3),
    "v5_zlib": (5, False, 6, 3),
    "v5_stream1": (5, False, None, 1),
    "v7": (7, False, None, 3),
    "v7_little_zlib": (7, True, 9, 3),
}
#: Columns that are derived; all others are 0.  {secs} is the ship date in seconds.
DERIVED = """
{secs} AS unix_secs,
CAST(167772160 + l_orderkey % 65536 AS BIGINT) AS srcip,
CAST(3232235520 + l_partkey % 65536 AS BIGINT) AS dstip,
CAST(l_linenumber AS INT) AS input,
CAST(l_suppkey % 65536 AS INT) AS output,
CAST(floor(l_quantity) AS BIGINT) AS packets,
CAST(floor(l_extendedprice) AS BIGINT) AS octets,
CAST((l_orderkey * 31 + l_linenumber) % 65536 AS INT) AS srcport,
CAST(CASE l_partkey % 3 WHEN 0 THEN 443 WHEN 1 THEN 80 ELSE 53 END AS INT) AS dstport,
CAST(CASE l_linenumber % 4 WHEN 0 THEN 1 WHEN 1 THEN 6 WHEN 2 THEN 17 ELSE 200 END AS SMALLINT) AS protocol
"""
COLUMNS = ["unix_secs", "srcip", "dstip", "input", "output", "packets", "octets", "srcport", "dstport", "protocol"]
SPARK_SECS = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', l_shipdate)"
SQL_SECS = "CAST(epoch(l_shipdate) AS BIGINT)"
#: A file for about so many flows.
FLOWS_IN_FILE = 1_000_000

_made: dict[tuple[str, str, str], str] = {}


def derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lineitem.selectExpr(*(x.strip() for x in DERIVED.format(secs=SPARK_SECS).strip().split(",\n")))


def _home(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="flowloom-captures-")
    atexit.register(shutil.rmtree, own, True)
    return own


def _put(folder: str, name: str, body: bytes) -> None:
    """A file that is there whole or not at all; folder and name may lie on any file system that pyarrow knows."""
    context = TaskContext.get()
    fs, root = (pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")) if "://" not in folder or folder.startswith("file:") else pafs.FileSystem.from_uri(folder)
    *inner, last = name.split("/")
    path, own = "/".join([root, *inner]), f".{context.partitionId()}-{context.taskAttemptId()}-{last}"
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/{own}") as f:
        f.write(body)
    fs.move(f"{path}/{own}", f"{path}/{last}")


def placed(spark: SparkSession, files: dict[str, bytes]) -> str:
    """A new folder with these files, by their names in it."""
    folder = f"{_home(spark)}/files-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column("name").to_pylist(), batch.column("body").to_pylist(), strict=True):
                _put(folder, name, body)
            yield batch.select(["name"])

    spark.createDataFrame(list(files.items()), "name string, body binary").mapInArrow(write, "name string").collect()
    return folder


def captures(spark: SparkSession, sf_dir: str, layout: str = "v5") -> str:
    """The folder of the captures in a layout; made on the first call of a session."""
    key = (spark.sparkContext.applicationId, sf_dir, layout)
    if key in _made:
        return _made[key]
    version, little, level, stream = LAYOUTS[layout]
    folder = f"{_home(spark)}/captures-{uuid.uuid4().hex}"
    flows = derived(spark, sf_dir)
    files = max(7, -(-flows.count() // FLOWS_IN_FILE))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        columns = {c: table.column(c).to_numpy() for c in COLUMNS}
        secs = columns["unix_secs"]
        body = capture(columns, version, little, level, stream, capture=(int(secs.min()), int(secs.max())), n_flows=len(secs))
        name = f"ft-{TaskContext.get().partitionId():05d}"
        _put(folder, name, body)
        yield pa.RecordBatch.from_pydict({"name": [name]})

    made = flows.repartitionByRange(int(files), "unix_secs").mapInArrow(write, "name string")
    made.agg({"name": "count"}).collect()
    _made[key] = folder
    if "://" not in folder:
        os.makedirs(folder, exist_ok=True)
    return folder
