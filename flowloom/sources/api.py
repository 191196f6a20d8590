"""Reading flow captures with a Spark session."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from flowloom.shipping import ship

from .datasource import FlowSource, key_column, listed, opened, resolve
from .decode import open_header
from .frame import FlowFrame, Reading, scans
from .options import FlowOptions
from .predicate import Predicate, to_json

def register(spark: SparkSession) -> None:
    """Makes format "netflow" known to the session, also for SQL: CREATE TEMPORARY VIEW v USING netflow OPTIONS (...)."""
    ship(spark)
    spark.dataSource.register(FlowSource)


def read_flows(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, where: Predicate | None = None, **options) -> DataFrame:
    """A DataFrame over captures, which reads only what its select() and filter() ask for (see frame).

    columns: only these.  where: a predicate for the source, on numbers.  Other options as of the format, with _ for -.
    The session's spark.sql.files.ignoreCorruptFiles holds unless ignoreCorruptFiles is given."""
    register(spark)
    own = {k.replace("_", "-"): str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}
    own.setdefault("ignoreCorruptFiles", spark.conf.get("spark.sql.files.ignoreCorruptFiles", "false"))

    def make(columns: Sequence[str] | None, where: Predicate | None) -> DataFrame:
        more, reader = dict(own), spark.read.format("netflow")
        if columns is not None:
            more["columns"] = json.dumps(list(columns))
        if where is not None:
            more["where"] = json.dumps(to_json(where))
        if scan is not None:  # known, so that files are listed again only when a plan is made
            reader = reader.schema(replace(scan, options=replace(scan.options, columns=None if columns is None else tuple(columns))).schema())
        return reader.options(**more).load(path if isinstance(path, str) else list(path))

    options, scan = FlowOptions.of(own), None
    keys = ({"path": path} if isinstance(path, str) else {"paths": json.dumps(list(path))}) | own
    # The version is read once; every scan that the frame makes has it given.
    try:
        scan = resolve(keys)
    except Exception:
        make(columns, where)  # fails in the same way, as Spark says it
        raise
    if options.version is None:
        own["version"] = str(scan.interface.version)
    fields = scan.schema().fieldNames()
    numbers = {k.name: key_column(k) for k in scan.keys if k.name not in scan.interface.by_name and isinstance(k.dataType, (IntegerType, LongType))}
    return FlowFrame(Reading(spark, make, scan.interface, options.stringify, options.pushdown, numbers, tuple(fields if columns is None else columns), where))


def netflow5(spark: SparkSession, path: str | Sequence[str], **options) -> DataFrame:
    return read_flows(spark, path, version="5", **options)


def netflow7(spark: SparkSession, path: str | Sequence[str], **options) -> DataFrame:
    return read_flows(spark, path, version="7", **options)


def flow_view(spark: SparkSession, name: str, path: str, **options) -> None:
    """A temporary view, by SQL."""
    register(spark)
    quoted = ", ".join(f"`{k.replace('_', '-')}` '{str(v)}'" for k, v in (options | {"path": path}).items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING netflow OPTIONS ({quoted})")


def flow_sql(spark: SparkSession, query: str, views: Mapping[str, str], **options) -> DataFrame:
    """The result of a query over captures, each view of which reads only the columns that the query needs, and, where
    it is read in one place, only the records that its conditions leave.  views: names and paths.

    The query is planned over whole views first; what its optimised plan asks of each is then read under that name."""
    for name, path in views.items():
        read_flows(spark, path, **options).createOrReplaceTempView(name)
    asked = scans(spark.sql(query))
    for name, path in views.items():
        frame = read_flows(spark, path, **options)
        own = [x for x in asked if set(x.output) == set(frame.columns)] if len(views) == 1 else []
        if own and all(x.columns is not None for x in own):
            used = {c for x in own for c in x.columns}
            if len(own) == 1:
                for text in own[0].conditions:
                    frame = frame.filter(text)
            if isinstance(frame, FlowFrame):
                kept = frame.select(*(c for c in frame.columns if c in used))
                # Under the old names, in the old order: columns that are not read are null, and nothing asks for them.
                schema = read_flows(spark, path, **options).schema
                frame = kept.select(*(F.col(f.name) if f.name in used else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
        frame.createOrReplaceTempView(name)
    return spark.sql(query)


HEADER_SCHEMA = (
    "path string, is_valid boolean, stream_version int, little_endian boolean, header_size long, flow_version int, capture_start long, capture_end long, flags long, is_compressed boolean, "
    "rotation long, n_flows long, n_lost long, n_misordered long, n_corrupt long, n_resets long, vendor int, exporter_ip long, agg_version int, agg_method int, hostname string, comments string, "
    "interface_names array<struct<ip: long, index: int, name: string>>, interface_aliases array<struct<ip: long, indexes: array<int>, alias: string>>, fields long"
)


def flow_headers(spark: SparkSession, path: str | Sequence[str], ignore_corrupt: bool = True) -> DataFrame:
    """A row for each file: its header.  A file without one has is_valid false, or fails the query if ignore_corrupt is off."""
    ship(spark)
    files = [f.path for f in listed({"path": path} if isinstance(path, str) else {"paths": json.dumps(list(path))})]
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(HEADER_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file in batch.column("path").to_pylist():
                with opened(file) as f:
                    row = open_header(f, ignore_corrupt).as_dict()
                row["interface_names"] = [{"ip": a, "index": b, "name": c} for a, b, c in row["interface_names"]]
                row["interface_aliases"] = [{"ip": a, "indexes": b, "alias": c} for a, b, c in row["interface_aliases"]]
                rows.append(row | {"path": file})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    n = max(1, min(len(files), spark.sparkContext.defaultParallelism * 4))
    return spark.createDataFrame([(f,) for f in files], "path string").repartition(n).mapInArrow(run, HEADER_SCHEMA)
