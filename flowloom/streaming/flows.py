"""Flow captures as a stream: files that come into a folder.  An extension; batches read the same records."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from flowloom.sources.api import register


def stream_flows(spark: SparkSession, path: str, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """A streaming DataFrame over the captures in a folder; options as of the format, stringify and so on."""
    register(spark)
    own = {k.replace("_", "-"): str(v) for k, v in options.items()}
    if columns is not None:
        own["columns"] = json.dumps(list(columns))
    return spark.readStream.format("netflow").options(**own).load(path)


def drained(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All that the folder holds now, through a stream that ends: written exactly once, and read back."""
    home = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="flowloom-stream-")).rstrip("/")
    out = f"{home}/drained-{uuid.uuid4().hex}"
    query = stream_flows(spark, path, columns, stringify="false").writeStream.format("parquet").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start(f"{out}/rows")
    query.awaitTermination()
    return spark.read.parquet(f"{out}/rows")
