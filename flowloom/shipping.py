"""Makes this package importable in Spark's Python workers when the caller has not installed it there."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    sc, home = spark.sparkContext, str(ROOT.parent)
    if sc.applicationId in _shipped or home in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _shipped.add(sc.applicationId)
    sc.environment["PYTHONPATH"] = os.pathsep.join(x for x in (home, sc.environment.get("PYTHONPATH")) if x)
    if not sc.master.startswith("local[") and sc.master != "local":
        target = Path(tempfile.mkdtemp(prefix="flowloom-")) / "flowloom.zip"
        with zipfile.ZipFile(target, "w") as z:
            for path in sorted(ROOT.rglob("*.py")):
                z.write(path, path.relative_to(ROOT.parent))
        sc.addPyFile(str(target))
