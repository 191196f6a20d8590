"""Times the seven published cases over flow captures made from lineitem, and prints one line of JSON.

BENCH_SF_DIR (default /root/testdata/sf0.1) has the tables, BENCH_CPUS (default 8) is the number of threads.  Each
case runs once to warm up and then RUNS times; the best counts, as written to Spark's noop sink.  Making the captures
is not timed.  Ratios between cases are printed too, since the published figures have no data size.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators.reports import FOUR, aggregated_report
from flowloom.plans.captures import captures
from flowloom.shipping import ship
from flowloom.sources.api import netflow5

RUNS = 3


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    ship(spark)
    path = captures(spark, sf_dir, "v5")

    def flows(**options) -> DataFrame:
        return netflow5(spark, path, **options)

    cases = {
        "full_scan": lambda: flows(stringify="false"),
        "full_scan_stringify": lambda: flows(),
        "high_pushdown_off": lambda: flows(predicate_pushdown="false").filter(F.col("srcport") != 10),
        "high_pushdown_on": lambda: flows().filter(F.col("srcport") != 10),
        "low_pushdown_off": lambda: flows(predicate_pushdown="false").filter(F.col("srcip") == "10.0.0.33"),
        "low_pushdown_on": lambda: flows().filter(F.col("srcip") == "10.0.0.33"),
        "aggregated_report": lambda: aggregated_report(flows().select(*FOUR, "packets", "octets")),
    }
    seconds = {}
    for name, case in cases.items():
        best = None
        for k in range(RUNS + 1):
            began = time.perf_counter()
            case().write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            best = took if k and (best is None or took < best) else best
        seconds[name] = round(best, 4)
    ratio = lambda a, b: round(seconds[a] / seconds[b], 2)
    said = {
        "metric": "flow_cases_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rows": flows(stringify="false").count(),
        "ratios": {"stringify": ratio("full_scan_stringify", "full_scan"), "pushdown_low": ratio("low_pushdown_off", "low_pushdown_on"), "pushdown_high": ratio("high_pushdown_off", "high_pushdown_on")},
    }
    print(json.dumps(said))
    spark.stop()


if __name__ == "__main__":
    main()
