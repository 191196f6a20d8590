"""Reports over flows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FOUR = ["srcip", "dstip", "srcport", "dstport"]


def aggregated_report(flows: DataFrame, min_port: int = 10) -> DataFrame:
    """How many flows each pair of endpoints has, from ports over min_port."""
    return flows.filter(F.col("srcport") > min_port).select(*FOUR, "packets", "octets").groupBy(*FOUR).count()


def top_talkers(flows: DataFrame, k: int = 10, by: str = "octets") -> DataFrame:
    """The k sources with most octets; ties by address."""
    return flows.groupBy("srcip").agg(F.sum(by).alias(f"sum_{by}"), F.count(F.lit(1)).alias("n_flows")).orderBy(F.desc(f"sum_{by}"), "srcip").limit(k)


def ranked(flows: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """The first k flows of each group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return flows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
