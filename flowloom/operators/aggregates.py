"""Aggregates over arrays of whole numbers, and for groups."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _not_empty(values: Column, result: Column, what: str) -> Column:
    return F.when(F.size(values) > 0, result).when(values.isNotNull(), F.raise_error(F.lit(f"{what} of an empty array")).cast("long"))


def truncated_mean(values: Column | str, sample: float) -> Column:
    """Sum of the smallest int(sample * n) values, divided by n in whole numbers, divided by sample, rounded up.

    One value is its own mean.  sample must be over 0 and at most 1; an empty array fails, null stays null."""
    if not 0 < sample <= 1:
        raise ValueError(f"Sample must be over 0 and at most 1, not {sample}")
    a = _column(values).cast("array<bigint>")
    n = F.size(a)
    first = F.slice(F.array_sort(a), F.lit(1), F.floor(F.lit(float(sample)) * n).cast("int"))
    total = F.aggregate(first, F.lit(0).cast("long"), lambda x, y: x + y)
    whole = (total - F.when(total < 0, -F.pmod(-total, n)).otherwise(F.pmod(total, n))) / n  # whole division, toward 0
    mean = F.ceil(whole / F.lit(float(sample))).cast("long")
    return _not_empty(a, F.when(n == 1, F.get(a, F.lit(0))).otherwise(mean), "Truncated mean")


def histogram_mode(values: Column | str, buckets: Callable[[Column, Column, Column], Column] | None = None) -> Column:
    """The greatest value in the fullest bucket of equal width, the first of equally full ones.

    There are ceil(sqrt(n)) buckets, or as many as buckets(min, max, n) says; both ends of a bucket are in it, so that
    a value on a bound may count twice.  One value is its own mode.  Where all values of the fullest bucket are
    negative the mode is 0, as it is where every bucket is empty.  An empty array fails, null stays null."""
    a = _column(values).cast("array<bigint>")
    n, low, high = F.size(a), F.array_min(a), F.array_max(a)
    k = (buckets(low, high, n) if buckets else F.ceil(F.pow(n, F.lit(0.5)))).cast("int")
    width = (high - low).cast("double")

    def bucket(b: Column) -> Column:
        begin, end = F.ceil(width * b.cast("double") / k) + low, F.floor(width * (b + 1).cast("double") / k) + low
        return F.filter(a, lambda e: (e >= begin) & (e <= end))

    all_buckets = F.transform(F.sequence(F.lit(0), k - 1), bucket)
    fullest = F.aggregate(all_buckets, F.array().cast("array<bigint>"), lambda best, x: F.when(F.size(x) > F.size(best), x).otherwise(best))
    mode = F.greatest(F.lit(0).cast("long"), F.coalesce(F.array_max(fullest), F.lit(0).cast("long")))
    return _not_empty(a, F.when(n == 1, F.get(a, F.lit(0))).otherwise(mode), "Histogram mode")


def grouped_truncated_mean(df: DataFrame, keys: list[str], value: str, sample: float, name: str = "mean") -> DataFrame:
    """truncated_mean() of each group, of any size: equal values are counted first, and pass in order through a window."""
    if not 0 < sample <= 1:
        raise ValueError(f"Sample must be over 0 and at most 1, not {sample}")
    v = F.col("_value")
    counts = df.select(*keys, F.col(value).cast("long").alias("_value")).filter(v.isNotNull()).groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias("_many"))
    own = Window.partitionBy(*keys)
    before = F.sum("_many").over(own.orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_many")
    placed = counts.withColumn("_before", before).withColumn("_n", F.sum("_many").over(own))
    most = F.floor(F.lit(float(sample)) * F.col("_n"))
    taken = F.least("_many", F.greatest(F.lit(0), most - F.col("_before"))).cast("long")
    sums = placed.groupBy(*keys).agg(F.sum(v * taken).alias("_total"), F.first("_n").alias("_n"), F.min(v).alias("_one"))
    total, n = F.col("_total"), F.col("_n")
    whole = (total - F.when(total < 0, -F.pmod(-total, n)).otherwise(F.pmod(total, n))) / n
    return sums.select(*keys, F.when(n == 1, F.col("_one")).otherwise(F.ceil(whole / F.lit(float(sample))).cast("long")).alias(name))


def grouped_histogram_mode(df: DataFrame, keys: list[str], value: str, name: str = "mode") -> DataFrame:
    """histogram_mode() of each group, of any size: values are counted by the buckets they are in, one or two each."""
    rows = df.select(*keys, F.col(value).cast("long").alias("_value")).filter(F.col("_value").isNotNull())
    counts = rows.groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias("_many"))
    same = [F.col(f"_c.{k}").eqNullSafe(F.col(f"_b.{k}")) for k in keys]
    bounds = counts.groupBy(*keys).agg(F.min("_value").alias("_low"), F.max("_value").alias("_high"), F.sum("_many").alias("_n")).withColumn("_k", F.ceil(F.pow("_n", F.lit(0.5))).cast("int"))
    both = counts.alias("_c").join(bounds.alias("_b"), functools.reduce(lambda a, b: a & b, same)) if keys else counts.crossJoin(bounds)
    both = both.select(*(F.col(f"_c.{k}").alias(k) for k in keys), "_value", "_many", "_low", "_high", "_n", "_k")
    width, k, b = (F.col("_high") - F.col("_low")).cast("double"), F.col("_k"), F.col("_bucket")
    near = F.when(width > 0, F.floor((F.col("_value") - F.col("_low")) * k / width)).otherwise(F.lit(0)).cast("int")
    placed = both.withColumn("_bucket", F.explode(F.sequence(F.greatest(F.lit(0), near - 1), F.least(k - 1, near + 1))))
    begin, end = F.ceil(width * b.cast("double") / k) + F.col("_low"), F.floor(width * (b + 1).cast("double") / k) + F.col("_low")
    inside = placed.filter((F.col("_value") >= begin) & (F.col("_value") <= end))
    buckets = inside.groupBy(*keys, "_bucket").agg(F.sum("_many").alias("_size"), F.max("_value").alias("_top"), F.first("_n").alias("_n"))
    fullest = buckets.groupBy(*keys).agg(F.min(F.struct(-F.col("_size"), "_bucket", "_top")).alias("_best"), F.first("_n").alias("_n"))
    none = bounds.select(*keys, F.col("_n").alias("_rows"), "_low")
    joined = none.alias("_b").join(fullest.alias("_f"), functools.reduce(lambda a, b: a & b, [F.col(f"_b.{x}").eqNullSafe(F.col(f"_f.{x}")) for x in keys]), "left") if keys else none.crossJoin(fullest)
    mode = F.greatest(F.lit(0).cast("long"), F.coalesce(F.col("_best._top"), F.lit(0).cast("long")))
    return joined.select(*(F.col(f"_b.{x}").alias(x) for x in keys), F.when(F.col("_rows") == 1, F.col("_low")).otherwise(mode).alias(name))
