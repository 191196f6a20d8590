"""Exact dedup: a tree merge of sorted digest runs, in DataFrame operations only.

Every document gets a digest (SHA-256 of its normalised text) and a check (byte length and a second, unrelated
hash).  The documents are dealt into RUNS runs; within a run the rows of one text are combined before anything is
shuffled, and a run holds one row for each digest in it, in order: smallest identifier and count.

Runs are merged in binomial rounds: in each, FAN_IN neighbours send their rows to the partitions of their common
successor, which are ranges of its digests, and there the sorted rows that come from each are merged by one sort (which
finds them in sorted stretches) and one pass of aggregation in that order, without another exchange.  Rows merge only
if digest, length and second hash agree, and keep the smallest identifier.  After the last round one run is left,
spread over all partitions by range of digest.  So a text which a third of all rows share never meets in one task: it
is one row for each run at every level.

The way back down is a join on (run, digest) as well: the winners go to the rows of the first level, which has each
digest once for each run, and from there to the documents of their run.

Nulls: a null text counts as empty; a null doc_id comes after every other.  Rows of one text and one doc_id, and
repeated rows: exactly one of them stays, the first as the digest table has them.  Texts of any length are read whole;
an empty table gives none.  Only doc_id and text are read; other columns, whatever their names, pass through
dedup_stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import SPACES, Workspace, documents, one_fits

FAN_IN = 2
#: Runs at the first level.
RUNS = 64
#: Of digests, the ranges that a run is divided into: as many as there are shuffle partitions, of 16 bits.
RANGES = 1 << 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACES}+", " ")


def digests(docs: DataFrame, runs: int = RUNS) -> DataFrame:
    """doc_id, run, digest (32 bytes), length, check and row (unique)."""
    text = normalised(F.col("text"))
    return docs.select("doc_id", text.alias("t")).select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2("t", 256)).alias("digest"),
        F.octet_length("t").alias("length"),
        F.xxhash64("t").alias("check"),
    ).withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs)).cast("int"))


def smallest(by: list[str], size: Column) -> list[Column]:
    """The verified smallest identifier of a run's equal rows, nulls last, with its row, and the number of rows."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    return [first.alias("first"), F.sum(size).alias("size")]


def of_run(level: DataFrame, key: list[str]) -> DataFrame:
    """One row for each run and key."""
    level = level.groupBy("run", "range", *key).agg(*smallest(key, F.col("size")))
    return level.select("run", "range", *key, F.col("first.doc_id").alias("doc_id"), F.col("first.row").alias("row"), "size")


def merged(level: DataFrame, key: list[str], fan_in: int) -> DataFrame:
    """One round: the rows of neighbouring runs go to the ranges of their successor, in order, and become one run."""
    level = level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")).repartition("run", "range")
    return of_run(level.sortWithinPartitions("run", "range", *key), key)


def exact_groups(docs: DataFrame, ws: Workspace, runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """One row for each document: doc_id, row, digest, keep_id, group_size, kept."""
    key = ["digest", "length", "check"]
    all_rows = ws.table(digests(docs, runs), "digests")
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("int")
    ranged = all_rows.withColumn("range", F.floor(place * ranges / RANGES).cast("int")).withColumn("size", F.lit(1).cast("long"))
    first = of_run(ranged, key)
    level, left = first, runs
    while left > 1:
        left = -(-left // fan_in)
        level = merged(level, key, fan_in)
    winners = level.select(*key, F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("size").alias("group_size"))
    down = first.select("run", *key).join(winners, key)
    return all_rows.join(down, ["run", *key]).withColumn("kept", F.col("row") == F.col("keep_row"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(documents(spark, sf_dir), Workspace(spark, "op5"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text, with all its columns.

    Rows that share text and doc_id are reduced to one before anything else, combined before they are shuffled; then
    (digest, doc_id) is unique, and the join on it has no hot key."""
    digest, none, number = (one_fits(docs.columns, x) for x in ("_digest", "_none", "_number"))
    winners = exact_groups(docs, Workspace(spark, "dedup")).filter("kept")
    winners = winners.select(F.col("digest").alias(digest), F.col("keep_id").isNull().alias(none), F.coalesce("keep_id", F.lit(0)).alias(number))
    keyed = docs.withColumns({digest: F.unhex(F.sha2(normalised(F.col("text")), 256)), none: F.col("doc_id").isNull(), number: F.coalesce("doc_id", F.lit(0))})
    key = [digest, none, number]
    return keyed.dropDuplicates(key).join(winners, key, "left_semi").select(*docs.columns)


OP5_SQL = """
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
