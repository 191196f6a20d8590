"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
docs of the next.  All but the last return the columns of documents, whatever these are called.

Every stage decides by rows, never by doc_id, which may be missing or repeated.  A text that is null or empty, or has no
letters, goes with the first stage; of texts that are equal but for white space one row stays, and of near copies one,
that of smallest doc_id (rows without one come last, of equal ones the first); a text of any length is read whole in
every stage.  Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowloom.llm._common import Workspace, documents
from flowloom.llm.bpe import bpe_stage
from flowloom.llm.decontamination import decontamination_stage
from flowloom.llm.exact_dedup import dedup_stage
from flowloom.llm.jaccard_join import near_dedup_stage
from flowloom.llm.language_id import language_stage

STAGES = [
    ("language ID", language_stage),
    ("exact dedup", dedup_stage),
    ("n-gram Jaccard join", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", bpe_stage),
]

#: SQL expresses neither the learnt language model nor the merges of a tokenizer; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = ws.table(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
