"""Language ID by Bayesian evidence fusion.

Text likelihood: letters in trigrams of bytes, hashed to GRAMS cells; a cell's probability in a language comes from
the counts over all documents declared to be in it, by grouped aggregation, smoothed.  Declared language: how often
texts that look like language l are declared as d, smoothed.  Address suffix: how often texts of l have it.  Host:
the prior of a host is its own counts shrunk to those of its domain, which are shrunk to those of all.  The
posterior is the product, the text counting as STRENGTH independent trigrams at most, since trigrams overlap.

One alternative more is an unknown language: all cells alike, a prior of UNKNOWN on every host, and the declared
languages and suffixes of all rows.  Text whose trigrams are in no declared language is likelier in it.

Rejected are texts without a trigram of letters, and those whose best posterior is under LEAST.  Null text counts as
empty; a null declared language, host or suffix is no evidence, and such rows are not learnt from.  With nothing
declared anywhere there are no languages, and all is rejected.  Rows of one doc_id, and repeated rows, are each judged
by themselves; of equal posteriors the language that sorts first is the answer; texts of any length are read whole.
An empty table gives none; other columns, whatever their names, pass through language_stage.  Every declared language is one of the model's, however
rare; the model is a table of GRAMS cells for each, whatever the size of the corpus, in blocks of BLOCK languages.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Workspace, documents, lean, numbered, one_fits, slices, utf8

GRAMS = 1 << 14
STRENGTH = 64
LEAST = 0.5
#: Prior of a language that no row declares.
UNKNOWN = 0.01
#: Languages whose cells are held at once.
BLOCK = 200
#: Scores of documents held at once.
SCORES = 1 << 22
#: Rows of a domain that weigh as much as a host's own, and of all for a domain's.
SHRINK = 20.0
RUNS = 64

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LOWER[~_LETTER] = 32


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The cells of each text's trigrams of letters and word ends, one behind the other; how many each text has."""
    data, starts = utf8(column)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(len(starts) - 1, np.int64)
    low = _LOWER[data]
    h = (low[:-2] * np.uint32(0x01000193) ^ low[1:-1]) * np.uint32(0x85EBCA6B) ^ low[2:] * np.uint32(0xC2B2AE35)
    cells = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - int(math.log2(GRAMS)))
    ok = _LETTER[data[1:-1]] & (_LETTER[data[:-2]] | _LETTER[data[2:]])
    doc = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
    ok &= doc[:-2] == doc[2:]
    return cells[ok].astype(np.int64), np.bincount(doc[:-2][ok], minlength=len(starts) - 1)


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, cell, n: over all rows with a declared language.  docs: text, lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, n in held.items():
                cells = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cells), pa.string()), pa.array(cells, pa.int32()), pa.array(n[cells])], names=["lang", "cell", "n"])

        for batch in slices(batches, "text"):
            cells, n = trigrams(batch.column("text"))
            names = np.array([x or "" for x in batch.column("lang").to_pylist()], object)
            of = np.repeat(names, n) if len(set(names)) > 1 else None
            for lang in set(names):
                if lang not in held and len(held) >= 2 * BLOCK:
                    yield from rows()
                    held.clear()
                own = cells if of is None else cells[of == lang]
                held[lang] = held.get(lang, 0) + np.bincount(own, minlength=GRAMS)
        yield from rows()

    return docs.select("text", "lang").filter("lang IS NOT NULL AND lang != ''").mapInArrow(lean(run), "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))


def text_model(docs: DataFrame, ws: Workspace, block: int = BLOCK) -> tuple[list[str], list[Broadcast]]:
    """All declared languages in order, and for each block of them the log probability of each cell in each."""
    langs = sorted(r[0] for r in docs.filter("lang IS NOT NULL AND lang != ''").select("lang").distinct().collect())
    blocks = [langs[a : a + block] for a in range(0, len(langs), block)]
    grams = gram_counts(docs)
    if len(blocks) > 1:
        grams = ws.table(grams, "grams")  # read once for each block
    out = []
    for some in blocks:
        of = {lang: k for k, lang in enumerate(some)}
        counts = np.zeros((len(some), GRAMS))
        own = grams if len(blocks) == 1 else grams.filter(F.col("lang").isin(some))
        for row in own.groupBy("lang").agg(F.collect_list(F.struct("cell", "n")).alias("cells")).toLocalIterator():  # GRAMS cells at most
            cells = np.array(row["cells"], np.int64)
            counts[of[row["lang"]], cells[:, 0]] = cells[:, 1]
        counts += 0.5
        out.append(docs.sparkSession.sparkContext.broadcast(np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)))
    return langs, out


def text_evidence(docs: DataFrame, langs: list[str], model: list[Broadcast], keep: list[str]) -> DataFrame:
    """keep's columns, n_grams, and the tempered log likelihood in each language."""
    size = len(langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(1, SCORES // size)
        for whole in slices(batches, "text", 1 << 20):
            for batch in (whole.slice(a, most) for a in range(0, whole.num_rows, most)):
                cells, n = trigrams(batch.column("text"))
                ends = np.concatenate([[0], np.cumsum(n)])
                scores = np.zeros((len(n), size))
                k = 0
                for shared in model:
                    for own in shared.value:
                        sums = np.concatenate([[0.0], np.cumsum(own[cells], dtype=np.float64)])
                        scores[:, k] = (sums[ends[1:]] - sums[ends[:-1]]) / np.maximum(n, 1) * np.minimum(n, STRENGTH)
                        k += 1
                    if len(model) > 1:
                        shared.__dict__.pop("_value", None)  # one block in memory; read again for the next batch
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * size, pa.int32()), pa.array(scores.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(n, pa.int64()), flat], names=[*keep, "n_grams", "likelihood"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n_grams long, likelihood array<double>"])
    return docs.select(*keep, "text").mapInArrow(lean(run), schema)


def constants(values: list, kind: str) -> Column:
    """An array of constants as one expression, however many."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def spread_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left with right's columns by key, unique in right.  A key that a third of left has goes to RUNS tasks: right is joined to the (key, run) pairs there are, and these to left."""
    pairs = left.select(key, "run").distinct().join(right, key)
    return left.join(pairs, [key, "run"], "left")


def fuse(evidence: DataFrame, langs: list[str], ws: Workspace) -> DataFrame:
    """evidence with lang_id and posterior, an unknown language being one alternative.  evidence: lang, host, domain, suffix, n_grams, likelihood, run."""
    size = len(langs)
    looks = F.when(F.col("n_grams") > 0, F.array_position("likelihood", F.array_max("likelihood")).cast("int"))
    rows = ws.table(evidence.withColumn("looks", looks), "evidence")
    seen = rows.filter("looks IS NOT NULL")

    def table(key: str) -> DataFrame:
        """For each value of key, the counts of languages as an array."""
        n = seen.filter(F.col(key).isNotNull()).groupBy(key, "looks").count()
        own = n.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("looks", F.col("count").cast("double")))).alias("n"))  # size entries at most
        return own.select(key, F.transform(F.sequence(F.lit(1), F.lit(size)), lambda k: F.coalesce(F.try_element_at("n", k), F.lit(0.0))).alias("counts"))

    total = seen.groupBy("looks").count().collect()  # a row for each language
    all_n = np.zeros(size)
    for r in total:
        all_n[r["looks"] - 1] = r["count"]
    base = (all_n + 1) / (all_n + 1).sum()
    overall = constants(base.tolist(), "double")

    def shrunk(counts: Column, prior: Column) -> Column:
        whole = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) + SHRINK
        return F.zip_with(counts, prior, lambda c, p: (c + F.lit(SHRINK) * p) / whole)

    domains = table("domain").select("domain", shrunk(F.col("counts"), overall).alias("domain_prior"))
    hosts = table("host").select("host", F.col("counts").alias("host_counts"))
    domain_of = seen.filter("host IS NOT NULL").groupBy("host").agg(F.min("domain").alias("domain"))
    hosts = hosts.join(domain_of, "host").join(domains, "domain", "left").select("host", shrunk(F.col("host_counts"), F.coalesce("domain_prior", overall)).alias("host_prior"))
    per = constants(all_n.tolist(), "double")
    given = lambda counts: F.zip_with(counts, per, lambda c, n: F.log((c + 1.0) / (n + 2.0 * size)))
    given_any = lambda counts: F.log((F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) + 1.0) / (float(all_n.sum()) + 2.0 * size))
    declared = table("lang").select("lang", given(F.col("counts")).alias("declared_log"), given_any(F.col("counts")).alias("declared_any"))
    suffixes = table("suffix").select("suffix", given(F.col("counts")).alias("suffix_log"), given_any(F.col("counts")).alias("suffix_any"))
    out = rows
    for key, right in (("host", hosts), ("lang", declared), ("suffix", suffixes)):
        out = spread_join(out, right, key)
    none = F.array_repeat(F.lit(0.0), size)
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    logs = add(add(add(F.col("likelihood"), F.coalesce("declared_log", none)), F.coalesce("suffix_log", none)), F.transform(F.coalesce("host_prior", overall), lambda p: F.log(p * (1 - UNKNOWN))))
    unknown = F.least("n_grams", F.lit(STRENGTH)) * F.lit(-math.log(GRAMS)) + F.coalesce("declared_any", F.lit(0.0)) + F.coalesce("suffix_any", F.lit(0.0)) + F.lit(math.log(UNKNOWN))
    out = out.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    best = F.array_position("logs", F.col("top")).cast("int")
    weight = F.aggregate("logs", F.exp(unknown - F.col("top")), lambda a, x: a + F.exp(x - F.col("top")))
    return out.withColumn("lang_id", F.element_at(constants(langs, "string"), best)).withColumn("posterior", F.lit(1.0) / weight)


def identify(docs: DataFrame, ws: Workspace, host: Column | None = None, domain: Column | None = None, suffix: Column | None = None, key: str = "doc_id") -> DataFrame:
    """One row for each document: key, declared, lang_id, posterior, kept.  docs: key, text, lang (declared)."""
    nothing = F.lit(None).cast("string")
    rows = docs.select(key, "text", "lang", *((nothing if c is None else c).alias(n) for n, c in (("host", host), ("domain", domain), ("suffix", suffix))))
    langs, model = text_model(rows, ws)
    if not langs:
        return docs.select(key, F.col("lang").alias("declared"), nothing.alias("lang_id"), F.lit(0.0).alias("posterior"), F.lit(False).alias("kept"))
    evidence = text_evidence(rows, langs, model, [key, "lang", "host", "domain", "suffix"]).withColumn("run", F.pmod(F.xxhash64(key), F.lit(RUNS)).cast("int"))
    kept = (F.col("n_grams") > 0) & (F.col("posterior") >= LEAST)
    return fuse(evidence, langs, ws).select(key, F.col("lang").alias("declared"), "lang_id", "posterior", kept.alias("kept"))


def source_parts(source: Column) -> dict[str, Column]:
    """A corpus' source as a host; its name without digits is the domain that it shares with others like it."""
    return {"host": source, "domain": F.regexp_replace(source, "[0-9]+", "")}


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(docs, Workspace(spark, "op8"), **source_parts(docs["source"]))


def pages_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for raw web pages: the language that the markup declares, the address' suffix, its host and domain."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    lang = F.lower(F.regexp_extract("html", r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    body = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), r"<[^>]*>|&[a-z#0-9]+;", " ")
    host = F.lower(F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1))
    rows = pages.select("page_id", body.alias("text"), F.nullif(lang, F.lit("")).alias("lang"), F.nullif(host, F.lit("")).alias("host"))
    domain, suffix = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), F.regexp_extract("host", r"\.([^.]+)$", 1)
    return identify(rows, Workspace(spark, "pages_lang"), F.col("host"), domain, suffix, "page_id")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose language is not recognised, each by itself: rows may share a doc_id or have none."""
    ws, row = Workspace(spark, "lang"), one_fits(docs.columns, "_row")
    rows = numbered(docs, ws, row)
    kept = identify(rows, ws, **source_parts(rows["source"]), key=row).filter("kept").select(row)
    return rows.join(kept, row, "left_semi").select(*docs.columns)
