"""The pipeline against its stages by brute force, and the registration of queries."""

import importlib.util
import os

import pytest

from flowloom.llm.queries import QUERIES, SQL
from tests.llm.conftest import frame
from tests.llm.test_exact_and_jaccard import brute_components

corpus = pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="the pipeline is not here")


@corpus
def test_run(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    alive = [(r.doc_id, r.text) for r in docs]
    first = {}
    for i, t in alive:
        key = " ".join(t.split())
        first[key] = min(first.get(key, 1 << 62), i)
    alive = [(i, t) for i, t in alive if first[" ".join(t.split())] == i]
    keep = {c for i, _, c in brute_components(alive)}
    alive = {i for i, t in alive if i in keep and not any(x in t for x in items)}
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == alive


@corpus
def test_stages(spark, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"]
    frame(spark, []).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "x")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_by_number():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 11))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in os.listdir(sf):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{sf}/{t}'")
    got = QUERIES[name](spark, sf)
    want = con.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(want.fetchall())


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory can't be read here")
def test_driver_gives_memory_back(spark, ws):
    """What the driver's JVM freed outside its heap goes back to the system when a table is written."""

    def held():
        with open(f"/proc/{spark.sparkContext._gateway.proc.pid}/smaps_rollup") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("Pss_Anon")) // 1024

    ws.table(spark.range(10), "before")
    made = [spark._jvm.java.util.zip.Deflater() for _ in range(1200)]  # each takes a quarter of a MB there
    data = bytes(range(256)) * 1024
    for k, x in enumerate(made):
        x.setInput(data)
        x.deflate(bytearray(1))
        if k % 8:
            x.end()
    many = held()
    ws.table(spark.range(10), "after")
    few = held()
    for x in made[::8]:
        x.end()
    assert few < many - 40
