"""The data source in a session."""

import io
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.functions.scalar import ipv4_to_long, ipv4_to_string, protocol_to_name, protocol_to_number, try_ipv4_to_long, uuid_for_string
from flowloom.operators import aggregates
from flowloom.operators.aggregates import histogram_mode, truncated_mean
from flowloom.sources.api import flow_headers, flow_sql, flow_view, netflow5, netflow7, read_flows, register
from flowloom.sources.library import column
from flowloom.sources.predicate import eq, gt
from flowloom.streaming.flows import stream_flows
from flowloom.testing.flowgen import capture, header_v3, sample


def put(folder, name, raw):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(raw)
    return str(path)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("flows")
    put(root, "v5/a", capture(sample(5)))
    put(root, "v7/a", capture(sample(7), 7, True, 9))
    put(root, "v8/a", header_v3(8))
    for year, (low, high) in enumerate([(100, 199), (200, 299), (300, 399)]):
        secs = np.arange(low, high + 1)
        put(root, f"times/{year}", capture({"unix_secs": secs, "srcport": secs % 7}, capture=(low, high)))
    put(root, "times/none", capture({"unix_secs": np.array([250, 999])}, capture=None))
    put(root, "times/odd", capture({"unix_secs": np.array([350])}, capture=(9, 3)))
    put(root, "parted/day=1/kind=x/a", capture(sample(5, 3)))
    put(root, "parted/day=2/kind=y/a", capture(sample(5, 4)))
    put(root, "parted/day=2/kind=__HIVE_DEFAULT_PARTITION__/a", capture(sample(5, 5)))
    put(root, "mixed/a", capture(sample(5, 3)))
    put(root, "mixed/b", capture(sample(5, 3), little=True, level=1))
    (root / "none").mkdir()
    put(root, "bad/junk", b"nothing of the kind")
    put(root, "cut/a", capture(sample(5, 10))[:-10])
    put(root, "stream127/a", b"\xcf\x10\x01\x7f")
    return root


def test_golden_rows(spark, files):
    df = netflow5(spark, str(files / "v5"))
    assert df.count() == 1000 and len(df.columns) == 24 and not any(f.nullable is True and False for f in df.schema)
    r = df.filter("srcip = '0.0.1.1'").collect()[0]
    assert (r.dstip, r.srcport, r.dstport, r.octets, r.protocol) == ("255.255.1.1", 257, 1, 258, "UDP")


def test_inference_and_version_7(spark, files):
    df = read_flows(spark, str(files / "v7"))
    assert len(df.columns) == 26 and df.filter("srcport > 0 AND srcport <= 5").select("router_sc").orderBy("srcport").first()[0] == "0.0.0.1"
    assert netflow7(spark, str(files / "v7"), stringify="false").agg(F.max("router_sc")).first()[0] == 999


def test_plain_format_and_sql(spark, files):
    register(spark)
    assert spark.read.format("netflow").option("stringify", "false").load(str(files / "v5")).agg(F.sum("srcip")).first()[0] == 499500
    flow_view(spark, "flows_view", str(files / "v5"), version="5")
    assert spark.sql("SELECT count(*) FROM flows_view WHERE protocol = 'UDP'").first()[0] == 1000
    spark.sql(f"CREATE TEMPORARY TABLE flows_table USING netflow OPTIONS (path '{files / 'v5'}', version '5')")
    assert spark.sql("SELECT srcip FROM flows_table ORDER BY srcport LIMIT 1").first()[0] == "0.0.0.0"


def test_errors(spark, files):
    with pytest.raises(Exception, match="Path does not exist"):
        read_flows(spark, str(files / "nowhere")).count()
    with pytest.raises(Exception, match="Failed to find NetFlow interface"):
        read_flows(spark, str(files / "v5"), version="8").count()
    with pytest.raises(Exception, match="Expected version 5, got 8"):
        netflow5(spark, str(files / "v8")).collect()
    with pytest.raises(Exception, match="Expected version 7, got 5"):
        netflow7(spark, str(files / "v5")).collect()
    with pytest.raises(Exception, match="Wrong magic number.*file=|Wrong magic number"):
        netflow5(spark, str(files / "bad")).collect()
    with pytest.raises(Exception, match="Failed to infer version"):
        read_flows(spark, str(files / "bad")).count()
    with pytest.raises(Exception, match="Unsupported stream version 127"):
        netflow5(spark, str(files / "stream127")).collect()
    with pytest.raises(Exception, match="Failed to read record"):
        netflow5(spark, str(files / "cut")).collect()
    with pytest.raises(Exception, match="minimum buffer"):
        netflow5(spark, str(files / "v5"), buffer="1024").count()
    with pytest.raises(Exception, match="Write is not supported"):
        netflow5(spark, str(files / "v5")).write.format("netflow").mode("append").save(str(files / "out"))


def test_lenient(spark, files):
    for name, n in (("bad", 0), ("stream127", 0), ("cut", 9), ("v5", 1000)):
        assert netflow5(spark, str(files / name), ignoreCorruptFiles="true").count() == n
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "true")
    try:
        assert netflow5(spark, str(files / "cut")).count() == 9
    finally:
        spark.conf.unset("spark.sql.files.ignoreCorruptFiles")


def test_empty_folder_and_mixed(spark, files):
    assert read_flows(spark, str(files / "none")).count() == 0
    assert read_flows(spark, str(files / "mixed")).count() == 6
    assert read_flows(spark, [str(files / "mixed/a"), str(files / "v5/*")]).count() == 1003


def test_projection_and_split(spark, files):
    df = netflow5(spark, str(files / "v5"), columns=["dstport", "srcip"], stringify="false", splitSize="1k")
    assert df.columns == ["dstport", "srcip"] and df.agg(F.sum("srcip")).first()[0] == 499500
    assert df.rdd.getNumPartitions() == 63


FILTERS = [
    "srcip = '0.0.0.9'", "srcip != '0.0.0.9'", "srcip IN ('0.0.0.9', 'x')", "srcip NOT IN ('0.0.0.9', '000.0.0.8')", "NOT (srcip LIKE '0.0.%')", "srcip > '0.0.2'",
    "protocol != '6'", "protocol = 'udp'", "protocol != '17'", "srcport > 990 AND dstport < 100", "srcport = 5 OR dstport = 3", "srcport <=> 7", "srcip IS NULL", "tos > 250", "srcport > 70000", "NOT (srcport > 10)", "srcip = '1.2.3'",
]


@pytest.mark.parametrize("condition", FILTERS)
def test_pushdown_changes_nothing(spark, files, condition):
    path = str(files / "v5")
    plain = netflow5(spark, path).filter(condition).select("srcport").collect()
    assert sorted(netflow5(spark, path).filter(condition).select("srcport").collect()) == sorted(plain)
    assert sorted(netflow5(spark, path, predicate_pushdown="false").filter(condition).select("srcport").collect()) == sorted(plain)


def test_same_frame_filtered_twice(spark, files):
    df = netflow5(spark, str(files / "v5"))
    assert df.filter("srcport < 5").union(df.filter("srcport >= 995")).count() == 10


def test_frames_narrow(spark, files):
    """What select() and filter() ask for reaches the scan, and nothing else is decoded."""
    path = str(files / "v5")
    df = netflow5(spark, path, stringify="false")
    either = df.filter((F.col("srcport") == 3) | ~F.col("dstport").isin(65281, 65282) & (F.lit(10) > F.col("octets"))).select("srcip", "srcport")
    assert sorted(r.srcport for r in either.collect()) == [0, 3, 4, 5, 6, 7, 8]
    assert either.reading.columns == ("srcip", "srcport") and either.reading.where is not None
    assert netflow5(spark, path).select("srcip").reading.columns == ("srcip",)
    plan = df.select(F.col("srcport") + 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "srcport" in plan and "dstip" not in plan and "dstip" not in df.agg(F.max("srcport"))._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 1000 and df.filter("srcport < 9").count() == 9 and df.filter("srcport < 9").filter("octets > 5").select("srcport").count() == 4


def test_frames_are_dataframes(spark, files):
    """Columns of a frame, functions in Python, and unknown columns do what they do elsewhere."""
    df = netflow5(spark, str(files / "v5"), stringify="false")
    odd = F.udf(lambda x: x % 2 == 1, "boolean")
    assert df.filter(odd("srcport")).filter(df["srcport"] < 5).count() == 2
    assert df.select(df["srcport"], df.dstport).join(df.select(F.col("srcport").alias("other")), F.col("srcport") == F.col("other")).count() == 1000
    assert df.where("srcport = 5 OR srcport = 6").groupBy("protocol").count().first()["count"] == 2
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        df.filter("nowhere = 1")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        df.select("srcip").filter("srcport = 1")


def test_sql_narrows(spark, files):
    path = str(files / "v5")
    read_flows(spark, path, version="5").createOrReplaceTempView("whole")
    for query in (
        "SELECT srcip, count(*) AS n FROM {} WHERE srcport > 989 OR dstport = 65281 GROUP BY srcip ORDER BY srcip",
        "SELECT count(*) AS n FROM {}",
        "SELECT srcport + 1 AS x, protocol FROM {} WHERE protocol = 'UDP' AND octets < 4",
        "SELECT * FROM {} WHERE srcport = 7",
        "SELECT a.srcip, b.dstip FROM {0} AS a JOIN {0} AS b ON a.srcport = b.srcport WHERE a.octets < 5 AND b.packets > 2",
    ):
        got = flow_sql(spark, query.format("flows", "flows"), {"flows": path}, version="5")
        assert sorted(map(str, got.collect())) == sorted(map(str, spark.sql(query.format("whole", "whole")).collect()))
    plan = flow_sql(spark, "SELECT srcip FROM flows WHERE srcport = 7", {"flows": path}, version="5")._jdf.queryExecution().optimizedPlan().toString()
    assert "srcip" in plan and "octets" not in plan


def test_files_are_skipped_by_partition_columns(spark, files):
    df = netflow5(spark, str(files / "parted"))
    assert df.filter("day = 1").rdd.getNumPartitions() == 1 and df.filter("day = 1").count() == 3
    assert df.filter("day = 1 OR srcport = 2000").count() == 3
    assert df.filter("NOT day = 1").count() == 9


@pytest.mark.parametrize(("condition", "n"), [("unix_secs > 500", 1), ("unix_secs >= 250 AND unix_secs < 260", 11), ("unix_secs = 350", 2), ("unix_secs < 100", 0), ("unix_secs > 0", 303)])
def test_time_skipping(spark, files, condition, n):
    """Only files whose header has a time range that makes sense are skipped."""
    assert netflow5(spark, str(files / "times")).filter(condition).count() == n


def test_skipped_files_have_no_partition(spark, files):
    df = netflow5(spark, str(files / "times"), where=gt(column("unix_secs"), 299))
    assert df.rdd.getNumPartitions() == 3 and df.count() == 102


def test_where_with_or(spark, files):
    where = eq(column("srcport"), 3) | eq(column("dstport"), 65280)
    assert netflow5(spark, str(files / "v5"), where=where).count() == 2


def test_partition_folders(spark, files):
    path = str(files / "parted")
    df = netflow5(spark, path)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema][-2:] == [("day", "int"), ("kind", "string")]
    assert sorted((r.day, r.kind, r.n) for r in df.groupBy("day", "kind").agg(F.count(F.lit(1)).alias("n")).collect() if r.kind) == [(1, "x", 3), (2, "y", 4)]
    assert df.filter("kind IS NULL").count() == 5
    pruned = netflow5(spark, path).filter("day = 1")
    assert pruned.count() == 3 and netflow5(spark, path).filter("day > 1 AND kind = 'y'").count() == 4


def test_custom_provider(spark, files):
    df = read_flows(spark, str(files / "v5"), version="tests.own_provider", stringify="false")
    assert df.columns == ["source", "port"] and df.agg(F.sum("source")).first()[0] == 499500


def test_headers(spark, files):
    rows = {os.path.basename(os.path.dirname(r.path)): r for r in flow_headers(spark, [str(files / "v5"), str(files / "v7"), str(files / "bad")]).collect()}
    assert rows["v5"].comments == "flow-gen" and rows["v7"].little_endian and rows["v7"].is_compressed and not rows["bad"].is_valid


def test_stream(spark, files, tmp_path):
    put(tmp_path, "in/a", capture(sample(5, 5)))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def drain():
        q = stream_flows(spark, str(tmp_path / "in"), ["srcport"], stringify="false").writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
        q.awaitTermination()
        return spark.read.parquet(out).count()

    assert drain() == 5
    put(tmp_path, "in/b", capture(sample(5, 7)))
    assert drain() == 12 and drain() == 12


def test_stream_takes_late_files_of_earlier_times(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    put(tmp_path, "in/b", capture(sample(5, 5)))

    def drain():
        q = stream_flows(spark, str(tmp_path / "in"), ["srcport"], stringify="false").writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
        q.awaitTermination()
        return spark.read.parquet(out).count()

    assert drain() == 5
    put(tmp_path, "in/a", capture(sample(5, 7)))
    os.utime(tmp_path / "in/a", (1, 1))
    assert drain() == 12


def test_stretches_read_their_own_part(files, monkeypatch):
    """A stretch seeks, and reads no more than itself and the header."""
    from flowloom.sources import datasource

    class Counted(io.FileIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            Counted.taken += len(out)
            return out

    monkeypatch.setattr(datasource, "opened", lambda path: Counted(path))
    reader = datasource.FlowBatchReader(datasource.resolve({"path": str(files / "v5"), "version": "5", "splitSize": "6400", "buffer": "32k", "columns": "srcport"}))
    parts = reader.partitions()
    assert len(parts) == 10 and Counted.taken == 0
    rows = [sum(b.num_rows for b in reader.read(p)) for p in parts]
    assert rows == [100] * 10 and Counted.taken <= 64_000 + 10 * 100


def test_grouped_aggregates(spark):
    """Against the functions over arrays, for groups of all kinds."""
    import random

    rng = random.Random(4)
    groups = [[rng.randint(-20, 40) for _ in range(rng.choice([1, 2, 3, 9, 50]))] for _ in range(40)] + [[5] * 7, [-3] * 4, [0, 100], [-9, -1]]
    rows = spark.createDataFrame([(k if k else None, v) for k, g in enumerate(groups) for v in g], "k int, v int")
    arrays = rows.groupBy("k").agg(F.collect_list("v").alias("a"))
    for s in (0.3, 0.8, 1.0):
        assert sorted(map(str, aggregates.grouped_truncated_mean(rows, ["k"], "v", s).collect())) == sorted(map(str, arrays.select("k", truncated_mean("a", s).alias("mean")).collect()))
    assert sorted(map(str, aggregates.grouped_histogram_mode(rows, ["k"], "v").collect())) == sorted(map(str, arrays.select("k", histogram_mode("a").alias("mode")).collect()))


def test_functions(spark):
    df = spark.createDataFrame([(4294902759, "10.0.0.1", 17, "TCP", "a"), (None, None, None, None, None)], "n long, ip string, p short, name string, s string")
    r = df.select(ipv4_to_string("n"), ipv4_to_long("ip"), protocol_to_name("p"), protocol_to_number("name"), uuid_for_string("s"), try_ipv4_to_long(F.lit("1.2.x.3"))).collect()
    assert tuple(r[0]) == ("255.255.3.231", 167772161, "UDP", 6, "0cc175b9-c0f1-36a8-b1c3-99e269772661", None)
    assert tuple(r[1])[1:5] == (None, None, None, None)
    for bad, f in (("1.2.3", ipv4_to_long), ("udp", protocol_to_number)):
        with pytest.raises(Exception, match="Invalid IPv4|Failed to convert"):
            spark.range(1).select(f(F.lit(bad))).collect()


def test_aggregates(spark):
    df = spark.createDataFrame([([7, 8, 8, 9, 30, 31, 60],), ([4, 9],), ([6],), ([-9, -2, -7],), ([-3, 5, 6, 6],), (None,)], "a array<long>")
    assert [r[0] for r in df.select(histogram_mode("a")).collect()] == [9, 4, 6, 0, 6, None]
    even = df.select(histogram_mode("a", lambda low, high, n: F.lit(2)))
    assert [r[0] for r in even.collect()] == [31, 4, 6, 0, 6, None]
    some = spark.createDataFrame([([12, 3, 9, 6],), ([-8, -4, 2, 10],)], "a array<long>")
    assert [[r[0] for r in some.select(truncated_mean("a", s)).collect()] for s in (1.0, 0.75, 0.5)] == [[7, 0], [6, -2], [4, -6]]
    empty = spark.createDataFrame([([],)], "a array<long>")
    for f in (lambda a: truncated_mean(a, 0.5), histogram_mode):
        with pytest.raises(Exception, match="empty array"):
            empty.select(f("a")).collect()
    with pytest.raises(ValueError):
        truncated_mean("a", 0)
    with pytest.raises(ValueError):
        truncated_mean("a", 1.5)
