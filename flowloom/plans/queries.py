"""The named queries over flow captures, and the SQL over lineitem that each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowloom.functions.scalar import ipv4_to_long, ipv4_to_string, protocol_to_name, protocol_to_number, uuid_for_string
from flowloom.operators import aggregates, reports
from flowloom.sources.api import flow_headers, flow_sql, flow_view, netflow5, netflow7, read_flows
from flowloom.sources.convert import PROTOCOLS
from flowloom.sources.library import column
from flowloom.sources.predicate import eq, gt, is_in, lt
from flowloom.streaming.flows import drained

from .captures import COLUMNS, DERIVED, SQL_SECS, captures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

FLOWS = f"WITH flows AS (SELECT {DERIVED.format(secs=SQL_SECS)} FROM lineitem) "
ALL = ", ".join(COLUMNS)


def query(sql: str | None = None):
    """Registers a query by its function's name, with SQL over flows."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = FLOWS + sql
        return f

    return register


def raw(spark: SparkSession, sf_dir: str, layout: str = "v5", **options) -> DataFrame:
    """The captures with numbers as numbers."""
    return read_flows(spark, captures(spark, sf_dir, layout), stringify="false", **options)


def text(spark: SparkSession, sf_dir: str, layout: str = "v5", **options) -> DataFrame:
    """The captures with addresses and protocols as text."""
    return read_flows(spark, captures(spark, sf_dir, layout), **options)


def sql_ip(x: str) -> str:
    return f"concat_ws('.', CAST(({x} >> 24) & 255 AS VARCHAR), CAST(({x} >> 16) & 255 AS VARCHAR), CAST(({x} >> 8) & 255 AS VARCHAR), CAST({x} & 255 AS VARCHAR))"


SQL_PROTOCOL = "CASE protocol " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in PROTOCOLS.items()) + " ELSE CAST(protocol AS VARCHAR) END"
SHOWN = f"unix_secs, {sql_ip('srcip')} AS srcip, {sql_ip('dstip')} AS dstip, input, output, packets, octets, srcport, dstport, {SQL_PROTOCOL} AS protocol"


# Scans


def _scan(name: str, layout: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return raw(spark, sf_dir, layout, columns=COLUMNS)

    run.__name__ = name
    query(f"SELECT {ALL} FROM flows")(run)


for _name, _layout in (("scan_v5_raw", "v5"), ("scan_v7_raw", "v7"), ("scan_little_endian", "v5_little"), ("scan_compressed", "v5_zlib"), ("scan_stream_v1", "v5_stream1"), ("scan_v7_little_compressed", "v7_little_zlib")):
    _scan(_name, _layout)


@query(f"SELECT {SHOWN} FROM flows")
def scan_stringify(spark, sf_dir):
    return text(spark, sf_dir).select(*COLUMNS)


@query(f"SELECT {ALL} FROM flows")
def scan_split(spark, sf_dir):
    """Plain files divided on record boundaries."""
    return raw(spark, sf_dir, splitSize="64k", columns=COLUMNS)


@query(f"SELECT {ALL} FROM flows")
def scan_small_buffer(spark, sf_dir):
    return raw(spark, sf_dir, "v5_zlib", buffer="32k", columns=COLUMNS)


@query("SELECT unix_secs, unix_secs * 0 AS unix_nsecs, unix_secs * 0 AS sysuptime, unix_secs * 0 AS exaddr, srcip, dstip, unix_secs * 0 AS nexthop, input, output, packets, octets, unix_secs * 0 AS first_flow, unix_secs * 0 AS last_flow, srcport, dstport, protocol, "
       + ", ".join(f"CAST(0 AS SMALLINT) AS {c}" for c in ("tos", "tcp_flags", "flags", "engine_type", "engine_id", "src_mask", "dst_mask"))
       + ", CAST(0 AS INT) AS src_as, CAST(0 AS INT) AS dst_as, unix_secs * 0 AS router_sc FROM flows")
def scan_all_columns_v7(spark, sf_dir):
    return netflow7(spark, captures(spark, sf_dir, "v7"), stringify="false")


@query(f"SELECT {SHOWN} FROM flows ORDER BY unix_secs, srcip, dstip, srcport, octets LIMIT 10")
def sql_view_limit_ordered(spark, sf_dir):
    flow_view(spark, "ips", captures(spark, sf_dir), version="5")
    return spark.sql(f"SELECT {ALL} FROM ips ORDER BY unix_secs, srcip, dstip, srcport, octets LIMIT 10")


@query(f"SELECT {sql_ip('srcip')} AS srcip, count(*) AS n FROM flows WHERE dstport = 443 OR packets > 45 GROUP BY srcip")
def sql_narrowed(spark, sf_dir):
    """A query in SQL whose view reads three columns, and only the records that it wants."""
    return flow_sql(spark, "SELECT srcip, count(*) AS n FROM narrowed WHERE dstport = 443 OR packets > 45 GROUP BY srcip", {"narrowed": captures(spark, sf_dir)}, version="5")


@query("SELECT srcip, count(*) AS n FROM flows GROUP BY srcip")
def shortcut_v5(spark, sf_dir):
    return netflow5(spark, captures(spark, sf_dir), stringify="false").groupBy("srcip").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT srcip, count(*) AS n FROM flows GROUP BY srcip")
def shortcut_v7(spark, sf_dir):
    return netflow7(spark, captures(spark, sf_dir, "v7"), stringify="false").groupBy("srcip").agg(F.count(F.lit(1)).alias("n"))


# Projections and counts


@query("SELECT srcport, dstport FROM flows")
def project_pruned(spark, sf_dir):
    return raw(spark, sf_dir).select("srcport", "dstport")


@query("SELECT srcip, srcip AS srcip_again FROM flows")
def project_repeated(spark, sf_dir):
    df = raw(spark, sf_dir, columns=["srcip"])
    return df.select("srcip", F.col("srcip").alias("srcip_again"))


@query("SELECT count(*) AS n FROM flows")
def count_zero_columns(spark, sf_dir):
    return raw(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n FROM (SELECT DISTINCT srcip FROM flows)")
def distinct_srcip(spark, sf_dir):
    return raw(spark, sf_dir, columns=["srcip"]).distinct().agg(F.count(F.lit(1)).alias("n"))


# Filters above the source


def _filter(name: str, sql: str, condition: Callable[[], Column], shown: bool = False, pushdown: str = "true") -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = (text if shown else raw)(spark, sf_dir, predicate_pushdown=pushdown).select(*COLUMNS)
        return df.filter(condition())

    run.__name__ = name
    base = f"(SELECT {SHOWN} FROM flows)" if shown else "flows"
    query(f"SELECT {ALL} FROM {base} AS t WHERE {sql}")(run)


C = F.col
_MIDDLE = 878_000_000  # seconds: a day in 1997
for _row in (
    ("filter_eq", "dstport = 443", lambda: C("dstport") == 443),
    ("filter_ne", "dstport <> 443", lambda: C("dstport") != 443),
    ("filter_gt", "srcport > 40000", lambda: C("srcport") > 40000),
    ("filter_ge", "srcport >= 40000", lambda: C("srcport") >= 40000),
    ("filter_lt", "packets < 5", lambda: C("packets") < 5),
    ("filter_le", "packets <= 5", lambda: C("packets") <= 5),
    ("filter_in", "dstport IN (53, 80)", lambda: C("dstport").isin(53, 80)),
    ("filter_not_in", "dstport NOT IN (53, 80)", lambda: ~C("dstport").isin(53, 80)),
    ("filter_and", "dstport = 80 AND packets > 25 AND srcport < 30000", lambda: (C("dstport") == 80) & (C("packets") > 25) & (C("srcport") < 30000)),
    ("filter_or", "dstport = 80 OR packets > 45", lambda: (C("dstport") == 80) | (C("packets") > 45)),
    ("filter_nested_not", "NOT (dstport = 80 AND NOT packets > 25)", lambda: ~((C("dstport") == 80) & ~(C("packets") > 25))),
    ("filter_is_null", "srcip IS NULL", lambda: C("srcip").isNull()),
    ("filter_is_not_null", "srcip IS NOT NULL", lambda: C("srcip").isNotNull()),
    ("filter_null_safe_eq", "dstport IS NOT DISTINCT FROM 53", lambda: C("dstport").eqNullSafe(53)),
    ("filter_unsigned", "dstip > 3232240000", lambda: C("dstip") > 3232240000),
    ("filter_out_of_range", "srcport > 70000", lambda: C("srcport") > 70000),
    ("filter_time_skip", "unix_secs < 0", lambda: C("unix_secs") < 0),
    ("filter_time_partial", f"unix_secs > {_MIDDLE}", lambda: C("unix_secs") > _MIDDLE),
    ("filter_time_full", "unix_secs > 1", lambda: C("unix_secs") > 1),
    ("filter_time_and_port", f"unix_secs <= {_MIDDLE} AND dstport = 80", lambda: (C("unix_secs") <= _MIDDLE) & (C("dstport") == 80)),
):
    _filter(*_row)
for _row in (
    ("filter_like_prefix", "srcip LIKE '10.0.1%'", lambda: C("srcip").like("10.0.1%")),
    ("filter_not_like_prefix", "NOT (srcip LIKE '10.0.1%')", lambda: ~C("srcip").like("10.0.1%")),
    ("filter_contains", "contains(srcip, '.12.')", lambda: C("srcip").contains(".12.")),
    ("filter_ends_with", "srcip LIKE '%.7'", lambda: C("srcip").endswith(".7")),
    ("filter_ip_string_eq", "srcip = '10.0.0.33'", lambda: C("srcip") == "10.0.0.33"),
    ("filter_ip_string_in", "srcip IN ('10.0.0.33', '10.0.0.7', 'none')", lambda: C("srcip").isin("10.0.0.33", "10.0.0.7", "none")),
    ("filter_ip_string_range", "srcip > '10.0.2.0'", lambda: C("srcip") > "10.0.2.0"),
    ("filter_ip_not_canonical", "srcip <> '010.0.0.33'", lambda: C("srcip") != "010.0.0.33"),
    ("filter_ip_malformed", "srcip = '1.2.3'", lambda: C("srcip") == "1.2.3"),
    ("filter_protocol_name", "protocol = 'TCP'", lambda: C("protocol") == "TCP"),
    ("filter_protocol_unknown_literal", "protocol = 'udp'", lambda: C("protocol") == "udp"),
    ("filter_protocol_ne_number_string", "protocol <> '6'", lambda: C("protocol") != "6"),
    ("filter_protocol_number_string", "protocol = '200'", lambda: C("protocol") == "200"),
):
    _filter(*_row, shown=True)
_filter("filter_no_pushdown", "srcport > 40000 AND dstport = 53", lambda: (C("srcport") > 40000) & (C("dstport") == 53), pushdown="false")
_filter("filter_no_pushdown_text", "srcip = '10.0.0.33'", lambda: C("srcip") == "10.0.0.33", shown=True, pushdown="false")


# Predicates given to the source itself


@query(f"SELECT {ALL} FROM flows WHERE (dstport = 80 OR packets > 45) AND NOT srcport IN (31, 32, 33)")
def where_or_not_in(spark, sf_dir):
    where = (eq(column("dstport"), 80) | gt(column("packets"), 45)) & ~is_in(column("srcport"), [31, 32, 33])
    return raw(spark, sf_dir, columns=COLUMNS, where=where)


@query("SELECT srcport FROM flows WHERE octets < 2000")
def where_column_not_projected(spark, sf_dir):
    return raw(spark, sf_dir, columns=["srcport"], where=lt(column("octets"), 2000))


# Functions


@query(f"SELECT DISTINCT srcip, {sql_ip('srcip')} AS shown FROM flows")
def ipv4_to_string_column(spark, sf_dir):
    return raw(spark, sf_dir, columns=["srcip"]).distinct().select("srcip", ipv4_to_string("srcip").alias("shown"))


@query(f"SELECT DISTINCT {sql_ip('dstip')} AS shown, dstip AS number FROM flows")
def ipv4_to_long_column(spark, sf_dir):
    return text(spark, sf_dir, columns=["dstip"]).distinct().select(F.col("dstip").alias("shown"), ipv4_to_long("dstip").alias("number"))


@query(f"SELECT DISTINCT protocol, {SQL_PROTOCOL} AS name FROM flows")
def protocol_to_name_column(spark, sf_dir):
    return raw(spark, sf_dir, columns=["protocol"]).distinct().select("protocol", protocol_to_name("protocol").alias("name"))


@query(f"SELECT DISTINCT {SQL_PROTOCOL} AS name, protocol AS number FROM flows")
def protocol_to_number_column(spark, sf_dir):
    return text(spark, sf_dir, columns=["protocol"]).distinct().select(F.col("protocol").alias("name"), protocol_to_number("protocol").alias("number"))


_MD5 = f"md5({sql_ip('srcip')})"


@query(f"SELECT DISTINCT {sql_ip('srcip')} AS srcip, substr({_MD5}, 1, 8) || '-' || substr({_MD5}, 9, 4) || '-3' || substr({_MD5}, 14, 3) || '-' || "
       f"CASE substr({_MD5}, 17, 1) WHEN '0' THEN '8' WHEN '4' THEN '8' WHEN '8' THEN '8' WHEN 'c' THEN '8' WHEN '1' THEN '9' WHEN '5' THEN '9' WHEN '9' THEN '9' WHEN 'd' THEN '9' "
       f"WHEN '2' THEN 'a' WHEN '6' THEN 'a' WHEN 'a' THEN 'a' WHEN 'e' THEN 'a' ELSE 'b' END || substr({_MD5}, 18, 3) || '-' || substr({_MD5}, 21, 12) AS id FROM flows")
def uuid_for_string_column(spark, sf_dir):
    return text(spark, sf_dir, columns=["srcip"]).distinct().select("srcip", uuid_for_string("srcip").alias("id"))


# Aggregates


@query("SELECT srcip, dstip, srcport, dstport, count(*) AS count FROM flows WHERE srcport > 10 GROUP BY srcip, dstip, srcport, dstport")
def aggregated_report(spark, sf_dir):
    return reports.aggregated_report(raw(spark, sf_dir, columns=[*reports.FOUR, "packets", "octets"]))


@query("""SELECT dstport, output, CASE WHEN len(a) = 1 THEN a[1] ELSE
CAST(ceil((list_sum(a[1:CAST(floor(0.8 * len(a)) AS INT)]) // len(a)) / 0.8) AS BIGINT) END AS mean
FROM (SELECT dstport, output, list_sort(list(octets)) AS a FROM flows GROUP BY dstport, output)""")
def truncated_mean(spark, sf_dir):
    df = raw(spark, sf_dir, columns=["dstport", "output", "octets"])
    return aggregates.grouped_truncated_mean(df, ["dstport", "output"], "octets", 0.8)


@query("""SELECT dstport, output, CASE WHEN len(a) = 1 THEN a[1] ELSE
greatest(0, coalesce(list_max(list_reduce(list_transform(range(0, k), lambda b: list_filter(a, lambda e:
  e >= ceil((mx - mn) * CAST(b AS DOUBLE) / k) + mn AND e <= floor((mx - mn) * CAST(b + 1 AS DOUBLE) / k) + mn)),
  lambda x, y: CASE WHEN len(y) > len(x) THEN y ELSE x END)), 0)) END AS mode
FROM (SELECT dstport, output, list(packets) AS a, CAST(ceil(sqrt(count(*))) AS BIGINT) AS k, min(packets) AS mn, max(packets) AS mx FROM flows GROUP BY dstport, output)""")
def histogram_mode(spark, sf_dir):
    df = raw(spark, sf_dir, columns=["dstport", "output", "packets"])
    return aggregates.grouped_histogram_mode(df, ["dstport", "output"], "packets")


# Operators that come with Spark, over flows


@query("SELECT srcip, CAST(sum(octets) AS BIGINT) AS sum_octets, count(*) AS n_flows FROM flows GROUP BY srcip ORDER BY sum_octets DESC, srcip LIMIT 10")
def top_talkers(spark, sf_dir):
    return reports.top_talkers(raw(spark, sf_dir, columns=["srcip", "octets"]))


@query("SELECT dstport, protocol, CAST(sum(octets) AS BIGINT) AS octets, count(*) AS n FROM flows GROUP BY ROLLUP (dstport, protocol)")
def octets_rollup(spark, sf_dir):
    return raw(spark, sf_dir, columns=["dstport", "protocol", "octets"]).rollup("dstport", "protocol").agg(F.sum("octets").alias("octets"), F.count(F.lit(1)).alias("n"))


@query("SELECT dstport, protocol, CAST(sum(packets) AS BIGINT) AS packets FROM flows GROUP BY CUBE (dstport, protocol)")
def packets_cube(spark, sf_dir):
    return raw(spark, sf_dir, columns=["dstport", "protocol", "packets"]).cube("dstport", "protocol").agg(F.sum("packets").alias("packets"))


@query("SELECT s_name, CAST(sum(octets) AS BIGINT) AS octets FROM flows JOIN supplier ON output = s_suppkey GROUP BY s_name")
def flows_join_supplier(spark, sf_dir):
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    flows = raw(spark, sf_dir, columns=["output", "octets"])
    return flows.join(supplier, flows["output"] == supplier["s_suppkey"]).groupBy("s_name").agg(F.sum("octets").alias("octets"))


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT output FROM flows WHERE dstport = 53 AND packets > 49)")
def suppliers_anti_join(spark, sf_dir):
    flows = raw(spark, sf_dir, columns=["output", "dstport", "packets"]).filter("dstport = 53 AND packets > 49")
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey").join(flows, F.col("s_suppkey") == flows["output"], "left_anti")


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey IN (SELECT output FROM flows WHERE dstport = 53 AND packets > 49)")
def suppliers_semi_join(spark, sf_dir):
    flows = raw(spark, sf_dir, columns=["output", "dstport", "packets"]).filter("dstport = 53 AND packets > 49")
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey").join(flows, F.col("s_suppkey") == flows["output"], "left_semi")


@query("SELECT * FROM (SELECT dstport, srcip, srcport, octets, CAST(row_number() OVER (PARTITION BY dstport, protocol ORDER BY octets DESC, srcip, srcport, dstip) AS INT) AS rank FROM flows) WHERE rank <= 5")
def rank_by_octets(spark, sf_dir):
    df = raw(spark, sf_dir, columns=["dstport", "protocol", "srcip", "srcport", "dstip", "octets"])
    return reports.ranked(df, ["dstport", "protocol"], [F.desc("octets"), "srcip", "srcport", "dstip"], 5).select("dstport", "srcip", "srcport", "octets", "rank")


@query("SELECT srcip, srcport, octets, CAST(sum(octets) OVER (PARTITION BY srcip ORDER BY srcport, octets, dstip ROWS UNBOUNDED PRECEDING) AS BIGINT) AS so_far FROM flows")
def running_octets(spark, sf_dir):
    w = Window.partitionBy("srcip").orderBy("srcport", "octets", "dstip").rowsBetween(Window.unboundedPreceding, 0)
    return raw(spark, sf_dir, columns=["srcip", "srcport", "octets", "dstip"]).select("srcip", "srcport", "octets", F.sum("octets").over(w).alias("so_far"))


@query("SELECT srcip, octets FROM flows UNION ALL SELECT srcip, octets FROM flows")
def union_v5_v7(spark, sf_dir):
    columns = ["srcip", "octets"]
    return raw(spark, sf_dir, "v5", columns=columns).unionByName(raw(spark, sf_dir, "v7", columns=columns))


@query("SELECT srcip FROM flows WHERE dstport = 80 INTERSECT SELECT srcip FROM flows WHERE dstport = 53")
def intersect_srcip(spark, sf_dir):
    df = raw(spark, sf_dir, columns=["srcip", "dstport"])
    return df.filter("dstport = 80").select("srcip").intersect(df.filter("dstport = 53").select("srcip"))


@query("SELECT srcip FROM flows WHERE dstport = 80 EXCEPT SELECT srcip FROM flows WHERE dstport = 53")
def except_srcip(spark, sf_dir):
    df = raw(spark, sf_dir, columns=["srcip", "dstport"])
    return df.filter("dstport = 80").select("srcip").subtract(df.filter("dstport = 53").select("srcip"))


@query("SELECT protocol, CAST(sum(CASE WHEN dstport = 53 THEN octets END) AS BIGINT) AS p53, CAST(sum(CASE WHEN dstport = 80 THEN octets END) AS BIGINT) AS p80, CAST(sum(CASE WHEN dstport = 443 THEN octets END) AS BIGINT) AS p443 FROM flows GROUP BY protocol")
def pivot_ports(spark, sf_dir):
    df = raw(spark, sf_dir, columns=["protocol", "dstport", "octets"]).groupBy("protocol").pivot("dstport", [53, 80, 443]).agg(F.sum("octets"))
    return df.select("protocol", *(F.col(str(p)).alias(f"p{p}") for p in (53, 80, 443)))


# Headers, corrupt files, streams


@query("SELECT CAST(5 AS INT) AS flow_version, CAST(3 AS INT) AS stream_version, count(*) AS n_flows, min(unix_secs) AS first, max(unix_secs) AS last FROM flows")
def flow_headers_summary(spark, sf_dir):
    heads = flow_headers(spark, captures(spark, sf_dir))
    return heads.groupBy("flow_version", "stream_version").agg(F.sum("n_flows").alias("n_flows"), F.min("capture_start").alias("first"), F.max("capture_end").alias("last"))


@query()
def flow_headers_all(spark, sf_dir):
    return flow_headers(spark, captures(spark, sf_dir, "v7_little_zlib")).drop("path")


@query("SELECT dstport, count(*) AS n FROM flows GROUP BY dstport")
def lenient_scan(spark, sf_dir):
    """Whole files read alike when corrupt ones are tolerated; of corrupt ones see outcomes."""
    return raw(spark, sf_dir, "v5_zlib", columns=["dstport"], ignoreCorruptFiles="true").groupBy("dstport").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT dstport, count(*) AS n, CAST(sum(octets) AS BIGINT) AS octets FROM flows GROUP BY dstport")
def stream_ports(spark, sf_dir):
    """The same files as a stream, drained into a table."""
    return drained(spark, captures(spark, sf_dir), ["dstport", "octets"]).groupBy("dstport").agg(F.count(F.lit(1)).alias("n"), F.sum("octets").alias("octets"))
