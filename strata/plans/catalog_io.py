"""Registered queries that exercise sources, sinks, snapshots and streams.

Each call works in a fresh folder under the shared root
(``spark.checkpoint.dir``), writes data derived from the driver tables, and
returns a DataFrame read back from what it wrote.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dedup as D
from ..operators import quality as Q
from ..session import scratch_path
from ..sources import files as FS
from ..sources import sync as S
from ..sources import versions as V
from ..streaming import events as ST
from .catalog import CUSTOMER_RULES, _CUSTOMER_CASE, register
from .ingest import ingest_dataset
from .tables import table

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


def _write_csv(df, path):
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


@register("dq_quarantine_roundtrip", f"""
SELECT *, {_CUSTOMER_CASE} AS dq_failed_rule, 'customer' AS dataset
FROM customer WHERE ({_CUSTOMER_CASE}) IS NOT NULL""")
def dq_quarantine_roundtrip(spark, d):
    path = scratch_path(spark, "quarantine")
    _, bad = Q.split(Q.tag(table(spark, d, "customer"), CUSTOMER_RULES))
    Q.write_quarantine(bad, path, "customer", "run-1")
    Q.write_quarantine(bad, path, "customer", "run-1")  # a retried run replaces its own partition
    return Q.read_quarantine(spark, path).drop(Q.TIMESTAMP_COL, "run_id")


@register("ingest_csv_roundtrip", """
SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'""")
def ingest_csv_roundtrip(spark, d):
    root = scratch_path(spark, "csv")
    cust = table(spark, d, "customer")
    # batch 1 carries within-file duplicates (hash partitioning keeps both
    # copies of a key in one file); batch 2 repeats a subset in other files
    _write_csv(cust.unionByName(cust.filter("c_nationkey = 1")).repartition("c_custkey"),
               f"{root}/batch1")
    _write_csv(cust.filter("c_mktsegment = 'BUILDING'"), f"{root}/batch2")
    df = FS.read_csv(spark, f"{root}/*", CUSTOMER_SCHEMA)
    df = D.drop_all_null_rows(D.drop_exact_duplicates(df, "file"))
    return df.drop("source_file")


@register("ingest_csv_dedup_all", "SELECT * FROM customer")
def ingest_csv_dedup_all(spark, d):
    root = scratch_path(spark, "csv")
    cust = table(spark, d, "customer")
    _write_csv(cust, f"{root}/batch1")
    _write_csv(cust.filter("c_mktsegment = 'BUILDING'"), f"{root}/batch2")
    df = FS.read_csv(spark, f"{root}/*", CUSTOMER_SCHEMA)
    return D.drop_exact_duplicates(df, "all").drop("source_file")


@register("manifest_incremental", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'crm' AS channel FROM customer""")
def manifest_incremental(spark, d):
    root = scratch_path(spark, "ingest")
    raw, bronze, manifest = f"{root}/raw", f"{root}/bronze", f"{root}/_manifest"
    cust = table(spark, d, "customer")
    _write_csv(cust.filter("c_nationkey < 12"), f"{raw}/customer_a")
    kw = dict(patterns=["customer"], schema=CUSTOMER_SCHEMA, bronze_path=bronze,
              manifest_path=manifest, channel="crm", load_date="2024-01-01")
    ingest_dataset(spark, raw, **kw)
    _write_csv(cust.filter("c_nationkey >= 12"), f"{raw}/customer_b")
    ingest_dataset(spark, raw, **kw)           # only the new files
    again = ingest_dataset(spark, raw, **kw)   # nothing new → writes nothing
    assert again == 0, "second run over the same files must be a no-op"
    return spark.read.parquet(bronze).drop("source_file", "load_date", "ingest_run")


# --------------------------------------------------------------------------
# Snapshot-versioned tables
# --------------------------------------------------------------------------
def _t(i: int) -> datetime:
    return datetime(2024, 1, 1, 0, 0, i)


def _orders_versions(spark, d):
    """v0 = finished orders, v1 = all orders, v2 = v1 + urgent orders again."""
    root = scratch_path(spark, "versions")
    o = table(spark, d, "orders")
    V.publish(o.filter("o_orderstatus = 'F'"), root, at=_t(0))
    V.publish(o, root, at=_t(1))
    V.publish(o.filter("o_orderpriority = '1-URGENT'"), root, mode="append", at=_t(2))
    return root


@register("snapshot_as_of", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def snapshot_as_of(spark, d):
    return V.read_as_of(spark, _orders_versions(spark, d), version=0)


@register("snapshot_as_of_time", "SELECT * FROM orders")
def snapshot_as_of_time(spark, d):
    return V.read_as_of(spark, _orders_versions(spark, d), timestamp="2024-01-01 00:00:01.500")


@register("snapshot_current", """
SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'""")
def snapshot_current(spark, d):
    return V.read_as_of(spark, _orders_versions(spark, d))


@register("snapshot_diff", """
SELECT *, 'added' AS change FROM orders WHERE o_orderstatus <> 'F'""")
def snapshot_diff(spark, d):
    return V.changes(spark, _orders_versions(spark, d), 0, 1)


@register("snapshot_restore", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def snapshot_restore(spark, d):
    root = _orders_versions(spark, d)
    V.restore(spark, root, version=0, at=_t(3))
    return V.read_as_of(spark, root)


@register("snapshot_history", """
SELECT * FROM (VALUES (0, '0', 'OVERWRITE'), (1, '1', 'OVERWRITE'), (2, '1,2', 'APPEND'),
                      (3, '0', 'RESTORE')) v(version, data_versions, operation)
JOIN (SELECT 0 AS version, count(*) AS num_rows FROM orders WHERE o_orderstatus = 'F'
      UNION ALL SELECT 1, count(*) FROM orders
      UNION ALL SELECT 2, (SELECT count(*) FROM orders) + count(*) FROM orders WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT 3, count(*) FROM orders WHERE o_orderstatus = 'F') c USING (version)""")
def snapshot_history(spark, d):
    root = _orders_versions(spark, d)
    V.restore(spark, root, version=0, at=_t(3))
    return V.history(spark, root).select(
        "version", F.array_join(F.col("data_versions").cast("array<string>"), ",").alias("data_versions"),
        "operation", "num_rows")


# --------------------------------------------------------------------------
# Serving sync
# --------------------------------------------------------------------------
@register("incremental_append", "SELECT * FROM orders")
def incremental_append(spark, d):
    target = scratch_path(spark, "extract")
    o = table(spark, d, "orders")
    split_key = o.agg(F.percentile_approx("o_orderkey", 0.5).alias("k")).first()["k"]
    S.incremental_append(o.filter(F.col("o_orderkey") <= split_key), target, "o_orderkey")
    # second sync sees the full source in a different column order: only
    # keys above the watermark are appended, by name
    S.incremental_append(o.select(*reversed(o.columns)), target, "o_orderkey")
    assert S.incremental_append(o, target, "o_orderkey") == 0
    return S.read_extract(spark, target)


@register("full_extract", "SELECT * FROM orders WHERE o_orderpriority = '2-HIGH'")
def full_extract(spark, d):
    root = _orders_versions(spark, d)
    out = scratch_path(spark, "extract")
    V.restore(spark, root, version=1, at=_t(3))
    S.full_extract(spark, root, out, where="o_orderpriority = '2-HIGH'")
    return S.read_extract(spark, out)


@register("partition_pruned_read", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'P'""")
def partition_pruned_read(spark, d):
    """A snapshot laid out by ``o_orderstatus``: the equality filter prunes
    to one ``o_orderstatus=P`` directory (PartitionFilters in the scan)."""
    root = scratch_path(spark, "versions")
    V.publish(table(spark, d, "orders"), root, partition_by=("o_orderstatus",), at=_t(0))
    return (V.read_as_of(spark, root).where(F.col("o_orderstatus") == "P")
            .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"))


@register("csv_infer_schema", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def csv_infer_schema(spark, d):
    root = scratch_path(spark, "csv")
    _write_csv(table(spark, d, "customer"), root)
    return FS.read_csv(spark, root, infer_schema=True, source_col=None)


# --------------------------------------------------------------------------
# Stream: events as JSON messages → parse → filter → idempotent sink
# --------------------------------------------------------------------------
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


@register("stream_parse_append", "SELECT * FROM events")
def stream_parse_append(spark, d):
    root = scratch_path(spark, "stream")
    src = ST.file_source(spark, d, table(spark, d, "events").schema, glob="events.parquet",
                         max_files_per_trigger=1)
    messages = ST.to_messages(src)
    parsed = ST.parse_messages(messages, EVENT_SCHEMA, key="event_id")
    for _ in range(2):  # the second run restarts from the checkpoint: nothing is re-delivered
        q = ST.start(parsed, f"{root}/sink", f"{root}/_checkpoint", available_now=True)
        q.awaitTermination()
    return ST.read_sink(spark, f"{root}/sink")


# --------------------------------------------------------------------------
# Inventory of raw files
# --------------------------------------------------------------------------
_RANGE = 4096


@register("raw_inventory", f"""
WITH f AS (SELECT c_nationkey, count(*) AS n_rows, string_agg(c_custkey || ';' || c_name || ';' || c_mktsegment || chr(10), '' ORDER BY c_custkey) AS t
  FROM customer GROUP BY c_nationkey),
r AS (SELECT c_nationkey, n_rows, t, unnest(generate_series(0, (strlen(t) - 1) // {_RANGE})) AS i FROM f)
SELECT c_nationkey, n_rows, strlen(t) AS size_bytes, count(*) AS n_ranges,
  md5(string_agg(md5(substr(t, 1 + {_RANGE} * i, {_RANGE})), '' ORDER BY i)) AS digest,
  CASE WHEN c_nationkey % 5 = 0 THEN 'pending' ELSE 'ingested' END AS status
FROM r GROUP BY c_nationkey, n_rows, t""")
def raw_inventory(spark, d):
    """The inventory of one text file per nation, cut into ranges of 4 KB: rows, size, digest and
    status.  Files of every fifth nation are not ingested yet, so their rows are counted apart."""
    root = scratch_path(spark, "inventory")
    line = F.concat_ws(";", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment").alias("value")
    (table(spark, d, "customer").select(line, "c_custkey", F.col("c_nationkey").alias("nation")).repartition("nation")
     .sortWithinPartitions("nation", "c_custkey").select("value", "nation").write.partitionBy("nation").text(root))
    rows = (spark.read.text(root).select(F.col("_metadata.file_path").alias("path"))
            .groupBy("path").agg(F.count(F.lit(1)).alias("n_rows")))
    nation = F.regexp_extract("path", "nation=(\\d+)", 1).cast("int")
    inv = FS.inventory(spark, root, ".txt", rows.filter(nation % 5 != 0), range_bytes=_RANGE)
    every = rows.select(FS.normalize_path("path").alias("path"), F.col("n_rows").alias("n"))
    return inv.join(every, "path").select(nation.alias("c_nationkey"), F.col("n").alias("n_rows"), "size_bytes", "n_ranges", "digest", "status")
