"""Registered queries for what the flow keeps besides its rows: key filters, schema
history, batch profiles, publish lags, dead letters, visit state, domains."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..operators import distinct as DI
from ..operators import marts as M
from ..operators import profile as P
from ..operators import quality as Q
from ..operators import segments as SG
from ..session import scratch_path
from ..sources import files as FS
from ..sources import key_index as KI
from ..sources import schema_drift as SD
from ..sources import versions as V
from ..streaming import events as ST
from . import batch_job
from . import healthcare as H
from .catalog import register
from .catalog_flow import _patients, _patients_sql
from .catalog_io import CUSTOMER_SCHEMA, EVENT_SCHEMA, _write_csv
from .ingest import ingest_dataset
from .tables import table

# --------------------------------------------------------------------------
# Natural keys over everything stored
# --------------------------------------------------------------------------
_KEY = "CASE WHEN c_custkey % 37 <> 0 THEN c_custkey % 1000 END"


@register("dedup_against_stored", f"""
WITH c AS (SELECT {_KEY} AS k, c_nationkey, c_acctbal, c_custkey FROM customer),
batches AS (SELECT 1 AS batch, k, c_nationkey, c_acctbal, c_custkey FROM c WHERE c_custkey % 3 = 0
  UNION ALL SELECT 2, k, c_nationkey, c_acctbal + 1, c_custkey FROM c WHERE c_custkey % 2 = 0
  UNION ALL SELECT 3, k, c_nationkey, c_acctbal + 2, c_custkey FROM c)
SELECT k, c_nationkey, round(c_acctbal, 2) AS c_acctbal, c_custkey, batch FROM batches WHERE k IS NULL
UNION ALL SELECT k, c_nationkey, round(c_acctbal, 2), c_custkey, batch FROM batches WHERE k IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY k, c_nationkey ORDER BY batch, round(c_acctbal, 2) DESC, c_custkey DESC) = 1""")
def dedup_against_stored(spark, d):
    """Three batches with repeats within and across them: a row per natural key, the first that came;
    rows without key all stay."""
    root, keys = scratch_path(spark, "keys"), [F.col("k"), F.col("c_nationkey")]
    c = table(spark, d, "customer").select(F.expr(_KEY).alias("k"), "c_nationkey", "c_acctbal", "c_custkey")
    for batch, where in ((1, "c_custkey % 3 = 0"), (2, "c_custkey % 2 = 0"), (3, "true")):
        new = c.filter(where).withColumn("c_acctbal", F.round(F.col("c_acctbal") + (batch - 1), 2))
        rows = KI.unseen(new, f"{root}/t", f"{root}/t_keys", keys)
        rows.withColumns({"load_date": F.lit("2024-01-01"), "ingest_run": F.lit(f"b{batch}")}).write.mode("append").partitionBy(
            "load_date", "ingest_run").parquet(f"{root}/t")
    stored = spark.read.parquet(f"{root}/t")
    return stored.select("k", "c_nationkey", "c_acctbal", "c_custkey", F.substring("ingest_run", 2, 1).cast("int").alias("batch"))


# --------------------------------------------------------------------------
# Batches: how soon published, how clean
# --------------------------------------------------------------------------
_FEED = "CASE WHEN event_type <> 'error' THEN event_type END"
_ARRIVALS = f"SELECT event_id, {_FEED} AS feed, ts FROM events WHERE event_id % 10 <> 0"
# one feed is never published, one publishes on even days only, each publish comes twice
_PUBLISHES = (f"SELECT {_FEED} AS feed, date_trunc('hour', ts) AS ts FROM events WHERE event_id % 10 = 0 "
              "AND event_type <> 'click' AND (event_type <> 'view' OR {day} % 2 = 0)")


def _followed(spark, d):
    e = table(spark, d, "events").withColumn("feed", F.expr(_FEED))
    arrivals = e.filter("event_id % 10 <> 0").select("event_id", "feed", "ts")
    pub = e.filter("event_id % 10 = 0 AND event_type <> 'click' AND (event_type <> 'view' OR day(ts) % 2 = 0)").select(
        "feed", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    return M.next_publish(arrivals, pub.drop("copy"), ["feed"], "ts")


_FOLLOWED_SQL = f"""
WITH a AS ({_ARRIVALS}), p AS ({_PUBLISHES.format(day="day(ts)")}), f AS (
SELECT event_id, feed, a.ts, (SELECT min(p.ts) FROM p WHERE p.feed IS NOT DISTINCT FROM a.feed AND p.ts >= a.ts) AS published_at FROM a)"""


@register("freshness_next_publish", _FOLLOWED_SQL + """
SELECT event_id, feed, published_at, round((epoch_us(published_at) - epoch_us(ts)) / 3600000000.0, 4) AS lag_hours FROM f""")
def freshness_next_publish(spark, d):
    """Every arrival with the next publish of its feed: late, doubled and missing publishes, a feed without name."""
    return _followed(spark, d).select("event_id", "feed", "published_at", "lag_hours")


@register("batch_success_rate", _FOLLOWED_SQL + """,
g AS (SELECT feed, published_at, round((epoch_us(published_at) - epoch_us(ts)) / 3600000000.0, 4) AS lag FROM f)
SELECT feed, count(*) AS n_batches, count(published_at) AS n_published,
  round(avg(CASE WHEN lag <= 6 THEN 1.0 ELSE 0.0 END), 4) AS success_rate, max(lag) AS max_lag_hours FROM g GROUP BY feed""")
def batch_success_rate(spark, d):
    return M.batch_success(_followed(spark, d), ["feed"], within_hours=6).drop("avg_lag_hours")


_ORDERS = ("SELECT strftime(o_orderdate, '%Y-%m') AS batch, strftime(o_orderdate, '%Y') AS y, o_custkey % 20 AS cust, o_orderpriority, "
           "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS status, o_totalprice < 20000 AS bad FROM orders")


def _profiles(spark, d):
    """Profiles of the monthly batches, written and read back: later figures come from them alone."""
    o = table(spark, d, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("batch"), (F.col("o_custkey") % 20).alias("cust"), "o_orderpriority",
        F.expr("CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END").alias("status"), (F.col("o_totalprice") < 20000).alias("bad"))
    path = scratch_path(spark, "profiles")
    P.batch_profile(o, ["batch"], ["cust", "o_orderpriority", "status"], F.col("bad")).write.parquet(path)
    return spark.read.parquet(path)


@register("quality_over_time", f"""
WITH o AS ({_ORDERS}), b AS (SELECT batch, y, count(*) AS n, count(DISTINCT (cust, o_orderpriority, coalesce(status, '?'))) AS different,
  count(*) FILTER (status IS NULL) AS nulls, count(*) FILTER (bad) AS bad FROM o GROUP BY batch, y),
r AS (SELECT y, count(*) AS n_batches, sum(n) AS n_rows, sum(bad) / sum(n) AS q, sum(nulls) / (3 * sum(n)) AS u, sum(n - different) / sum(n) AS r,
  avg(CASE WHEN n - different < 0.5 * n THEN 1.0 ELSE 0.0 END) AS s FROM b GROUP BY y)
SELECT y, n_batches, CAST(n_rows AS BIGINT) AS n_rows, round(s, 4) AS success_rate, round(q, 4) AS quarantine_rate, round(u, 4) AS null_rate,
  round(r, 4) AS duplicate_rate, round(0.3 * s + 0.3 * (1 - q) + 0.2 * (1 - u) + 0.2 * (1 - r), 4) AS quality_score FROM r""")
def quality_over_time(spark, d):
    """Yearly rates and score of monthly batches, rolled up from their stored profiles; a batch
    counts as good if fewer than half its rows repeat others."""
    p = _profiles(spark, d).withColumn("y", F.substring("batch", 1, 4))
    good = p.groupBy("y").agg(F.avg((F.col("n_rows") - F.col("n_different") < 0.5 * F.col("n_rows")).cast("double")).alias("s"))
    return P.score(P.rolled_up(p, ["y"]).join(good, "y"), F.col("s")).select(
        "y", "n_batches", "n_rows", "success_rate", "quarantine_rate", "null_rate", "duplicate_rate", "quality_score")


@register("null_rate_by_column", f"""
WITH o AS ({_ORDERS}) SELECT y, c AS "column", count(*) AS n_rows, count(*) FILTER (v IS NULL) AS n_nulls,
  round(count(*) FILTER (v IS NULL) / count(*), 4) AS null_rate, count(*) FILTER (v IS NULL) / count(*) > 0.05 AS flagged
FROM (SELECT y, unnest(['cust', 'o_orderpriority', 'status']) AS c, unnest([CAST(cust AS VARCHAR), o_orderpriority, status]) AS v FROM o) GROUP BY y, c""")
def null_rate_by_column(spark, d):
    return P.null_rates(_profiles(spark, d).withColumn("y", F.substring("batch", 1, 4)), ["y"])


@register("distinct_by_dimension", """
SELECT o_orderstatus, o_orderpriority, y, CAST(grouping(o_orderstatus) * 4 + grouping(o_orderpriority) * 2 + grouping(y) AS BIGINT) AS gid,
  count(*) AS n_rows, count(DISTINCT cust) AS customers, round(sum(o_totalprice), 2) AS total
FROM (SELECT o_orderstatus, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS y,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS cust, o_totalprice FROM orders)
GROUP BY GROUPING SETS ((), (o_orderstatus), (o_orderpriority), (y))""")
def distinct_by_dimension(spark, d):
    """Distinct customers overall and by three dimensions (NULLs in one, and in the customer) from bitmaps."""
    o = table(spark, d, "orders").select(
        "o_orderstatus", F.expr("CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END").alias("o_orderpriority"),
        F.year("o_orderdate").alias("y"), F.expr("CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END").alias("cust"), "o_totalprice")
    n = DI.distinct_by(o, ["o_orderstatus", "o_orderpriority", "y"], "cust", {"total": F.col("o_totalprice")}, out="customers")
    return n.withColumns({"total": F.round("total", 2), "gid": F.col("gid").cast("long")})


# --------------------------------------------------------------------------
# Raw files: schemas over time, cells that don't fit, cells with line breaks
# --------------------------------------------------------------------------
@register("schema_history", """
SELECT run, "column", change, old_type, new_type FROM (VALUES ('r2', 'c_phone', 'added', NULL, 'string'), ('r2', 'c_nationkey', 'widened', 'int', 'bigint'),
  ('r3', 'c_nationkey', 'narrowed', 'bigint', 'int'), ('r3', 'c_acctbal', 'retyped', 'double', 'string'), ('r3', 'c_mktsegment', 'removed', 'string', NULL),
  ('r4', 'c_acctbal', 'retyped', 'string', 'decimal(12,2)'), ('r5', 'c_acctbal', 'widened', 'decimal(12,2)', 'decimal(14,3)'))
  v(run, "column", change, old_type, new_type), (SELECT 1 FROM customer LIMIT 1)""")
def schema_history(spark, d):
    """Five runs of one table whose columns come, go, widen and narrow, each recorded as it is written."""
    path, c = scratch_path(spark, "schemas"), table(spark, d, "customer")
    more = c.withColumns({"c_phone": F.lit("-"), "c_nationkey": F.col("c_nationkey").cast("long")})
    text = more.withColumns({"c_nationkey": F.col("c_nationkey").cast("int"), "c_acctbal": F.col("c_acctbal").cast("string")}).drop("c_mktsegment")
    runs = [c, more, text, text.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)")),
            text.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(14,3)"))]
    for i, df in enumerate(runs, 1):
        SD.record(df, path, "customer", f"r{i}", datetime(2024, 1, i))
    return SD.history(SD.snapshots(spark, path)).drop("table", "at")


_CELLS_SQL = """
SELECT *, CASE WHEN c_custkey % 7 = 0 THEN 'n/a' WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS nation,
  CASE WHEN c_custkey % 9 = 0 THEN '2024-13-01' ELSE '2024-01-31' END AS day FROM customer"""


def _cells(spark, d):
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("key"),
                    F.concat(F.lit("line one\n\"line\", two "), "c_name").alias("note"),
                    F.expr("CASE WHEN c_custkey % 7 = 0 THEN 'n/a' WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS STRING) END").alias("nation"),
                    F.expr("CASE WHEN c_custkey % 9 = 0 THEN '2024-13-01' ELSE '2024-01-31' END").alias("day"))


_CELL_SCHEMA = T.StructType([T.StructField("key", T.LongType()), T.StructField("note", T.StringType()),
                             T.StructField("nation", T.IntegerType()), T.StructField("day", T.DateType())])


@register("csv_malformed_cells", f"""
SELECT c_custkey % 2 AS part, c AS "column", count(*) AS n_rows, count(*) FILTER (bad) AS n_malformed FROM (
  SELECT c_custkey, unnest(['key', 'nation', 'day']) AS c, unnest([false, coalesce(nation = 'n/a', false), day = '2024-13-01']) AS bad
  FROM ({_CELLS_SQL})) GROUP BY 1, 2""")
def csv_malformed_cells(spark, d):
    """Bad numbers and dates per file and column, in files whose notes hold line breaks and quotes."""
    root, cells = scratch_path(spark, "cells"), _cells(spark, d)
    for part in (0, 1):
        _write_csv(cells.filter(F.col("key") % 2 == part), f"{root}/part{part}")
    found = FS.malformed_cells(spark, f"{root}/part*", _CELL_SCHEMA, multiline=True)
    part = F.regexp_extract("path", "/part(\\d)/", 1).cast("long")
    return found.groupBy(part.alias("part"), "column").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_malformed").alias("n_malformed"))


@register("ingest_line_breaks", f"""
SELECT c_custkey AS key, CASE WHEN c_custkey % 2 = 0 THEN 'line one' || chr(10) || '"line", two ' || c_name ELSE c_name END AS note,
  CASE WHEN nation <> 'n/a' THEN CAST(nation AS INTEGER) END AS nation FROM ({_CELLS_SQL})""")
def ingest_line_breaks(spark, d):
    """Files with and without line breaks in cells, which the caller does not tell apart: no cell is cut."""
    root, cells = scratch_path(spark, "breaks"), _cells(spark, d)
    _write_csv(cells.filter("key % 2 = 0"), f"{root}/raw/cells_a")
    _write_csv(cells.filter("key % 2 = 1").withColumn("note", F.substring_index("note", "two ", -1)), f"{root}/raw/cells_b")
    ingest_dataset(spark, f"{root}/raw", ["cells"], _CELL_SCHEMA, f"{root}/bronze", f"{root}/manifest", "c", "2024-01-01")
    return spark.read.parquet(f"{root}/bronze").select("key", "note", "nation")


@register("ingest_inventory", """
SELECT 'customer_' || (c_nationkey % 3) AS source, 'SUCCESS' AS status, count(*) AS row_count FROM customer WHERE c_nationkey % 3 < 2 GROUP BY c_nationkey % 3
UNION ALL SELECT 'customer_2', 'FAILED', NULL FROM (SELECT 1 FROM customer LIMIT 1)""")
def ingest_inventory(spark, d):
    """What two runs that ended and one that failed (its header does not fit) leave in the inventory."""
    root, c = scratch_path(spark, "runs"), table(spark, d, "customer")
    for i in range(3):
        rows = c.filter(f"c_nationkey % 3 = {i}")
        _write_csv(rows if i < 2 else rows.withColumnRenamed("c_name", "label"), f"{root}/raw/customer_{i}")
        try:
            ingest_dataset(spark, f"{root}/raw", ["customer"], CUSTOMER_SCHEMA, f"{root}/bronze", f"{root}/manifest", "crm", "2024-01-01",
                           inventory_path=f"{root}/inventory", schema_path=f"{root}/schemas")
        except Exception:
            if i < 2:
                raise
    inv = spark.read.parquet(f"{root}/inventory")
    return inv.groupBy(F.regexp_extract("path", "(customer_\\d)", 1).alias("source"), "status").agg(F.sum("row_count").alias("row_count"))


# --------------------------------------------------------------------------
# Stream, visit state, pruning by a joined list
# --------------------------------------------------------------------------
@register("stream_dead_letters", """
SELECT CASE WHEN event_id % 8 = 1 THEN 'unparsable' WHEN event_id % 8 = 2 THEN 'no_key' WHEN event_id % 8 = 3 THEN 'empty' ELSE 'row' END AS kind,
  count(*) AS n, CAST(sum(CASE WHEN event_id % 8 NOT IN (1, 2, 3) THEN event_id END) AS BIGINT) AS ids FROM events GROUP BY 1""")
def stream_dead_letters(spark, d):
    """Rows and dead letters of one stream, restarted once: every message in one place."""
    root = scratch_path(spark, "dead")
    src = ST.file_source(spark, d, table(spark, d, "events").schema, glob="events.parquet", max_files_per_trigger=1)
    keyless = src.withColumn("__k", F.col("event_id")).withColumn("event_id", F.when(F.col("__k") % 8 != 2, F.col("__k")))
    value = F.to_json(F.struct(*EVENT_SCHEMA.names), ST.JSON_OPTIONS)
    raw = keyless.select(F.when(F.col("__k") % 8 == 1, F.concat(F.lit("x"), value)).when(F.col("__k") % 8 == 3, F.lit(" ")).otherwise(value).alias("value"))
    for _ in range(2):
        ST.start_with_dead_letters(ST.split_messages(raw, EVENT_SCHEMA, "event_id"), f"{root}/sink", f"{root}/checkpoint",
                                   available_now=True).awaitTermination()
    dead = ST.read_dead_letters(spark, f"{root}/sink").groupBy(F.col("reason").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    rows = ST.read_rows(spark, f"{root}/sink").agg(F.lit("row").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
    return dead.withColumn("ids", F.lit(None).cast("long")).unionByName(rows)


@register("retention_incremental", """
WITH v AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders), f AS (SELECT o_custkey, min(d) AS first_visit FROM v GROUP BY 1)
SELECT f.o_custkey, first_visit, CAST(date_trunc('month', first_visit) AS DATE) AS cohort_month,
  max(CASE WHEN d - first_visit BETWEEN 1 AND 30 THEN 1 ELSE 0 END) AS retained_30,
  max(CASE WHEN d - first_visit BETWEEN 1 AND 60 THEN 1 ELSE 0 END) AS retained_60,
  max(CASE WHEN d - first_visit BETWEEN 1 AND 90 THEN 1 ELSE 0 END) AS retained_90
FROM f JOIN v USING (o_custkey) GROUP BY 1, 2, 3""")
def retention_incremental(spark, d):
    """Visit state kept up to date over four batches, the last one of late days, without reading a visit again."""
    o, path = table(spark, d, "orders"), scratch_path(spark, "state")
    late = F.col("o_orderkey") % 6 == 0
    parts = [~late & (F.year("o_orderdate") < 1995), ~late & (F.year("o_orderdate").between(1995, 1997)), ~late & (F.year("o_orderdate") > 1997), late]
    for i, part in enumerate(parts):
        new = SG.visit_state(o.filter(part), "o_custkey", "o_orderdate")
        state = new if i == 0 else SG.merge_visit_state(spark.read.parquet(f"{path}/{i - 1}"), new, "o_custkey")
        state.write.parquet(f"{path}/{i}")
    return SG.flags_of_state(spark.read.parquet(f"{path}/{len(parts) - 1}"))


@register("partition_pruned_join", """
SELECT o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_orderpriority IN (SELECT o_orderpriority FROM orders GROUP BY 1 HAVING min(o_orderkey) % 2 = 0) GROUP BY 1""")
def partition_pruned_join(spark, d):
    """Orders laid out by priority, joined with a list of priorities known only when it runs: the
    scan reads the partitions on the list (dynamic pruning)."""
    root, o = scratch_path(spark, "by-priority"), table(spark, d, "orders")
    o.groupBy("o_orderpriority").agg((F.min("o_orderkey") % 2).alias("parity")).write.parquet(f"{root}/list")
    V.publish(o, f"{root}/orders", partition_by=("o_orderpriority",), at=datetime(2024, 1, 1))
    wanted = spark.read.parquet(f"{root}/list").where("parity = 0").select("o_orderpriority")
    return (V.read_as_of(spark, f"{root}/orders").join(wanted, "o_orderpriority").groupBy("o_orderpriority")
            .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total")))


# --------------------------------------------------------------------------
# The flow: rule sets, marts, domains, the whole job
# --------------------------------------------------------------------------
_INSURANCE = {"age": "CASE WHEN p_partkey % 17 <> 0 THEN p_size * 3 - 4 END", "bmi": "CASE WHEN p_partkey % 19 <> 0 THEN p_size % 40 END",
              "charges": "CASE WHEN p_partkey % 23 <> 0 THEN p_retailprice - 950 END"}
_LAB = {"age": "CASE WHEN p_partkey % 13 <> 0 THEN p_size * 3 - 4 END", "glucose": "p_partkey % 200", "bmi": "p_partkey % 45"}
_VISIT = {"patientid": "CASE WHEN p_partkey % 11 <> 0 THEN p_partkey END", "age": "CASE WHEN p_partkey % 13 <> 0 THEN p_size - 3 END"}


def _select(cols: dict) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in cols.items())


@register("flow_channel_rules", f"""
SELECT 'insurance' AS dataset, p_partkey, CASE WHEN age IS NULL THEN 'null_age' WHEN age < 0 OR age > 115 THEN 'invalid_age'
  WHEN bmi <= 0 THEN 'invalid_bmi' WHEN charges <= 0 THEN 'invalid_charges' END AS dq_failed_rule FROM (SELECT p_partkey, {_select(_INSURANCE)} FROM part)
UNION ALL SELECT 'diabetes', p_partkey, CASE WHEN age IS NULL THEN 'null_age' WHEN age < 0 OR age > 115 THEN 'invalid_age'
  WHEN glucose = 0 THEN 'zero_glucose' WHEN bmi = 0 THEN 'zero_bmi' END FROM (SELECT p_partkey, {_select(_LAB)} FROM part)
UNION ALL SELECT 'noshows', p_partkey, CASE WHEN patientid IS NULL THEN 'null_patientid' WHEN age IS NULL THEN 'null_age'
  WHEN age < 0 THEN 'negative_age' END FROM (SELECT p_partkey, {_select(_VISIT)} FROM part)""")
def flow_channel_rules(spark, d):
    """The rule sets of the three optional channels on rows that break each of them."""
    part, out = table(spark, d, "part"), None
    for ds, cols in (("insurance", _INSURANCE), ("diabetes", _LAB), ("noshows", _VISIT)):
        rows = part.select("p_partkey", *[F.expr(e).alias(n) for n, e in cols.items()])
        tagged = Q.tag(rows, H.RULES[ds]).select(F.lit(ds).alias("dataset"), "p_partkey", "dq_failed_rule")
        out = tagged if out is None else out.unionByName(tagged)
    return out


@register("mart_patient_mix", f"""
WITH p AS ({_patients_sql()})
SELECT 'provider' AS mix, insurance_provider AS value, count(*) AS visits, round(avg(billing_amount), 2) AS avg_billing, NULL AS share FROM p GROUP BY 2
UNION ALL SELECT 'condition', medical_condition, count(*), NULL, round(count(*) / sum(count(*)) OVER (), 4) FROM p GROUP BY 2
UNION ALL SELECT 'admission', gender, count(*), NULL, round(count(*) / sum(count(*)) OVER (), 4) FROM p GROUP BY 2""")
def mart_patient_mix(spark, d):
    """Billing by hospital and two of the mixes, on the customers as patients."""
    p = _patients(spark, d).withColumns({"hospital": F.col("insurance_provider"), "admission_type": F.col("gender"), "test_results": F.col("gender")})
    m = H.mart_patient_mix(p)
    none = F.lit(None).cast("double")
    return (m["billing_by_hospital"].select(F.lit("provider").alias("mix"), F.col("hospital").alias("value"), "visits", "avg_billing", none.alias("share"))
            .unionByName(m["condition_prevalence"].select(F.lit("condition").alias("mix"), F.col("medical_condition").alias("value"), "visits", none.alias("avg_billing"), "share"))
            .unionByName(m["admission_mix"].select(F.lit("admission").alias("mix"), F.col("admission_type").alias("value"), "visits", none.alias("avg_billing"), "share")))


_COHORT = {"age": "CASE WHEN p_partkey % 13 <> 0 THEN p_size * 2 END", "glucose": "CASE WHEN p_partkey % 6 <> 0 THEN p_size * 4 END",
           "bmi": "CASE WHEN p_partkey % 7 <> 0 THEN 15 + p_size % 25 END", "outcome": "p_partkey % 2"}


@register("mart_diabetes_cohort", f"""
WITH p AS (SELECT {_select(_COHORT)} FROM part)
SELECT 'status' AS measure, CASE WHEN glucose IS NULL THEN 'Unknown' WHEN glucose < 100 THEN 'Normal' WHEN glucose < 126 THEN 'Prediabetes' ELSE 'Diabetes' END AS value,
  round(count(*) / sum(count(*)) OVER (), 4) AS x FROM p GROUP BY 2
UNION ALL SELECT 'prevalence', 'all', round(avg(CASE WHEN outcome = 1 THEN 1.0 ELSE 0.0 END), 4) FROM p
UNION ALL SELECT 'glucose', CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 18 THEN '0-17' WHEN age < 36 THEN '18-35' WHEN age < 56 THEN '36-55'
  WHEN age < 71 THEN '56-70' ELSE '71+' END, round(avg(glucose), 2) FROM p GROUP BY 2""")
def mart_diabetes_cohort(spark, d):
    m = H.mart_diabetes_cohort(table(spark, d, "part").select(*[F.expr(e).alias(n) for n, e in _COHORT.items()]))
    return (m["status_distribution"].select(F.lit("status").alias("measure"), F.col("glucose_status").alias("value"), F.col("share").alias("x"))
            .unionByName(m["prevalence"].select(F.lit("prevalence").alias("measure"), F.lit("all").alias("value"), F.col("prevalence").alias("x")))
            .unionByName(m["glucose_by_age_group"].select(F.lit("glucose").alias("measure"), F.col("age_group").alias("value"), F.col("avg_glucose").alias("x"))))


def _csv_sources(spark, d, raw):
    """The flow's four CSV files from customers, parts and orders, with faults of every kind."""
    p = _patients(spark, d)
    patients = p.select(
        F.col("name").alias("Name"), F.col("age").alias("Age"), F.col("gender").alias("Gender"), F.lit("A+").alias("Blood Type"),
        F.col("medical_condition").alias("Medical Condition"), F.col("date_of_admission").alias("Date of Admission"),
        F.concat(F.lit("Dr. "), F.col("c_custkey").cast("string")).alias("Doctor"), F.lit("St. Mary").alias("Hospital"),
        F.col("insurance_provider").alias("Insurance Provider"), F.col("billing_amount").alias("Billing Amount"),
        F.lit(1).alias("Room Number"), F.lit("Urgent").alias("Admission Type"), F.col("discharge_date").alias("Discharge Date"),
        F.lit("x").alias("Medication"), F.lit("Normal").alias("Test Results"))
    part = table(spark, d, "part")
    ins = part.select(F.expr(_INSURANCE["age"]).alias("age"), F.expr("CASE WHEN p_partkey % 2 = 0 THEN 'male' ELSE 'female' END").alias("sex"),
                      F.expr(_INSURANCE["bmi"]).cast("double").alias("bmi"), F.col("p_partkey").cast("int").alias("children"), F.lit("no").alias("smoker"),
                      F.lit("n").alias("region"), F.expr(_INSURANCE["charges"]).alias("charges"))
    o = table(spark, d, "orders")
    visits = o.select(
        F.expr("CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey AS DOUBLE) END").alias("PatientId"), F.col("o_orderkey").cast("int").alias("AppointmentID"),
        F.lit("F").alias("Gender"), F.col("o_orderdate").cast("date").alias("ScheduledDay"),
        F.expr("date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 20 - 3 AS INT))").alias("AppointmentDay"),
        F.expr("CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey % 97 AS INT) - 2 END").alias("Age"), F.lit("x").alias("Neighbourhood"),
        F.expr("o_orderkey % 4 = 0").alias("Scholarship"), F.lit(False).alias("Hipertension"), F.lit(False).alias("Diabetes"), F.lit(False).alias("Alcoholism"),
        F.lit(False).alias("Handcap"), F.expr("o_orderkey % 3 = 0").alias("SMS_received"), F.expr("o_orderkey % 5 <> 0").alias("Showed_up"), F.lit(1).alias("Date.diff"))
    lab = part.select(
        F.col("p_partkey").cast("int").alias("Id"), F.lit(0).alias("Pregnancies"), F.expr("CAST(p_partkey % 200 AS INT)").alias("Glucose"), F.lit(70).alias("BloodPressure"),
        F.lit(1).alias("SkinThickness"), F.lit(0).alias("Insulin"), F.expr("CAST(p_partkey % 45 AS DOUBLE)").alias("BMI"), F.lit(0.5).alias("DiabetesPedigreeFunction"),
        F.expr(_LAB["age"]).alias("Age"), F.expr("CAST(p_partkey % 2 AS INT)").alias("Outcome"))
    for name, df in (("patients", patients), ("insurance", ins), ("noshows", visits), ("diabetes", lab)):
        _write_csv(df, f"{raw}/{name}")


_GOOD_PATIENTS = f"""SELECT * FROM ({_patients_sql()}) WHERE NOT (age IS NULL OR coalesce(age < 0 OR age > 115, false) OR name IS NULL OR trim(name) = ''
  OR coalesce(billing_amount <= 0, false) OR coalesce(discharge_date < date_of_admission, false))"""
_GOOD_VISITS = "SELECT * FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 97 >= 2"


@register("flow_batch_job", f"""
WITH i AS (SELECT p_partkey, {_select(_INSURANCE)} FROM part), l AS (SELECT {_select(_LAB)} FROM part)
SELECT 'bronze.patients' AS dataset, count(*) AS n_rows FROM customer
UNION ALL SELECT 'bronze.insurance', count(*) FROM part UNION ALL SELECT 'bronze.noshows', count(*) FROM orders
UNION ALL SELECT 'quarantine', (SELECT count(*) FROM customer) - (SELECT count(*) FROM ({_GOOD_PATIENTS})) + (SELECT count(*) FROM orders)
  - (SELECT count(*) FROM ({_GOOD_VISITS})) + (SELECT count(*) FROM i WHERE age IS NULL OR age < 0 OR age > 115 OR bmi <= 0 OR charges <= 0)
  + (SELECT count(*) FROM l WHERE age IS NULL OR age < 0 OR age > 115 OR glucose = 0 OR bmi = 0)
UNION ALL SELECT 'silver', count(*) FROM ({_GOOD_PATIENTS}) UNION ALL SELECT 'gold.kpi_cost_by_gender', count(DISTINCT gender) FROM ({_GOOD_PATIENTS})
UNION ALL SELECT 'gold.kpi_cost_by_condition', count(DISTINCT coalesce(medical_condition, '?')) FROM ({_GOOD_PATIENTS})""")
def flow_batch_job(spark, d):
    """The batch command, layer by layer and silver twice, over CSV files with faults: rows of each layer."""
    root = scratch_path(spark, "job")
    _csv_sources(spark, d, f"{root}/raw")
    for mode in ("bronze", "silver", "silver", "gold"):
        status = batch_job.main(["--mode", mode, "--raw", f"{root}/raw", "--lake", f"{root}/lake", "--load-date", "2024-02-01"])
        assert status == 0, mode
    names = ["bronze.patients", "bronze.insurance", "bronze.noshows", "quarantine", "silver", "gold.kpi_cost_by_gender", "gold.kpi_cost_by_condition"]
    return H.layer_report(spark, H.Lake(f"{root}/lake")).filter(F.col("dataset").isin(names)).select("dataset", "n_rows")


@register("flow_domains", f"""
SELECT 'inpatient' AS domain, count(*) AS n_rows, CAST(sum(discharge_date - date_of_admission) AS BIGINT) AS days,
  count(*) FILTER (medical_condition IN ('Diabetes', 'Hypertension', 'Arthritis', 'Asthma')) AS flagged, 0 AS text_ids FROM ({_GOOD_PATIENTS})
UNION ALL SELECT 'outpatient', count(*), CAST(sum(o_orderkey % 20 - 3) AS BIGINT),
  count(*) FILTER (o_orderkey % 20 - 3 > 7 AND o_orderkey % 3 <> 0 AND o_orderkey % 4 = 0), count(*) FROM ({_GOOD_VISITS})""")
def flow_domains(spark, d):
    """Both silver domains, published together from one pass over each bronze table, cleaned and enriched."""
    root = scratch_path(spark, "domains")
    _csv_sources(spark, d, f"{root}/raw")
    lake = H.Lake(f"{root}/lake")
    H.run_bronze(spark, f"{root}/raw", lake, "2024-02-01", records=False)
    H.run_domains(spark, lake, "2024-02-01", "r")
    inn, out = H.read_domain(spark, lake, "inpatient"), H.read_domain(spark, lake, "outpatient")
    n = F.count(F.lit(1)).alias("n_rows")
    return (inn.agg(F.lit("inpatient").alias("domain"), n, F.sum("length_of_stay").alias("days"), F.count_if("is_chronic").alias("flagged"), F.lit(0).cast("long").alias("text_ids"))
            .unionByName(out.agg(F.lit("outpatient").alias("domain"), n, F.sum("lead_time").alias("days"), F.count_if("is_high_risk_noshow").alias("flagged"),
                                 F.count_if(F.col("patientid").rlike("^[0-9]+$")).alias("text_ids"))))


@register("quarantine_audit", """
SELECT c_custkey, 'negative' AS dq_failed_rule, TIMESTAMP '2024-03-01 12:30:00' AS dq_timestamp, 'customer' AS dataset, 'run-7' AS run_id
FROM customer WHERE c_acctbal < 0""")
def quarantine_audit(spark, d):
    """The audit columns of the quarantine, under a given time."""
    path = scratch_path(spark, "audit")
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    bad = Q.split(Q.tag(rows, [Q.Rule("negative", "c_acctbal < 0")]))[1].drop("c_acctbal")
    Q.write_quarantine(bad, path, "customer", "run-7", ts=datetime(2024, 3, 1, 12, 30))
    return Q.read_quarantine(spark, path).withColumn("dq_timestamp", F.col("dq_timestamp").cast("timestamp_ntz"))


@register("clean_channels", """
SELECT 'zero' AS kind, CAST(p_partkey AS VARCHAR) AS id, p_partkey % 5 = 0 AS flag FROM part
UNION ALL SELECT 'title', 'Bobby Jackson ' || c_custkey, NULL FROM customer
UNION ALL SELECT 'typo', CAST(o_orderkey * 1000000007 AS VARCHAR), o_orderkey % 2 = 0 FROM orders""")
def clean_channels(spark, d):
    """Bronze clean-up: zeros flagged and kept, names in title case, ids as plain text, typos in column names corrected."""
    lab = H.clean("diabetes", table(spark, d, "part").select("p_partkey", F.expr("p_partkey % 5").alias("insulin")))
    names = H.clean("patients", table(spark, d, "customer").select(F.concat(F.lit("bobby JacksOn "), F.col("c_custkey").cast("string")).alias("name")))
    visits = H.clean("noshows", table(spark, d, "orders").select((F.col("o_orderkey") * 1000000007).cast("double").alias("patientid"),
                                                                 (F.col("o_orderkey") % 2 == 0).alias("handcap")))
    none = F.lit(None).cast("boolean").alias("flag")
    return (lab.select(F.lit("zero").alias("kind"), F.col("p_partkey").cast("string").alias("id"), F.col("insulin_is_missing").alias("flag"))
            .unionByName(names.select(F.lit("title").alias("kind"), F.col("name").alias("id"), none))
            .unionByName(visits.select(F.lit("typo").alias("kind"), F.col("patientid").alias("id"), F.col("handicap").alias("flag"))))
