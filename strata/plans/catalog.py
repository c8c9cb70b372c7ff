"""Registered queries over the driver tables.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame; the same
operators that run the healthcare medallion flow (``strata.plans.healthcare``)
are configured here with TPC-H-style column names.  ``ORACLE_SQL`` holds the
equivalent DuckDB SQL for each key (omitted where the operator is not
expressible in SQL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import aggregate as A
from ..operators import quality as Q
from ..operators.enrich import Channel, enrich
from .tables import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# --------------------------------------------------------------------------
# DQ gate on customer
# --------------------------------------------------------------------------
CUSTOMER_RULES = [
    Q.Rule("negative_balance", "c_acctbal < 0"),
    Q.Rule("high_balance", "c_acctbal > 9000"),
    Q.Rule("nation_zero", "c_nationkey = 0"),
]
_CUSTOMER_CASE = """CASE WHEN c_acctbal < 0 THEN 'negative_balance'
            WHEN c_acctbal > 9000 THEN 'high_balance'
            WHEN c_nationkey = 0 THEN 'nation_zero' END"""


@register("dq_tag_first_match", f"""
SELECT c_custkey, c_acctbal, c_nationkey, {_CUSTOMER_CASE} AS dq_failed_rule FROM customer""")
def dq_tag_first_match(spark: SparkSession, d: str) -> DataFrame:
    cust = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return Q.tag(cust, CUSTOMER_RULES)


@register("dq_good_rows", f"""
SELECT * FROM customer WHERE ({_CUSTOMER_CASE}) IS NULL""")
def dq_good_rows(spark, d):
    return Q.gate(table(spark, d, "customer"), CUSTOMER_RULES).good


@register("dq_breakdown", f"""
WITH t AS (SELECT coalesce({_CUSTOMER_CASE}, 'passed') AS rule FROM customer)
SELECT rule, count(*) AS n_rows, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct
FROM t GROUP BY rule""")
def dq_breakdown(spark, d):
    return Q.breakdown(Q.tag(table(spark, d, "customer"), CUSTOMER_RULES))


@register("dq_rule_counts_desc", f"""
SELECT rule, count(*) AS n_rows FROM (SELECT {_CUSTOMER_CASE} AS rule FROM customer)
WHERE rule IS NOT NULL GROUP BY rule ORDER BY n_rows DESC, rule""")
def dq_rule_counts_desc(spark, d):
    _, bad = Q.split(Q.tag(table(spark, d, "customer"), CUSTOMER_RULES))
    return Q.count_by_rule(bad)


# --------------------------------------------------------------------------
# Channel aggregates and the group-level enrichment (flagship)
# --------------------------------------------------------------------------
def _order_channel(spark, d, cust: DataFrame) -> Channel:
    # Eager aggregation: orders collapse to one partial (sum, count) per
    # customer before the join that attaches the peer-group keys, so the
    # join and the final shuffle carry #customers rows, not #orders rows.
    per_cust = (table(spark, d, "orders").groupBy("o_custkey")
                .agg(F.sum("o_totalprice").alias("_sum_price"), F.count(F.lit(1)).alias("_n")))
    keyed = per_cust.join(
        cust.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"), "o_custkey")
    return Channel("orders", keyed, ["c_nationkey", "c_mktsegment"],
                   [(F.sum("_sum_price") / F.sum("_n")).alias("avg_peer_order_price"),
                    F.sum("_n").alias("order_channel_size")])


def _supplier_channel(spark, d) -> Channel:
    return Channel("supplier", table(spark, d, "supplier"), ["c_nationkey"],
                   [F.avg("s_acctbal").alias("avg_supplier_acctbal"),
                    F.count(F.lit(1)).alias("supplier_channel_size")],
                   prepare=lambda df: df.withColumnRenamed("s_nationkey", "c_nationkey"))


def _event_channel(spark, d) -> Channel:
    return Channel("events", table(spark, d, "events"), ["c_custkey"],
                   [C.rate(F.col("event_type") == "error").alias("event_error_rate"),
                    F.avg("value").alias("avg_event_value"),
                    F.count(F.lit(1)).alias("event_channel_size")],
                   prepare=lambda df: df.withColumnRenamed("user_id", "c_custkey"))


def enriched_customers(spark, d) -> DataFrame:
    cust = table(spark, d, "customer")
    return enrich(cust, [_order_channel(spark, d, cust), _supplier_channel(spark, d),
                         _event_channel(spark, d)])


_ENRICH_CTES = """
WITH oc AS (
  SELECT c.c_nationkey, c.c_mktsegment, sum(o.o_totalprice) / count(*) AS avg_peer_order_price,
         count(*) AS order_channel_size
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey, c.c_mktsegment),
sc AS (SELECT s_nationkey AS c_nationkey, avg(s_acctbal) AS avg_supplier_acctbal,
              count(*) AS supplier_channel_size FROM supplier GROUP BY s_nationkey),
ec AS (SELECT user_id AS c_custkey,
              avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS event_error_rate,
              avg(value) AS avg_event_value, count(*) AS event_channel_size
       FROM events GROUP BY user_id),
enriched AS (
  SELECT * FROM customer LEFT JOIN oc USING (c_nationkey, c_mktsegment)
                         LEFT JOIN sc USING (c_nationkey)
                         LEFT JOIN ec USING (c_custkey))
"""


@register("enrich_profile", _ENRICH_CTES + """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal,
       round(avg_peer_order_price, 2) AS avg_peer_order_price, order_channel_size,
       round(avg_supplier_acctbal, 2) AS avg_supplier_acctbal, supplier_channel_size,
       round(event_error_rate, 4) AS event_error_rate, round(avg_event_value, 2) AS avg_event_value,
       event_channel_size
FROM enriched""")
def enrich_profile(spark, d):
    e = enriched_customers(spark, d)
    return e.select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal",
        F.round("avg_peer_order_price", 2).alias("avg_peer_order_price"), "order_channel_size",
        F.round("avg_supplier_acctbal", 2).alias("avg_supplier_acctbal"), "supplier_channel_size",
        F.round("event_error_rate", 4).alias("event_error_rate"),
        F.round("avg_event_value", 2).alias("avg_event_value"), "event_channel_size")


@register("channel_agg_two_key", """
SELECT c.c_nationkey, c.c_mktsegment, round(avg(o.o_totalprice), 2) AS avg_order_price,
       count(*) AS n_orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_nationkey, c.c_mktsegment""")
def channel_agg_two_key(spark, d):
    cust = table(spark, d, "customer")
    ch = _order_channel(spark, d, cust)
    return (ch.aggregate().select("c_nationkey", "c_mktsegment",
                                  F.round("avg_peer_order_price", 2).alias("avg_order_price"),
                                  F.col("order_channel_size").alias("n_orders")))


@register("channel_agg_rate", """
SELECT user_id, round(avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS error_rate,
       round(avg(CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS purchase_rate,
       round(avg(value), 2) AS avg_value, count(*) AS n_events
FROM events GROUP BY user_id""")
def channel_agg_rate(spark, d):
    ev = table(spark, d, "events")
    return ev.groupBy("user_id").agg(
        F.round(C.rate(F.col("event_type") == "error"), 4).alias("error_rate"),
        F.round(C.rate(F.col("event_type") == "purchase"), 4).alias("purchase_rate"),
        F.round(F.avg("value"), 2).alias("avg_value"),
        F.count(F.lit(1)).alias("n_events"))


# --------------------------------------------------------------------------
# Gold KPIs
# --------------------------------------------------------------------------
@register("kpi_cost_by_group", _ENRICH_CTES + """
SELECT c_mktsegment, round(avg(avg_peer_order_price), 2) AS avg_peer_order_price,
       round(avg(c_acctbal), 2) AS avg_acctbal
FROM enriched GROUP BY c_mktsegment""")
def kpi_cost_by_group(spark, d):
    return A.kpi(enriched_customers(spark, d), ["c_mktsegment"], {
        "avg_peer_order_price": F.round(F.avg("avg_peer_order_price"), 2),
        "avg_acctbal": F.round(F.avg("c_acctbal"), 2)})


@register("kpi_cost_by_condition", """
SELECT o_orderpriority, round(avg(o_totalprice), 2) AS avg_total_price, count(*) AS order_count
FROM orders GROUP BY o_orderpriority""")
def kpi_cost_by_condition(spark, d):
    return A.kpi(table(spark, d, "orders"), ["o_orderpriority"], {
        "avg_total_price": F.round(F.avg("o_totalprice"), 2),
        "order_count": F.count(F.lit(1))})


@register("kpi_two_key_count", """
SELECT l_returnflag, l_linestatus, count(*) AS n_rows FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def kpi_two_key_count(spark, d):
    return A.kpi(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"],
                 {"n_rows": F.count(F.lit(1))})


SIZE_EDGES = [10, 20, 30, 40]
SIZE_LABELS = ["01-09", "10-19", "20-29", "30-39", "40-50"]


@register("kpi_by_bucket", """
SELECT CASE WHEN p_size < 10 THEN '01-09' WHEN p_size < 20 THEN '10-19' WHEN p_size < 30 THEN '20-29'
            WHEN p_size < 40 THEN '30-39' ELSE '40-50' END AS size_group,
       round(avg(p_retailprice), 2) AS avg_retail_price, count(*) AS n_parts
FROM part GROUP BY size_group""")
def kpi_by_bucket(spark, d):
    p = table(spark, d, "part").withColumn("size_group", C.bucket("p_size", SIZE_EDGES, SIZE_LABELS))
    return A.kpi(p, ["size_group"], {"avg_retail_price": F.round(F.avg("p_retailprice"), 2),
                                     "n_parts": F.count(F.lit(1))})


BALANCE_EDGES = [0, 2500, 5000, 7500]
BALANCE_LABELS = ["negative", "0-2499", "2500-4999", "5000-7499", "7500+"]


@register("kpi_rate_by_bucket", _ENRICH_CTES + """
SELECT CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 2500 THEN '0-2499'
            WHEN c_acctbal < 5000 THEN '2500-4999' WHEN c_acctbal < 7500 THEN '5000-7499'
            ELSE '7500+' END AS balance_group,
       round(avg(event_error_rate), 4) AS event_error_rate,
       round(avg(avg_peer_order_price), 2) AS avg_peer_order_price, count(*) AS n_customers
FROM enriched GROUP BY balance_group""")
def kpi_rate_by_bucket(spark, d):
    e = enriched_customers(spark, d).withColumn(
        "balance_group", C.bucket("c_acctbal", BALANCE_EDGES, BALANCE_LABELS))
    return A.kpi(e, ["balance_group"], {
        "event_error_rate": F.round(F.avg("event_error_rate"), 4),
        "avg_peer_order_price": F.round(F.avg("avg_peer_order_price"), 2),
        "n_customers": F.count(F.lit(1))})


ORDER_STATUSES = ["F", "O", "P"]


def _pivot_share_sql(source: str, values: list[str]) -> str:
    counted = {v: f"count(*) FILTER (WHERE s = '{v}')" for v in values}
    listed = ", ".join(f"'{v}'" for v in values)
    counted["other"] = f"count(*) FILTER (WHERE s IS NULL OR s NOT IN ({listed}))"
    total = " + ".join(f"n_{v}" for v in counted)
    return f"""
WITH c AS (SELECT o_orderpriority, {", ".join(f"{e} AS n_{v}" for v, e in counted.items())}
           FROM (SELECT o_orderpriority, {source} AS s FROM orders) GROUP BY o_orderpriority)
SELECT o_orderpriority, {", ".join(f"n_{v}" for v in counted)}, {total} AS n_total,
       {", ".join(f"round(n_{v} / ({total}), 4) AS share_{v}" for v in counted)}
FROM c"""


@register("pivot_share", _pivot_share_sql("o_orderstatus", ORDER_STATUSES))
def pivot_share(spark, d):
    return A.pivot_share(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ORDER_STATUSES)


@register("pivot_share_unlisted", _pivot_share_sql("CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END", ["F", "O"]))
def pivot_share_unlisted(spark, d):
    """Values outside the list, and NULL, count in the total and share a column."""
    orders = table(spark, d, "orders").withColumn("s", F.expr("CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END"))
    return A.pivot_share(orders, "o_orderpriority", "s", ["F", "O"])


@register("null_profile", """
WITH heavy AS (SELECT o_custkey, count(*) AS n_orders, avg(o_totalprice) AS avg_price
               FROM orders GROUP BY o_custkey HAVING count(*) > 10),
j AS (SELECT c.c_custkey, c.c_name, c.c_acctbal, h.n_orders, h.avg_price
      FROM customer c LEFT JOIN heavy h ON c.c_custkey = h.o_custkey)
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE c_custkey IS NULL) AS c_custkey_nulls,
       count(*) FILTER (WHERE c_name IS NULL) AS c_name_nulls,
       count(*) FILTER (WHERE c_acctbal IS NULL) AS c_acctbal_nulls,
       count(*) FILTER (WHERE n_orders IS NULL) AS n_orders_nulls,
       count(*) FILTER (WHERE avg_price IS NULL) AS avg_price_nulls
FROM j""")
def null_profile(spark, d):
    heavy = (table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
             .agg(F.count(F.lit(1)).alias("n_orders"), F.avg("o_totalprice").alias("avg_price"))
             .filter(F.col("n_orders") > 10))
    j = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").join(heavy, "c_custkey", "left")
    return A.null_profile(j, ["c_custkey", "c_name", "c_acctbal", "n_orders", "avg_price"])


@register("topk_desc", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def topk_desc(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return A.top_k(o, 10, [F.desc("o_totalprice"), F.asc("o_orderkey")])


# --------------------------------------------------------------------------
# Scalar functions
# --------------------------------------------------------------------------
@register("normalize_columns", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment AS c_mkt_segment FROM customer""")
def normalize_columns(spark, d):
    raw = table(spark, d, "customer").toDF("C CustKey", "c;name", "(C_NationKey)", "C=AcctBal",
                                           "c mkt{segment}")
    return C.normalize_columns(raw)


FLAG_LABELS = {"R": "returned", "A": "accepted"}


@register("map_codes", """
SELECT l_orderkey, l_linenumber, l_returnflag,
       CASE WHEN lower(l_returnflag) = 'r' THEN 'returned' WHEN lower(l_returnflag) = 'a' THEN 'accepted'
            ELSE lower(l_returnflag) END AS flag_label
FROM lineitem""")
def map_codes(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return li.withColumn("flag_label", C.map_codes("l_returnflag", FLAG_LABELS))


@register("name_norm", """
SELECT c_custkey, regexp_replace(lower(c_name), '[^a-z0-9 ]', '', 'g') AS name_norm,
       lower(regexp_replace(c_name, '[^a-z0-9 ]', '', 'g')) AS name_norm_compat,
       array_to_string(list_transform(string_split(lower(c_name), ' '),
                       lambda w: upper(w[1]) || w[2:]), ' ') AS name_title
FROM customer""")
def name_norm(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", C.name_norm("c_name").alias("name_norm"),
                    C.name_norm("c_name", compat=True).alias("name_norm_compat"),
                    C.title_case(F.lower("c_name")).alias("name_title"))


# Spark's round() on a double is HALF_UP on the value's shortest decimal
# text (36.855 -> 36.86 even though the binary value is a hair below); the
# oracle reproduces that by rounding the decimal text.
@register("round_half_up", """
SELECT l_orderkey, l_linenumber,
       round(CAST(CAST(l_extendedprice * l_discount AS VARCHAR) AS DECIMAL(38, 20)), 2)::DOUBLE AS disc_amount,
       round(CAST(CAST(l_extendedprice * (1 - l_discount) AS VARCHAR) AS DECIMAL(38, 20)), 2)::DOUBLE AS net_price
FROM lineitem""")
def round_half_up(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.round(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("disc_amount"),
                     F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("net_price"))


@register("json_parse", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events WHERE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NOT NULL""")
def json_parse(spark, d):
    from ..functions.json import parse_json
    ev = table(spark, d, "events")
    return (ev.select("event_id", parse_json("props", "k int").alias("data"))
              .select("event_id", "data.*").filter(F.col("k").isNotNull()))


@register("flatten_struct", """
SELECT o_orderkey, o_custkey AS cust_o_custkey, o_orderstatus AS cust_o_orderstatus,
       o_totalprice AS cust_detail_o_totalprice, o_orderpriority AS cust_detail_o_orderpriority,
       to_json([o_orderstatus, o_orderpriority])::VARCHAR AS tags,
       CASE WHEN microsecond(o_orderdate) % 1000000 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') END AS o_orderdate
FROM orders""")
def flatten_struct(spark, d):
    o = table(spark, d, "orders")
    nested = o.select("o_orderkey",
                      F.struct("o_custkey", "o_orderstatus",
                               F.struct("o_totalprice", "o_orderpriority").alias("detail")).alias("cust"),
                      F.array("o_orderstatus", "o_orderpriority").alias("tags"), "o_orderdate")
    return C.flatten(nested, sep="_")


@register("double_key_to_string", """
SELECT c_custkey, CAST(CAST(c_custkey AS DOUBLE) * 1000003 AS DECIMAL(38,0))::VARCHAR AS key_text
FROM customer""")
def double_key_to_string(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", (F.col("c_custkey").cast("double") * 1000003).alias("k"))
    return c.select("c_custkey", C.integral_double_to_string("k").alias("key_text"))


@register("zero_as_missing", """
SELECT p_partkey, p_size, p_size = 0 AS is_missing_p_size,
       p_retailprice = 0 AS is_missing_p_retailprice
FROM part""")
def zero_as_missing(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    return C.zero_as_missing_flags(p, ["p_size", "p_retailprice"]).drop("p_retailprice")


# --------------------------------------------------------------------------
# Dedup
# --------------------------------------------------------------------------
@register("exact_dedup", "SELECT DISTINCT * FROM lineitem")
def exact_dedup(spark, d):
    from ..operators.dedup import drop_exact_duplicates
    return drop_exact_duplicates(table(spark, d, "lineitem"), "file")


_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]


@register("dedup_natural_key", f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate DESC, {', '.join(c + ' DESC' for c in _LI_REST)}) = 1""")
def dedup_natural_key(spark, d):
    from ..operators.dedup import dedup_by_key
    return dedup_by_key(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"],
                        [F.col("l_shipdate")])


@register("describe_layer", """
SELECT 'customer' AS dataset, count(*) AS n_rows, 5 AS n_cols FROM customer
UNION ALL SELECT 'orders', count(*), 6 FROM orders
UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem
UNION ALL SELECT 'events', count(*), 6 FROM events""")
def describe_layer(spark, d):
    from ..operators.inspect import describe_layer as describe
    return describe({n: table(spark, d, n) for n in ("customer", "orders", "lineitem", "events")})


@register("predicate_filters", """
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE contains(o_orderpriority, 'URGENT') OR (o_orderstatus IN ('P') AND o_totalprice > 300000)""")
def predicate_filters(spark, d):
    o = table(spark, d, "orders")
    return (o.filter(F.col("o_orderpriority").contains("URGENT")
                     | (F.col("o_orderstatus").isin("P") & (F.col("o_totalprice") > 300000)))
             .select("o_orderkey", "o_orderpriority", "o_orderstatus"))


_CHANNEL_COLS = ["avg_peer_order_price", "avg_supplier_acctbal", "event_error_rate"]


@register("rows_with_any_null", _ENRICH_CTES + """
SELECT c_mktsegment, count(*) AS n_incomplete FROM enriched
WHERE avg_peer_order_price IS NULL OR avg_supplier_acctbal IS NULL OR event_error_rate IS NULL
GROUP BY c_mktsegment""")
def rows_with_any_null(spark, d):
    from functools import reduce
    from operator import or_
    e = enriched_customers(spark, d)
    any_null = reduce(or_, [F.col(c).isNull() for c in _CHANNEL_COLS])
    return e.filter(any_null).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_incomplete"))


@register("dq_evidence_report", f"""
WITH t AS (SELECT *, {_CUSTOMER_CASE} AS dq_failed_rule FROM customer)
SELECT 'customer' AS dataset, 'quarantine' AS kind, dq_failed_rule AS name, count(*) AS n_rows
FROM t WHERE dq_failed_rule IS NOT NULL GROUP BY dq_failed_rule
UNION ALL SELECT 'customer', 'nulls', 'c_acctbal', count(*) FILTER (WHERE c_acctbal IS NULL) FROM t
UNION ALL SELECT 'customer', 'nulls', 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment IS NULL) FROM t
UNION ALL SELECT 'customer', 'nulls', 'c_name', count(*) FILTER (WHERE c_name IS NULL) FROM t""")
def dq_evidence_report(spark, d):
    from ..operators.inspect import dq_evidence
    return dq_evidence("customer", Q.tag(table(spark, d, "customer"), CUSTOMER_RULES),
                       ["c_acctbal", "c_mktsegment", "c_name"])


@register("freshness_lag", """
WITH m AS (SELECT event_type, max(ts) AS last_ts FROM events GROUP BY event_type)
SELECT event_type, last_ts,
       round(date_diff('microsecond', last_ts, (SELECT max(ts) FROM events)) / 3600000000.0, 4) AS lag_hours
FROM m""")
def freshness_lag(spark, d):
    from pyspark.sql import Window
    ev = table(spark, d, "events")
    last = ev.groupBy("event_type").agg(F.max("ts").alias("last_ts"))
    # the newest event overall is the max of the per-type maxima; the window
    # runs over the aggregated frame (one row per event type), not the events
    newest = F.max("last_ts").over(Window.partitionBy(F.lit(1)))
    # difference taken on timestamp_ntz values: independent of the session time zone
    lag_us = F.timestamp_diff("MICROSECOND", F.col("last_ts"), newest)
    return last.select("event_type", "last_ts", F.round(lag_us / F.lit(3600000000.0), 4).alias("lag_hours"))
