"""Registered mart queries (specified-only layer of the source design),
mapped onto the driver tables: orders/lineitem play visits, customers play
patients, returned line items play no-shows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import marts as M
from ..operators import quality as Q
from ..operators import segments as SG
from ..operators.enrich import Channel, enrich
from .catalog import _event_channel, register
from .tables import table

# Fixed values (ours): lead-time buckets in days, with a bucket for negative
# lead times (ship before order in the synthetic data)
LEAD_EDGES = [0, 1, 4, 8, 31]
LEAD_LABELS = ["negative", "0", "1-3", "4-7", "8-30", "31+"]
_LEAD_CASE = """CASE WHEN lead_time < 0 THEN 'negative' WHEN lead_time < 1 THEN '0'
     WHEN lead_time < 4 THEN '1-3' WHEN lead_time < 8 THEN '4-7' WHEN lead_time < 31 THEN '8-30'
     ELSE '31+' END"""
_LEAD_SQL = """lineitem JOIN orders ON l_orderkey = o_orderkey"""
_LEAD_TIME_SQL = "date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))"


def _lines_with_lead(spark, d):
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.withColumns({
        "lead_time": F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")),
        "is_returned": F.col("l_returnflag") == "R"})


@register("lead_time_buckets", f"""
WITH j AS (SELECT *, {_LEAD_TIME_SQL} AS lead_time FROM {_LEAD_SQL})
SELECT {_LEAD_CASE} AS lead_bucket, count(*) AS n_lines, round(avg(lead_time), 2) AS avg_lead_time,
       round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS return_rate
FROM j GROUP BY lead_bucket""")
def lead_time_buckets(spark, d):
    j = _lines_with_lead(spark, d).withColumn("lead_bucket", C.bucket("lead_time", LEAD_EDGES, LEAD_LABELS))
    return j.groupBy("lead_bucket").agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.avg("lead_time"), 2).alias("avg_lead_time"),
        F.round(C.rate(F.col("is_returned")), 4).alias("return_rate"))


@register("weekday_rates", """
SELECT strftime(l_shipdate, '%a') AS ship_weekday, count(*) AS n_lines,
       round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS return_rate
FROM lineitem GROUP BY ship_weekday""")
def weekday_rates(spark, d):
    li = table(spark, d, "lineitem")
    return li.groupBy(F.date_format("l_shipdate", "E").alias("ship_weekday")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.round(C.rate(F.col("l_returnflag") == "R"), 4).alias("return_rate"))


@register("mart_return_analytics", f"""
WITH j AS (SELECT *, {_LEAD_TIME_SQL} AS lead_time FROM {_LEAD_SQL}),
b AS (SELECT *, strftime(l_shipdate, '%Y-%m') AS ship_month, {_LEAD_CASE} AS lead_bucket FROM j)
SELECT ship_month, lead_bucket, GROUPING_ID(ship_month, lead_bucket) AS gid, count(*) AS n_lines,
       round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS return_rate,
       round(avg(lead_time), 2) AS avg_lead_time
FROM b GROUP BY GROUPING SETS ((), (ship_month), (lead_bucket))""")
def mart_return_analytics(spark, d):
    j = _lines_with_lead(spark, d).withColumns({
        "ship_month": F.date_format("l_shipdate", "yyyy-MM"),
        "lead_bucket": C.bucket("lead_time", LEAD_EDGES, LEAD_LABELS)})
    return M.overall_and_by(j, ["ship_month", "lead_bucket"], [
        F.count(F.lit(1)).alias("n_lines"),
        F.round(C.rate(F.col("is_returned")), 4).alias("return_rate"),
        F.round(F.avg("lead_time"), 2).alias("avg_lead_time")])


@register("mart_customer_summary", """
WITH per AS (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS spend FROM orders GROUP BY o_custkey),
j AS (SELECT * FROM per JOIN customer ON o_custkey = c_custkey)
SELECT c_mktsegment, GROUPING_ID(c_mktsegment) AS gid, count(*) AS n_customers,
       CAST(sum(n_orders) AS BIGINT) AS n_orders, round(sum(n_orders) / count(*), 4) AS orders_per_customer,
       round(sum(spend) / sum(n_orders), 2) AS avg_order_price
FROM j GROUP BY GROUPING SETS ((), (c_mktsegment))""")
def mart_customer_summary(spark, d):
    # eager aggregation: one row per customer before the join, so distinct
    # customers are plain row counts (no COUNT DISTINCT over all orders)
    per = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("spend"))
    j = per.join(table(spark, d, "customer"), per.o_custkey == F.col("c_custkey"))
    return M.overall_and_by(j, ["c_mktsegment"], [
        F.count(F.lit(1)).alias("n_customers"), F.sum("n_orders").alias("n_orders"),
        F.round(F.sum("n_orders") / F.count(F.lit(1)), 4).alias("orders_per_customer"),
        F.round(F.sum("spend") / F.sum("n_orders"), 2).alias("avg_order_price")])


@register("mart_segment_utilization", """
WITH buyers AS (SELECT DISTINCT o_custkey FROM orders),
c AS (SELECT c.*, b.o_custkey IS NOT NULL AS has_orders FROM customer c LEFT JOIN buyers b ON c_custkey = o_custkey)
SELECT c_mktsegment, count(*) AS n_customers, round(avg(c_acctbal), 2) AS avg_acctbal,
       round(avg(c_acctbal) FILTER (WHERE has_orders), 2) AS avg_acctbal_buyers,
       round(avg(c_acctbal) FILTER (WHERE NOT has_orders), 2) AS avg_acctbal_non_buyers,
       round(avg(CASE WHEN c_acctbal > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS positive_balance_rate
FROM c GROUP BY c_mktsegment""")
def mart_segment_utilization(spark, d):
    buyers = (table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
              .agg(F.lit(True).alias("has_orders")))
    c = (table(spark, d, "customer").join(buyers, "c_custkey", "left")
         .withColumn("has_orders", F.coalesce("has_orders", F.lit(False))))
    return c.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_customers"), F.round(F.avg("c_acctbal"), 2).alias("avg_acctbal"),
        F.round(F.avg(F.when(F.col("has_orders"), F.col("c_acctbal"))), 2).alias("avg_acctbal_buyers"),
        F.round(F.avg(F.when(~F.col("has_orders"), F.col("c_acctbal"))), 2).alias("avg_acctbal_non_buyers"),
        F.round(C.rate(F.col("c_acctbal") > 0), 4).alias("positive_balance_rate"))


@register("corr_by_group", """
SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS corr_qty_price, count(*) AS n_lines
FROM lineitem GROUP BY l_returnflag""")
def corr_by_group(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("corr_qty_price"),
        F.count(F.lit(1)).alias("n_lines"))


@register("histogram_by_flag", """
SELECT l_returnflag, CAST(floor(l_quantity / 5) * 5 AS BIGINT) AS qty_bin, count(*) AS n_lines
FROM lineitem GROUP BY l_returnflag, qty_bin""")
def histogram_by_flag(spark, d):
    li = table(spark, d, "lineitem")
    return li.groupBy("l_returnflag", (F.floor(F.col("l_quantity") / 5) * 5).cast("long").alias("qty_bin")) \
             .agg(F.count(F.lit(1)).alias("n_lines"))


_FIRST_VISIT_SQL = """
WITH ev AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders),
f AS (SELECT o_custkey, min(d) AS first_visit FROM ev GROUP BY o_custkey),
flags AS (SELECT ev.o_custkey, f.first_visit,
                 max(CASE WHEN date_diff('day', f.first_visit, d) BETWEEN 1 AND 30 THEN 1 ELSE 0 END) AS retained_30,
                 max(CASE WHEN date_diff('day', f.first_visit, d) BETWEEN 1 AND 60 THEN 1 ELSE 0 END) AS retained_60,
                 max(CASE WHEN date_diff('day', f.first_visit, d) BETWEEN 1 AND 90 THEN 1 ELSE 0 END) AS retained_90
          FROM ev JOIN f USING (o_custkey) GROUP BY ev.o_custkey, f.first_visit)"""


@register("cohort_retention", _FIRST_VISIT_SQL + """
SELECT CAST(date_trunc('month', first_visit) AS DATE) AS cohort_month, count(*) AS cohort_size,
       CAST(sum(retained_30) AS BIGINT) AS retained_30, round(avg(retained_30), 4) AS retention_rate_30,
       CAST(sum(retained_60) AS BIGINT) AS retained_60, round(avg(retained_60), 4) AS retention_rate_60,
       CAST(sum(retained_90) AS BIGINT) AS retained_90, round(avg(retained_90), 4) AS retention_rate_90
FROM flags GROUP BY cohort_month""")
def cohort_retention(spark, d):
    flags = SG.first_visit_flags(table(spark, d, "orders"), "o_custkey", "o_orderdate")
    return SG.cohort_retention(flags)


def _reference_date(spark, d):
    # one scalar (max order date) — the "as of" date for recency
    return table(spark, d, "orders").agg(F.max(F.to_date("o_orderdate")).alias("m")).first()["m"]


_RFM_SQL = """
ref AS (SELECT max(CAST(o_orderdate AS DATE)) AS r FROM orders),
per AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last_visit, min(CAST(o_orderdate AS DATE)) AS first_v,
               count(*) AS frequency, sum(o_totalprice) AS monetary FROM orders GROUP BY o_custkey),
rfm AS (SELECT per.*, date_diff('day', last_visit, r) AS recency, date_diff('day', first_v, r) AS tenure FROM per, ref),
seg AS (SELECT *, CASE WHEN tenure <= 180 THEN 'New'
                       WHEN recency <= 90 AND frequency >= 12 AND monetary >= 3000000.0 THEN 'Champions'
                       WHEN recency <= 365 AND frequency >= 10 THEN 'Loyal'
                       WHEN recency > 365 THEN 'Lost' ELSE 'At Risk' END AS segment FROM rfm)"""


@register("rfm_segments", "WITH" + _RFM_SQL + """
SELECT segment, count(*) AS n_entities, round(avg(recency), 2) AS avg_recency,
       round(avg(frequency), 2) AS avg_frequency, round(avg(monetary), 2) AS avg_monetary
FROM seg GROUP BY segment""")
def rfm_segments(spark, d):
    per = SG.rfm(table(spark, d, "orders"), "o_custkey", "o_orderdate", "o_totalprice",
                 _reference_date(spark, d))
    return SG.segment_summary(per)


@register("retention_by_segment", _FIRST_VISIT_SQL + "," + _RFM_SQL + """
SELECT segment, count(*) AS n_entities, round(avg(retained_30), 4) AS retention_rate_30
FROM seg JOIN flags USING (o_custkey) GROUP BY segment""")
def retention_by_segment(spark, d):
    profile = SG.entity_profile(table(spark, d, "orders"), "o_custkey", "o_orderdate", "o_totalprice",
                                _reference_date(spark, d))
    return SG.retention_by_segment(profile)


@register("risk_counts", """
WITH e AS (SELECT c.c_custkey, c.c_acctbal,
                  (SELECT count(*) FROM orders o WHERE o.o_custkey = c.c_custkey) AS n_orders,
                  ev.err AS event_error_rate
           FROM customer c LEFT JOIN (SELECT user_id, avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS err
                                      FROM events GROUP BY user_id) ev ON ev.user_id = c.c_custkey)
SELECT count(*) FILTER (WHERE event_error_rate > 0.25) AS high_error_customers,
       count(*) FILTER (WHERE c_acctbal < 0 AND n_orders = 0) AS negative_without_orders,
       count(*) FILTER (WHERE c_acctbal < 0 AND event_error_rate > 0.25) AS negative_and_high_error,
       count(*) AS n_customers
FROM e""")
def risk_counts(spark, d):
    # each customer's own orders and events: two per-customer channels, one
    # scan of each input (the peer-group channel is not needed here)
    own_orders = Channel("own_orders", table(spark, d, "orders"), ["c_custkey"],
                         [F.count(F.lit(1)).alias("n_orders")],
                         prepare=lambda df: df.withColumnRenamed("o_custkey", "c_custkey"))
    e = enrich(table(spark, d, "customer").select("c_custkey", "c_acctbal"),
               [_event_channel(spark, d), own_orders])
    e = e.withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))
    return e.agg(
        F.count_if(F.col("event_error_rate") > 0.25).alias("high_error_customers"),
        F.count_if((F.col("c_acctbal") < 0) & (F.col("n_orders") == 0)).alias("negative_without_orders"),
        F.count_if((F.col("c_acctbal") < 0) & (F.col("event_error_rate") > 0.25)).alias("negative_and_high_error"),
        F.count(F.lit(1)).alias("n_customers"))


@register("daily_trend", """
WITH daily AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows FROM events GROUP BY day),
j AS (SELECT a.day, a.n_rows, b.n_rows AS prev_n_rows FROM daily a LEFT JOIN daily b ON b.day + INTERVAL 1 DAY = a.day)
SELECT day, n_rows, prev_n_rows, round((n_rows - prev_n_rows) / prev_n_rows, 4) AS pct_change,
       coalesce(round((n_rows - prev_n_rows) / prev_n_rows, 4) < -0.2, false) AS drop_alert
FROM j""")
def daily_trend(spark, d):
    return M.daily_trend(table(spark, d, "events"), "ts")


LINE_RULES = [Q.Rule("bulk_quantity", "l_quantity > 45"), Q.Rule("deep_discount", "l_discount > 0.09")]


@register("quality_score", """
WITH t AS (SELECT *, CASE WHEN l_quantity > 45 THEN 'bulk_quantity' WHEN l_discount > 0.09 THEN 'deep_discount' END AS r
           FROM lineitem),
a AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE r IS NULL) AS n_passed,
             count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys FROM t)
SELECT n_rows, n_passed, n_keys, round(n_passed / n_rows, 4) AS success_rate,
       round(1 - n_passed / n_rows, 4) AS quarantine_rate, round(0.0::DOUBLE, 4) AS null_rate,
       round(1 - n_keys / n_rows, 4) AS duplicate_rate,
       round(0.3 * (n_passed / n_rows) + 0.3 * (1 - (1 - n_passed / n_rows)) + 0.2 * 1.0 + 0.2 * (1 - (1 - n_keys / n_rows)), 4) AS quality_score,
       false AS null_rate_flag
FROM a""")
def quality_score(spark, d):
    li = table(spark, d, "lineitem")
    return M.quality_score(Q.tag(li, LINE_RULES), Q.REASON_COL, li.columns, ["l_orderkey", "l_linenumber"])


PRIORITY_TIERS = {"1-URGENT": "Priority", "2-HIGH": "Priority", "3-MEDIUM": "Standard"}


@register("line_enrich", """
SELECT l_orderkey, l_linenumber,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS length_of_stay,
       round(CAST(CAST(CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) = 0 THEN NULL
                  ELSE l_extendedprice / date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) END
                  AS VARCHAR) AS DECIMAL(38, 20)), 2)::DOUBLE AS cost_per_day,
       l_returnflag IN ('R', 'A') AS is_flagged,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Priority' WHEN o_orderpriority = '3-MEDIUM' THEN 'Standard'
            WHEN o_orderpriority IS NULL THEN 'Unknown' ELSE 'Basic' END AS tier
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def line_enrich(spark, d):
    j = _lines_with_lead(spark, d)
    tier = F.when(F.col("o_orderpriority").isNull(), "Unknown")
    for label in dict.fromkeys(PRIORITY_TIERS.values()):
        codes = [k for k, v in PRIORITY_TIERS.items() if v == label]
        tier = tier.when(F.col("o_orderpriority").isin(*codes), label)
    tier = tier.otherwise("Basic")
    return j.select("l_orderkey", "l_linenumber", F.col("lead_time").alias("length_of_stay"),
                    F.round(F.try_divide(F.col("l_extendedprice"), F.col("lead_time")), 2).alias("cost_per_day"),
                    F.col("l_returnflag").isin("R", "A").alias("is_flagged"), tier.alias("tier"))
