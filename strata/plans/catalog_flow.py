"""Registered queries for the healthcare flow's own functions, on inputs with
what the driver tables lack: NULLs, zeros, blank names, impossible dates,
rows without any value, unlisted codes, hot and missing keys, crashes.

The faulty columns are derived by expressions that both dialects state alike."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import aggregate as A
from ..operators import dedup as D
from ..operators import quality as Q
from ..operators import segments as SG
from ..operators.enrich import Channel, enrich
from ..session import scratch_path
from ..sources import files as FS
from ..sources import sync as S
from ..sources import tables as TB
from . import healthcare as H
from .catalog import register
from .catalog_io import CUSTOMER_SCHEMA, _write_csv
from .ingest import ingest_dataset
from .tables import table

_DAY = "date_add(DATE'2024-01-01', CAST({} AS INT))"
_DUCK_DAY = "(DATE '2024-01-01' + CAST({} AS INTEGER))"
_PATIENTS = {
    "name": "CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '  ' ELSE concat('Dr. ', c_name) END",
    "age": "CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN 130 ELSE c_custkey % 100 END",
    "gender": "CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'FEMALE' END",
    "medical_condition": "CASE c_custkey % 6 WHEN 0 THEN 'Diabetes' WHEN 1 THEN 'Cancer' WHEN 2 THEN 'Asthma' "
                         "WHEN 3 THEN 'Obesity' WHEN 4 THEN 'Hypertension' END",
    "insurance_provider": "CASE c_custkey % 3 WHEN 0 THEN 'Medicare' WHEN 1 THEN 'Aetna' END",
    "billing_amount": "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_acctbal END",
}


def _patients_sql() -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in _PATIENTS.items())
    return (f"SELECT c_custkey, {cols}, {_DUCK_DAY.format('c_custkey % 300')} AS date_of_admission, "
            f"CASE WHEN c_custkey % 29 <> 0 THEN {_DUCK_DAY.format('c_custkey % 300 + c_custkey % 12 - 2')} END AS discharge_date FROM customer")


def _patients(spark, d):
    cols = [F.expr(e).alias(n) for n, e in _PATIENTS.items()]
    return table(spark, d, "customer").select(
        "c_custkey", *cols, F.expr(_DAY.format("c_custkey % 300")).alias("date_of_admission"),
        F.expr(f"CASE WHEN c_custkey % 29 <> 0 THEN {_DAY.format('c_custkey % 300 + c_custkey % 12 - 2')} END").alias("discharge_date"))


@register("flow_patient_rules", f"""
SELECT c_custkey, CASE WHEN age IS NULL THEN 'null_age' WHEN age < 0 OR age > 115 THEN 'invalid_age'
  WHEN name IS NULL OR trim(name) = '' THEN 'null_name' WHEN billing_amount <= 0 THEN 'invalid_billing'
  WHEN discharge_date < date_of_admission THEN 'invalid_dates' END AS dq_failed_rule
FROM ({_patients_sql()})""")
def flow_patient_rules(spark, d):
    return Q.tag(_patients(spark, d), H.RULES["patients"]).select("c_custkey", "dq_failed_rule")


@register("flow_prepare_patients", f"""
SELECT c_custkey, name, age, lower(gender) AS gender, billing_amount AS bmi_patients
FROM ({_patients_sql()})""")
def flow_prepare_patients(spark, d):
    """Metadata columns go, ``bmi`` is renamed where it exists, gender is lower-cased."""
    p = _patients(spark, d).select("c_custkey", "name", "age", "gender", F.col("billing_amount").alias("bmi"),
                                   F.lit("f.csv").alias("source_file"), F.lit("hospital").alias("channel"),
                                   F.lit("r").alias("ingest_run"))
    return H.prepare_patients(p).drop("name_norm")


@register("flow_inpatient", f"""
SELECT c_custkey, CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 18 THEN '0-17' WHEN age < 36 THEN '18-35' WHEN age < 56 THEN '36-55'
    WHEN age < 71 THEN '56-70' ELSE '71+' END AS age_group,
  discharge_date - date_of_admission AS length_of_stay,
  billing_amount / nullif(discharge_date - date_of_admission, 0) AS cost_per_day,
  medical_condition IN ('Diabetes', 'Hypertension', 'Arthritis', 'Asthma') AS is_chronic,
  CASE WHEN insurance_provider IS NULL THEN 'Unknown' WHEN insurance_provider = 'Medicare' THEN 'Government'
    ELSE 'Commercial' END AS insurance_tier
FROM ({_patients_sql()})""")
def flow_inpatient(spark, d):
    return H.enrich_inpatient(_patients(spark, d)).select(
        "c_custkey", "age_group", F.col("length_of_stay").cast("long").alias("length_of_stay"), "cost_per_day",
        "is_chronic", "insurance_tier")


@register("flow_outpatient", """
SELECT o_orderkey, CAST(o_orderkey % 20 - 3 AS BIGINT) AS lead_time,
  (o_orderkey % 20 - 3 > 7) AND NOT (o_orderkey % 3 = 0) AND (o_orderkey % 4 = 0) AS is_high_risk_noshow,
  strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 - 3 AS INTEGER), '%A') AS day_of_week
FROM orders""")
def flow_outpatient(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("scheduledday"),
        F.expr("date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 20 - 3 AS INT))").alias("appointmentday"),
        F.expr("o_orderkey % 3 = 0").alias("sms_received"), F.expr("o_orderkey % 4 = 0").alias("scholarship"))
    return H.enrich_outpatient(o).select("o_orderkey", F.col("lead_time").cast("long").alias("lead_time"),
                                         "is_high_risk_noshow", "day_of_week")


@register("flow_diabetes_unknown", """
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 6 <> 0 THEN p_size * 4 END AS glucose,
    CASE WHEN p_partkey % 7 <> 0 THEN 15 + p_size % 25 END AS bmi, p_partkey % 2 AS outcome FROM part),
s AS (SELECT *, CASE WHEN glucose IS NULL THEN 'Unknown' WHEN glucose < 100 THEN 'Normal' WHEN glucose < 126 THEN 'Prediabetes'
    ELSE 'Diabetes' END AS glucose_status,
  CASE WHEN bmi IS NULL THEN 'Unknown' WHEN bmi < 18.5 THEN 'Underweight' WHEN bmi < 25 THEN 'Normal' WHEN bmi < 30 THEN 'Overweight'
    ELSE 'Obese' END AS bmi_category FROM p)
SELECT p_partkey, glucose_status, bmi_category,
  CASE WHEN outcome = 1 AND (glucose_status = 'Diabetes' OR coalesce(bmi >= 30, false)) THEN 'High'
    WHEN glucose IS NULL OR bmi IS NULL THEN 'Unknown'
    WHEN outcome = 0 AND glucose_status = 'Normal' AND bmi < 30 THEN 'Low' ELSE 'Medium' END AS diabetes_risk_tier
FROM s""")
def flow_diabetes_unknown(spark, d):
    p = table(spark, d, "part").select(
        "p_partkey", F.expr("CASE WHEN p_partkey % 6 <> 0 THEN p_size * 4 END").alias("glucose"),
        F.expr("CASE WHEN p_partkey % 7 <> 0 THEN 15 + p_size % 25 END").alias("bmi"), F.expr("p_partkey % 2").alias("outcome"))
    return H.enrich_diabetes(p).select("p_partkey", "glucose_status", "bmi_category", "diabetes_risk_tier")


@register("drop_all_null_rows", "SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS c_acctbal, 'f.csv' AS source_file"
          " FROM customer WHERE c_custkey % 4 <> 0")
def drop_all_null_rows(spark, d):
    """A row whose data columns are all NULL goes, though its lineage column has a value."""
    keep = F.expr("c_custkey % 4 <> 0")
    rows = table(spark, d, "customer").select(
        F.when(keep, F.col("c_custkey")).alias("c_custkey"), F.when(keep, F.col("c_name")).alias("c_name"),
        F.when(keep & F.expr("c_custkey % 3 <> 0"), F.col("c_acctbal")).alias("c_acctbal"), F.lit("f.csv").alias("source_file"))
    return D.drop_all_null_rows(rows)


@register("append_evolving", """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 1 THEN c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 2 = 1 THEN DATE '2024-01-02' ELSE DATE '2024-01-01' END AS load_date FROM customer""")
def append_evolving(spark, d):
    """The second day's files have a column more; older rows read it as NULL."""
    path, c = scratch_path(spark, "evolving"), table(spark, d, "customer")
    TB.append(c.filter("c_custkey % 2 = 0").select("c_custkey", "c_name", F.expr("DATE'2024-01-01'").alias("load_date")), path)
    TB.append(c.filter("c_custkey % 2 = 1").select("c_custkey", "c_name", "c_acctbal", F.expr("DATE'2024-01-02'").alias("load_date")), path)
    return TB.read_evolving(spark, path).select("c_custkey", "c_name", "c_acctbal", "load_date")


@register("tolerant_read_optional_channel", """
SELECT c_custkey, n_orders FROM customer LEFT JOIN
  (SELECT o_custkey AS c_custkey, count(*) AS n_orders FROM orders GROUP BY 1) USING (c_custkey)""")
def tolerant_read_optional_channel(spark, d):
    """A channel whose path is missing is skipped; one that is there is joined."""
    absent = FS.safe_read(spark, f"{d}/no_such_channel.parquet")
    present = FS.safe_read(spark, f"{d}/orders.parquet").withColumnRenamed("o_custkey", "c_custkey")
    n = F.count(F.lit(1)).alias("n_orders")
    return enrich(table(spark, d, "customer").select("c_custkey"),
                  [Channel("absent", absent, ["c_custkey"], [n]), Channel("orders", present, ["c_custkey"], [n])])


_HOT_KEY = "CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber = 3 THEN NULL ELSE l_suppkey END"


@register("enrich_hot_key_shuffle", f"""
SELECT l_orderkey, l_linenumber, k, s_total FROM (SELECT l_orderkey, l_linenumber, {_HOT_KEY} AS k FROM lineitem)
LEFT JOIN (SELECT s_suppkey AS k, sum(s_acctbal) AS s_total FROM supplier GROUP BY 1) USING (k)""")
def enrich_hot_key_shuffle(spark, d):
    """The shuffle path with over a third of all rows on one key and a seventh without key."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_HOT_KEY).alias("k"))
    suppliers = table(spark, d, "supplier").withColumnRenamed("s_suppkey", "k")
    return enrich(lines, [Channel("s", suppliers, ["k"], [F.sum("s_acctbal").alias("s_total")], broadcast=False)])


@register("quarantine_recheck", """
SELECT c_custkey, CASE WHEN c_nationkey % 3 = 2 THEN 'negative' ELSE 'large' END AS dq_failed_rule
FROM customer WHERE CASE WHEN c_nationkey % 3 = 2 THEN c_acctbal < 0 ELSE c_acctbal > 9000 AND c_nationkey % 3 = 1 END""")
def quarantine_recheck(spark, d):
    """Batches 0 and 1 are checked again under another rule, which nothing in batch 0
    breaks, twice under the run id of the first check; batch 2 keeps what that found."""
    path = scratch_path(spark, "recheck")
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal", F.expr("CAST(c_nationkey % 3 AS INT)").alias("batch"))
    Q.write_quarantine(Q.split(Q.tag(rows, [Q.Rule("negative", "c_acctbal < 0")]))[1], path, "customer", "r1",
                       batch_col="batch", checked=rows)
    again = rows.filter("batch < 2")
    for run in ("r1", "r1", "r2"):
        Q.write_quarantine(Q.split(Q.tag(again, [Q.Rule("large", "c_acctbal > 9000 AND batch = 1")]))[1], path, "customer", run,
                           batch_col="batch", checked=again)
    return Q.read_quarantine(spark, path).select("c_custkey", "dq_failed_rule")


@register("ingest_after_lost_manifest", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def ingest_after_lost_manifest(spark, d):
    """Half the rows are ingested, the manifest is lost, the other half arrives: every row once."""
    root = scratch_path(spark, "lost")
    cust = table(spark, d, "customer")

    def ingest():
        ingest_dataset(spark, f"{root}/raw", ["customer"], CUSTOMER_SCHEMA, f"{root}/bronze", f"{root}/manifest", "c", "2024-01-01")

    _write_csv(cust.filter("c_custkey % 2 = 0"), f"{root}/raw/customer_1")
    ingest()
    FS.delete_path(spark, f"{root}/manifest")
    _write_csv(cust.filter("c_custkey % 2 = 1"), f"{root}/raw/customer_2")
    ingest()
    return spark.read.parquet(f"{root}/bronze").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")


@register("incremental_append_null_keys", """
SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS o_orderkey, round(o_totalprice / 1000) AS o_totalprice FROM orders""")
def incremental_append_null_keys(spark, d):
    """Every row once, a fifth of them without key and many of those alike: the first sync sees
    half of either, the second all, the third finds nothing."""
    path = scratch_path(spark, "null-keys")
    rows = table(spark, d, "orders").select(F.expr("CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END").alias("o_orderkey"),
                                             F.round(F.col("o_totalprice") / 1000).alias("o_totalprice"), (F.col("o_orderkey") % 2).alias("half"))
    middle = table(spark, d, "orders").agg(F.floor(F.max("o_orderkey") / 2)).first()[0]
    first = F.when(F.col("o_orderkey").isNull(), F.col("half") == 0).otherwise(F.col("o_orderkey") <= middle)
    S.incremental_append(rows.filter(first).drop("half"), path, "o_orderkey")
    S.incremental_append(rows.drop("half"), path, "o_orderkey")
    assert S.incremental_append(rows.drop("half"), path, "o_orderkey") == 0
    return S.read_extract(spark, path)


@register("bucket_unknown", """
SELECT CASE WHEN s IS NULL THEN 'Unknown' WHEN s < 10 THEN 'small' WHEN s < 30 THEN 'medium' ELSE 'large' END AS size_group,
  count(*) AS n_parts FROM (SELECT CASE WHEN p_partkey % 9 <> 0 THEN p_size END AS s FROM part) GROUP BY 1""")
def bucket_unknown(spark, d):
    size = F.expr("CASE WHEN p_partkey % 9 <> 0 THEN p_size END")
    return (table(spark, d, "part").groupBy(C.bucket(size, [10, 30], ["small", "medium", "large"], "Unknown").alias("size_group"))
            .agg(F.count(F.lit(1)).alias("n_parts")))


_VISITS = ("SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderkey % 200 - o_custkey % 150 AS lead, "
           "CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 4 = 0 END AS missed FROM orders")


def _visit_profile(spark, d):
    o = table(spark, d, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("day"), F.expr("o_orderkey % 200 - o_custkey % 150").alias("lead"),
        F.expr("CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 4 = 0 END").alias("missed"))
    return SG.visit_profile(o, "o_custkey", "day", "lead", "missed")


_PROFILE_SQL = f"""
WITH v AS ({_VISITS}), f AS (SELECT o_custkey, min(day) AS first_visit FROM v GROUP BY 1),
p AS (SELECT o_custkey, first_visit, count(*) AS visits, avg(lead) AS avg_lead_time,
    count(*) FILTER (WHERE coalesce(missed, false)) / count(*) AS no_show_rate,
    {", ".join(f"max(CASE WHEN day - first_visit > 0 AND day - first_visit <= {n} THEN 1 ELSE 0 END) AS retained_{n}" for n in (30, 60, 90))}
  FROM v JOIN f USING (o_custkey) GROUP BY 1, 2),
s AS (SELECT *, CASE WHEN visits = 1 THEN 'New'
    WHEN visits >= 3 AND avg_lead_time <= 30 AND no_show_rate <= 0.15 THEN 'Champions'
    WHEN avg_lead_time > 180 OR (visits <= 2 AND no_show_rate >= 0.5) THEN 'Lost'
    WHEN visits >= 3 AND avg_lead_time <= 90 AND no_show_rate < 0.5 THEN 'Loyal' ELSE 'At Risk' END AS segment FROM p)"""


@register("visit_segments", _PROFILE_SQL + """
SELECT o_custkey, visits, round(avg_lead_time, 6) AS avg_lead_time, round(no_show_rate, 6) AS no_show_rate, segment,
  CAST(date_trunc('month', first_visit) AS DATE) AS cohort_month FROM s""")
def visit_segments(spark, d):
    return _visit_profile(spark, d).select(
        "o_custkey", "visits", F.round("avg_lead_time", 6).alias("avg_lead_time"), F.round("no_show_rate", 6).alias("no_show_rate"),
        "segment", "cohort_month")


@register("visit_segment_retention", _PROFILE_SQL + f"""
SELECT segment, count(*) AS n_entities, {", ".join(f"round(avg(retained_{n}), 4) AS retention_rate_{n}" for n in (30, 60, 90))}
FROM s GROUP BY segment""")
def visit_segment_retention(spark, d):
    return SG.retention_at(_visit_profile(spark, d))


@register("condition_prevalence", f"""
SELECT medical_condition, count(*) AS visits, round(count(*) / sum(count(*)) OVER (), 4) AS share
FROM ({_patients_sql()}) GROUP BY 1""")
def condition_prevalence(spark, d):
    return A.shares(_patients(spark, d), ["medical_condition"], "visits")


@register("clinical_risk_counts", f"""
SELECT 'high_no_show_risk' AS risk, count(*) AS n_rows FROM orders
  WHERE o_orderkey % 20 - 3 > 7 AND o_orderkey % 3 <> 0 AND o_orderkey % 4 = 0
UNION ALL SELECT 'chronic_uninsured', count(*) FROM ({_patients_sql()})
  WHERE medical_condition IN ('Diabetes', 'Hypertension', 'Arthritis', 'Asthma') AND insurance_provider IS NULL
UNION ALL SELECT 'diabetes_high', count(*) FROM part WHERE p_partkey % 2 = 1
  AND ((p_partkey % 6 <> 0 AND p_size * 4 >= 126) OR (p_partkey % 7 <> 0 AND 15 + p_size % 25 >= 30))""")
def clinical_risk_counts(spark, d):
    noshows = table(spark, d, "orders").select(
        F.col("o_orderdate").cast("date").alias("scheduledday"),
        F.expr("date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 20 - 3 AS INT))").alias("appointmentday"),
        F.expr("o_orderkey % 3 = 0").alias("sms_received"), F.expr("o_orderkey % 4 = 0").alias("scholarship"))
    diabetes = table(spark, d, "part").select(
        F.expr("CASE WHEN p_partkey % 6 <> 0 THEN p_size * 4 END").alias("glucose"),
        F.expr("CASE WHEN p_partkey % 7 <> 0 THEN 15 + p_size % 25 END").alias("bmi"), F.expr("p_partkey % 2").alias("outcome"))
    return H.clinical_risk_counts(_patients(spark, d), noshows, diabetes)
