"""The four-channel healthcare medallion flow, configured from the generic
operators: raw CSV → bronze (append, per channel) → DQ gate (quarantine) →
silver unified profile (primary + channel aggregates) → gold KPIs.

Layout under ``lake``::

    bronze/<dataset>/load_date=…/ingest_run=…/   bronze/_manifest/
    quarantine/dataset=…/run_id=…/
    silver/  (snapshot-versioned: data/version=N/dataset=…/load_date=…/, _versions/)
    gold/<kpi>/  (snapshot-versioned: data/version=N/load_date=…/, _versions/)
"""

from __future__ import annotations

import logging
from collections.abc import Collection
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..operators import aggregate as A
from ..operators import quality as Q
from ..operators.enrich import Channel, enrich
from ..sources import versions as V
from ..sources.files import glob_dirs, safe_read
from .ingest import ingest_dataset

log = logging.getLogger("strata.healthcare")

# ---------------------------------------------------------------------------
# Source CSV headers (in file order) and types
# ---------------------------------------------------------------------------
_S, _I, _D, _DT, _B = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.BooleanType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS = {
    "patients": _schema(("Name", _S), ("Age", _I), ("Gender", _S), ("Blood Type", _S),
                        ("Medical Condition", _S), ("Date of Admission", _DT), ("Doctor", _S),
                        ("Hospital", _S), ("Insurance Provider", _S), ("Billing Amount", _D),
                        ("Room Number", _I), ("Admission Type", _S), ("Discharge Date", _DT),
                        ("Medication", _S), ("Test Results", _S)),
    "insurance": _schema(("age", _I), ("sex", _S), ("bmi", _D), ("children", _I), ("smoker", _S),
                         ("region", _S), ("charges", _D)),
    "diabetes": _schema(("Id", _I), ("Pregnancies", _I), ("Glucose", _I), ("BloodPressure", _I),
                        ("SkinThickness", _I), ("Insulin", _I), ("BMI", _D),
                        ("DiabetesPedigreeFunction", _D), ("Age", _I), ("Outcome", _I)),
    "noshows": _schema(("PatientId", _D), ("AppointmentID", _I), ("Gender", _S), ("ScheduledDay", _DT),
                       ("AppointmentDay", _DT), ("Age", _I), ("Neighbourhood", _S), ("Scholarship", _B),
                       ("Hipertension", _B), ("Diabetes", _B), ("Alcoholism", _B), ("Handcap", _B),
                       ("SMS_received", _B), ("Showed_up", _B), ("Date.diff", _I)),
}

# File-name patterns and channel labels per dataset
DATASETS = {
    "patients": (["patients", "patient"], "hospital"),
    "insurance": (["insurance"], "insurance"),
    "diabetes": (["diabetes"], "lab_results"),
    "noshows": (["noshows"], "appointment"),
}

# DQ rules (first match wins; a NULL condition passes)
RULES = {
    "patients": [
        Q.Rule("null_age", "age IS NULL"),
        Q.Rule("invalid_age", "age < 0 OR age > 115"),
        Q.Rule("null_name", "name IS NULL OR trim(name) = ''"),
        Q.Rule("invalid_billing", "billing_amount <= 0"),
        Q.Rule("invalid_dates", "discharge_date < date_of_admission"),
    ],
    "insurance": [
        Q.Rule("null_age", "age IS NULL"),
        Q.Rule("invalid_age", "age < 0 OR age > 115"),
        Q.Rule("invalid_bmi", "bmi <= 0"),
        Q.Rule("invalid_charges", "charges <= 0"),
    ],
    "diabetes": [
        Q.Rule("null_age", "age IS NULL"),
        Q.Rule("invalid_age", "age < 0 OR age > 115"),
        Q.Rule("zero_glucose", "glucose = 0"),
        Q.Rule("zero_bmi", "bmi = 0"),
    ],
    "noshows": [
        Q.Rule("null_patientid", "patientid IS NULL"),
        Q.Rule("null_age", "age IS NULL"),
        Q.Rule("negative_age", "age < 0"),
    ],
}

# Gender codes of the appointment channel, KPI age bins
GENDER_CODES = {"f": "female", "m": "male"}
AGE_GROUP_EDGES = [30, 45, 60, 75]
AGE_GROUP_LABELS = ["13-29", "30-44", "45-59", "60-74", "75-89"]
# Natural keys, on the columns of the bronze tables
NATURAL_KEYS = {
    "patients": ["name_norm", "date_of_admission", "hospital"],
    "noshows": ["patientid", "appointmentid"],
    "diabetes": ["id"],
    "insurance": ["age", "sex", "bmi", "region"],
}
# Measurements of the lab channel in which zero stands for missing
ZERO_IS_MISSING = ["insulin", "bloodpressure", "glucose"]
METADATA_COLS = ("dataset", "load_date", "_source_file", "source_file", "channel", "ingest_run")
SILVER_DATASET = "healthcare_unified"


def bronze_schema(ds: str) -> T.StructType:
    """Columns of a bronze table as ingestion writes them: the declared CSV
    columns under their normalised names, the lineage and channel columns and
    the ``(load_date, ingest_run)`` partition columns.  Reading bronze with it
    needs no footer scan, and a column added to the declared schema later
    reads as NULL for older files."""
    fields = [T.StructField(C.normalize_name(f.name), f.dataType, True) for f in SCHEMAS[ds].fields]
    fields += [T.StructField("source_file", _S), T.StructField("channel", _S),
               T.StructField("load_date", _DT), T.StructField("ingest_run", _S)]
    return T.StructType(fields)


def read_bronze(spark: SparkSession, lake: "Lake", ds: str) -> DataFrame | None:
    return safe_read(spark, lake.bronze(ds), schema=bronze_schema(ds))


@dataclass
class Lake:
    root: str

    def bronze(self, ds: str) -> str:
        return f"{self.root}/bronze/{ds}"

    @property
    def manifest(self) -> str:
        return f"{self.root}/bronze/_manifest"

    @property
    def inventory(self) -> str:
        return f"{self.root}/bronze/_inventory"

    @property
    def schemas(self) -> str:
        return f"{self.root}/bronze/_schemas"

    @property
    def domains(self) -> str:
        return f"{self.root}/silver_domains"

    def mart(self, name: str) -> str:
        return f"{self.root}/marts/{name}"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


# ---------------------------------------------------------------------------
# Bronze
# ---------------------------------------------------------------------------
def run_bronze(spark: SparkSession, raw_root: str, lake: Lake, load_date: date | str,
               since: date | str | None = None, dedup_scope: str = "file",
               multiline: Collection[str] | None = None, records: bool = True) -> dict[str, int]:
    """Ingest every dataset's new files; returns rows written per dataset.
    Files whose quoted cells hold line breaks are found by a scan of the lines
    and read whole, each by one task; ``multiline`` spares the scan by naming the datasets that have such files.
    ``dedup_scope="key"`` keeps one row per natural key (:data:`NATURAL_KEYS`) over everything that was ever
    ingested.  ``records``: each run also writes its inventory and schema snapshot."""
    out = {}
    for ds, (patterns, channel) in DATASETS.items():
        out[ds] = ingest_dataset(spark, raw_root, patterns, SCHEMAS[ds], lake.bronze(ds), lake.manifest,
                                 channel, load_date, since, "file" if dedup_scope == "key" else dedup_scope,
                                 None if multiline is None else ds in multiline,
                                 trim_cols=("name",) if ds == "patients" else (),
                                 natural_key=natural_key(ds) if dedup_scope == "key" else (),
                                 inventory_path=f"{lake.inventory}/dataset={ds}" if records else None,
                                 schema_path=lake.schemas if records else None)
    return out


def natural_key(ds: str) -> list:
    return [C.name_norm("name") if k == "name_norm" else F.col(k) for k in NATURAL_KEYS[ds]]


def clean(ds: str, df: DataFrame) -> DataFrame:
    """Bronze rows under corrected names and values: typos in column names, the
    patient id as text, names in title case, and a flag ``<column>_is_missing``
    for measurements in which zero stands for missing (the value is kept)."""
    if ds == "noshows":
        return fix_noshow_names(df)
    if ds == "patients" and "name" in df.columns:
        return df.withColumn("name", C.title_case("name"))
    if ds == "diabetes":
        return C.zero_as_missing_flags(df, ZERO_IS_MISSING, prefix="", suffix="_is_missing")
    return df


# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------
def prepare_patients(p: DataFrame, compat_name_norm: bool = False) -> DataFrame:
    if "name" in p.columns:
        p = p.withColumn("name_norm", C.name_norm("name", compat=compat_name_norm))
    p = p.drop(*METADATA_COLS).withColumnsRenamed({"bmi": "bmi_patients"})
    if "gender" in p.columns:
        p = p.withColumn("gender", F.lower("gender"))
    return p


def channels(ins: DataFrame | None, dia: DataFrame | None, nos: DataFrame | None) -> list[Channel]:
    def prep_ins(df):
        df = df.withColumnsRenamed({"sex": "gender"}).drop(*METADATA_COLS)
        return df.withColumn("gender", F.lower("gender")) if "gender" in df.columns else df

    def prep_nos(df):
        df = df.drop(*METADATA_COLS)
        return df.withColumn("gender", C.map_codes("gender", GENDER_CODES)) if "gender" in df.columns else df

    return [
        Channel("insurance", ins, ["age", "gender"], [
            F.avg("charges").alias("avg_insurance_charge"), F.avg("bmi").alias("avg_bmi_insurance"),
            F.count(F.lit(1)).alias("insurance_channel_size")], prepare=prep_ins),
        Channel("lab_results", dia, ["age"], [
            F.avg("glucose").alias("avg_glucose"), F.avg("bmi").alias("avg_bmi_lab"),
            F.avg("insulin").alias("avg_insulin"),
            C.rate(F.col("outcome") == 1).alias("diabetes_positive_rate"),
            F.count(F.lit(1)).alias("lab_channel_size")],
            prepare=lambda df: df.drop(*METADATA_COLS)),
        Channel("appointment", nos, ["age", "gender"], [
            C.rate(F.col("showed_up") == F.lit(True)).alias("appointment_show_rate"),
            F.count(F.lit(1)).alias("appointment_channel_size")], prepare=prep_nos),
    ]


def build_silver(bronze: dict[str, DataFrame | None], load_date: date | str,
                 compat_name_norm: bool = False,
                 rules: dict[str, list[Q.Rule]] | None = None) -> tuple[DataFrame, dict[str, Q.Gate]]:
    """DQ-gate every present dataset and enrich the primary.  Returns the
    unified profile (one row per good patient row) and the gates (whose
    ``bad`` frames feed the quarantine).  ``rules`` replaces the default rule
    set per dataset (``RULES``)."""
    rules = {**RULES, **(rules or {})}
    if bronze.get("patients") is None:
        raise ValueError("primary dataset 'patients' is missing; cannot build silver")
    # metrics ride on the bad path: the quarantine write consumes it for every dataset
    gates = {ds: Q.gate(df, rules[ds], name=f"dq_{ds}", observe_on="bad")
             for ds, df in bronze.items() if df is not None}
    good = {ds: (gates[ds].good if ds in gates else None) for ds in DATASETS}
    unified = enrich(prepare_patients(good["patients"], compat_name_norm),
                     channels(good["insurance"], good["diabetes"], good["noshows"]))
    return (unified.withColumns({"dataset": F.lit(SILVER_DATASET),
                                 "load_date": F.lit(str(load_date)).cast("date")}), gates)


def run_silver(spark: SparkSession, lake: Lake, load_date: date | str, run_id: str,
               compat_name_norm: bool = False, rules: dict[str, list[Q.Rule]] | None = None) -> int:
    """Bronze → quarantine + new silver snapshot version.  Returns the version."""
    rules = {**RULES, **(rules or {})}
    bronze = {ds: read_bronze(spark, lake, ds) for ds in DATASETS}
    unified, gates = build_silver(bronze, load_date, compat_name_norm, rules)
    for ds, g in gates.items():
        # partitioned by the bronze batch: re-checking the same bronze rows in a
        # later run replaces their quarantine copy instead of adding one
        Q.write_quarantine(g.bad, lake.quarantine, ds, run_id, batch_col="ingest_run", checked=bronze[ds])
        log.info("[DQ] %s", Q.summary_line(ds, g.summary(), rules[ds]))
    return V.publish(unified, lake.silver, operation="WRITE",
                     parameters={"run_id": run_id, "load_date": str(load_date)},
                     partition_by=("dataset", "load_date"))


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------
def kpis(silver: DataFrame, age_edges=AGE_GROUP_EDGES, age_labels=AGE_GROUP_LABELS) -> dict[str, DataFrame]:
    """The four gold KPIs; the age bins default to the source's."""
    age_group = C.bucket("age", age_edges, age_labels)
    return {
        "kpi_cost_by_gender": silver.groupBy("gender").agg(
            F.round(F.avg("avg_insurance_charge"), 2).alias("avg_insurance_charges"),
            F.round(F.avg("billing_amount"), 2).alias("avg_treatment_cost")),
        "kpi_cost_by_condition": silver.groupBy("medical_condition").agg(
            F.round(F.avg("billing_amount"), 2).alias("avg_treatment_cost"),
            F.count(F.lit(1)).alias("patient_count")),
        "kpi_test_results_by_condition": silver.groupBy("medical_condition", "test_results").agg(
            F.count(F.lit(1)).alias("count")),
        "kpi_diabetes_by_age_group": silver.withColumn("age_group", age_group).groupBy("age_group").agg(
            F.round(F.avg("diabetes_positive_rate"), 4).alias("diabetes_positive_rate"),
            F.round(F.avg("avg_glucose"), 2).alias("avg_glucose"),
            F.count(F.lit(1)).alias("patient_count")),
    }


def run_gold(spark: SparkSession, lake: Lake, load_date: date | str,
             keep_other_days: bool = False, age_edges=AGE_GROUP_EDGES,
             age_labels=AGE_GROUP_LABELS) -> dict[str, str]:
    """Current silver version → four KPI tables, each published as a new
    snapshot version partitioned by ``load_date`` (an atomic replacement:
    readers see the previous version until the new one commits, and earlier
    versions stay readable, as with a table format).

    By default a version holds this run only (the source behaviour).
    ``keep_other_days=True`` carries the other days of the current version
    over and replaces just this run's ``load_date``.  KPI outputs have one
    row per group, so a single file per version is enough."""
    silver = V.read_as_of(spark, lake.silver).where(F.col("dataset") == SILVER_DATASET)
    day = F.lit(str(load_date)).cast("date")
    out = {}
    for name, df in kpis(silver, age_edges, age_labels).items():
        df = df.withColumn("load_date", day)
        prev = read_gold(spark, lake, name) if keep_other_days else None
        if prev is not None:
            df = prev.where(F.col("load_date") != day).unionByName(df)
        V.publish(df.coalesce(1), lake.gold(name), operation="KPI",
                  parameters={"load_date": str(load_date)}, partition_by=("load_date",))
        out[name] = lake.gold(name)
    return out


def read_gold(spark: SparkSession, lake: Lake, name: str, version: int | None = None) -> DataFrame | None:
    """A gold KPI table (current version by default); ``None`` if never built."""
    if V.current_version(spark, lake.gold(name)) is None:
        return None
    return V.read_as_of(spark, lake.gold(name), version=version)


# ---------------------------------------------------------------------------
# Domain enrichments (specified-only layer); thresholds are ours where the
# specification leaves gaps (BMI edges 18.5/25/30, lead buckets)
# ---------------------------------------------------------------------------
INPATIENT_AGE_EDGES = [18, 36, 56, 71]
INPATIENT_AGE_LABELS = ["0-17", "18-35", "36-55", "56-70", "71+"]
CHRONIC_CONDITIONS = ["Diabetes", "Hypertension", "Asthma", "Arthritis"]
GOVERNMENT_PROVIDERS = ["Medicare"]
GLUCOSE_EDGES, GLUCOSE_LABELS = [100, 126], ["Normal", "Prediabetes", "Diabetes"]
BMI_EDGES, BMI_LABELS = [18.5, 25, 30], ["Underweight", "Normal", "Overweight", "Obese"]


def enrich_inpatient(p: DataFrame) -> DataFrame:
    los = F.datediff("discharge_date", "date_of_admission")
    tier = (F.when(F.col("insurance_provider").isNull(), "Unknown")
             .when(F.col("insurance_provider").isin(*GOVERNMENT_PROVIDERS), "Government")
             .otherwise("Commercial"))
    return p.withColumns({
        "age_group": C.bucket("age", INPATIENT_AGE_EDGES, INPATIENT_AGE_LABELS, "Unknown"),
        "length_of_stay": los,
        "cost_per_day": F.try_divide(F.col("billing_amount"), los),
        "is_chronic": F.col("medical_condition").isin(*CHRONIC_CONDITIONS),
        "insurance_tier": tier})


def enrich_outpatient(n: DataFrame, high_risk_lead_days: int = 7) -> DataFrame:
    """``is_high_risk_noshow`` is false where the lead time, the message or the scholarship is unknown."""
    lead = F.datediff("appointmentday", "scheduledday")
    risk = (lead > high_risk_lead_days) & ~F.col("sms_received") & F.col("scholarship")
    return n.withColumns({
        "lead_time": lead,
        "is_high_risk_noshow": F.coalesce(risk, F.lit(False)),
        "day_of_week": F.date_format("appointmentday", "EEEE")})


def enrich_diabetes(d: DataFrame) -> DataFrame:
    # a measurement that wasn't taken is no finding
    status = C.bucket("glucose", GLUCOSE_EDGES, GLUCOSE_LABELS, null_label="Unknown")
    bmi_cat = C.bucket("bmi", BMI_EDGES, BMI_LABELS, null_label="Unknown")
    d = d.withColumns({"glucose_status": status, "bmi_category": bmi_cat})
    risk = (F.when((F.col("outcome") == 1) & ((F.col("glucose_status") == "Diabetes") | (F.col("bmi") >= 30)),
                   "High")
             .when((F.col("outcome") == 0) & (F.col("glucose_status") == "Normal") & (F.col("bmi") < 30), "Low")
             .otherwise("Medium"))
    unknown = F.col("outcome").isNull() | F.col("glucose").isNull() | F.col("bmi").isNull()
    return d.withColumn("diabetes_risk_tier", F.when(risk == "High", risk).when(unknown, "Unknown").otherwise(risk))


def fix_noshow_names(n: DataFrame) -> DataFrame:
    """Correct source typos and render the double patient id as text."""
    n = n.withColumnsRenamed({"hipertension": "hypertension", "handcap": "handicap", "date.diff": "date_diff"})
    if "patientid" in n.columns:
        n = n.withColumn("patientid", C.integral_double_to_string("patientid"))
    return n


# ---------------------------------------------------------------------------
# Domain marts (specified-only layer) on the healthcare column names
# ---------------------------------------------------------------------------
# ours: lead-time buckets without the specification's overlaps at 7 and 30
LEAD_EDGES, LEAD_LABELS = [0, 1, 4, 8, 31], ["negative", "0", "1-3", "4-7", "8-30", "31+"]


def mart_noshow_analytics(noshows: DataFrame) -> DataFrame:
    """No-show rate and average lead time overall and by month,
    neighbourhood, age group, SMS received, scholarship, lead bucket and
    weekday — one GROUPING SETS aggregate over the enriched appointments."""
    from ..operators.marts import overall_and_by
    n = (noshows if "lead_time" in noshows.columns else enrich_outpatient(noshows)).withColumns({
        "appointment_month": F.date_format("appointmentday", "yyyy-MM"),
        "age_group": C.bucket("age", INPATIENT_AGE_EDGES, INPATIENT_AGE_LABELS, "Unknown"),
        "lead_bucket": C.bucket("lead_time", LEAD_EDGES, LEAD_LABELS)})
    dims = ["appointment_month", "neighbourhood", "age_group", "sms_received", "scholarship",
            "lead_bucket", "day_of_week"]
    return overall_and_by(n, dims, [
        F.count(F.lit(1)).alias("appointments"),
        F.round(C.rate(~F.col("showed_up")), 4).alias("noshow_rate"),
        F.round(F.avg("lead_time"), 2).alias("avg_lead_time")])


def mart_patient_summary(silver: DataFrame) -> DataFrame:
    """Distinct patients, visits per patient and average cost/stay, overall
    and by condition, gender and admission type.  A patient is identified by
    the normalised name (the sources share no patient id); names are numbered and counted
    in bitmaps (:mod:`strata.operators.distinct`)."""
    from ..operators.distinct import dense_ids, distinct_by
    p = silver if "length_of_stay" in silver.columns else enrich_inpatient(silver)
    p = p.join(dense_ids(p, "name_norm", "__patient"), "name_norm", "left")
    n = distinct_by(p, ["medical_condition", "gender", "admission_type"], "__patient", out="patients", sums={
        "billing": F.col("billing_amount"), "billed": F.col("billing_amount").isNotNull().cast("long"),
        "days": F.col("length_of_stay"), "stays": F.col("length_of_stay").isNotNull().cast("long"),
        "chronic": F.when(F.col("is_chronic"), 1).otherwise(0)})
    return n.select(
        "medical_condition", "gender", "admission_type", F.col("gid").cast("long").alias("gid"), "patients",
        F.col("n_rows").alias("visits"),
        F.round(F.try_divide("n_rows", "patients"), 4).alias("visits_per_patient"),
        F.round(F.try_divide("billing", "billed"), 2).alias("avg_billing"),
        F.round(F.try_divide("days", "stays"), 2).alias("avg_length_of_stay"),
        F.round(F.try_divide("chronic", "n_rows"), 4).alias("chronic_share"))


def mart_patient_mix(silver: DataFrame) -> dict[str, DataFrame]:
    """Billing by hospital, and counts with shares of admission types, test
    results and conditions (prevalence)."""
    return {
        "billing_by_hospital": silver.groupBy("hospital").agg(
            F.count(F.lit(1)).alias("visits"), F.round(F.avg("billing_amount"), 2).alias("avg_billing")),
        "admission_mix": A.shares(silver, ["admission_type"], "visits"),
        "test_result_mix": A.shares(silver, ["test_results"], "visits"),
        "condition_prevalence": A.shares(silver, ["medical_condition"], "visits"),
    }


def mart_visit_segments(noshows: DataFrame) -> dict[str, DataFrame]:
    """Segment and cohort per patient, segment sizes with retention at 30, 60
    and 90 days, and the same per cohort month."""
    from ..operators import segments as SG
    n = noshows if "lead_time" in noshows.columns else enrich_outpatient(noshows)
    n = n.withColumn("missed", ~F.col("showed_up"))
    profile = SG.visit_profile(n, "patientid", "appointmentday", "lead_time", "missed")
    return {"patients": profile, "by_segment": SG.retention_at(profile),
            "by_cohort": SG.retention_at(profile, "cohort_month")}


def clinical_risk_counts(patients: DataFrame, noshows: DataFrame, diabetes: DataFrame) -> DataFrame:
    """(risk, n_rows): appointments at high no-show risk, chronic patients
    without insurance, diabetes patients in the high tier."""
    def count(df, cond, name):
        return df.agg(F.lit(name).alias("risk"), F.count_if(cond).alias("n_rows"))

    return (count(enrich_outpatient(noshows), F.col("is_high_risk_noshow"), "high_no_show_risk")
            .unionByName(count(enrich_inpatient(patients), F.col("is_chronic") & F.col("insurance_provider").isNull(),
                               "chronic_uninsured"))
            .unionByName(count(enrich_diabetes(diabetes), F.col("diabetes_risk_tier") == "High", "diabetes_high")))


def mart_insurance_utilization(insurance: DataFrame, silver: DataFrame | None = None) -> dict[str, DataFrame]:
    """Average charges by region and smoker status, BMI↔charges correlation
    per age group, and (with silver) billing by provider / insured share."""
    age_group = C.bucket("age", INPATIENT_AGE_EDGES, INPATIENT_AGE_LABELS, "Unknown")
    out = {
        "by_region_smoker": insurance.groupBy("region", "smoker").agg(
            F.count(F.lit(1)).alias("members"), F.round(F.avg("charges"), 2).alias("avg_charges")),
        "bmi_charge_corr": insurance.withColumn("age_group", age_group).groupBy("age_group").agg(
            F.round(F.corr("bmi", "charges"), 6).alias("corr_bmi_charges"), F.count(F.lit(1)).alias("members")),
    }
    if silver is not None:
        out["by_provider"] = silver.groupBy("insurance_provider").agg(
            F.count(F.lit(1)).alias("patients"), F.round(F.avg("billing_amount"), 2).alias("avg_billing"))
        out["insured_rate"] = silver.agg(
            F.round(C.rate(F.col("insurance_provider").isNotNull()), 4).alias("insured_rate"))
    return out


def mart_diabetes_cohort(diabetes: DataFrame) -> dict[str, DataFrame]:
    """Status distribution, prevalence, glucose by age group, high-risk
    count and a BMI histogram (5-unit bins) by outcome."""
    d = enrich_diabetes(diabetes).withColumn("age_group", C.bucket("age", INPATIENT_AGE_EDGES, INPATIENT_AGE_LABELS,
                                                                    "Unknown"))
    return {
        "status_distribution": A.shares(d, ["glucose_status"], "patients"),
        "prevalence": d.agg(F.round(C.rate(F.col("outcome") == 1), 4).alias("prevalence"),
                            F.count_if(F.col("diabetes_risk_tier") == "High").alias("high_risk")),
        "glucose_by_age_group": d.groupBy("age_group").agg(F.round(F.avg("glucose"), 2).alias("avg_glucose")),
        "bmi_histogram": d.groupBy((F.floor(F.col("bmi") / 5) * 5).cast("int").alias("bmi_bin"), "outcome")
                          .agg(F.count(F.lit(1)).alias("patients")),
    }


def mart_data_quality(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Per dataset: files ingested in success, rows quarantined, NULL cells, rows that repeat
    another of their ingest run, and the score of these; and the NULL rate of each column.

    Both come from one profile per ingest run, which adds up."""
    from functools import reduce

    from ..operators import profile as P
    profiles = []
    for ds in DATASETS:
        bronze = read_bronze(spark, lake, ds)
        if bronze is not None:
            columns = [c for c in bronze.columns if c not in METADATA_COLS]
            profiles.append(P.batch_profile(bronze, ["ingest_run"], columns, Q.reason_expr(RULES[ds]).isNotNull())
                            .withColumn("dataset", F.lit(ds)))
    if not profiles:
        raise ValueError("no bronze table is there")
    every = reduce(DataFrame.unionByName, profiles)
    files = safe_read(spark, lake.inventory)
    rolled = P.rolled_up(every, ["dataset"])
    if files is None:
        rolled = rolled.withColumn("success", F.lit(None).cast("double"))
    else:
        rolled = rolled.join(files.groupBy("dataset").agg(F.avg((F.col("status") == "SUCCESS").cast("double")).alias("success")), "dataset", "left")
    return {"by_dataset": P.score(rolled, F.col("success")).drop("success"), "null_rates": P.null_rates(every, ["dataset"])}


# ---------------------------------------------------------------------------
# Silver domains and marts of the job
# ---------------------------------------------------------------------------
DOMAINS = {"inpatient": ("patients", enrich_inpatient), "outpatient": ("noshows", enrich_outpatient)}


def domain_rows(bronze: dict[str, DataFrame | None], rules: dict[str, list[Q.Rule]] | None = None) -> dict[str, DataFrame]:
    """Good, cleaned and enriched rows of each domain whose dataset is there."""
    rules = {**RULES, **(rules or {})}
    out = {}
    for domain, (ds, enrichment) in DOMAINS.items():
        if bronze.get(ds) is not None:
            good, _ = Q.split(Q.tag(bronze[ds], rules[ds]))
            rows = clean(ds, good).drop(*METADATA_COLS)
            if "name" in rows.columns:
                rows = rows.withColumn("name_norm", C.name_norm("name"))
            out[domain] = enrichment(rows)
    return out


def run_domains(spark: SparkSession, lake: Lake, load_date: date | str, run_id: str,
                rules: dict[str, list[Q.Rule]] | None = None) -> int:
    """Both silver domains as one new version: a single write that reads each
    bronze table once and lays its rows out by domain, so a reader sees both of a run or neither."""
    from functools import reduce
    frames = domain_rows({ds: read_bronze(spark, lake, ds) for ds, _ in DOMAINS.values()}, rules)
    if not frames:
        raise ValueError("no dataset of a domain is there")
    tagged = [df.withColumn("domain", F.lit(d)) for d, df in frames.items()]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return V.publish(every.withColumn("load_date", F.lit(str(load_date)).cast("date")), lake.domains, operation="WRITE",
                     parameters={"run_id": run_id}, partition_by=("domain", "load_date"))


def read_domain(spark: SparkSession, lake: Lake, domain: str, version: int | None = None) -> DataFrame | None:
    """One domain with its own columns (None if its dataset was not there); only its folders are read."""
    ds = DOMAINS[domain][0]
    own = domain_rows({ds: spark.createDataFrame([], bronze_schema(ds))})[domain].columns
    every = V.read_as_of(spark, lake.domains, version=version)
    return every.where(F.col("domain") == domain).select(*own, "load_date") if set(own) <= set(every.columns) else None


def marts(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The domain marts over what the lake holds now."""
    inpatient, outpatient = read_domain(spark, lake, "inpatient"), read_domain(spark, lake, "outpatient")
    out = {}
    if inpatient is not None:
        out["patient_summary"] = mart_patient_summary(inpatient)
        out |= {f"patient_mix_{n}": df for n, df in mart_patient_mix(inpatient).items()}
    if outpatient is not None:
        out["noshow_analytics"] = mart_noshow_analytics(outpatient)
        out |= {f"visit_segments_{n}": df for n, df in mart_visit_segments(outpatient).items()}
    ins, dia = read_bronze(spark, lake, "insurance"), read_bronze(spark, lake, "diabetes")
    if ins is not None:
        good, _ = Q.split(Q.tag(ins, RULES["insurance"]))
        out |= {f"insurance_{n}": df for n, df in mart_insurance_utilization(good, inpatient).items()}
    if dia is not None:
        good, _ = Q.split(Q.tag(clean("diabetes", dia), RULES["diabetes"]))
        out |= {f"diabetes_{n}": df for n, df in mart_diabetes_cohort(good).items()}
    return out | {f"data_quality_{n}": df for n, df in mart_data_quality(spark, lake).items()}


def run_marts(spark: SparkSession, lake: Lake, load_date: date | str) -> list[str]:
    """Publish every mart as a new version of its own table."""
    out = marts(spark, lake)
    for name, df in out.items():
        V.publish(df.withColumn("load_date", F.lit(str(load_date)).cast("date")), lake.mart(name), operation="MART",
                  parameters={"load_date": str(load_date)})
    return sorted(out)


def read_mart(spark: SparkSession, lake: Lake, name: str) -> DataFrame | None:
    return V.read_as_of(spark, lake.mart(name)) if V.current_version(spark, lake.mart(name)) is not None else None


# ---------------------------------------------------------------------------
# Layer inspection and DQ evidence over the lake
# ---------------------------------------------------------------------------
def layer_report(spark: SparkSession, lake: Lake, schemas: bool = False) -> DataFrame:
    """(dataset, n_rows, n_cols) for every bronze table, the quarantine, the
    current silver version and every gold table that exists; with
    ``schemas=True`` their columns instead (dataset, position, column, type)."""
    from ..operators.inspect import describe_columns, describe_layer
    frames: dict[str, DataFrame] = {}
    for ds in DATASETS:
        df = read_bronze(spark, lake, ds)
        if df is not None:
            frames[f"bronze.{ds}"] = df
    q = safe_read(spark, lake.quarantine, mergeSchema="true")
    if q is not None:
        frames["quarantine"] = q
    if V.current_version(spark, lake.silver) is not None:
        frames["silver"] = V.read_as_of(spark, lake.silver)
    for name in ("kpi_cost_by_gender", "kpi_cost_by_condition", "kpi_test_results_by_condition",
                 "kpi_diabetes_by_age_group"):
        g = read_gold(spark, lake, name)
        if g is not None:
            frames[f"gold.{name}"] = g
    if V.current_version(spark, lake.domains) is not None:
        frames |= {f"silver.{d}": df for d in DOMAINS if (df := read_domain(spark, lake, d)) is not None}
    for path in sorted(glob_dirs(spark, lake.mart("*"))):
        name = path.rstrip("/").rsplit("/", 1)[1]
        frames[f"mart.{name}"] = read_mart(spark, lake, name)
    for name, path in (("inventory", lake.inventory), ("schemas", lake.schemas)):
        df = safe_read(spark, path)
        if df is not None:
            frames[f"bronze.{name}"] = df
    return describe_columns(frames) if schemas else describe_layer(frames)


def dq_report(spark: SparkSession, lake: Lake) -> DataFrame:
    """Quarantined rows per (dataset, rule) plus NULL counts of every typed
    (non-string) column of each bronze dataset, as (dataset, kind, name,
    n_rows)."""
    from functools import reduce
    parts = []
    q = safe_read(spark, lake.quarantine, mergeSchema="true")
    if q is not None:
        parts.append(q.groupBy("dataset", F.col(Q.REASON_COL).alias("name"))
                      .agg(F.count(F.lit(1)).alias("n_rows"))
                      .select("dataset", F.lit("quarantine").alias("kind"), "name", "n_rows"))
    for ds in DATASETS:
        b = read_bronze(spark, lake, ds)
        if b is None:
            continue
        typed = [f.name for f in b.schema.fields
                 if not isinstance(f.dataType, T.StringType) and f.name not in METADATA_COLS]
        if not typed:
            continue
        nulls = b.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in typed])
        parts.append(nulls.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("long").alias("n_rows")) for c in typed]))
            .alias("s")).select(F.lit(ds).alias("dataset"), F.lit("nulls").alias("kind"), "s.name", "s.n_rows"))
    if not parts:
        return spark.createDataFrame([], "dataset string, kind string, name string, n_rows bigint")
    return reduce(DataFrame.unionByName, parts)
