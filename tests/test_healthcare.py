"""End-to-end medallion run on small CSV fixtures, including the golden
bad-data scenario (4 rows in → bronze 4, quarantine 3, silver 1)."""

from pyspark.sql import functions as F

from conftest import write_text
from strata.plans import batch_job
from strata.plans import healthcare as H
from strata.sources import versions as V

PATIENTS = (
    "Name,Age,Gender,Blood Type,Medical Condition,Date of Admission,Doctor,Hospital,Insurance Provider,"
    "Billing Amount,Room Number,Admission Type,Discharge Date,Medication,Test Results\n"
    "Alice TypeEnforce,45,Female,A+,Diabetes,2024-01-01,Dr X,H1,Medicare,5000.50,INVALID_ROOM,Urgent,2024-01-05,Aspirin,Normal\n"
    "Bob NegativeAge,-999,Male,B+,Asthma,2024-01-01,Dr Y,H1,Aetna,1000,101,Urgent,2024-01-02,X,Normal\n"
    ",35,Male,O+,Cancer,2024-01-01,Dr Z,H2,Aetna,1000,102,Elective,2024-01-03,Y,Abnormal\n"
    "Dave NegBilling,30,Male,AB-,Obesity,2024-01-01,Dr Q,H2,Cigna,-100.00,103,Emergency,2024-01-02,Z,Normal\n")
INSURANCE = ("age,sex,bmi,children,smoker,region,charges\n"
             "45,female,30.0,1,no,ne,100.0\n45,female,20.0,0,yes,nw,300.0\n45,male,25.0,0,no,ne,999.0\n"
             "-1,female,20.0,0,no,ne,5.0\n")
DIABETES = ("Id,Pregnancies,Glucose,BloodPressure,SkinThickness,Insulin,BMI,DiabetesPedigreeFunction,Age,Outcome\n"
            "1,0,100,70,20,80,30.0,0.5,45,1\n2,0,120,70,20,100,20.0,0.5,45,0\n3,0,0,70,20,100,20.0,0.5,45,1\n")
NOSHOWS = ("PatientId,AppointmentID,Gender,ScheduledDay,AppointmentDay,Age,Neighbourhood,Scholarship,Hipertension,"
           "Diabetes,Alcoholism,Handcap,SMS_received,Showed_up,Date.diff\n"
           "29872499824296,1,F,2024-01-01,2024-01-10,45,X,true,false,false,false,false,false,true,9\n"
           "1.0,2,F,2024-01-01,2024-01-02,45,X,false,false,false,false,false,true,false,1\n"
           ",3,M,2024-01-01,2024-01-02,45,X,false,false,false,false,false,true,true,1\n")


def _raw(tmp):
    write_text(f"{tmp}/raw/patients/patients.csv", PATIENTS)
    write_text(f"{tmp}/raw/insurance.csv", INSURANCE)
    write_text(f"{tmp}/raw/diabetes.csv", DIABETES)
    write_text(f"{tmp}/raw/noshows.csv", NOSHOWS)
    return f"{tmp}/raw"


def test_end_to_end_golden(spark, tmp, caplog):
    caplog.set_level("INFO", logger="strata.healthcare")
    lake = H.Lake(f"{tmp}/lake")
    counts = H.run_bronze(spark, _raw(tmp), lake, "2024-02-01")
    assert counts == {"patients": 4, "insurance": 4, "diabetes": 3, "noshows": 3}
    alice = spark.read.parquet(lake.bronze("patients")).filter("name = 'Alice TypeEnforce'").first()
    assert alice.room_number is None and alice.billing_amount == 5000.5
    # the declared bronze schema is exactly what ingestion writes
    for ds in H.DATASETS:
        written = spark.read.option("mergeSchema", "true").parquet(lake.bronze(ds)).schema
        assert [(f.name, f.dataType) for f in written] == \
            [(f.name, f.dataType) for f in H.bronze_schema(ds)], ds

    v = H.run_silver(spark, lake, "2024-02-01", "run-1")
    # DQ totals come from the observation on the quarantine write (all rows, no extra job)
    dq = [r.getMessage() for r in caplog.records if r.getMessage().startswith("[DQ]")]
    assert "[DQ] dataset=patients rows=4 bad=3 share=0.7500 " \
           "invalid_age=1 null_name=1 invalid_billing=1" in dq
    q = spark.read.parquet(lake.quarantine)
    reasons = {(r.dataset, r.dq_failed_rule) for r in q.collect()}
    assert {("patients", "invalid_age"), ("patients", "null_name"), ("patients", "invalid_billing"),
            ("insurance", "invalid_age"), ("diabetes", "zero_glucose"), ("noshows", "null_patientid")} == reasons
    assert q.filter("dataset = 'patients'").count() == 3

    silver = V.read_as_of(spark, lake.silver, version=v)
    rows = silver.collect()
    assert len(rows) == 1
    s = rows[0]
    assert (s.name, s.gender, s.name_norm) == ("Alice TypeEnforce", "female", "alice typeenforce")
    assert (s.avg_insurance_charge, s.insurance_channel_size) == (200.0, 2)
    assert (s.avg_glucose, s.diabetes_positive_rate, s.lab_channel_size) == (110.0, 0.5, 2)
    assert (s.appointment_show_rate, s.appointment_channel_size) == (0.5, 2)
    assert s.dataset == "healthcare_unified"

    # re-running silver — same run id or a new one — does not duplicate quarantine rows:
    # they are partitioned by the bronze batch they came from
    H.run_silver(spark, lake, "2024-02-01", "run-1")
    assert spark.read.parquet(lake.quarantine).filter("dataset = 'patients'").count() == 3
    H.run_silver(spark, lake, "2024-02-02", "run-2")
    q2 = spark.read.parquet(lake.quarantine).filter("dataset = 'patients'")
    assert q2.count() == 3 and {r.run_id for r in q2.select("run_id").distinct().collect()} == {"run-2"}

    H.run_gold(spark, lake, "2024-02-01")
    g = H.read_gold(spark, lake, "kpi_diabetes_by_age_group").collect()
    assert [(r.age_group, r.diabetes_positive_rate, r.avg_glucose, r.patient_count) for r in g] == [
        ("45-59", 0.5, 110.0, 1)]
    c = H.read_gold(spark, lake, "kpi_cost_by_gender").first()
    assert (c.gender, c.avg_insurance_charges, c.avg_treatment_cost) == ("female", 200.0, 5000.5)

    # a later run replaces the whole KPI table by default; keep_other_days
    # keeps earlier load dates next to the new one
    H.run_gold(spark, lake, "2024-02-02")
    days = lambda: sorted(str(r.load_date) for r in
                          H.read_gold(spark, lake, "kpi_cost_by_gender").select("load_date").collect())
    assert days() == ["2024-02-02"]
    # each gold run is an atomic new version; the earlier one stays readable
    assert [str(r.load_date) for r in H.read_gold(spark, lake, "kpi_cost_by_gender", version=0)
            .select("load_date").collect()] == ["2024-02-01"]
    H.run_gold(spark, lake, "2024-02-03", keep_other_days=True)
    assert days() == ["2024-02-02", "2024-02-03"]

    # bronze re-run adds nothing
    assert H.run_bronze(spark, f"{tmp}/raw", lake, "2024-02-01") == {k: 0 for k in counts}


def test_missing_primary_raises(spark):
    import pytest
    with pytest.raises(ValueError):
        H.build_silver({"patients": None}, "2024-01-01")


def test_batch_cli(spark, tmp):
    raw = _raw(tmp)
    args = ["--mode", "all", "--raw", raw, "--lake", f"{tmp}/lake", "--load-date", "2024-02-01"]
    assert batch_job.main(args) == 0
    lake = H.Lake(f"{tmp}/lake")
    bronze = sum(spark.read.parquet(lake.bronze(ds)).count() for ds in H.DATASETS)
    quarantined = spark.read.parquet(lake.quarantine).count()
    # the whole job re-run: nothing new in bronze, no duplicated quarantine
    # rows, one more silver and gold version with the same content
    assert batch_job.main(args[:-1] + ["2024-02-02"]) == 0
    assert sum(spark.read.parquet(lake.bronze(ds)).count() for ds in H.DATASETS) == bronze
    assert spark.read.parquet(lake.quarantine).count() == quarantined
    assert V.current_version(spark, lake.silver) == 1
    assert V.current_version(spark, lake.gold("kpi_cost_by_gender")) == 1
    assert H.read_gold(spark, lake, "kpi_cost_by_gender").count() == \
        H.read_gold(spark, lake, "kpi_cost_by_gender", version=0).count()
    assert batch_job.main(["--mode", "gold", "--raw", raw, "--lake", f"{tmp}/nolake"]) == 2


def test_domain_enrichments(spark):
    p = spark.createDataFrame([("2024-01-01", "2024-01-01", 100.0, 20, "Diabetes", "Medicare"),
                               ("2024-01-01", "2024-01-05", 100.0, 71, "Flu", None)],
                              "date_of_admission string, discharge_date string, billing_amount double, age int, "
                              "medical_condition string, insurance_provider string") \
        .select(F.to_date("date_of_admission").alias("date_of_admission"),
                F.to_date("discharge_date").alias("discharge_date"), "billing_amount", "age",
                "medical_condition", "insurance_provider")
    r = [(x.length_of_stay, x.cost_per_day, x.age_group, x.is_chronic, x.insurance_tier)
         for x in H.enrich_inpatient(p).collect()]
    assert r == [(0, None, "18-35", True, "Government"), (4, 25.0, "71+", False, "Unknown")]
    d = spark.createDataFrame([(130, 22.0, 1), (90, 22.0, 0), (110, 31.0, 0)], "glucose int, bmi double, outcome int")
    assert [(x.glucose_status, x.bmi_category, x.diabetes_risk_tier) for x in H.enrich_diabetes(d).collect()] == [
        ("Diabetes", "Normal", "High"), ("Normal", "Normal", "Low"), ("Prediabetes", "Obese", "Medium")]


def test_marts_on_fixtures(spark, tmp):
    lake = H.Lake(f"{tmp}/lake")
    H.run_bronze(spark, _raw(tmp), lake, "2024-02-01")
    v = H.run_silver(spark, lake, "2024-02-01", "r")
    silver = V.read_as_of(spark, lake.silver, version=v)
    nos = H.fix_noshow_names(spark.read.parquet(lake.bronze("noshows")).filter("patientid IS NOT NULL"))
    assert "hypertension" in nos.columns and "handicap" in nos.columns and "date_diff" in nos.columns
    assert sorted(r.patientid for r in nos.collect()) == ["1", "29872499824296"]
    m = H.mart_noshow_analytics(nos)
    overall = m.filter("appointment_month IS NULL AND neighbourhood IS NULL AND age_group IS NULL "
                       "AND sms_received IS NULL AND scholarship IS NULL AND lead_bucket IS NULL "
                       "AND day_of_week IS NULL").first()
    assert (overall.appointments, overall.noshow_rate) == (2, 0.5)
    ps = H.mart_patient_summary(silver).filter("gid = 7").first()
    assert (ps.patients, ps.visits, ps.avg_billing, ps.avg_length_of_stay) == (1, 1, 5000.5, 4.0)
    ins = H.mart_insurance_utilization(spark.read.parquet(lake.bronze("insurance")), silver)
    assert ins["insured_rate"].first().insured_rate == 1.0
    dia = H.mart_diabetes_cohort(spark.read.parquet(lake.bronze("diabetes")))
    assert dia["prevalence"].first().prevalence == round(2 / 3, 4)


def test_schema_drift(spark):
    from strata.sources.schema_drift import drift, schema_rows
    a = spark.createDataFrame([(1, "x", 1.0)], "id int, name string, v double")
    b = spark.createDataFrame([(1, 1, "z")], "id int, name int, extra string")
    d = {(r.column, r.change) for r in drift(schema_rows(spark, a, "t", "r1"), schema_rows(spark, b, "t", "r2")).collect()}
    assert d == {("name", "retyped"), ("v", "removed"), ("extra", "added")}


def test_layer_and_dq_reports(spark, tmp):
    lake = H.Lake(f"{tmp}/lake")
    H.run_bronze(spark, _raw(tmp), lake, "2024-02-01")
    H.run_silver(spark, lake, "2024-02-01", "r")
    H.run_gold(spark, lake, "2024-02-01")
    layers = {r.dataset: r.n_rows for r in H.layer_report(spark, lake).collect()}
    assert layers["bronze.patients"] == 4 and layers["silver"] == 1 and layers["quarantine"] == 6
    assert layers["gold.kpi_cost_by_gender"] == 1
    cols = {(r.dataset, r.column): r.type for r in H.layer_report(spark, lake, schemas=True).collect()}
    assert cols[("bronze.patients", "billing_amount")] == "double"
    assert cols[("silver", "name_norm")] == "string"
    assert cols[("gold.kpi_cost_by_gender", "load_date")] == "date"
    rep = {(r.dataset, r.kind, r.name): r.n_rows for r in H.dq_report(spark, lake).collect()}
    assert rep[("patients", "quarantine", "invalid_age")] == 1
    assert rep[("patients", "nulls", "room_number")] == 1
    assert rep[("noshows", "nulls", "patientid")] == 1


def test_rules_and_bins_are_parameters(spark):
    from strata.operators import quality as Q
    p = spark.createDataFrame([("A", 20, "Male", 100.0), ("B", 50, "Female", 200.0)],
                              "name string, age int, gender string, billing_amount double")
    strict = {"patients": [Q.Rule("too_old", "age > 40")]}
    unified, gates = H.build_silver({"patients": p}, "2024-01-01", rules=strict)
    assert [r.name for r in unified.collect()] == ["A"]
    assert [r.dq_failed_rule for r in gates["patients"].bad.collect()] == ["too_old"]
    silver = p.withColumns({"diabetes_positive_rate": F.lit(0.5), "avg_glucose": F.lit(1.0),
                            "avg_insurance_charge": F.lit(1.0), "medical_condition": F.lit("x"),
                            "test_results": F.lit("Normal")})
    g = H.kpis(silver, [35], ["young", "old"])["kpi_diabetes_by_age_group"]
    assert sorted((r.age_group, r.patient_count) for r in g.collect()) == [("old", 1), ("young", 1)]
