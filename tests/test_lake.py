"""What the flow keeps besides its rows: key filters, inventories, schema history,
batch profiles, publish lags, visit state, dead letters, silver domains."""

import hashlib
import json
import os
import random
from datetime import date, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import write_text
from strata.operators import distinct as DI
from strata.operators import marts as M
from strata.operators import profile as P
from strata.operators import quality as Q
from strata.operators import segments as SG
from strata.plans import batch_job
from strata.plans import healthcare as H
from strata.plans.ingest import ingest_dataset
from strata.sources import files as FS
from strata.sources import key_index as KI
from strata.sources import schema_drift as SD
from strata.sources import versions as V
from strata.streaming import events as ST

PEOPLE = T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- natural keys over everything stored

def _people(spark, tmp, **more):
    return ingest_dataset(spark, f"{tmp}/raw", ["people"], PEOPLE, f"{tmp}/bronze", f"{tmp}/manifest", "c", "2024-01-01", **more)


def test_only_batches_that_may_hold_a_key_are_read(spark, tmp):
    key = [F.col("id")]
    for b in range(4):
        rows = spark.range(b * 1000, b * 1000 + 1000).withColumns({"load_date": F.lit("d"), "ingest_run": F.lit(f"b{b}"), "v": F.lit("x" * 50)})
        rows.write.mode("append").partitionBy("load_date", "ingest_run").parquet(f"{tmp}/t")
    assert KI.refresh(spark, f"{tmp}/t", f"{tmp}/k", key) == ["b0", "b1", "b2", "b3"]
    assert KI.refresh(spark, f"{tmp}/t", f"{tmp}/k", key) == []
    batch = spark.createDataFrame([(1500,), (3999,), (9999,), (9999,), (None,), (None,)], "id long")
    assert KI.batches_to_read(batch, f"{tmp}/k", key) == ["b1", "b3"]
    out = KI.unseen(batch, f"{tmp}/t", f"{tmp}/k", key)
    assert sorted(r.id or 0 for r in out.collect()) == [0, 0, 9999]
    plan = _plan(out)
    assert "ingest_run" in plan[plan.index("PartitionFilters"):] and "b1" in plan and "b3" in plan and "b2" not in plan
    assert "ReadSchema: struct<id:bigint>" in plan
    # keys that were never stored seldom pass a filter, keys that were always do
    passed = KI.candidates(spark.range(100_000, 110_000), f"{tmp}/k", key).count()
    assert passed <= 40
    assert KI.candidates(spark.range(0, 4000), f"{tmp}/k", key).select("__k0").distinct().count() == 4000


def test_key_dedup_over_runs_and_crashes(spark, tmp, monkeypatch):
    key = [F.lower("name"), F.col("age")]
    write_text(f"{tmp}/raw/people_1.csv", "name,age\nAnn,1\nann,1\nBob,2\n")
    assert _people(spark, tmp, natural_key=key) == 2
    write_text(f"{tmp}/raw/people_2.csv", "name,age\nANN,1\nCy,3\nDee,\nDee,\n")

    def crash(*a, **k):
        raise RuntimeError("lost before the manifest")

    monkeypatch.setattr(FS, "record_ingested", crash)
    with pytest.raises(RuntimeError):
        _people(spark, tmp, natural_key=key)
    monkeypatch.undo()
    # the second run's bronze has no filter yet: it is built before the third run asks
    write_text(f"{tmp}/raw/people_3.csv", "name,age\ncy,3\nEve,4\n")
    _people(spark, tmp, natural_key=key)
    got = sorted((r.name.lower(), r.age) for r in spark.read.parquet(f"{tmp}/bronze").collect() if r.age)
    assert got == [("ann", 1), ("bob", 2), ("cy", 3), ("eve", 4)]


def test_keys_with_a_hot_value(spark, tmp):
    rows = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    out = KI.unseen(rows, f"{tmp}/t", f"{tmp}/i", [F.col("k")])
    assert out.count() == out.distinct().count() == rows.distinct().count()


# ---- raw files

@pytest.mark.parametrize("range_bytes", [1, 7, 64, 10_000])
def test_digest_depends_on_content_and_range_only(spark, tmp, range_bytes):
    rng = random.Random(range_bytes)
    files = {"one.bin": b"x", "many.bin": bytes(rng.randrange(256) for _ in range(500)), "a b%.bin": b"spaces" * 20}
    os.makedirs(f"{tmp}/f")
    for name, data in files.items():
        with open(f"{tmp}/f/{name}", "wb") as f:
            f.write(data)
    got = {r.file_name: (r.size_bytes, r.n_ranges, r.digest) for r in FS.inventory(spark, f"{tmp}/f", ".bin", range_bytes=range_bytes).collect()}
    want = {}
    for name, data in files.items():
        parts = [data[i:i + range_bytes] for i in range(0, len(data), range_bytes)]
        tree = hashlib.md5("".join(hashlib.md5(p).hexdigest() for p in parts).encode()).hexdigest()
        want[name] = (len(data), len(parts), tree)
    assert got == want


def test_inventory_of_each_run(spark, tmp):
    write_text(f"{tmp}/raw/people_1.csv", "name,age\nAnn,1\nAnn,1\n,\n")
    write_text(f"{tmp}/raw/people_2.csv", "name,age\n")
    _people(spark, tmp, inventory_path=f"{tmp}/inv", schema_path=f"{tmp}/schemas")
    write_text(f"{tmp}/raw/people_3.csv", "age,name\n1,Ann\n")
    for _ in range(2):  # a retry replaces its rows
        with pytest.raises(Exception):
            _people(spark, tmp, inventory_path=f"{tmp}/inv", schema_path=f"{tmp}/schemas")
    rows = {(r.file_name, r.row_count, r.status) for r in spark.read.parquet(f"{tmp}/inv").collect()}
    assert rows == {("people_1.csv", 1, "SUCCESS"), ("people_2.csv", 0, "SUCCESS"), ("people_3.csv", None, "FAILED")}
    assert spark.read.parquet(f"{tmp}/inv").count() == 3
    assert [r.column for r in SD.snapshots(spark, f"{tmp}/schemas").orderBy("position").collect()][:2] == ["name", "age"]


def test_cells_with_line_breaks_are_never_cut(spark, tmp):
    broken = write_text(f"{tmp}/raw/people_1.csv", 'name,age\n"line one\nline ""two"", end",1\nBob,2\n')
    write_text(f"{tmp}/raw/people_2.csv", 'name,age\n"Cy ""the"" third",3\n"""",4\n')
    paths = [r.path for r in FS.list_files(spark, f"{tmp}/raw").collect()]
    assert [FS._bare(p) for p in FS.files_with_line_breaks(spark, paths)] == [FS._bare("file:" + broken)]
    with pytest.raises(ValueError, match="line breaks"):
        FS.read_csv_files(spark, paths, PEOPLE, multiline=False)
    want = {('line one\nline "two", end', 1), ("Bob", 2), ('Cy "the" third', 3), ('"', 4)}
    for multiline in (None, True):
        assert {(r.name, r.age) for r in FS.read_csv_files(spark, paths, PEOPLE, multiline).collect()} == want
    assert _people(spark, tmp) == 4


def test_malformed_cells(spark, tmp):
    f = write_text(f"{tmp}/x.csv", "name,age\nAnn,x\nBob,2\nCy,\n,2.5\n")
    assert [(r.column, r.n_rows, r.n_malformed) for r in FS.malformed_cells(spark, f, PEOPLE).collect()] == [("age", 4, 2)]


# ---- schemas

@pytest.mark.parametrize("old,new,change", [
    ("int", "bigint", "widened"), ("bigint", "int", "narrowed"), ("int", "double", "widened"), ("bigint", "double", "retyped"),
    ("int", "float", "retyped"), ("date", "timestamp_ntz", "widened"), ("string", "int", "retyped"), ("int", "string", "retyped"),
    ("decimal(10,2)", "decimal(12,4)", "widened"), ("decimal(10,2)", "decimal(10,4)", "retyped"), ("decimal(12,4)", "decimal(10,2)", "narrowed"),
    ("int", "decimal(10,0)", "widened"), ("int", "decimal(11,2)", "retyped"), ("bigint", "decimal(21,2)", "widened"), ("decimal(19,0)", "bigint", "narrowed")])
def test_retyping(spark, old, new, change):
    df = spark.createDataFrame([(old, new)], "o string, n string")
    assert df.select(SD.retyping(F.col("o"), F.col("n")).alias("c")).first().c == change


def test_history_compares_consecutive_runs_of_each_table(spark, tmp):
    def snap(table, run, day, **cols):
        schema = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in cols.items()])
        SD.record(spark.createDataFrame([], schema), f"{tmp}/s", table, run, datetime(2024, 1, day))

    snap("a", "z", 1, x="int", y="string")
    snap("a", "k", 2, x="int")
    snap("a", "m", 3, x="bigint", y="string")
    snap("b", "k", 2, q="int")
    got = sorted((r.table, r.run, r.column, r.change) for r in SD.history(SD.snapshots(spark, f"{tmp}/s")).collect())
    assert got == [("a", "k", "y", "removed"), ("a", "m", "x", "widened"), ("a", "m", "y", "added")]


# ---- batches

@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 5 * 86400))), max_size=25),
       st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 5 * 86400)), max_size=8))
def test_next_publish_brute_force(spark, arrivals, publishes):
    t0 = datetime(2024, 1, 1)
    at = lambda s: None if s is None else t0 + timedelta(seconds=s)
    a = spark.createDataFrame([(i, f, at(s)) for i, (f, s) in enumerate(arrivals)], "i int, f string, ts timestamp_ntz")
    p = spark.createDataFrame([(f, at(s)) for f, s in publishes] * 2, "f string, ts timestamp_ntz")
    got = {r.i: r.published_at for r in M.next_publish(a, p, ["f"], "ts").collect()}
    assert got == {i: min((at(q) for g, q in publishes if g == f and s is not None and q >= s), default=None)
                   for i, (f, s) in enumerate(arrivals)}


def test_sketches_roll_up_within_their_error(spark):
    # 30 batches, every row in two of them, one row a third of all
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.floor(F.col("id") / 2)).alias("x"), (F.col("id") % 30).cast("int").alias("batch"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 2).alias("y"))
    p = P.batch_profile(rows, ["batch"], ["x", "y"], F.col("x") < 0)
    r = P.rolled_up(p).first()
    exact = rows.select("x", "y").distinct().count()
    assert (r.n_batches, r.n_rows, r.n_rejected, r.n_cells) == (30, 60_000, 20_000, 120_000)
    assert r.n_null_cells == 15_000
    assert abs(r.different - exact) <= 4 * 1.04 / 2 ** (P.LOG_K / 2) * exact
    per = {x.batch: x.n for x in rows.groupBy("batch").agg(F.count_distinct("x", F.coalesce("y", F.lit(9))).alias("n")).collect()}
    assert {x.batch: x.n_different for x in p.collect()} == per
    empty = P.rolled_up(P.batch_profile(rows.limit(0), ["batch"], ["x"])).first()
    assert (empty.n_batches, empty.n_rows) == (0, 0)
    assert P.score(P.rolled_up(P.batch_profile(rows.limit(0), ["batch"], ["x"])), F.lit(1.0)).first().quality_score is None


def test_distinct_by_equals_count_distinct(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2]), rng.choice([None, *(f"n{k}" for k in range(40))]), rng.randint(0, 9)) for _ in range(600)]
    df = spark.createDataFrame(rows, "d string, e int, name string, v int")
    ids = DI.dense_ids(df, "name")
    assert sorted(r.id for r in ids.collect()) == list(range(40))
    out = DI.distinct_by(df.join(ids, "name", "left"), ["d", "e"], "id", {"v": F.col("v")})
    got = {(r.gid, r.d, r.e): (r.n_rows, r.n_distinct, r.v) for r in out.collect()}
    want = {}
    for gid, of in ((3, lambda r: (None, None)), (1, lambda r: (r[0], None)), (2, lambda r: (None, r[1]))):
        for k in {of(r) for r in rows}:
            some = [r for r in rows if of(r) == k]
            want[(gid, *k)] = (len(some), len({r[2] for r in some} - {None}), sum(r[3] for r in some))
    assert got == want
    plan = _plan(out)
    expand = plan[plan.rindex("Expand"):] if "Expand" in plan else ""
    assert "bitmap_construct_agg" in expand  # rows are reduced to bitmaps below the expansion
    # ids beyond one bitmap
    far = spark.range(100_000).select((F.col("id") * 7).alias("id"), F.lit(1).alias("one"))
    assert {r.n_distinct for r in DI.distinct_by(far.unionByName(far), ["one"], "id").collect()} == {100_000}


# ---- visits

@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 120), st.integers(0, 3)), min_size=1, max_size=30))
def test_visit_state_equals_full_recomputation(spark, visits):
    rows = spark.createDataFrame([(e, date(2024, 1, 1) + timedelta(days=n), p) for e, n, p in visits], "e int, d date, p int")
    state = SG.visit_state(rows.filter("p = 3"), "e", "d")  # in any order: late days come last or first
    for p in (0, 2, 1):
        state = SG.merge_visit_state(state, SG.visit_state(rows.filter(F.col("p") == p), "e", "d"), "e")
    full = SG.first_visit_flags(rows, "e", "d")
    assert sorted(map(tuple, SG.flags_of_state(state).select(*full.columns).collect())) == sorted(map(tuple, full.collect()))


# ---- stream

def test_dead_letters_survive_a_kill(spark, tmp):
    messages = ['{"id": 1, "v": "a"}', '{"id": null}', "{}", "nonsense", "[1]", "", " ", '{"id": "x"}', '{"id": 2}', "3", None]
    spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.parquet(f"{tmp}/in")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])

    def run():
        src = ST.file_source(spark, f"{tmp}/in", "value string", glob="*.parquet")
        ST.start_with_dead_letters(ST.split_messages(src, schema, "id"), f"{tmp}/sink", f"{tmp}/check", available_now=True).awaitTermination()

    run()
    # killed after the write, before the commit of the epoch: it is replayed
    for f in os.listdir(f"{tmp}/check/commits"):
        os.replace(f"{tmp}/check/commits/{f}", f"{tmp}/{f.replace('.', '_')}-gone")
    run()
    assert sorted((r.id, r.v) for r in ST.read_rows(spark, f"{tmp}/sink").collect()) == [(1, "a"), (2, None)]
    dead = sorted(((r.value, r.reason) for r in ST.read_dead_letters(spark, f"{tmp}/sink").collect()), key=str)
    assert dead == sorted([('{"id": null}', "no_key"), ("{}", "no_key"), ("nonsense", "unparsable"), ("[1]", "unparsable"), ("", "empty"),
                           (" ", "empty"), ('{"id": "x"}', "no_key"), ("3", "unparsable"), (None, "empty")], key=str)


# ---- tables

def test_append_keeps_the_layout(spark, tmp):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    V.publish(df, f"{tmp}/t", partition_by=("p",))
    V.publish(df, f"{tmp}/t", mode="append")
    assert sorted((r.id, r.p) for r in V.read_as_of(spark, f"{tmp}/t").collect()) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    with pytest.raises(ValueError, match="laid out"):
        V.publish(df, f"{tmp}/t", mode="append", partition_by=("id",))
    V.publish(df, f"{tmp}/u")
    with pytest.raises(ValueError, match="laid out"):
        V.publish(df, f"{tmp}/u", mode="append", partition_by=("p",))


def test_a_run_id_used_twice_releases_rows(spark, tmp):
    df = spark.createDataFrame([(1, -1, "a:1"), (2, 5, "a:1"), (3, -3, None), (4, 2, "c")], "id int, x int, batch string")

    def run(rules):
        bad = Q.split(Q.tag(df, rules))[1]
        Q.write_quarantine(bad, f"{tmp}/q", "d", "same", batch_col="batch", checked=df)
        return sorted(r.id for r in Q.read_quarantine(spark, f"{tmp}/q").collect())

    assert run([Q.Rule("negative", "x < 0")]) == [1, 3]
    assert run([Q.Rule("small", "x < 3 AND x > 0")]) == [4]
    assert run([Q.Rule("large", "x > 3")]) == [2]


# ---- the flow

def _raw(tmp):
    write_text(f"{tmp}/raw/patients.csv", "Name,Age,Gender,Blood Type,Medical Condition,Date of Admission,Doctor,Hospital,Insurance Provider,"
               "Billing Amount,Room Number,Admission Type,Discharge Date,Medication,Test Results\n"
               'bobby JacksOn,30,Male,A+,Cancer,2024-01-01,"Dr.\nNo",St. Mary,Aetna,100.5,1,Urgent,2024-01-05,x,Normal\n'
               "Bobby Jackson,30,Male,A+,Cancer,2024-01-01,Dr. Who,St. Mary,Aetna,100.5,1,Urgent,2024-01-05,x,Normal\n"
               "Ann,,Female,A+,Asthma,2024-01-01,Dr. No,St. Mary,,7.0,1,Urgent,2024-01-05,x,Normal\n")
    write_text(f"{tmp}/raw/noshows.csv", "PatientId,AppointmentID,Gender,ScheduledDay,AppointmentDay,Age,Neighbourhood,Scholarship,Hipertension,Diabetes,"
               "Alcoholism,Handcap,SMS_received,Showed_up,Date.diff\n"
               "29872499824296,5,F,2024-01-01,2024-01-20,62,X,true,true,false,false,false,false,true,19\n"
               "29872499824296,6,F,2024-01-01,2024-02-02,62,X,,true,false,false,false,false,false,19\n")
    write_text(f"{tmp}/raw/diabetes.csv", "Id,Pregnancies,Glucose,BloodPressure,SkinThickness,Insulin,BMI,DiabetesPedigreeFunction,Age,Outcome\n"
               "1,0,130,0,1,0,33.0,0.5,40,1\n")
    write_text(f"{tmp}/raw/insurance.csv", "age,sex,bmi,children,smoker,region,charges\n30,male,22.5,0,no,north,100.0\n30,male,22.5,1,yes,north,200.0\n")
    return f"{tmp}/raw"


def test_whole_job_writes_every_layer(spark, tmp):
    raw = _raw(tmp)
    lake = H.Lake(f"{tmp}/lake")
    args = ["--mode", "all", "--raw", raw, "--lake", lake.root, "--load-date", "2024-02-01", "--dedup-scope", "key"]
    assert batch_job.main(args) == 0
    layers = {r.dataset: r.n_rows for r in H.layer_report(spark, lake).collect()}
    # one patient and one policy of each natural key; the cell with a line break is whole
    assert layers["bronze.patients"] == 2 and layers["bronze.insurance"] == 1 and layers["bronze.noshows"] == 2
    assert layers["bronze.inventory"] == 4 and layers["silver.inpatient"] == 1 and layers["silver.outpatient"] == 2
    marts = {n for n in layers if n.startswith("mart.")}
    assert {"mart.patient_summary", "mart.noshow_analytics", "mart.patient_mix_billing_by_hospital", "mart.visit_segments_by_cohort",
            "mart.diabetes_prevalence", "mart.insurance_by_region_smoker"} <= marts
    inn = H.read_domain(spark, lake, "inpatient").first()
    assert (inn.name, inn.name_norm, inn.length_of_stay) == ("Bobby Jackson", "bobby jackson", 4)
    out = sorted(H.read_domain(spark, lake, "outpatient").collect(), key=lambda r: r.appointmentid)
    assert [(r.patientid, r.hypertension, r.lead_time, r.is_high_risk_noshow) for r in out] == [
        ("29872499824296", True, 19, True), ("29872499824296", True, 32, False)]  # an unknown scholarship is no finding
    assert "name" not in out[0].asDict() and "lead_time" not in inn.asDict()
    assert H.read_mart(spark, lake, "diabetes_prevalence").first().high_risk == 1
    dq = {r.dataset: r for r in H.read_mart(spark, lake, "data_quality_by_dataset").collect()}
    assert (dq["patients"].n_rows, dq["patients"].quarantine_rate, dq["patients"].success_rate) == (2, 0.5, 1.0)
    assert (dq["noshows"].null_rate, dq["noshows"].quality_score) == (round(1 / 30, 4), round(0.8 + 0.2 * 29 / 30, 4))
    nulls = {(r.dataset, r.column): r.null_rate for r in H.read_mart(spark, lake, "data_quality_null_rates").collect()}
    assert nulls["noshows", "scholarship"] == 0.5 and nulls["patients", "age"] == 0.5 and nulls["patients", "doctor"] == 0.0
    # again: nothing new, and the domains are replaced together
    assert batch_job.main(args) == 0
    assert {r.dataset: r.n_rows for r in H.layer_report(spark, lake).collect()} == layers
    assert V.current_version(spark, lake.domains) == 1


def test_domains_are_one_write_over_one_scan_each(spark, tmp):
    lake = H.Lake(f"{tmp}/lake")
    H.run_bronze(spark, _raw(tmp), lake, "2024-02-01", records=False)
    frames = H.domain_rows({ds: H.read_bronze(spark, lake, ds) for ds, _ in H.DOMAINS.values()})
    for domain, df in frames.items():
        assert _plan(df).count("FileScan") == 1 and "Exchange" not in _plan(df), domain
    H.run_domains(spark, lake, "2024-02-01", "r")
    history = V.history(spark, lake.domains).collect()
    assert len(history) == 1 and json.loads(history[0].parameters) == {"run_id": "r"}
    assert "PartitionFilters: [isnotnull(domain" in _plan(H.read_domain(spark, lake, "inpatient"))


def test_zero_flags_keep_the_value(spark):
    r = H.clean("diabetes", spark.createDataFrame([(0, 5, None)], "insulin int, glucose int, bloodpressure int")).first()
    assert (r.insulin, r.insulin_is_missing, r.glucose_is_missing, r.bloodpressure_is_missing) == (0, True, False, None)


def test_partitions_chosen_by_a_joined_list(spark):
    import __spark_entry__ as E
    df = E.queries()["partition_pruned_join"](spark, "/root/testdata/sf0.001")
    assert "dynamicpruning" in _plan(df)
    df.collect()
    nodes = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in nodes
