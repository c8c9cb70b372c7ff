from pyspark.sql import functions as F

from strata.operators import aggregate as A
from strata.operators import marts as M
from strata.operators import segments as SG


def test_pivot_share(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", "x"), ("b", "q")], "r string, c string")
    rows = {r.r: r for r in A.pivot_share(df, "r", "c", ["x", "y"]).collect()}
    assert (rows["a"].n_x, rows["a"].n_y, rows["a"].n_total, rows["a"].share_y) == (1, 2, 3, 0.6667)
    b = rows["b"]
    assert (b.n_x, b.n_y, b.n_other, b.n_total, b.share_x, b.share_y, b.share_other) == (1, 0, 1, 2, 0.5, 0.0, 0.5)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    r = A.null_profile(df).first()
    assert (r.n_rows, r.a_nulls, r.b_nulls) == (3, 1, 2)


def test_top_k_total_order(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 7.0)], "k int, v double")
    assert [r.k for r in A.top_k(df, 2, [F.desc("v"), F.asc("k")]).collect()] == [3, 1]


def test_daily_trend_alert(spark):
    df = spark.createDataFrame([("2024-01-01",)] * 10 + [("2024-01-02",)] * 7 + [("2024-01-04",)] * 7,
                               "d string").select(F.to_timestamp("d").alias("ts"))
    rows = {str(r.day): r for r in M.daily_trend(df, "ts").collect()}
    assert rows["2024-01-02"].pct_change == -0.3 and rows["2024-01-02"].drop_alert
    assert rows["2024-01-01"].prev_n_rows is None and not rows["2024-01-01"].drop_alert
    assert rows["2024-01-04"].prev_n_rows is None  # previous *calendar* day has no rows


def test_retention_flags(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-20"), (2, "2024-01-05"), (2, "2024-03-30"),
                                (3, "2024-02-01"), (3, "2024-02-01")], "id int, d string")
    flags = {r.id: (r.retained_30, r.retained_60, r.retained_90)
             for r in SG.first_visit_flags(df, "id", "d").collect()}
    assert flags == {1: (1, 1, 1), 2: (0, 0, 1), 3: (0, 0, 0)}  # same-day repeat is not a return
    coh = {str(r.cohort_month): r.cohort_size for r in SG.cohort_retention(SG.first_visit_flags(df, "id", "d")).collect()}
    assert coh == {"2024-01-01": 2, "2024-02-01": 1}


def test_grouping_sets(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "d1 string, d2 string, v int")
    out = M.overall_and_by(df, ["d1", "d2"], [F.sum("v").alias("s")])
    rows = [(r.d1, r.d2, r.gid, r.s) for r in out.collect()]
    assert (None, None, 3, 6) in rows and ("a", None, 1, 3) in rows and (None, "x", 2, 4) in rows
    assert len(rows) == 5


def test_entity_profile_matches_rfm_and_flags(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", 10.0), (1, "2024-01-20", 5.0), (1, "2024-01-20", 1.0), (2, "2024-01-05", 7.0),
         (2, "2024-03-30", 2.0), (3, "2024-02-01", 4.0), (3, "2024-02-01", 4.0)],
        "id int, d string, amt double")
    ref = "2024-04-01"
    prof = {r.id: r for r in SG.entity_profile(df, "id", "d", "amt", ref).collect()}
    rfm = {r.id: r for r in SG.rfm(df, "id", "d", "amt", ref).collect()}
    flags = {r.id: r for r in SG.first_visit_flags(df, "id", "d").collect()}
    assert prof.keys() == rfm.keys() == flags.keys()
    for k, p in prof.items():
        for c in ("first_visit", "last_visit", "frequency", "monetary", "recency", "tenure", "segment"):
            assert p[c] == rfm[k][c], (k, c)
        for c in ("retained_30", "retained_60", "retained_90"):
            assert p[c] == flags[k][c], (k, c)
    assert prof[1].frequency == 3 and prof[1].monetary == 16.0


def test_retention_ignores_events_without_entity(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-10"), (None, "2024-01-02")], "id int, d string")
    flags = SG.first_visit_flags(df, "id", "d").collect()
    assert [(r.id, r.retained_30) for r in flags] == [(1, 1)]


def test_quality_score_empty_input_gives_null_rates(spark):
    from strata.operators import quality as Q
    df = spark.createDataFrame([], "k int, v int")
    r = M.quality_score(Q.tag(df, [Q.Rule("neg", "v < 0")]), Q.REASON_COL, ["k", "v"], ["k"]).first()
    assert (r.n_rows, r.success_rate, r.quality_score) == (0, None, None)


def test_unparsable_dates_do_not_fail_jobs(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (1, "not a date"), (1, "2024-01-15")], "id int, d string")
    r = SG.first_visit_flags(df, "id", "d").first()
    assert (str(r.first_visit), r.retained_30) == ("2024-01-01", 1)
    days = {str(x.day): (x.n_rows, x.prev_n_rows)
            for x in M.daily_trend(df.withColumnRenamed("d", "ts"), "ts").collect()}
    assert days == {"2024-01-01": (1, None), "2024-01-15": (1, None), "None": (1, None)}


def test_count_desc_and_weighted_mean_merge(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("c",)], "k string")
    assert [(r.k, r.n_rows) for r in A.count_desc(df, "k").collect()] == [("b", 2), ("c", 2), ("a", 1)]
    parts = spark.createDataFrame([("x", 10.0, 2), ("x", 20.0, 3), ("y", 5.0, 1)], "g string, s double, n long")
    got = {r.g: (r.avg, r.cnt) for r in A.weighted_mean_merge(parts, ["g"], "s", "n", "avg", "cnt").collect()}
    assert got == {"x": (6.0, 5), "y": (5.0, 1)}
