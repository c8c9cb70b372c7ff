from hypothesis import given, settings
from hypothesis import strategies as st

from strata.operators import quality as Q

RULES = [Q.Rule("null_age", "age IS NULL"),
         Q.Rule("invalid_age", "age IS NOT NULL AND (age < 0 OR age > 115)"),
         Q.Rule("null_name", "name IS NULL OR trim(name) = ''")]


def test_first_match_and_null_condition_passes(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (2, -5, " "), (3, 30, None), (4, 30, "x"), (5, 0, "y"), (6, 115, "z"), (7, 116, "w")],
        "id int, age int, name string")
    got = {r.id: r.dq_failed_rule for r in Q.tag(df, RULES).collect()}
    # row 2 violates invalid_age and null_name: the first rule wins
    assert got == {1: "null_age", 2: "invalid_age", 3: "null_name", 4: None, 5: None, 6: None,
                   7: "invalid_age"}


def test_gate_split_and_metrics(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 40, "b"), (3, 200, "c")], "id int, age int, name string")
    g = Q.gate(df, RULES)
    assert [r.id for r in g.good.collect()] == [2]
    assert sorted((r.id, r.dq_failed_rule) for r in g.bad.collect()) == [(1, "null_age"), (3, "invalid_age")]
    m = g.summary()
    assert m["total"] == 3 and m["null_age"] == 1 and m["invalid_age"] == 1 and m["null_name"] == 0


def test_breakdown_and_counts(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (500, "c"), (10, "d")], "age int, name string")
    t = Q.tag(df, RULES)
    b = {r.rule: (r.n_rows, r.pct) for r in Q.breakdown(t).collect()}
    assert b == {"null_age": (2, 50.0), "invalid_age": (1, 25.0), "passed": (1, 25.0)}
    _, bad = Q.split(t)
    assert [(r.rule, r.n_rows) for r in Q.count_by_rule(bad).collect()] == [("null_age", 2), ("invalid_age", 1)]


def test_quarantine_is_idempotent_per_run(spark, tmp):
    df = spark.createDataFrame([(None, "a"), (300, "b")], "age int, name string")
    _, bad = Q.split(Q.tag(df, RULES))
    for _ in range(2):
        Q.write_quarantine(bad, tmp, "patients", "r1")
    Q.write_quarantine(bad, tmp, "patients", "r2")
    q = Q.read_quarantine(spark, tmp)
    assert q.count() == 4
    assert {r.run_id for r in q.select("run_id").distinct().collect()} == {"r1", "r2"}
    assert "dq_timestamp" in q.columns


def _py_reason(age, name):
    # brute-force reference of RULES, evaluated in order in plain Python
    if age is None:
        return "null_age"
    if age < 0 or age > 115:
        return "invalid_age"
    if name is None or name.strip() == "":
        return "null_name"
    return None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-50, 200)),
                          st.one_of(st.none(), st.sampled_from(["", " ", "ann", "bo"]))), max_size=30))
def test_partition_property(spark, rows):
    df = spark.createDataFrame(rows, "age int, name string")
    got = sorted(((r.age, r.name, r.dq_failed_rule) for r in Q.tag(df, RULES).collect()), key=repr)
    want = sorted(((a, n, _py_reason(a, n)) for a, n in rows), key=repr)
    assert got == want
    good, bad = Q.split(Q.tag(df, RULES))
    assert good.count() + bad.count() == len(rows)


def test_dq_evidence_single_pass_and_empty_input(spark):
    from strata.operators.inspect import dq_evidence
    df = spark.createDataFrame([(1, None, "x"), (-1, 2.0, None), (-2, None, None), (5, 1.0, "y")],
                               "a int, b double, c string")
    tagged = Q.tag(df, [Q.Rule("neg_a", "a < 0")])
    got = sorted((r.dataset, r.kind, r.name, r.n_rows) for r in dq_evidence("t", tagged, ["b", "c"]).collect())
    assert got == [("t", "nulls", "b", 2), ("t", "nulls", "c", 2), ("t", "quarantine", "neg_a", 2)]
    empty = sorted((r.kind, r.name, r.n_rows) for r in dq_evidence("t", tagged.limit(0), ["b", "c"]).collect())
    assert empty == [("nulls", "b", 0), ("nulls", "c", 0)]


def test_gate_metrics_on_bad_path(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 40, "b"), (3, 200, "c")], "id int, age int, name string")
    g = Q.gate(df, RULES, name="dq_bad_path", observe_on="bad")
    assert g.bad.count() == 2          # only the bad path is consumed ...
    m = g.summary()                    # ... and the metrics still cover every row
    assert m["total"] == 3 and m["null_age"] == 1 and m["invalid_age"] == 1
    assert Q.summary_line("t", m, RULES) == \
        "dataset=t rows=3 bad=2 share=0.6667 null_age=1 invalid_age=1"


def test_two_default_gates_in_one_plan(spark):
    a = spark.createDataFrame([(1, 30, "a")], "id int, age int, name string")
    b = spark.createDataFrame([(1, None, "b")], "id int, age int, name string")
    # both observations end up in one plan: ga on its good path, gb on its bad path
    ga, gb = Q.gate(a, RULES), Q.gate(b, RULES, observe_on="bad")
    assert ga.good.join(gb.bad.select("id", "dq_failed_rule"), "id").count() == 1
    assert ga.summary()["total"] == 1 and gb.summary()["total"] == 1
