"""Randomised checks of the single-pass operators against brute force."""

from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import marts as M
from strata.operators import segments as SG
from strata.sources import versions as V

D0 = date(2024, 1, 1)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=30),
       st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=30))
def test_changes_is_except_all_both_ways(spark, tmp_path_factory, old, new):
    root = str(tmp_path_factory.mktemp("v"))
    schema = "k int, v string"
    V.publish(spark.createDataFrame(old, schema), root, at=datetime(2024, 1, 1, 0, 0, 0))
    V.publish(spark.createDataFrame(new, schema), root, at=datetime(2024, 1, 1, 0, 0, 1))
    got = sorted((r.change, r.k, r.v or "") for r in V.changes(spark, root, 0, 1).collect())
    want = []
    for change, src, other in (("added", new, old), ("removed", old, new)):
        rest = list(other)
        for row in src:
            if row in rest:
                rest.remove(row)
            else:
                want.append((change, row[0], row[1] or ""))
    assert got == sorted(want)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 20), min_size=1, max_size=60))
def test_daily_trend_is_previous_calendar_day(spark, offsets):
    df = spark.createDataFrame([(D0 + timedelta(days=o),) for o in offsets], "d date") \
              .select(F.col("d").cast("timestamp").alias("ts"))
    counts = {}
    for o in offsets:
        counts[o] = counts.get(o, 0) + 1
    rows = {(r.day - D0).days: r for r in M.daily_trend(df, "ts").collect()}
    assert set(rows) == set(counts)
    for o, r in rows.items():
        prev = counts.get(o - 1)
        assert (r.n_rows, r.prev_n_rows) == (counts[o], prev)
        change = None if prev is None else round((counts[o] - prev) / prev, 4)
        assert r.pct_change == change
        assert r.drop_alert == (change is not None and change < -0.2)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 200), st.integers(1, 9)), min_size=1, max_size=60))
def test_entity_profile_brute_force(spark, visits):
    df = spark.createDataFrame([(k, D0 + timedelta(days=o), float(a)) for k, o, a in visits],
                               "id int, d date, amt double")
    ref = D0 + timedelta(days=250)
    got = {r.id: r for r in SG.entity_profile(df, "id", "d", "amt", ref).collect()}
    ents = {}
    for k, o, a in visits:
        ents.setdefault(k, []).append((o, a))
    assert set(got) == set(ents)
    for k, vs in ents.items():
        days = sorted({o for o, _ in vs})
        first, last = days[0], days[-1]
        r = got[k]
        assert (r.first_visit - D0).days == first and (r.last_visit - D0).days == last
        assert r.frequency == len(vs) and r.monetary == sum(a for _, a in vs)
        assert r.recency == 250 - last and r.tenure == 250 - first
        for n in (30, 60, 90):
            assert r[f"retained_{n}"] == int(any(0 < d - first <= n for d in days))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.sampled_from(["a", "b", "c", None])),
                min_size=1, max_size=40))
def test_dedup_by_key_keeps_the_largest_row(spark, rows):
    from strata.operators.dedup import dedup_by_key
    df = spark.createDataFrame(rows, "k int, p int, v string")
    got = {(r.k, r.p, r.v) for r in dedup_by_key(df, ["k"], [F.col("p")]).collect()}
    want = set()
    for k in {r[0] for r in rows}:
        group = [r for r in rows if r[0] == k]
        # largest by p, ties by v (NULL smallest, as in Spark's ordering)
        want.add(max(group, key=lambda r: (r[1], r[2] is not None, r[2] or "")))
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.sampled_from(["F", "O", "P", "Q"])), max_size=40))
def test_pivot_share_brute_force(spark, rows):
    from strata.operators.aggregate import pivot_share
    df = spark.createDataFrame(rows, "r string, c string")
    got = {r.r: r for r in pivot_share(df, "r", "c", ["F", "O", "P"]).collect()}
    assert set(got) == {r for r, _ in rows}
    for key, out in got.items():
        counts = {v: sum(1 for r, c in rows if r == key and c == v) for v in "FOP"}
        total = sum(1 for r, _ in rows if r == key)
        counts["other"] = total - sum(counts.values())
        assert out.n_total == total
        for v, n in counts.items():
            share = (Decimal(n) / total).quantize(Decimal("0.0001"), ROUND_HALF_UP)
            assert (out[f"n_{v}"], out[f"share_{v}"]) == (n, float(share))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 130)), min_size=1, max_size=30))
def test_bucket_brute_force(spark, ages):
    from strata.functions.columns import bucket
    edges, labels = [30, 45, 60, 75], ["13-29", "30-44", "45-59", "60-74", "75-89"]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i int, age int")
    got = [r.g for r in df.select("i", bucket("age", edges, labels).alias("g")).orderBy("i").collect()]
    want = []
    for a in ages:
        lab = labels[-1]   # NULL and everything past the last edge: last bin
        if a is not None:
            for e, l in zip(edges, labels):
                if a < e:
                    lab = l
                    break
        want.append(lab)
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 2), st.integers(0, 99)),
                min_size=1, max_size=60),
       st.lists(st.tuples(st.integers(0, 6), st.integers(0, 2), st.floats(0, 10)), max_size=30))
def test_hot_key_split_join_equals_plain_join(spark, prim, chan):
    from strata.operators.enrich import Channel, enrich
    p = spark.createDataFrame(prim, "a int, b int, v int")
    c = spark.createDataFrame(chan, "a int, b int, x double")
    mk = lambda split: Channel("c", c, ["a", "b"], [F.round(F.sum("x"), 6).alias("sx"),
                                                   F.count(F.lit(1)).alias("n")],
                               broadcast=False, split_hot_keys=split, hot_key_share=0.05, hot_key_sample=1.0)
    plain = sorted((tuple(r) for r in enrich(p, [mk(False)]).collect()), key=repr)
    split = sorted((tuple(r) for r in enrich(p, [mk(True)]).collect()), key=repr)
    assert split == plain and len(split) == len(prim)
