from pyspark.sql import functions as F

from strata.operators.enrich import Channel, enrich
from strata.operators.join import checked_broadcast


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_count_preserved_and_unmatched_null(spark):
    p = spark.createDataFrame([(1, 30, "male"), (2, 30, "female"), (3, 99, "male"), (4, None, "male")],
                              "id int, age int, gender string")
    ch = spark.createDataFrame([(30, "male", 10.0), (30, "male", 20.0), (30, "female", 5.0), (None, "male", 1.0)],
                               "age int, gender string, charges double")
    out = enrich(p, [Channel("ins", ch, ["age", "gender"],
                             [F.avg("charges").alias("avg_c"), F.count(F.lit(1)).alias("n")])])
    rows = {r.id: (r.avg_c, r.n) for r in out.collect()}
    assert rows == {1: (15.0, 2), 2: (5.0, 1), 3: (None, None), 4: (None, None)}


def test_absent_channel_is_skipped(spark):
    p = spark.createDataFrame([(1, 30)], "id int, age int")
    ch1 = Channel("missing", None, ["age"], [F.count(F.lit(1)).alias("n")])
    ch2 = Channel("nokey", spark.createDataFrame([(1,)], "x int"), ["age"], [F.count(F.lit(1)).alias("m")])
    out = enrich(p, [ch1, ch2])
    assert out.columns == ["id", "age"] and out.count() == 1
    assert ch1.notes["skipped"] and ch2.notes["skipped"]


def test_checked_broadcast_decision(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(100).withColumnRenamed("id", "k")
    _, b1 = checked_broadcast(small, max_rows=10)
    _, b2 = checked_broadcast(big, max_rows=10)
    assert b1 and not b2


def test_checked_broadcast_byte_bound(spark):
    # few rows but long strings: the measured byte size, not the row count,
    # must stop the broadcast
    wide = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 10_000).alias("s"))
    df, b = checked_broadcast(wide, max_rows=1000, max_bytes=50_000)
    assert not b and df.count() == 10
    _, b_ok = checked_broadcast(wide, max_rows=1000, max_bytes=200_000)
    assert b_ok


def test_row_bytes_measures_strings(spark):
    from strata.operators.join import row_bytes
    df = spark.createDataFrame([(1, "abc"), (2, None)], "k int, s string")
    assert [r.b for r in df.select(row_bytes(df).alias("b")).orderBy("k").collect()] == [15, 12]


def test_broadcast_join_when_small(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only the explicit hint may broadcast
    try:
        p = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id"))
        ch = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
        small = Channel("c", ch, ["k"], [F.sum("v").alias("s")])
        out = enrich(p, [small])
        assert "BroadcastHashJoin" in _plan(out)
        forced = Channel("c", ch, ["k"], [F.sum("v").alias("s")], broadcast=False, split_hot_keys=False)
        assert "BroadcastHashJoin" not in _plan(enrich(p, [forced]))
        assert enrich(p, [forced]).count() == 1000
        # with hot-key splitting (the default) every key here is hot (1/7 of the rows each):
        # their aggregate rows are broadcast, and the result is the same
        split = Channel("c", ch, ["k"], [F.sum("v").alias("s")], broadcast=False)
        a = sorted(tuple(r) for r in enrich(p, [forced]).collect())
        assert sorted(tuple(r) for r in enrich(p, [split]).collect()) == a and split.notes["hot_keys"] >= 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 9)), max_size=25),
       st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.floats(0, 100)), max_size=25))
def test_enrich_preserves_primary_rows(spark, prim, chan):
    p = spark.createDataFrame(prim, "k int, v int")
    c = spark.createDataFrame(chan, "k int, x double")
    out = enrich(p, [Channel("c", c, ["k"], [F.avg("x").alias("ax"), F.count(F.lit(1)).alias("n")])])
    assert out.count() == len(prim)
    counts = {}
    for k, _ in chan:
        if k is not None:
            counts[k] = counts.get(k, 0) + 1
    for r in out.collect():
        assert r.n == counts.get(r.k)


def test_row_bytes_nested_and_interval_types(spark):
    from strata.operators.join import row_bytes
    df = spark.sql("SELECT 1 AS k, array(1, 2) AS a, named_struct('x', 'ab') AS s, INTERVAL '2' DAY AS i")
    b = df.select(row_bytes(df).alias("b")).first().b
    assert b == 8 + 4 + len("[1,2]") + len('{"x":"ab"}') + 16
