"""Hot-key behaviour: one key holding a large share of rows must not change
results, and per-key work must aggregate map-side (partial aggregation)."""

import pytest
from pyspark.sql import functions as F

from strata.operators import dedup as D
from strata.operators import segments as SG
from strata.operators.enrich import Channel, enrich


def _hot(spark, n=3000, hot_share=3):
    # every `hot_share`-th row belongs to key 0
    return spark.range(n).select(
        F.when(F.col("id") % hot_share == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
        F.expr("date_add(DATE'2024-01-01', CAST(id % 120 AS INT))").alias("d"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_by_key_hot_key_partial_agg(spark):
    df = _hot(spark)
    out = D.dedup_by_key(df, ["k"], [F.col("v")])
    assert out.count() == df.select("k").distinct().count()
    assert out.filter("k = 0").first().v == 2997  # largest id with id % 3 == 0
    plan = _plan(out)
    assert "partial_max" in plan  # map-side combine before the shuffle


def test_retention_hot_entity(spark):
    df = _hot(spark).select(F.col("k").alias("id"), "d")
    flags = SG.first_visit_flags(df, "id", "d")
    hot = flags.filter("id = 0").first()
    assert (hot.first_visit.isoformat(), hot.retained_30) == ("2024-01-01", 1)
    assert flags.count() == df.select("id").distinct().count()
    plan = _plan(flags)
    # events reduce to (entity, day) map-side; flags are a partial+final max
    assert "partial_max" in plan
    # (entity, day) de-duplication: partial + final hash aggregate on both keys
    assert plan.count("HashAggregate(keys=[id#") >= 4


def test_enrich_hot_primary_key_preserves_rows(spark):
    p = _hot(spark)
    ch = _hot(spark, n=600)
    out = enrich(p, [Channel("c", ch, ["k"], [F.count(F.lit(1)).alias("n")], broadcast=False)])
    assert out.count() == p.count()
    assert out.filter("k = 0").select("n").distinct().first().n == 200


def test_retention_joins_distinct_entity_days(spark):
    """The hot entity reaches the join as one row per day, not per event."""
    df = _hot(spark, n=6000).select(F.col("k").alias("id"), "d")
    flags = SG.first_visit_flags(df, "id", "d")
    plan = _plan(flags)
    # distinct (id, day) is a hash aggregate below the join
    assert "HashAggregate(keys=[id" in plan and "_d" in plan
    pdf = df.toPandas()
    first = pdf.groupby("id")["d"].min()
    hot = pdf[pdf.id == 0]
    gaps = [(d - first[0]).days for d in hot.d]
    expect = int(any(0 < g <= 60 for g in gaps))
    got = flags.filter("id = 0").first()
    assert got.retained_60 == expect
    assert flags.count() == pdf.id.nunique()


def test_hot_keys_found_and_bounded(spark):
    from strata.operators.enrich import hot_keys
    df = _hot(spark, n=20000)          # key 0 holds a third of the rows, the rest are unique
    found = hot_keys(df, ["k"], share=0.01, sample=0.5)
    assert (0,) in found
    assert len(found) <= 100           # at most 1 / share candidates


@pytest.mark.parametrize("aqe", ["true", "false"])
@pytest.mark.parametrize("kind", ["half of all rows on one key", "alike rows", "null keys"])
def test_shuffle_path_spreads_hot_rows_over_tasks(spark, aqe, kind):
    """At most about twice the mean rows per task, also for identical rows and NULL keys."""
    n, parts = 40_000, 8
    key = F.when(F.col("id") % 2 == 0, F.lit(None if kind == "null keys" else 0)).otherwise(F.col("id")).alias("k")
    value = F.lit(1) if kind == "alike rows" else F.col("id")
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions",
                                             "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        channel = spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("x"))
        out = enrich(spark.range(n).select(key, value.alias("v")),
                     [Channel("c", channel, ["k"], [F.sum("x").alias("s")], broadcast=False)])
        rows = out.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in rows) <= 2 * n / parts
        assert out.count() == n
        hits = out.filter("s is not null").count()
        assert hits == 2500 + (0 if kind == "null keys" else n // 2)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
