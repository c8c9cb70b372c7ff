"""The pipeline's stages, each judged on its own input, and the SQL of the registered queries."""

import oracle_check as OC
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from strata.llm import common, decontaminate, quality, simhash
from strata.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert [n for n, _ in P.STAGES] == ["quality", "exact dedup", "near dedup", "decontamination", "packing"]


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, left = docs.columns, docs
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    for name, stage in P.STAGES:
        before = left
        left = common.materialise(stage(spark, before, SF), "test")
        if name != "packing":
            assert left.columns == columns and ids(left) <= ids(before)
        if name == "quality":
            ranker = quality.learn(before, spark.read.parquet(f"{SF}/labels.parquet"))
            assert ids(left) == {r.doc_id for r in quality.score(before, ranker).collect() if r.score >= 0.3}
        elif name == "exact dedup":
            lower = F.translate("text", common.UPPER, common.LOWER)
            assert ids(left) == {r.i for r in before.groupBy(lower).agg(F.max("doc_id").alias("i")).collect()}
        elif name == "near dedup":
            assert ids(left) == {r.component_id for r in simhash.cluster(before).collect()}
        elif name == "decontamination":
            bad = decontaminate.report(before, spark.read.parquet(f"{SF}/benchmark.parquet")).filter("contaminated")
            assert ids(left) == ids(before) - ids(bad)
        else:
            assert ids(left) == ids(before)
    assert sorted(map(tuple, P.run(spark, SF).select("doc_id", "piece", "length").collect())) == sorted(
        map(tuple, left.select("doc_id", "piece", "length").collect()))


def test_the_quality_stage_learns_from_every_labelled_row(spark, tmp, monkeypatch):
    """More rows of a label than the 6,000 that were once the most."""
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text "), F.col("id")).alias("text"))
    docs.select("doc_id", (F.col("doc_id") % 9 > 0).cast("int").alias("quality")).write.parquet(f"{tmp}/labels.parquet")
    seen = []

    def fitted(rows, columns, share, cut):
        seen.append({r["good"]: r["count"] for r in rows.rows.groupBy("good").count().collect()})
        return quality.Ranker(quality.np.zeros(columns), 0.0, cut)

    monkeypatch.setattr(quality, "_fitted", fitted)
    assert P.good(spark, docs, tmp).count() == 9000
    want = docs.filter(~common.held_out("doc_id", 5)).groupBy((F.col("doc_id") % 9 > 0).cast("long").alias("good")).count().collect()
    assert seen == [{r["good"]: r["count"] for r in want}] and seen[0][1] > 6000


def test_stages_on_odd_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(5).unionByName(docs.limit(2)).unionByName(
        docs.limit(2).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang",
                             F.lit(None).cast("string").alias("source"), "n_chars")).withColumn("fp", F.lit("x")).withColumn("score", F.lit(None))
    for table in (odd, odd.limit(0)):
        for _, stage in P.STAGES:
            assert stage(spark, table, SF).count() <= table.count() + 5


def test_scratch_is_removed_on_request(spark):
    mark = common.scratch_mark(spark)
    df = common.materialise(spark.range(3), "gone")
    path = df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
    import os
    path = "/" + path.lstrip("/")
    assert os.path.isdir(path)
    common.clear_scratch(spark, mark)
    assert not os.path.isdir(path)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    got = OC._rows(QUERIES[name](spark, SF).toPandas())
    want = OC._rows(OC.duck(SF).execute(ORACLE_SQL[name]).to_arrow_table().to_pandas())
    assert got == want
