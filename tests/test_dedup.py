from pyspark.sql import functions as F

from strata.operators import dedup as D


def test_file_vs_all_scope(spark):
    df = spark.createDataFrame([(1, "a", "f1"), (1, "a", "f1"), (1, "a", "f2"), (2, "b", "f2")],
                               "id int, v string, source_file string")
    assert D.drop_exact_duplicates(df, "file").count() == 3
    out = D.drop_exact_duplicates(df, "all")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", "f1"), (2, "b", "f2")]


def test_all_null_rows_use_data_columns(spark):
    df = spark.createDataFrame([(None, None, "f"), (1, None, "f")], "a int, b string, source_file string")
    assert df.na.drop("all").count() == 2          # lineage column keeps every row
    assert D.drop_all_null_rows(df).count() == 1


def test_dedup_by_key_deterministic(spark):
    df = spark.createDataFrame([(1, 1, 5, "x"), (1, 1, 9, "a"), (1, 1, 9, "b"), (2, 1, 1, "z")],
                               "k1 int, k2 int, d int, v string")
    out = D.dedup_by_key(df, ["k1", "k2"], [F.col("d")])
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1, 9, "b"), (2, 1, 1, "z")]
