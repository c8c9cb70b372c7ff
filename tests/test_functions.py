import pytest
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.functions.json import parse_json


def test_normalize_name():
    assert C.normalize_name("Blood Type") == "blood_type"
    assert C.normalize_name("BloodPressure") == "bloodpressure"
    assert C.normalize_name("_source_file") == "source_file"
    assert C.normalize_name("Date.diff") == "date_diff"
    assert C.normalize_name("Date.diff", keep_dots=True) == "date.diff"
    assert C.normalize_name("a (b)=c") == "a_b_c"


def test_normalize_columns_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(ValueError):
        C.normalize_columns(df)


def test_name_norm_orders(spark):
    df = spark.createDataFrame([("Bobby JacksOn",), (None,)], "name string")
    r = df.select(C.name_norm("name").alias("a"), C.name_norm("name", compat=True).alias("b")).collect()
    assert (r[0].a, r[0].b) == ("bobby jackson", "obby acksn")
    assert (r[1].a, r[1].b) == (None, None)


def test_map_codes_and_bucket(spark):
    df = spark.createDataFrame([("F", 10), ("m", 29), ("X", 30), (None, None), ("Female", 80)], "g string, age int")
    out = df.select(C.map_codes("g", {"f": "female", "m": "male"}).alias("g"),
                    C.bucket("age", [30, 45, 60, 75], ["13-29", "30-44", "45-59", "60-74", "75-89"]).alias("b"))
    assert [tuple(r) for r in out.collect()] == [("female", "13-29"), ("male", "13-29"), ("x", "30-44"),
                                                 (None, "75-89"), ("female", "75-89")]


def test_rate_treats_null_as_zero(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (1,)], "o int")
    assert df.agg(C.rate(F.col("o") == 1).alias("r")).first().r == 0.5


def test_round_half_up(spark):
    r = spark.createDataFrame([(2.675,), (0.125,), (-0.125,)], "x double").select(F.round("x", 2).alias("r"))
    assert [x.r for x in r.collect()] == [2.68, 0.13, -0.13]


def test_json_parse_permissive(spark):
    df = spark.createDataFrame([('{"p": 7, "q": "a"}',), ('{"p": "x"}',), ("not json",), (None,)], "v string")
    rows = df.select(parse_json("v", "p int, q string").alias("d")).select("d.*").collect()
    assert [tuple(r) for r in rows] == [(7, "a"), (None, None), (None, None), (None, None)]


def test_flatten(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a', 2, 'b', named_struct('c', 'x')) AS s, "
                   "array(1, 2) AS arr, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS ts")
    out = C.flatten(df)
    assert out.columns == ["id", "s_a", "s_b_c", "arr", "ts"]
    assert tuple(out.first()) == (1, 2, "x", "[1,2]", "2024-01-02T03:04:05")


def test_integral_double_to_string(spark):
    df = spark.createDataFrame([(29872499824296.0,), (1.5,), (None,)], "x double")
    assert [r.s for r in df.select(C.integral_double_to_string("x").alias("s")).collect()] == [
        "29872499824296", "1.5000000000", None]


def test_title_case_and_zero_flags(spark):
    df = spark.createDataFrame([("bobby JACKSON", 0), ("ann", 3)], "n string, g int")
    out = C.zero_as_missing_flags(df.withColumn("t", C.title_case("n")), ["g", "absent"])
    assert [(r.t, r.g, r.is_missing_g) for r in out.collect()] == [("Bobby Jackson", 0, True), ("Ann", 3, False)]


def test_integral_double_to_string_edge_values(spark):
    df = spark.createDataFrame([(1e20,), (float("nan"),), (float("inf"),), (1e300,), (-3.0,)], "x double")
    got = [r.t for r in df.select(C.integral_double_to_string("x").alias("t")).collect()]
    assert got == ["100000000000000000000", "NaN", "Infinity", "1.0E300", "-3"]
