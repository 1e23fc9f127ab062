"""X1-X11, L8, L9 and the R missing-value rules N1-N10, with NULL fixtures."""
from pyspark.sql import functions as F

from surveyfold.functions import scalars as S


def one(spark, expr, schema, rows):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("o")).collect()]


def test_pad_left_never_truncates(spark):
    got = one(spark, S.pad_left("x", 5), "x string", [("100",), ("123456",), (None,)])
    assert got == ["00100", "123456", None]


def test_canonical_key(spark):
    got = one(spark, S.canonical_key("x"), "x string", [("00100100",), ("abc",), (None,)])
    assert got == ["100100", None, None]


def test_r_ifelse_null_condition_is_null(spark):
    got = one(spark, S.r_ifelse(F.col("x") == 1, "a", "b"), "x int", [(1,), (2,), (None,)])
    assert got == ["a", "b", None]


def test_r_isin_null_is_false(spark):
    got = one(spark, S.r_isin("x", [2, 3, 4, 5]), "x int", [(1,), (3,), (None,)])
    assert got == [False, True, False]


def test_flag_times(spark):
    got = one(spark, S.flag_times(F.col("f") == 2, "w"), "f int, w double",
              [(2, 5.0), (1, 5.0), (None, 5.0), (1, None)])
    assert got == [5.0, 0.0, None, None]        # NA * FALSE is NA


def test_text_between_is_textual(spark):
    got = one(spark, S.text_between("x", "30", "33"), "x string",
              [("31",), ("3S",), ("33",), ("4",), (None,)])
    assert got == [True, False, True, False, None]


def test_pct_ratio(spark):
    got = one(spark, S.pct_ratio("a", "b"), "a double, b double", [(1.0, 4.0), (0.0, 0.0)])
    assert got == [25.0, None]


def test_remove_first_and_all(spark):
    df = spark.createDataFrame([("15-1200",), ("a-b-c",), (None,)], "x string")
    r = df.select(S.remove_first("x", "-").alias("f"), S.remove_all("x", "-").alias("a")).collect()
    assert [(x.f, x.a) for x in r] == [("151200", "151200"), ("ab-c", "abc"), (None, None)]


def test_sum_na_rm(spark):
    df = spark.createDataFrame([("g1", None), ("g1", None), ("g2", 1), ("g2", None), ("g2", 2)],
                               "g string, x int")
    out = {r.g: r.rm for r in df.groupBy("g").agg(S.sum_na_rm("x").alias("rm")).collect()}
    assert out == {"g1": 0, "g2": 3}
