"""Null / NaN / division / bucket rules."""

import math

from pyspark.sql import functions as F

from enrichlab.functions import scalars as S
from enrichlab.operators import features as FE


def col_values(df, c):
    return [r[c] for r in df.collect()]


def test_time_bucket(spark):
    df = spark.createDataFrame([(v,) for v in [9, 10, 29, 30, 59, 60, None]], "s int")
    got = col_values(df.select(S.case_time_bucket("s").alias("b")), "b")
    assert got == ["<10", "10=<Second<30", "10=<Second<30", "30=<Second<60", "30=<Second<60", ">=60", ">=60"]


def test_age_cut_right_closed_include_lowest(spark):
    vals = [-1.0, 0.0, 1.0, 1.5, 3.0, 5.0, 6.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "y double")
    e = S.bin_fixed_edges_expr("y", FE.AGE_YEAR_EDGES, FE.AGE_YEAR_LABELS, include_lowest=True)
    got = col_values(df.select(e.alias("g")), "g")
    assert got == [None, "0-1", "0-1", "1-3", "1-3", "3-5", "5+", None]
    filled = col_values(df.select(F.coalesce(e, F.lit("0-1")).alias("g")), "g")
    assert filled[0] == "0-1" and filled[-1] == "0-1"


def test_ratio_rules(spark):
    rows = [(1.0, 2.0), (0.0, 0.0), (1.0, 0.0), (None, 1.0), (3.0, 1.0)]
    df = spark.createDataFrame(rows, "s double, l double")
    got = col_values(df.select(FE.p_sale_no_epsilon("s", "l").alias("p")), "p")
    assert got == [0.5, 1e-4, 1.0, 1e-4, 1.0]
    r = df.withColumnsRenamed({"s": "normalized_p_cr_sale", "l": "normalized_p_cr_lead"})
    eps = col_values(r.select(FE.p_sale_expr(r).alias("p")), "p")
    assert eps[0] == 1.0 / (2.0 + 1e-8)


def test_safe_ratio_and_clip(spark):
    df = spark.createDataFrame([(1, 0), (2, 4), (None, 1)], "a int, b int")
    got = col_values(df.select(S.safe_ratio("a", "b").alias("r")), "r")
    assert got == [None, 0.5, None]
    c = col_values(spark.createDataFrame([(-1.0,), (0.5,), (2.0,), (None,)], "x double").select(S.clip("x", 0, 1).alias("c")), "c")
    assert c == [0.0, 0.5, 1.0, None]


def test_timestamps_flex(spark):
    rows = [("2024-03-01T06:00:00",), ("2024-03-01 18:30:00",), ("2024-03-01T06:00:00+0000",), ("junk",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    full = col_values(df.select(S.truncate_millis_format(S.parse_timestamp_flex("t")).alias("x")), "x")
    assert full == ["2024-03-01 06:00:00.000000", "2024-03-01 18:30:00.000000", "2024-03-01 06:00:00.000000", None, None]
    no_space = col_values(df.select(S.parse_timestamp_flex("t", with_space=False).alias("x")), "x")
    assert no_space[1] is None and no_space[0] is not None


def test_hour_diff_floor0(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 05:59:00"), ("2024-01-02 00:00:00", "2024-01-01 00:00:00"),
                                (None, "2024-01-01 00:00:00")], "ref string, t string")
    df = df.select(F.to_timestamp("ref").alias("ref"), F.to_timestamp("t").alias("t"))
    assert col_values(df.select(S.hour_diff_floor0("t", "ref").alias("h")), "h") == [5.0, 0.0, None]


def test_coerce_numeric_and_weekend(spark):
    df = spark.createDataFrame([("12",), ("n/a",), (None,), ("1.5",)], "x string")
    assert col_values(df.select(S.coerce_numeric("x").alias("v")), "v") == [12.0, None, None, 1.5]
    d = spark.createDataFrame([("2024-01-06",), ("2024-01-08",)], "d string").select(F.to_date("d").alias("d"))
    assert col_values(d.select(S.is_weekend("d").alias("w")), "w") == [1, 0]


def test_month_window():
    assert S.month_window("2025-01-01", "2025-01-20") == ("2025-01", "2025-02")
    assert S.month_window("2025-12-01", "2025-12-20") == ("2025-12", "2026-01")
    assert S.month_window("2025-01-01", "2025-03-20") == ("2025-01", "2025-03")
    assert S.month_window("2025-01-01", "2025-01-20", bump=False) == ("2025-01", "2025-01")


def test_log_rules(spark):
    df = spark.createDataFrame([(-1.0,), (-2.0,), (0.0,)], "x double")
    l1 = col_values(df.select(S.log1p("x").alias("v")), "v")
    assert l1[0] == -math.inf and l1[1] is None and l1[2] == 0.0
    assert col_values(df.select(S.non_finite_to_null(S.log1p("x")).alias("v")), "v") == [None, None, 0.0]
