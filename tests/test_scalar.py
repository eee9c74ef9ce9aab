"""Scalar traps: target text, NaN decision, width, season with missing time."""

import math

from pyspark.sql import functions as F

from riskloom.functions import scalar as S
from riskloom.functions.features import season_flag


def test_target_text(spark):
    df = spark.createDataFrame([("Yes",), ("TRUE",), ("1",), ("1.0",), ("no",), (None,)], "w string")
    assert [r.y for r in df.select(S.bool_target("w").alias("y")).collect()] == [1, 1, 1, 0, 0, 0]


def test_nan_score_decides_zero(spark):
    df = spark.createDataFrame([(0.9,), (float("nan"),), (None,)], "s double")
    assert [r.d for r in df.select(S.decide("s", 0.6).alias("d")).collect()] == [1, 0, 0]


def test_exclusive_cut(spark):
    df = spark.createDataFrame([(0.5,)], "s double")
    r = df.select(S.decide("s", 0.5, True).alias("a"), S.decide("s", 0.5, False).alias("b")).first()
    assert (r.a, r.b) == (1, 0)


def test_width(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([float(i) for i in range(64)],), ([1.0] * 70,)], "v array<double>")
    out = [r.w for r in df.select(S.fit_width("v", 64).alias("w")).collect()]
    assert out[0] == [1.0, 2.0, 3.0] + [0.0] * 61
    assert out[1] == [float(i) for i in range(64)]
    assert out[2] == [1.0] * 64


def test_l2(spark):
    df = spark.createDataFrame([([3.0, 4.0],)], "v array<double>")
    u = df.select(S.l2_normalise("v").alias("u")).first().u
    assert math.isclose(u[0], 3 / (5 + 1e-8)) and math.isclose(u[1], 4 / (5 + 1e-8))


def test_season_missing_month_is_zero(spark):
    df = spark.createDataFrame([(None,), (5,), (11,)], "m int")
    assert [r.f for r in df.select(season_flag(F.col("m")).alias("f")).collect()] == [0, 1, 0]


def test_rescale_and_sign(spark):
    df = spark.createDataFrame([(-1.0, 0), (0.5, 1)], "e double, y int")
    r = df.select(S.rescale_unit("e").alias("p"), S.sign_decision("e").alias("d"), S.signed_label("y").alias("s")).collect()
    assert [(x.p, x.d, x.s) for x in r] == [(0.0, 0, -1), (0.75, 1, 1)]


def test_division_by_zero_is_null(spark):
    from riskloom.functions.features import safe_ratio
    df = spark.createDataFrame([(1.0, -1e-6), (1.0, 1.0)], "a double, b double")
    got = [r.r for r in df.select(safe_ratio("a", "b").alias("r")).collect()]
    assert got[0] is None and abs(got[1] - 1 / (1 + 1e-6)) < 1e-15


def test_bad_date_modes(spark):
    import pytest
    df = spark.createDataFrame([("2024-01-05",), ("not a date",)], "s string")
    got = [r.t for r in df.select(S.parse_time("s").alias("t")).collect()]
    assert got[0].day == 5 and got[1] is None
    with pytest.raises(Exception):
        df.select(S.parse_time("s", mode="strict").alias("t")).collect()
