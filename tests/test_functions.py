import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.functions import (day_name, hour_boundary_diff, month_index_diff, month_name, round_half_up, safe_int,
                                 sunday_zero_weekday, title_case)


def _one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_title_case_examples(spark):
    cases = ["santa bárbara d'oeste", "mogi-mirim 3x são joão", "", None, "  sp  ", "SAO PAULO"]
    got = _one(spark, title_case(F.col("s")), [(c,) for c in cases], "s string")
    assert got == ["Santa Bárbara D'Oeste", "Mogi-Mirim 3X São João", None, None, "  Sp  ", "Sao Paulo"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ é'-3 _ç", max_size=12), min_size=1, max_size=8))
def test_title_case_matches_python(spark, words):
    got = _one(spark, title_case(F.col("s")), [(w,) for w in words], "s string")
    assert got == [w.title() if w else None for w in words]


def _py_round(x, n):
    s = 10.0 ** n
    return math.copysign(1.0, x) * math.floor(abs(x) * s + 0.5) / s + 0.0 if x != 0 else 0.0


def test_round_half_up_binary_value(spark):
    xs = [1.005, 0.285, 2.5, -2.5, 0.0, -0.0, 123.455, 1e-9, -1.25]
    got = _one(spark, round_half_up(F.col("x"), 2), [(x,) for x in xs], "x double")
    assert got == [_py_round(x, 2) for x in xs]
    assert got[0] == 1.0 and got[1] == 0.28 and got[2] == 2.5
    assert str(got[5]) == "0.0"          # no negative zero


def test_safe_int(spark):
    vals = ["12.7", "1e2", "x", "", " 7 ", "12.5", "-12.5", None]
    assert _one(spark, safe_int(F.col("s")), [(v,) for v in vals], "s string") == [13, 100, None, None, 7, 13, -13, None]


def test_boundary_date_diffs(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 10, 59), dt.datetime(2020, 1, 1, 11, 1),
                                 dt.date(2020, 1, 31), dt.date(2020, 2, 1))], "a timestamp_ntz, b timestamp_ntz, c date, e date")
    r = df.select(hour_boundary_diff("a", "b").alias("h"), month_index_diff("c", "e").alias("m")).first()
    assert (r.h, r.m) == (1, 1)


def test_weekday_names(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 2),), (dt.date(2024, 6, 8),)], "d date")
    rows = df.select(sunday_zero_weekday("d"), day_name("d"), month_name("d")).collect()
    assert [tuple(r) for r in rows] == [(0, "Sunday", "June"), (6, "Saturday", "June")]
