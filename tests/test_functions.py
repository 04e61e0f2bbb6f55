from pyspark.sql import functions as F

from tests.conftest import D
from tidewater.functions import (round_half_away_ratio, round_half_up_ratio, strip_all,
                                 upper_strip)
from tidewater.operators.calendar import calendar, run_window


def test_strip_removes_all_whitespace_like_python(spark):
    values = ["  Ann  ", "\tBob\n", " Cid ", "", None, "  "]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(strip_all(F.col("s"))).collect()]
    assert got == [v.strip() if v is not None else None for v in values]
    got = [r[0] for r in df.select(upper_strip(F.col("s"))).collect()]
    assert got == [v.upper().strip() if v is not None else None for v in values]


def test_round_half_up_exact(spark):
    cases = [(1, 8), (2549496, 100000), (5, 2), (1, 3), (2, 3), (10, 4), (0, 5), (7, 0)]
    df = spark.createDataFrame(cases, "n long, d long")
    got = [r[0] for r in df.select(round_half_up_ratio(F.col("n"), F.col("d"))).collect()]
    # 1/8 = 0.125 rounds up; 25.49496 rounds once to 25.49; d = 0 gives null
    assert got == [0.13, 25.49, 2.5, 0.33, 0.67, 2.5, 0.0, None]


def test_round_half_away_negative(spark):
    df = spark.createDataFrame([(-1, 8), (1, 8), (-2, 3), (-50, 100)], "n long, d long")
    got = [r[0] for r in df.select(round_half_away_ratio(F.col("n"), F.col("d"), 2, 100)).collect()]
    assert got == [-12.5, 12.5, -66.67, -50.0]


def test_calendar_edges(spark):
    cal = {r["date"]: r for r in calendar(spark, D("2020-02-28"), D("2021-01-04")).collect()}
    assert len(cal) == (D("2021-01-04") - D("2020-02-28")).days + 1
    leap = cal[D("2020-02-29")]
    assert leap["date_key"] == 20200229 and leap["day_of_week"] == 6 and leap["is_weekend"]
    assert leap["day_name"] == "Saturday " and leap["month_name"] == "February "
    sun = cal[D("2021-01-03")]
    assert sun["week"] == 53 and sun["day_of_week"] == 0 and sun["is_weekend"]
    mon = cal[D("2021-01-04")]
    assert mon["week"] == 1 and not mon["is_weekend"] and mon["quarter"] == 1
    assert len(cal[D("2020-05-01")]["month_name"]) == 9 and not cal[D("2020-05-01")]["is_holiday"]


def test_run_window_leap_day():
    assert run_window(D("2024-02-29")) == (D("2022-02-28"), D("2025-02-28"))
    assert run_window(D("2001-11-05")) == (D("1999-11-05"), D("2002-11-05"))
