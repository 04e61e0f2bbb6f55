"""Values far beyond the test data: nothing overflows, nothing is cut."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from tests.conftest import T
from tidewater.functions import round_half_away_ratio, round_half_up_ratio
from tidewater.operators.runlog import RunLog
from tidewater.plans.monitoring import daily_trend, performance_summary

LOG = "process_name string, start_time timestamp_ntz, end_time timestamp_ntz, status string, " \
      "duration_us long, rows_processed long"


def log(spark, us):
    t = T("2024-01-01 00:00:00")
    return spark.createDataFrame([("p", t, t, "SUCCESS", us, 3_000_000_000)] * 2, LOG)


def test_long_durations(spark):
    assert daily_trend(log(spark, 3 * 10**12)).first()["avg_duration"] == 3e6
    r = performance_summary(log(spark, 3 * 10**16)).first()
    assert r["avg_duration_seconds"] == 3e10 and r["total_rows_processed"] == 6_000_000_000


@pytest.mark.parametrize("num,den,scale,want", [
    (9 * 10**18, 9 * 10**18 - 1, 2, 1.0), (9 * 10**18, 1_000_000, 2, 9e12), (5, 1000, 2, 0.01),
    (9_223_372_036_854_775_807, 9_223_372_036_854_775_807, 6, 1.0), (1, 3, 6, 0.333333), (7, 0, 2, None)])
def test_ratios_of_large_longs(spark, num, den, scale, want):
    df = spark.createDataFrame([(num, den)], "n long, d long")
    assert df.select(round_half_up_ratio(F.col("n"), F.col("d"), scale)).first()[0] == want
    neg = df.select(round_half_away_ratio(-F.col("n"), F.col("d"), scale)).first()[0]
    assert neg == (None if want is None else -want)


def test_log_counters_errors_and_ids(spark, tmp_path):
    rl = RunLog(spark, str(tmp_path / "log"))
    one = rl.start("big")
    rl.end(one, "FAILED", processed=3_000_000_000, error="x" * 5000)
    ids = []
    threads = [threading.Thread(target=lambda: ids.extend(rl.start("t") for _ in range(50))) for _ in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(set(ids)) == 400 and len(rl.rows) == 401
    rl.flush()
    again = RunLog(spark, str(tmp_path / "log"))
    r = again.stored().filter("log_id = 1").first()
    assert (r["rows_processed"], len(r["error_message"]), r["status"]) == (3_000_000_000, 5000, "FAILED")
    assert again.start("next") == 402 and r["duration_seconds"] >= 0
