from pyspark.sql import functions as F

from tests.conftest import T, rows
from tidewater.operators import quality as Q
from tidewater.operators.runlog import RunLog
from tidewater.plans import monitoring as L

LOG = ("log_id long, process_name string, start_time timestamp_ntz, end_time timestamp_ntz, "
       "status string, rows_processed int, error_message string, created_at timestamp_ntz")


def log(spark):
    data = [(1, "job_1", "2024-01-01 00:00:00", "2024-01-01 00:00:01.005", "SUCCESS", 5),
            (2, "job_1", "2024-01-02 00:00:00", "2024-01-02 00:00:02", "FAILED", 1),
            (3, "job_1", "2024-01-03 00:00:00", None, "RUNNING", 0),
            (4, "jobX1", "2024-01-02 00:00:00", "2024-01-02 00:00:03", "SUCCESS", 2),
            (5, "job_2", "2024-01-02 12:00:00", "2024-01-02 12:00:04", "WARNING", 2)]
    df = spark.createDataFrame([(i, p, T(s), T(e) if e else None, st, n, None, T(s))
                                for i, p, s, e, st, n in data], LOG)
    return df.withColumn("duration_us", F.timestamp_diff("MICROSECOND", "start_time", "end_time"))


def test_summary_skips_running(spark):
    got = {r["process_name"]: r for r in rows(L.performance_summary(log(spark)))}
    j = got["job_1"]
    assert (j["total_runs"], j["successful_runs"], j["failed_runs"]) == (2, 1, 1)
    assert j["avg_duration_seconds"] == 1.5 and j["min_duration_seconds"] == 1.01
    assert j["last_run_time"] == T("2024-01-02 00:00:00")
    assert [r["process_name"] for r in rows(L.performance_summary(log(spark)))][0] == "job_2"


def test_recent_failed_like_trend(spark):
    lg = log(spark)
    assert [r["log_id"] for r in rows(L.recent_runs(lg, 2))] == [3, 5]
    assert [r["log_id"] for r in rows(L.failed_runs(lg))] == [2]
    # '_' is a wildcard, so jobX1 matches job_1%
    assert sorted(r["process_name"] for r in rows(L.runs_like(lg, "job_1%"))) == \
        sorted(["job_1"] * 3 + ["jobX1"])
    trend = rows(L.daily_trend(lg))
    assert [(r["process_name"], r["avg_duration"]) for r in trend] == [("jobX1", 3.0), ("job_1", 1.005)]


def test_freshness_and_layers(spark):
    marks = spark.createDataFrame([("a", T("2024-01-01 00:00:00")), ("b", T("2024-01-02 00:00:00"))],
                                  "table_name string, last_updated timestamp_ntz")
    got = rows(L.freshness(marks, "2024-01-03 00:00:00"))
    assert [(r["table_name"], r["age_seconds"]) for r in got] == [("a", 172800), ("b", 86400)]
    lc = rows(L.layer_counts({"x": spark.range(3), "y": spark.range(0)}))
    assert lc == [{"layer": "x", "row_count": 3}, {"layer": "y", "row_count": 0}]


def test_run_log_start_end(spark):
    rl = RunLog(spark)
    a = rl.start("p", {"start_date": "2024-01-01"})
    rl.end(a, "SUCCESS", 10, 10)
    b = rl.start("q", {"k": 1})
    rl.end(b, "FAILED", error="boom")
    df = {r["log_id"]: r for r in rows(rl.frame())}
    assert df[1]["status"] == "SUCCESS" and df[1]["rows_processed"] == 10
    assert df[2]["error_message"] == "boom" and df[2]["additional_info"] == '{"k": 1}'
    assert df[1]["duration_us"] >= 0


def test_quality_rules(spark):
    s = spark.createDataFrame([(1, 5, "ok"), (2, 0, "SUCCESS"), (3, -1, "BAD"), (4, None, "FAILED")],
                              "id long, qty int, status string")
    valid, rejected = Q.apply_rules(s, {"qty_positive": Q.rule_positive("qty"),
                                        "status_allowed": Q.rule_status("status")})
    assert [r["id"] for r in rows(valid, "id")] == []
    got = {r["id"]: r["failed_rules"] for r in rows(rejected, "id")}
    assert got == {1: "status_allowed", 2: "qty_positive", 3: "qty_positive,status_allowed",
                   4: "qty_positive"}
    summary = {r["rule"]: r["rows_failed"] for r in rows(Q.rule_summary(
        s, "t", {"qty_positive": Q.rule_positive("qty")}))}
    assert summary == {"qty_positive": 3}


def test_keys_orphans_cascade(spark):
    sales = spark.createDataFrame([(1, 10), (1, 11), (2, 99)], "id long, customer_id long")
    parents = spark.createDataFrame([(10,), (11,)], "cid long")
    dup = rows(Q.duplicate_keys(sales, ["id"], "sales"))
    assert dup == [{"table_name": "sales", "key_value": "1", "copies": 2}]
    orph = rows(Q.orphans(sales, parents, "customer_id", "cid", "missing customer"))
    assert [(r["id"], r["reason"]) for r in orph] == [(2, "missing customer")]
    other = spark.createDataFrame([(1,)], "pid long")
    rep = rows(Q.orphan_report(sales, [(parents, "customer_id", "cid", "missing customer"),
                                       (other, "id", "pid", "missing other")], ["id"]), "id", "reason")
    assert [(r["id"], r["reason"]) for r in rep] == [(2, "missing customer"), (2, "missing other")]
    kept = rows(Q.cascade_keep(sales, parents, "customer_id", "cid"), "customer_id")
    assert [r["customer_id"] for r in kept] == [10, 11]
