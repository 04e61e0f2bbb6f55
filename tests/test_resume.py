"""A warehouse continues across processes from its run manifest."""

from tests.conftest import D, T
from tests.test_pipeline import C0, CUST, PROD, sales
from tidewater.plans.pipeline import Run, new_warehouse, open_warehouse, run_pipeline


def test_second_run_in_a_new_process_matches_one_process(spark):
    prods = spark.createDataFrame([(10, "Widget", "Tools", C0, C0)], PROD)
    c1 = spark.createDataFrame([(1, "Ann", "US", C0, C0)], CUST)
    c2 = spark.createDataFrame([(1, "Ann", "CA", C0, C0), (2, "Bob", "UK", C0, C0)], CUST)
    s1 = sales(spark, [(100, 1, 10, 2, "2024-01-10 00:00:00"), (101, 2, 10, 1, "2024-01-11 00:00:00")])
    s2 = sales(spark, [(100, 1, 10, 2, "2024-01-10 00:00:00"), (101, 2, 10, 1, "2024-01-11 00:00:00"),
                       (102, 2, 10, 4, "2024-02-01 00:00:00")])
    run1 = Run(1, D("2024-01-12"), "2024-01-12 06:00:00", {"customers": c1, "products": prods, "sales": s1})

    one = new_warehouse(spark)
    run_pipeline(one, run1)
    run_pipeline(one, Run(2, D("2024-02-02"), "2024-02-02 06:00:00",
                          {"customers": c2, "products": prods, "sales": s2}))

    first = new_warehouse(spark)
    run_pipeline(first, run1)
    # a crashed third process writes a version but never commits its run
    crashed = open_warehouse(spark, first.store.root)
    crashed.store.write("mrr_fact_sales", crashed.table("mrr_fact_sales").limit(0))
    resumed = open_warehouse(spark, first.store.root)
    assert sorted(resumed.runs) == [1]
    assert resumed.runs[1]["marks"]["sales"] == "1900-01-01 00:00:00"
    run_pipeline(resumed, Run(2, D("2024-02-02"), "2024-02-02 06:00:00",
                              {"customers": c2, "products": prods, "sales": s2}))
    for t in ["mrr_fact_sales", "stg_fact_sales", "dwh_dim_customers", "dwh_fact_sales",
              "high_water_mark"]:
        a = sorted(map(tuple, one.table(t).collect()))
        b = sorted(map(tuple, resumed.table(t).collect()))
        assert a == b, t
    again = open_warehouse(spark, first.store.root)
    assert sorted(again.runs) == [1, 2]
    logs = again.table("etl_logs")
    assert logs.count() == logs.select("log_id").distinct().count() == 22  # 11 steps per run
    marks = {r["table_name"]: r["last_updated"] for r in again.table("high_water_mark").collect()}
    assert marks["sales"] == T("2024-02-01 00:00:00")


def test_failed_run_leaves_its_entries(spark, tmp_path):
    import datetime as dt

    import pytest

    from tidewater.plans.pipeline import Run, new_warehouse, open_warehouse, run_pipeline
    wh = new_warehouse(spark, str(tmp_path / "wh"))
    broken = {n: spark.range(1) for n in ("customers", "products", "sales")}  # no such columns
    with pytest.raises(Exception):
        run_pipeline(wh, Run(1, dt.date(2024, 1, 1), "2024-01-01 00:00:00", broken))
    again = open_warehouse(spark, str(tmp_path / "wh"))
    stored = again.log.stored()
    assert stored.filter("status = 'FAILED'").count() == 3
    assert again.log.start("next") > stored.agg({"log_id": "max"}).first()[0]
