"""The reference's functions, called from SQL."""

import json

import pytest

from tests.conftest import SMALL, D
from tidewater.plans import functions_api as FA
from tidewater.plans import metrics as M


@pytest.fixture(scope="module")
def wh(spark):
    from tidewater.plans.scenario import warehouse
    from tidewater.plans.sql_functions import register_functions
    w = warehouse(spark, SMALL)
    assert len(register_functions(w)) == 7
    return w


def value(spark, text):
    return spark.sql(f"SELECT {text}").first()[0]


def test_calls_with_literals_and_unknown_keys(spark, wh):
    fact, cust, prod = (wh.table(f"dwh_{t}") for t in ("fact_sales", "dim_customers", "dim_products"))
    cid = M.lifetime_quantity(fact, cust).filter("lifetime_quantity > 0").first()["customer_id"]
    start, end = D("1997-01-01"), D("1998-06-30")
    dates = f"DATE'{start}', DATE'{end}'"
    assert value(spark, f"fn_customer_lifetime_value({cid})") == FA.customer_lifetime_value(fact, cust, cid).first()[0]
    assert value(spark, f"fn_avg_quantity_per_customer({cid})") == FA.avg_quantity_per_customer(fact, cust, cid).first()[0]
    assert value(spark, f"fn_avg_quantity_per_customer({cid}, {dates})") == \
        FA.avg_quantity_per_customer(fact, cust, cid, start, end).first()[0]
    assert value(spark, "fn_month_over_month_growth(1997, 5)") == FA.month_over_month_growth(fact, 1997, 5).first()[0]
    assert value(spark, "fn_month_over_month_growth(1950, 1)") is None
    for call, want in (("fn_customer_lifetime_value(-1)", 0), ("fn_customer_recency(-1)", None),
                       ("fn_avg_quantity_per_customer(-1)", 0.0), ("fn_product_sales_velocity(-1)", 0.0)):
        assert value(spark, call) == want


def test_group_performance_and_top_customers(spark, wh):
    fact, cust, prod = (wh.table(f"dwh_{t}") for t in ("fact_sales", "dim_customers", "dim_products"))
    start, end = D("1997-01-01"), D("1997-12-31")
    group = M.group_performance(fact, prod).filter("total_transactions > 5").first()["product_group"]
    got = json.loads(value(spark, f"fn_product_group_performance('{group}', DATE'{start}', DATE'{end}')"))
    want = M.group_performance(fact, prod, start, end).filter(f"product_group = '{group}'").first().asDict()
    assert got == {k: v.isoformat() if hasattr(v, "isoformat") else v for k, v in want.items()}
    none = json.loads(value(spark, "fn_product_group_performance('NO SUCH GROUP')"))
    assert none["total_quantity"] == none["unique_customers"] == 0 and none["start_date"] is None
    for n in (3, 10_000):
        a = spark.sql(f"SELECT * FROM fn_top_customers({n}, DATE'{start}', DATE'{end}')").collect()
        b = M.top_customers(fact, cust, n, start, end).collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_rollup_sums_only_touched_months_again(spark, wh):
    one, two = (wh.store.parts("dwh_monthly_sales", wh.runs[r]["versions"]["dwh_monthly_sales"]).parts for r in (1, 2))
    facts = [wh.store.parts("dwh_fact_sales", wh.runs[r]["versions"]["dwh_fact_sales"]).parts for r in (1, 2)]
    for m in two:
        same = m in facts[0] and facts[0][m].folder == facts[1][m].folder
        assert (m in one and one[m].folder == two[m].folder) == same
    want = M.monthly_group_sales(wh.table("dwh_fact_sales"), wh.table("dwh_dim_products")).collect()
    got = M.monthly_group_sales_of(wh.store.read("dwh_monthly_sales"), wh.table("dwh_dim_products")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_no_raw_sale_is_joined_without_broadcasts(spark, wh, monkeypatch):
    """Above the broadcast limit the report and the point-in-time sales reduce
    the fact before their first join, and give the same rows."""
    from tests.test_plans import plan
    fact, cust, prod = (wh.table(f"dwh_{t}") for t in ("fact_sales", "dim_customers", "dim_products"))
    small = sorted(map(tuple, M.sales_report(fact, cust, prod, rows_c=10, rows_p=10).collect()))
    pit = sorted(map(tuple, M.point_in_time_sales(fact, cust).collect()))
    spark.conf.set("tidewater.broadcast.maxRows", "0")
    try:
        report, at = M.sales_report(fact, cust, prod), M.point_in_time_sales(fact, cust)
        assert sorted(map(tuple, report.collect())) == small and sorted(map(tuple, at.collect())) == pit
        for df in (report, at):
            text = plan(df, "simple")
            # the scan of the fact meets an aggregate before any join
            above = text[:text.rindex("quantity")].splitlines()
            assert "HashAggregate" in "".join(above[-8:])
    finally:
        spark.conf.unset("tidewater.broadcast.maxRows")
