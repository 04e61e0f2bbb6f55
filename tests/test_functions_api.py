import json

import pytest

from tests.conftest import SMALL, D
from tidewater.plans import functions_api as FA
from tidewater.plans import metrics as M


@pytest.fixture(scope="module")
def wh(spark):
    from tidewater.plans.scenario import warehouse
    return warehouse(spark, SMALL)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0][0]


def test_scalar_forms_match_grouped_forms(wh):
    fact, cust, prod = (wh.table("dwh_fact_sales"), wh.table("dwh_dim_customers"),
                        wh.table("dwh_dim_products"))
    life = {r["customer_id"]: r["lifetime_quantity"] for r in M.lifetime_quantity(fact, cust).collect()}
    rec = {r["customer_id"]: r["days_since_last_purchase"] for r in M.recency(fact, cust).collect()}
    avg = {r["customer_id"]: r["avg_quantity"] for r in
           M.avg_quantity(fact, cust, D("1998-01-01"), D("1998-12-31")).collect()}
    for cid in list(life)[:3]:
        assert one(FA.customer_lifetime_value(fact, cust, cid)) == life[cid]
        assert one(FA.customer_recency(fact, cust, cid)) == rec[cid]
        assert one(FA.avg_quantity_per_customer(fact, cust, cid, D("1998-01-01"),
                                                D("1998-12-31"))) == avg[cid]
    vel = {r["product_id"]: r["velocity"] for r in M.velocity(fact, prod).collect()}
    pid = max(vel, key=vel.get)
    assert one(FA.product_sales_velocity(fact, prod, pid)) == vel[pid]
    growth = {(r["year"], r["month"]): r["growth_pct"] for r in M.mom_growth(fact).collect()}
    assert one(FA.month_over_month_growth(fact, 1998, 3)) == growth[(1998, 3)]
    perf = {r["product_group"]: r for r in M.group_performance(fact, prod).collect()}
    g = next(iter(perf))
    got = json.loads(one(FA.product_group_performance(fact, prod, g)))
    assert got["total_quantity"] == perf[g]["total_quantity"]


def test_unknown_keys_still_give_one_row(wh):
    fact, cust, prod = (wh.table("dwh_fact_sales"), wh.table("dwh_dim_customers"),
                        wh.table("dwh_dim_products"))
    assert one(FA.avg_quantity_per_customer(fact, cust, -1)) == 0.0
    assert one(FA.customer_lifetime_value(fact, cust, -1)) == 0
    assert one(FA.customer_recency(fact, cust, -1)) is None
    assert one(FA.product_sales_velocity(fact, prod, -1)) == 0.0
    assert one(FA.month_over_month_growth(fact, 1990, 1)) is None  # previous month empty
    got = json.loads(one(FA.product_group_performance(fact, prod, "NO SUCH GROUP",
                                                      D("2000-01-01"), D("2000-01-31"))))
    assert got == {"product_group": "NO SUCH GROUP", "total_quantity": 0, "total_transactions": 0,
                   "unique_customers": 0, "unique_products": 0,
                   "avg_quantity_per_transaction": 0.0, "start_date": "2000-01-01",
                   "end_date": "2000-01-31"}


def test_sql_views(spark, wh):
    from tidewater.plans.views import register_views
    names = register_views(wh)
    assert {"dwh_fact_sales", "vw_recent_etl_runs", "vw_etl_performance_summary"} <= set(names)
    n = spark.sql("""SELECT count(*) FROM dwh_fact_sales s
                     JOIN dwh_dim_customers c ON s.customer_key = c.customer_key
                     WHERE c.is_current""").first()[0]
    assert n > 0
    assert spark.sql("SELECT * FROM vw_recent_etl_runs").count() > 0
    assert spark.sql("SELECT * FROM etl_logs WHERE status = 'FAILED'").count() == 0
