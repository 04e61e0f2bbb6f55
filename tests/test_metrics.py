import json

import pytest

from tests.conftest import D, rows
from tidewater.plans import metrics as M

FACT = ("sale_key long, customer_key long, product_key long, date_key int, original_sale_id long, "
        "quantity int, transaction_date date")
CUST = ("customer_key long, customer_id long, customer_name string, country string, "
        "is_current boolean, valid_from date, valid_to date")
PROD = "product_key long, product_id long, product_name string, product_group string, is_current boolean"


def fact(spark, items):
    return spark.createDataFrame(
        [(i, c, p, int(d.replace("-", "")), i, q, D(d)) for i, (c, p, q, d) in enumerate(items, 1)], FACT)


@pytest.fixture(scope="module")
def dims(spark):
    cust = spark.createDataFrame([
        (1, 1, "Ann", "US", True, D("2024-01-01"), D("9999-12-31")),
        (2, 2, "Bob", "UK", True, D("2024-01-01"), D("9999-12-31")),
        (3, 3, "Cid", "FR", True, D("2024-01-01"), D("9999-12-31"))], CUST)
    prod = spark.createDataFrame([(1, 10, "W", "Tools", True), (2, 11, "G", "Toys", True),
                                  (3, 12, "X", "Empty", True)], PROD)
    return cust, prod


def test_mom_growth_gaps_and_zero(spark):
    f = fact(spark, [(1, 1, 10, "2024-01-05"), (1, 1, 5, "2024-03-01"), (2, 1, 5, "2024-04-09"),
                     (2, 1, 2, "2024-05-01")])
    got = [(r["month"], r["current_quantity"], r["previous_quantity"], r["growth_pct"])
           for r in rows(M.mom_growth(f), "year", "month")]
    assert got == [(1, 10, 0, None), (2, 0, 10, -100.0), (3, 5, 0, None), (4, 5, 5, 0.0),
                   (5, 2, 5, -60.0)]


def test_top_customers_ties_and_averages(spark, dims):
    cust, _ = dims
    f = fact(spark, [(2, 1, 3, "2024-01-01"), (2, 1, 3, "2024-01-02"), (1, 1, 6, "2024-01-03"),
                     (3, 1, 1, "2024-01-04")])
    top = rows(M.top_customers(f, cust, n=2))
    assert [(r["customer_id"], r["total_quantity"]) for r in top] == [(1, 6), (2, 6)]
    assert top[1]["avg_quantity_per_transaction"] == 3.0 and top[1]["total_transactions"] == 2
    avg = {r["customer_id"]: r["avg_quantity"]
           for r in rows(M.avg_quantity(f, cust, D("2024-01-02"), None))}
    assert avg == {1: 6.0, 2: 3.0, 3: 1.0}
    assert {r["customer_id"]: r["avg_quantity"]
            for r in rows(M.avg_quantity(f, cust, D("2030-01-01")))} == {1: 0.0, 2: 0.0, 3: 0.0}


def test_sales_report_rounding(spark, dims):
    cust, prod = dims
    f = fact(spark, [(1, 1, 1, "2024-01-01"), (1, 1, 1, "2024-01-02"), (1, 2, 2, "2024-01-03"),
                     (1, 1, 1, "2024-02-01"), (2, 1, 4, "2023-12-31")])
    got = rows(M.sales_report(f, cust, prod, D("2024-01-01"), D("2024-02-29")))
    assert [(r["sales_month"], r["product_group"], r["total_quantity"], r["transaction_count"],
             r["avg_quantity_per_transaction"]) for r in got] == [
        (D("2024-01-01"), "Tools", 2, 2, 1.0), (D("2024-01-01"), "Toys", 2, 1, 2.0),
        (D("2024-02-01"), "Tools", 1, 1, 1.0)]
    f3 = fact(spark, [(1, 1, 1, "2024-01-01"), (1, 1, 1, "2024-01-02"), (1, 1, 2, "2024-01-03")])
    assert rows(M.sales_report(f3, cust, prod, D("2024-01-01"), D("2024-01-31")))[0][
        "avg_quantity_per_transaction"] == 1.33


def test_velocity_and_groups(spark, dims):
    _, prod = dims
    f = fact(spark, [(1, 1, 30, "2024-03-01"), (1, 1, 3, "2024-03-31"), (2, 2, 9, "2024-01-01")])
    v = {r["product_id"]: r["velocity"] for r in rows(M.velocity(f, prod, 30, D("2024-03-31")))}
    assert v == {10: 1.1, 11: 0.0, 12: 0.0}  # 2024-03-01 is exactly 30 days back: included
    with pytest.raises(ValueError):
        M.velocity(f, prod, 0)
    perf = {r["product_group"]: r for r in rows(M.group_performance(f, prod))}
    assert perf["Empty"]["total_quantity"] == 0 and perf["Empty"]["start_date"] is None
    assert perf["Tools"]["unique_customers"] == 1 and perf["Tools"]["start_date"] == D("2024-03-01")
    js = {r["product_group"]: json.loads(r["performance"])
          for r in rows(M.group_performance_json(M.group_performance(f, prod)))}
    assert js["Tools"]["total_quantity"] == 33 and js["Tools"]["end_date"] == "2024-03-31"
    assert set(js["Toys"]) == {"product_group", "total_quantity", "total_transactions",
                               "unique_customers", "unique_products",
                               "avg_quantity_per_transaction", "start_date", "end_date"}


def test_counts_without_joins(spark, dims):
    cust, prod = dims
    f = fact(spark, [(1, 1, 1, "2024-01-01")])
    assert rows(M.current_counts(f, cust, prod)) == [
        {"fact_rows": 1, "current_customers": 3, "current_products": 3}]
