"""A hand-built two-run scenario through the whole pipeline."""

import pytest

from tests.conftest import D, T, rows
from tidewater.plans import metrics as M
from tidewater.plans.pipeline import Run, new_warehouse, run_pipeline

CUST = "id long, name string, country string, created_at timestamp_ntz, updated_at timestamp_ntz"
PROD = "id long, name string, group_name string, created_at timestamp_ntz, updated_at timestamp_ntz"
SALE = ("id long, customer_id long, product_id long, qty int, transaction_date timestamp_ntz, "
        "created_at timestamp_ntz")
C0 = T("2024-01-01 00:00:00")


def sales(spark, items):
    return spark.createDataFrame([(i, c, p, q, T(d), T(d)) for i, c, p, q, d in items], SALE)


@pytest.fixture(scope="module")
def wh(spark):
    prods = spark.createDataFrame([(10, "Widget", "Tools", C0, C0), (11, "Gadget", " toys ", C0, C0)], PROD)
    run1_sales = [(100, 1, 10, 9, "2024-01-09 00:00:00"), (100, 1, 10, 2, "2024-01-10 00:00:00"),
                  (101, 3, 10, 1, "2024-01-11 00:00:00"), (102, 2, 11, 5, "2024-01-12 00:00:00")]
    run1 = Run(1, D("2024-01-13"), "2024-01-13 06:00:00", {
        "customers": spark.createDataFrame([(1, " Ann\t", "us", C0, C0), (2, "Bob", "UK", C0, C0)], CUST),
        "products": prods, "sales": sales(spark, run1_sales)})
    run2_sales = run1_sales + [(100, 1, 10, 7, "2024-02-01 00:00:00"),
                               (103, 1, 11, 3, "2024-02-02 00:00:00")]
    run2 = Run(2, D("2024-02-03"), "2024-02-03 06:00:00", {
        "customers": spark.createDataFrame([(1, " Ann\t", "ca", C0, C0), (2, "Bob", "UK", C0, C0),
                                            (3, "Cid", "FR", C0, C0), (4, "Dee", None, C0, C0)], CUST),
        "products": prods, "sales": sales(spark, run2_sales)})
    w = new_warehouse(spark)
    run_pipeline(w, run1)
    run_pipeline(w, run2)
    # a third run with no new sales: the empty delta leaves the mirror alone
    run3 = Run(3, D("2024-02-04"), "2024-02-04 06:00:00", dict(run2.sources))
    w.versions_before_run3 = dict(w.store.versions)
    run_pipeline(w, run3)
    return w


def test_staging_cleaning(wh):
    got = {r["customer_id"]: r for r in rows(wh.table("stg_dim_customers", 2))}
    assert got[1]["customer_name"] == "Ann" and got[1]["country"] == "ca"
    assert got[1]["country_normalized"] == "CA"
    assert got[4]["country_normalized"] == ""
    assert got[1]["valid_from"] == T("2024-01-13 06:00:00")  # first value survives
    assert got[1]["loaded_at"] == T("2024-02-03 06:00:00")
    prod = {r["product_id"]: r for r in rows(wh.table("stg_dim_products", 2))}
    assert prod[11]["product_group"] == " toys " and prod[11]["product_group_normalized"] == "TOYS"


def test_staging_date_parts(wh):
    s = {r["sale_id"]: r for r in rows(wh.table("stg_fact_sales", 1))}
    r = s[102]  # 2024-01-12 is a Friday
    assert (r["transaction_year"], r["transaction_month"], r["transaction_day"],
            r["transaction_quarter"], r["day_of_week"]) == (2024, 1, 12, 1, 5)
    assert s[100]["quantity"] == 2  # latest row of the repeated id


def test_skip_heal_and_partial_update(wh):
    f1 = {r["original_sale_id"]: r for r in rows(wh.table("dwh_fact_sales", 1))}
    assert sorted(f1) == [100, 102]  # 101 skipped: customer 3 unknown in run 1
    f2 = {r["original_sale_id"]: r for r in rows(wh.table("dwh_fact_sales", 2))}
    assert sorted(f2) == [100, 101, 102, 103]
    assert [f2[i]["sale_key"] for i in (100, 102, 101, 103)] == [1, 2, 3, 4]
    # re-sent sale: new quantity; keys and dates stay as first loaded
    assert f2[100]["quantity"] == 7 and f2[100]["transaction_date"] == D("2024-01-10")
    assert f2[100]["customer_key"] == f1[100]["customer_key"]
    assert f2[100]["date_key"] == 20240110


def test_marks_and_empty_delta(wh):
    marks = {r["table_name"]: r["last_updated"] for r in rows(wh.table("high_water_mark", 1))}
    assert marks["sales"] == T("2024-01-12 00:00:00")
    assert marks["customers"] == T("1900-01-01 00:00:00")
    assert wh.runs[2]["marks"]["sales"] == "2024-01-12 00:00:00"
    assert wh.runs[3]["versions"]["mrr_fact_sales"] == wh.versions_before_run3["mrr_fact_sales"]
    ops = [r for r in wh.log.rows.values() if r["process_name"] == "operational_to_mrr_sales"]
    assert [r["rows_processed"] for r in ops] == [3, 2, 0]
    # batch maximum of the extracted order column (H4), kept with the mark used
    assert wh.runs[1]["batch_max"]["sales"] == "2024-01-12 00:00:00"
    assert wh.runs[2]["batch_max"]["sales"] == "2024-02-02 00:00:00"
    assert wh.runs[3]["batch_max"]["sales"] is None
    assert '"batch_max": "2024-02-02 00:00:00"' in ops[1]["additional_info"]
    assert all(r["status"] == "SUCCESS" for r in wh.log.rows.values())
    assert wh.log.frame().filter("duration_us < 0").count() == 0


def test_scd2_versions(wh):
    dim = rows(wh.table("dwh_dim_customers", 2), "customer_key")
    ann = [r for r in dim if r["customer_id"] == 1]
    assert [(r["country"], r["is_current"], r["valid_to"]) for r in ann] == \
        [("us", False, D("2024-02-03")), ("ca", True, D("9999-12-31"))]
    assert [r["customer_key"] for r in dim] == [1, 2, 3, 4, 5]


def test_current_version_metrics(wh):
    fact, cust = wh.table("dwh_fact_sales", 2), wh.table("dwh_dim_customers", 2)
    m = {r["customer_id"]: r for r in rows(M.customer_metrics(fact, cust))}
    # sale 100 still points at Ann's closed version, so it leaves her metrics
    assert m[1]["total_transactions"] == 1 and m[1]["total_quantity_purchased"] == 3
    assert m[4]["total_transactions"] == 0 and m[4]["total_quantity_purchased"] is None
    assert m[4]["avg_quantity_per_transaction"] is None and m[4]["first_purchase_date"] is None
    life = {r["customer_id"]: r["lifetime_quantity"] for r in rows(M.lifetime_quantity(fact, cust))}
    assert life == {1: 3, 2: 5, 3: 1, 4: 0}
    rec = {r["customer_id"]: r["days_since_last_purchase"]
           for r in rows(M.recency(fact, cust, D("2024-02-10")))}
    assert rec[1] == 8 and rec[4] is None
    assert M.scalar(M.lifetime_quantity(fact, cust), "customer_id", 999).count() == 0
    # the point-in-time join uses the version valid on the sale date: Ann moved
    # on 2024-02-03, after both her sales; Cid's first version counts from 1900
    pit = {(r["country_at_sale"]): r["total_quantity"]
           for r in rows(M.point_in_time_sales(fact, cust))}
    assert pit == {"us": 10, "UK": 5, "FR": 1}


def test_two_increments_equal_one_full_load(spark):
    """In-order data, unchanged dimensions: two increments = one full load."""
    custs = spark.createDataFrame([(1, "Ann", "US", C0, C0), (2, "Bob", "UK", C0, C0)], CUST)
    prods = spark.createDataFrame([(10, "Widget", "Tools", C0, C0)], PROD)
    items = [(100 + i, 1 + i % 2, 10, 1 + i, f"2024-01-{10 + i:02d} 00:00:00") for i in range(8)]
    first = sales(spark, items[:5])
    full = sales(spark, items)

    inc = new_warehouse(spark)
    run_pipeline(inc, Run(1, D("2024-01-15"), "2024-01-15 06:00:00",
                          {"customers": custs, "products": prods, "sales": first}))
    run_pipeline(inc, Run(2, D("2024-01-20"), "2024-01-20 06:00:00",
                          {"customers": custs, "products": prods, "sales": full}))
    once = new_warehouse(spark)
    run_pipeline(once, Run(1, D("2024-01-20"), "2024-01-20 06:00:00",
                           {"customers": custs, "products": prods, "sales": full}))

    def content(w):
        f = w.table("dwh_fact_sales").join(w.table("dwh_dim_customers"), "customer_key")
        return sorted((r["original_sale_id"], r["customer_id"], r["quantity"], r["transaction_date"])
                      for r in f.collect())
    assert content(inc) == content(once) and len(content(once)) == 8
    assert [r["sale_key"] for r in rows(once.table("dwh_fact_sales"), "original_sale_id")] == \
        list(range(1, 9))
    assert [r["sale_key"] for r in rows(inc.table("dwh_fact_sales"), "original_sale_id")] == \
        list(range(1, 9))


def test_order_column_and_calendar_are_parameters(spark):
    from tidewater.operators.marks import write_mark
    c1 = spark.createDataFrame([(1, "Ann", "US", C0, C0)], CUST)
    # an edit that moves only updated_at
    c2 = spark.createDataFrame([(1, "Ann", "CA", C0, T("2024-03-01 00:00:00"))], CUST)
    prods = spark.createDataFrame([(10, "Widget", "Tools", C0, C0)], PROD)
    s = sales(spark, [(100, 1, 10, 2, "2024-01-10 00:00:00")])

    def two_runs(order_cols):
        w = new_warehouse(spark)
        r1 = Run(1, D("2024-01-15"), "2024-01-15 06:00:00",
                 {"customers": c1, "products": prods, "sales": s}, order_cols=order_cols,
                 calendar=(D("2024-01-01"), D("2024-01-31")))
        run_pipeline(w, r1)
        # suppose the customers mark had advanced to the first load
        w.write(r1, "high_water_mark", write_mark(w.table("high_water_mark"), "customers", C0,
                                                  "2024-01-15 06:00:00"))
        run_pipeline(w, Run(2, D("2024-03-02"), "2024-03-02 06:00:00",
                            {"customers": c2, "products": prods, "sales": s},
                            order_cols=order_cols, calendar=(D("2024-01-01"), D("2024-03-31"))))
        cur = {r["customer_id"]: r["country"]
               for r in w.table("dwh_dim_customers").filter("is_current").collect()}
        return cur, w.rows["dwh_dim_date"]

    assert two_runs({}) == ({1: "US"}, 91)  # created_at did not move: the edit is missed
    assert two_runs({"customers": "updated_at"}) == ({1: "CA"}, 91)
