"""A run rewrites what its delta touches, and nothing else."""

import pytest

from tests.conftest import D, T, rows
from tests.test_pipeline import C0, CUST, PROD, sales
from tidewater.plans.pipeline import Run, new_warehouse, open_warehouse, run_pipeline

MONTHS = [f"2024-{m:02d}-10 00:00:00" for m in range(1, 7)]
TABLES = ["mrr_fact_sales", "stg_fact_sales", "dwh_fact_sales"]


def folders(wh, run):
    return {t: {m: p.folder for m, p in wh.store.parts(t, wh.runs[run]["versions"][t]).parts.items()}
            for t in TABLES}


@pytest.fixture(scope="module")
def wh(spark):
    custs = [(1, "Ann", "US", C0, C0), (2, "Bob", "UK", C0, C0)]
    prods = spark.createDataFrame([(10, "Widget", "Tools", C0, C0)], PROD)
    first = [(100 + i, 1 + i % 2, 10, 1 + i, d) for i, d in enumerate(MONTHS)] + [(200, 3, 10, 5, MONTHS[1])]
    # 101 moves from February to June; 103 now points at an unknown customer; 300 is new
    second = first + [(101, 2, 10, 50, "2024-06-20 00:00:00"), (103, 9, 10, 60, "2024-06-21 00:00:00"),
                      (300, 1, 10, 7, "2024-06-22 00:00:00")]
    third = second + [(103, 2, 10, 61, "2024-07-01 00:00:00")]
    w = new_warehouse(spark)
    for n, (day, items, more) in enumerate([("2024-06-15", first, []), ("2024-06-30", second, []),
                                            ("2024-07-02", third, [(3, "Cid", "FR", C0, C0)])], 1):
        # run 3 also sends customer 3 late: its sale heals without being sent again
        created = [(i, name, land, T(f"{day} 00:00:00"), u) for i, name, land, _, u in custs + more]
        run_pipeline(w, Run(n, D(day), f"{day} 06:00:00", {
            "customers": spark.createDataFrame(created, CUST), "products": prods,
            "sales": sales(spark, items)}))
    return w


def test_untouched_months_keep_their_files(wh):
    one, two = folders(wh, 1), folders(wh, 2)
    # February lost 101, April lost 103, June got all three
    for t in ("mrr_fact_sales", "stg_fact_sales"):
        assert {m for m in one[t] if two[t].get(m) != one[t][m]} == {202402, 202404, 202406}
    # the fact keeps dates as first loaded: 101 changes its quantity in February,
    # 103 is skipped and keeps its old loaded_at in April, 300 is new in June
    assert {m for m in one["dwh_fact_sales"] if two["dwh_fact_sales"][m] != one["dwh_fact_sales"][m]} == \
        {202402, 202404, 202406}


def test_a_moved_sale_leaves_its_old_month(wh):
    month = {r["id"]: r["transaction_date"].month for r in rows(wh.table("mrr_fact_sales", 2))}
    assert month[101] == 6 and month[103] == 6 and len(month) == 8
    staged = {r["sale_id"]: (r["transaction_month"], r["quantity"]) for r in rows(wh.table("stg_fact_sales", 2))}
    assert staged[101] == (6, 50) and len(staged) == 8


def test_loaded_at_holds_for_the_version_but_for_skipped_sales(wh):
    t1, t2, t3 = T("2024-06-15 06:00:00"), T("2024-06-30 06:00:00"), T("2024-07-02 06:00:00")
    assert {r["loaded_at"] for r in rows(wh.table("stg_fact_sales", 2))} == {t2}
    fact = {r["original_sale_id"]: r for r in rows(wh.table("dwh_fact_sales", 2))}
    assert (fact[101]["quantity"], fact[101]["transaction_date"]) == (50, D("2024-02-10"))
    assert (fact[103]["quantity"], fact[103]["loaded_at"]) == (4, t1)  # skipped: as it was
    assert {r["loaded_at"] for i, r in fact.items() if i != 103} == {t2} and 200 not in fact
    fact = {r["original_sale_id"]: r for r in rows(wh.table("dwh_fact_sales", 3))}
    assert fact[103]["quantity"] == 61 and fact[200]["quantity"] == 5
    assert {r["loaded_at"] for r in fact.values()} == {t3}
    assert sorted(r["sale_key"] for r in fact.values()) == list(range(1, 9))
    assert wh.table("stg_skipped_sales", 3).count() == 0
    assert wh.table("high_water_mark", 3).filter("table_name = 'sales'").first()["last_updated"] == \
        T("2024-06-22 00:00:00")


def test_reopened_warehouse_reads_the_same_parts(spark, wh):
    again = open_warehouse(spark, wh.store.root)
    for t in TABLES:
        for run in (1, 2, 3):
            assert sorted(map(tuple, again.table(t, run).collect())) == \
                sorted(map(tuple, wh.table(t, run).collect())), (t, run)
        assert again.rows[t] == wh.rows[t]


def test_an_empty_run_writes_no_sales(spark, wh):
    w = open_warehouse(spark, wh.store.root)
    before = {t: w.store.parts(t) for t in TABLES}
    run_pipeline(w, Run(4, D("2024-07-03"), "2024-07-03 06:00:00", {
        "customers": spark.createDataFrame([], CUST), "products": spark.createDataFrame([], PROD),
        "sales": sales(spark, [(1, 1, 10, 1, "2024-01-01 00:00:00")])}))
    for t in TABLES:
        assert {m: p.folder for m, p in w.store.parts(t).parts.items()} == \
            {m: p.folder for m, p in before[t].parts.items()}
    assert {r["loaded_at"] for r in rows(w.table("dwh_fact_sales"))} == {T("2024-07-03 06:00:00")}


def test_rejected_rows_stay_out_and_are_kept_by_run(spark):
    from tidewater.plans.pipeline import extract_one, prepare_marks
    w = new_warehouse(spark)
    items = {1: [(1, 1, 1, 5, "2024-01-01 00:00:00"), (2, 1, 1, 0, "2024-01-02 00:00:00"),
                 (1, 1, 1, -3, "2024-01-05 00:00:00"), (3, None, 1, -1, "2024-01-03 00:00:00")],
             2: [(2, 1, 1, 9, "2024-02-01 00:00:00"), (4, 1, 1, 0, "2024-02-02 00:00:00")]}
    for n, sent in items.items():
        run = Run(n, D("2024-03-01"), f"2024-03-0{n} 00:00:00", {"sales": sales(spark, sent)})
        prepare_marks(w, run)
        assert extract_one(w, run, "sales")[0] == 1
    assert {r["id"]: r["qty"] for r in rows(w.table("mrr_fact_sales"))} == {1: 5, 2: 9}
    got = sorted((r["run"], r["id"], r["failed_rules"]) for r in rows(w.table("rejected_sales")))
    assert got == [(1, 1, "qty_positive"), (1, 2, "qty_positive"), (1, 3, "qty_positive,keys_not_null"),
                   (2, 4, "qty_positive")]
    assert w.table("rejected_sales", 1).count() == 3
