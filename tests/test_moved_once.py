"""Large merges move a row once, by month, and only what rows need to be made again."""

from pyspark.sql import functions as F

from tests.conftest import D, rows
from tests.test_delta_load import MONTHS, TABLES
from tests.test_pipeline import C0, CUST, PROD, sales
from tidewater.operators.upsert import merge_clustered, upsert
from tidewater.plans.metrics import product_months
from tidewater.plans.pipeline import (MONTH_KEY, SALE_COLS, SALT, Run, looked_up, month_layout, new_warehouse,
                                      run_pipeline, salted, with_month)

LIMIT = "tidewater.broadcast.maxRows"


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def two_runs(spark):
    custs = spark.createDataFrame([(1, "Ann", "US", C0, C0), (2, "Bob", "UK", C0, C0)], CUST)
    prods = spark.createDataFrame([(10, "Widget", "Tools", C0, C0)], PROD)
    first = [(100 + i, 1 + i % 2, 10, 1 + i, d) for i, d in enumerate(MONTHS)] + [(200, 3, 10, 5, MONTHS[1])]
    # 101 moves, 103 loses its customer, 104 is sent again with another quantity, 300 is new
    second = first + [(101, 2, 10, 50, "2024-06-20 00:00:00"), (103, 9, 10, 60, "2024-06-21 00:00:00"),
                      (104, 1, 10, 70, "2024-06-22 00:00:00"), (300, 1, 10, 7, "2024-06-22 00:00:00")]
    w = new_warehouse(spark)
    for n, (day, items) in enumerate([("2024-06-15", first), ("2024-06-30", second)], 1):
        run_pipeline(w, Run(n, D(day), f"{day} 06:00:00", {
            "customers": custs, "products": prods, "sales": sales(spark, items)}))
    return w


def test_both_ways_of_merging_give_the_same_tables(spark):
    a = two_runs(spark)
    spark.conf.set(LIMIT, "0")
    try:
        b = two_runs(spark)
    finally:
        spark.conf.unset(LIMIT)
    for t in [*TABLES, "stg_skipped_sales", "dwh_monthly_sales"]:
        one, two = a.table(t), b.table(t)
        assert one.schema == two.schema
        assert rows(one, *one.columns) == rows(two, *one.columns)
    assert a.rows["dwh_fact_sales"] == 7 and a.table("stg_skipped_sales").count() == 2


def test_a_clustered_upsert_is_one_shuffle(spark):
    stored = spark.createDataFrame([(i, i % 3, "old") for i in range(30)] + [(None, 1, "no key")],
                                   f"id int, {MONTH_KEY} int, v string")
    batch = spark.createDataFrame([(4, 2, "new"), (31, 0, "new"), (None, 1, "new")], stored.schema)
    matched = spark.createDataFrame([(4, 1), (None, 1)], f"id int, {MONTH_KEY} int")
    t, b, m = (salted(df, "id", 2) for df in (stored, batch, matched))
    got = upsert(t, b, ["id"], matched=m, cluster=[MONTH_KEY, SALT]).drop(SALT)
    assert sorted(map(str, got.collect())) == sorted(map(str, upsert(stored, batch, ["id"]).collect()))
    assert shuffles(month_layout(got, ["id"], clustered=True)) == 1


def test_clustered_changes_update_rows(spark):
    kept = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (None, 5, "c")], "id int, m int, v string")
    fresh = spark.createDataFrame([(3, 5, "d")], kept.schema)
    change = spark.createDataFrame([(2, 5, None), (1, 5, "x"), (9, 5, "y")], "id int, m int, w string")
    got = merge_clustered(kept, fresh, change, ["id"], ["m"], {"v": "w"})
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 5, "x"), (2, 5, None), (3, 5, "d"), (None, 5, "c")]


def test_staged_months_are_laid_out_without_a_shuffle(spark):
    df = with_month(sales(spark, [(1, 1, 1, 1, MONTHS[0])]))
    assert shuffles(month_layout(df, ["id"])) == 1
    assert shuffles(month_layout(df, ["id"], clustered=True)) == 0


def test_sales_are_looked_up_without_derived_columns(spark):
    w = two_runs(spark)
    pinned, _ = looked_up(w, w.store.read("stg_fact_sales").select(*SALE_COLS), w.store.parts("dwh_fact_sales"))
    assert not {"transaction_year", "transaction_month", "day_of_week", MONTH_KEY, "old_at"} & set(pinned.columns)
    assert pinned.filter("found AND customer_id IS NOT NULL").count() == 0


def test_the_rollup_sums_where_months_lie(spark):
    f = spark.createDataFrame([(202401, p % 7, p) for p in range(50)], f"{MONTH_KEY} int, product_key int, quantity int")
    once = product_months(salted(f, "product_key", 3).repartition(F.col(MONTH_KEY), F.col(SALT)), [SALT]).drop(SALT)
    assert shuffles(once) == 1
    assert sorted(once.collect()) == sorted(product_months(f).collect())
