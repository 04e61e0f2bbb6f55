"""Only what came since the last load is looked up, and large new batches stay in their tasks."""

from tests.conftest import D, rows
from tests.test_moved_once import LIMIT, shuffles
from tests.test_pipeline import C0, CUST, PROD, sales
from tidewater.plans import pipeline as P

FIRST = [(1, 1, 10, 5, "2024-06-01 00:00:00"), (2, 2, 10, 6, "2024-06-02 00:00:00"),
         (3, 1, 10, 7, "2024-06-03 00:00:00"), (4, 9, 10, 8, "2024-06-01 00:00:00"),
         (6, 8, 10, 9, "2024-06-01 00:00:00")]
# 2 is sent again, 5 is new, 4 has its customer now, and 6, skipped before, is sent again
SECOND = FIRST + [(2, 1, 10, 50, "2024-06-20 00:00:00"), (5, 2, 10, 11, "2024-07-01 00:00:00"),
                  (6, 1, 10, 12, "2024-06-21 00:00:00")]


def test_only_new_and_skipped_sales_are_looked_up(spark, monkeypatch):
    prods = spark.createDataFrame([(10, "Widget", "Tools", C0, C0)], PROD)
    monkeypatch.setattr(P, "FILE_ROWS", 1)  # new rows are written where they are
    seen, looked_up = [], P.looked_up

    def spy(wh, df, stored):
        seen.append(sorted(r[0] for r in df.select("sale_id").collect()))
        return looked_up(wh, df, stored)
    monkeypatch.setattr(P, "looked_up", spy)
    w = P.new_warehouse(spark)
    spark.conf.set(LIMIT, "0")
    try:
        for n, (day, ids, items) in enumerate([("2024-06-15", (1, 2), FIRST), ("2024-07-02", (1, 2, 9), SECOND)], 1):
            custs = spark.createDataFrame([(i, f"c{i}", "US", C0, C0) for i in ids], CUST)
            P.run_pipeline(w, P.Run(n, D(day), f"{day} 06:00:00", {
                "customers": custs, "products": prods, "sales": sales(spark, items)}))
    finally:
        spark.conf.unset(LIMIT)
    # 6 twice: the row that was skipped, and the one sent since, which counts
    assert seen == [[1, 2, 3, 4, 6], [2, 4, 5, 6, 6]]
    facts = rows(w.table("dwh_fact_sales").select("original_sale_id", "sale_key", "quantity", "date_key"), "sale_key")
    assert [tuple(r.values()) for r in facts] == [
        (1, 1, 5, 20240601), (2, 2, 50, 20240602), (3, 3, 7, 20240603),
        (4, 4, 8, 20240601), (5, 5, 11, 20240701), (6, 6, 12, 20240621)]
    assert w.rows["dwh_fact_sales"] == 6 and w.table("stg_skipped_sales").count() == 0
    assert [r["qty"] for r in rows(w.table("mrr_fact_sales"), "id")] == [5, 50, 7, 8, 11, 12]
    assert P.MIRRORED not in w.table("stg_fact_sales").columns


def test_new_rows_stay_in_their_tasks_where_their_files_are_large(spark, monkeypatch):
    df = P.with_month(sales(spark, [(1, 1, 1, 1, "2024-06-01 00:00:00")]))
    assert shuffles(P.month_layout(None, ["id"], placed=df)) == 0
    assert shuffles(P.month_layout(df, ["id"], placed=df)) == 1
    full = {m: P.FILE_ROWS for m in range(48)}
    assert P.tasks_in_place(spark, full) == 1
    assert P.tasks_in_place(spark, {**full, 48: 1}) == 0 and P.tasks_in_place(spark, {}) == 0
    many = {m: 50_000_000 for m in range(48)}
    assert P.tasks_in_place(spark, many) == 50_000_000 * 48 // P.ROWS_PER_PARTITION
