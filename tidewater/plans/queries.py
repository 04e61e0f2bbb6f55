"""Registry of the queries checked against the SQL oracle.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Warehouse
queries read the tables the two-run pipeline wrote (built once per session
and folder); source queries read the driver tables through the adapter.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater import config as C
from tidewater.functions import ntz
from tidewater.operators import quality as Q
from tidewater.operators.calendar import CALENDAR_COLS, calendar_between
from tidewater.operators.joins import skipped_rows
from tidewater.operators.marks import extract_delta, late_rows
from tidewater.operators.upsert import insert_if_absent, latest_per_key
from tidewater.plans import metrics as M
from tidewater.plans import monitoring as L
from tidewater.plans.pipeline import SALES_ORDER, open_warehouse
from tidewater.plans.procedures import refresh_customer_metrics
from tidewater.plans.scenario import warehouse
from tidewater.plans.sql_functions import register_functions
from tidewater.sources import adapter as A
from tidewater.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _wh(spark, sf_dir):
    return warehouse(spark, sf_dir)


def _t(name: str, run: int | None = None):
    return lambda spark, sf_dir: _wh(spark, sf_dir).table(name, run)


def _star(fn):
    def q(spark, sf_dir):
        wh = _wh(spark, sf_dir)
        return fn(wh.table("dwh_fact_sales"), wh.table("dwh_dim_customers"),
                  wh.table("dwh_dim_products"))
    return q


# --------------------------------------------------------------- step 1: report
def q_sales_report(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return M.sales_report(wh.facts_between(C.REPORT_START, C.REPORT_END),
                          wh.table("dwh_dim_customers"),
                          wh.table("dwh_dim_products"), C.REPORT_START, C.REPORT_END,
                          wh.rows.get("dwh_dim_customers"), wh.rows.get("dwh_dim_products"))


# --------------------------------------------------------------- step 2: incremental
def _delta(source: str, order_col: str, cols: list[str]):
    def q(spark, sf_dir):
        wh = _wh(spark, sf_dir)
        src = {"customers": A.source_customers, "products": A.source_products,
               "sales": A.source_sales}[source](spark, sf_dir, 2)
        return extract_delta(src, order_col, wh.runs[2]["marks"][source]).select(*cols)
    return q


def q_upsert_partial(spark, sf_dir):
    """Facts of run 1 that run 2 re-sent: only the quantity follows staging,
    keys and dates stay as first loaded."""
    wh = _wh(spark, sf_dir)
    f1 = wh.table("dwh_fact_sales", 1).select("sale_key", F.col("quantity").alias("quantity_before"))
    f2 = wh.table("dwh_fact_sales", 2).select(
        "sale_key", "original_sale_id", "customer_key", "transaction_date",
        "transaction_timestamp", F.col("quantity").alias("quantity_after"))
    s2 = wh.table("stg_fact_sales", 2).select(
        F.col("sale_id").alias("original_sale_id"),
        F.col("transaction_date").alias("staged_timestamp"),
        F.col("quantity").alias("staged_quantity"))
    j = f1.join(f2, "sale_key").join(s2, "original_sale_id")
    changed = ((F.col("staged_timestamp") != F.col("transaction_timestamp"))
               | (F.col("quantity_before") != F.col("quantity_after")))
    return j.filter(changed).select(
        "sale_key", "original_sale_id", "customer_key", "transaction_date",
        F.to_date("staged_timestamp").alias("staged_transaction_date"),
        "quantity_before", "quantity_after")


def q_upsert_do_nothing(spark, sf_dir):
    """``ON CONFLICT DO NOTHING`` variant of the mirror load: the run-2 batch
    only adds sale ids the mirror lacks, so the first version of a sale wins."""
    wh = _wh(spark, sf_dir)
    cols = ["id", "customer_id", "product_id", "qty", "transaction_date"]
    mirror1 = wh.table("mrr_fact_sales", 1).select(*cols)
    delta = extract_delta(A.source_sales(spark, sf_dir, 2), "transaction_date",
                          wh.runs[2]["marks"]["sales"]).select(*cols)
    return insert_if_absent(mirror1, latest_per_key(delta, ["id"], SALES_ORDER), ["id"])


def q_high_water_mark(spark, sf_dir):
    return _wh(spark, sf_dir).table("high_water_mark")


def q_late_rows(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    src = A.source_sales(spark, sf_dir, 2)
    return late_rows(src, wh.table("mrr_fact_sales"), "transaction_date",
                     wh.runs[2]["marks"]["sales"])


# --------------------------------------------------------------- step 3: staging, calendar
def q_dim_date(spark, sf_dir):
    """Calendar after a backfill covering every sale date (days already there
    are left alone)."""
    wh = _wh(spark, sf_dir)
    cal = wh.table("dwh_dim_date")
    span = wh.table("dwh_fact_sales").agg(F.min("transaction_date").alias("start"),
                                          F.max("transaction_date").alias("end"))
    return insert_if_absent(cal, calendar_between(span).select(*CALENDAR_COLS), ["date_key"])


# --------------------------------------------------------------- step 4: keys, SCD2, facts
def q_fact_skipped(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    out = None
    for run in (1, 2):
        cur_c = wh.table("dwh_dim_customers", run).filter("is_current").select("customer_id")
        cur_p = wh.table("dwh_dim_products", run).filter("is_current").select("product_id")
        s = wh.table("stg_fact_sales", run).select("sale_id", "customer_id", "product_id")
        r = skipped_rows(s, cur_c, cur_p, rows_c=wh.rows.get("dwh_dim_customers"),
                         rows_p=wh.rows.get("dwh_dim_products")).withColumn("run", F.lit(run))
        out = r if out is None else out.unionByName(r)
    return out.select("run", "sale_id", "customer_id", "product_id", "reason")


# --------------------------------------------------------------- step 5: metrics
def q_avg_quantity(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return M.avg_quantity(wh.facts_between(C.REPORT_START, C.REPORT_END),
                          wh.table("dwh_dim_customers"), C.REPORT_START, C.REPORT_END)


def q_velocity(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    since = C.AS_OF_DAY - dt.timedelta(days=C.VELOCITY_DAYS)
    return M.velocity(wh.facts_between(since, None), wh.table("dwh_dim_products"))


def q_group_performance(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return M.group_performance(wh.table("dwh_fact_sales"), wh.table("dwh_dim_products"),
                               rows_p=wh.rows.get("dwh_dim_products"))


def q_mom_growth(spark, sf_dir):
    return M.mom_growth(_wh(spark, sf_dir).table("dwh_fact_sales"))


def q_monthly_group_sales(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return M.monthly_group_sales(wh.table("dwh_fact_sales"), wh.table("dwh_dim_products"),
                                 wh.rows.get("dwh_dim_products"))


def q_top_groups(spark, sf_dir):
    return M.top_groups(A.source_sales(spark, sf_dir, 2), A.source_products(spark, sf_dir, 2))


def q_source_profile(spark, sf_dir):
    return M.source_profile(A.source_customers(spark, sf_dir, 2),
                            A.source_products(spark, sf_dir, 2),
                            A.source_sales(spark, sf_dir, 2))


# --------------------------------------------------------------- step 6: as-of, calendar join
def q_point_in_time_sales(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return M.point_in_time_sales(wh.table("dwh_fact_sales"), wh.table("dwh_dim_customers"),
                                 wh.rows.get("dwh_dim_customers"))


def q_weekend_quantity(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return M.weekend_quantity(wh.table("dwh_fact_sales"), wh.table("dwh_dim_date"),
                              wh.rows.get("dwh_dim_date"))


# --------------------------------------------------------------- step 7: run log
def _log(fn):
    return lambda spark, sf_dir: fn(A.run_log(spark, sf_dir))


def q_freshness(spark, sf_dir):
    return L.freshness(_wh(spark, sf_dir).table("high_water_mark"))


def q_layer_counts(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return L.layer_counts({"operational": A.source_sales(spark, sf_dir, 2),
                           "mrr": wh.table("mrr_fact_sales"),
                           "stg": wh.table("stg_fact_sales"),
                           "dwh": wh.table("dwh_fact_sales")})


# --------------------------------------------------------------- step 8: quality
def sales_rules():
    return {
        "qty_positive": Q.rule_positive("qty"),
        "keys_not_null": Q.rule_not_null("id", "customer_id", "product_id", "transaction_date"),
    }


def customer_rules():
    return {
        "name_not_null": Q.rule_not_null("name"),
        "name_max_255": Q.rule_max_length("name", 255),
        "country_not_null": Q.rule_not_null("country"),
        "country_max_100": Q.rule_max_length("country", 100),
    }


def product_rules():
    return {
        "name_not_null": Q.rule_not_null("name"),
        "name_max_255": Q.rule_max_length("name", 255),
        "group_not_null": Q.rule_not_null("group_name"),
        "group_max_100": Q.rule_max_length("group_name", 100),
    }


def log_rules():
    return {"status_allowed": Q.rule_status("status")}


def q_rejected_sales(spark, sf_dir):
    _, rejected = Q.apply_rules(A.source_sales(spark, sf_dir, 2), sales_rules())
    return rejected.select("id", "customer_id", "product_id", "qty", "transaction_date",
                           "failed_rules")


def q_rule_summary(spark, sf_dir):
    return (Q.rule_summary(A.source_sales(spark, sf_dir, 2), "sales", sales_rules())
            .unionByName(Q.rule_summary(A.source_customers(spark, sf_dir, 2), "customers",
                                        customer_rules()))
            .unionByName(Q.rule_summary(A.source_products(spark, sf_dir, 2), "products",
                                        product_rules()))
            .unionByName(Q.rule_summary(A.run_log(spark, sf_dir), "etl_logs", log_rules())))


def q_broken_rules(spark, sf_dir):
    """The rules over given tables that break them: every rule fails somewhere."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    events = read_table(spark, sf_dir, "events", ["event_type"])
    customers = read_table(spark, sf_dir, "customer", ["c_acctbal"])
    sales = A.source_sales(spark, sf_dir, 2).select("customer_id").join(
        A.source_customers(spark, sf_dir, 1).select(F.col("id").alias("customer_id"), "name"),
        "customer_id", "left")
    return (Q.rule_summary(docs, "documents", {"text_max_255": Q.rule_max_length("text", 255)})
            .unionByName(Q.rule_summary(events, "events",
                                        {"status_allowed": Q.rule_status("event_type")}))
            .unionByName(Q.rule_summary(customers, "customer",
                                        {"balance_positive": Q.rule_positive("c_acctbal")}))
            .unionByName(Q.rule_summary(sales, "sales",
                                        {"parent_name_not_null": Q.rule_not_null("name")})))


def q_rejected_documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    _, rejected = Q.apply_rules(docs, {"text_max_255": Q.rule_max_length("text", 255),
                                       "text_not_null": Q.rule_not_null("text")})
    return rejected.select("doc_id", "failed_rules")


#: What the loads below ask of a sale beyond the default rules.
MOST_SOLD, FIRST_DAY = 45, "1993-01-01 00:00:00"


def _guarded(spark, sf_dir):
    """The run-1 sales loaded into a mirror under stricter rules."""
    from tidewater.plans.pipeline import Run, extract_one, new_warehouse, prepare_marks
    wh = new_warehouse(spark)
    rules = {**Q.load_rules("sales"), "qty_at_most": F.col("qty") <= MOST_SOLD,
             "not_before_first_day": F.col("transaction_date") >= ntz(FIRST_DAY)}
    run = Run(1, C.RUN1_DAY, C.RUN1_TS, {"sales": A.source_sales(spark, sf_dir, 1)}, rules={"sales": rules})
    prepare_marks(wh, run)
    extract_one(wh, run, "sales")
    return wh


def q_load_rejected(spark, sf_dir):
    """Rows that a load kept out of the mirror, with the rules they break."""
    return _guarded(spark, sf_dir).table("rejected_sales").select(
        "id", "customer_id", "product_id", "qty", "transaction_date", "failed_rules", "run")


def q_load_accepted(spark, sf_dir):
    """The mirror of the same load, without them."""
    return _guarded(spark, sf_dir).table("mrr_fact_sales").drop("loaded_at")


def q_monthly_group_sales_table(spark, sf_dir):
    """Monthly group sales from the rollup that both runs kept, read from a
    reopened warehouse."""
    wh = open_warehouse(spark, _wh(spark, sf_dir).store.root)
    return M.monthly_group_sales_of(wh.store.read("dwh_monthly_sales"), wh.table("dwh_dim_products"),
                                    wh.rows.get("dwh_dim_products"))


def _sql(text: str):
    """A query through the SQL functions; ``AS_OF``, ``START`` and ``END`` stand
    for the fixed dates."""
    def q(spark, sf_dir):
        register_functions(_wh(spark, sf_dir))
        day = {"AS_OF": C.AS_OF_DAY, "START": C.REPORT_START, "END": C.REPORT_END}
        out = text
        for name, value in day.items():
            out = out.replace(name, f"DATE'{value}'")
        return spark.sql(out)
    return q


#: Every key of a dimension, and one that nobody has.
ALL_CUSTOMERS = "(SELECT DISTINCT customer_id FROM dwh_dim_customers UNION ALL SELECT -1)"
ALL_PRODUCTS = "(SELECT DISTINCT product_id FROM dwh_dim_products UNION ALL SELECT -1)"
SQL_QUERIES = {
    "sql_avg_quantity": f"SELECT customer_id, fn_avg_quantity_per_customer(customer_id, START, END) AS avg_quantity "
                        f"FROM {ALL_CUSTOMERS}",
    "sql_velocity": f"SELECT product_id, fn_product_sales_velocity(product_id, {C.VELOCITY_DAYS}, AS_OF) AS velocity "
                    f"FROM {ALL_PRODUCTS}",
    "sql_lifetime_value": f"SELECT customer_id, fn_customer_lifetime_value(customer_id) AS lifetime_quantity "
                          f"FROM {ALL_CUSTOMERS}",
    "sql_recency": f"SELECT customer_id, fn_customer_recency(customer_id, AS_OF) AS days FROM {ALL_CUSTOMERS}",
    "sql_growth": "SELECT y AS year, m AS month, fn_month_over_month_growth(y, m) AS growth_pct FROM "
                  "(SELECT DISTINCT year AS y, month AS m FROM dwh_dim_date UNION ALL SELECT 1950, 1)",
    "sql_top_customers": f"SELECT * FROM fn_top_customers({C.TOP_N}, START, END)",
}


LOGGED = ["mrr_to_stg_customers", "mrr_to_stg_products", "mrr_to_stg_sales",
          "stg_to_dwh_customers", "stg_to_dwh_date_dimension", "stg_to_dwh_products",
          "stg_to_dwh_sales"]


def q_etl_run_log(spark, sf_dir):
    """The pipeline's own log of both runs: rows that each step processed."""
    log = _wh(spark, sf_dir).table("etl_logs").filter(F.col("process_name").isin(*LOGGED))
    run = F.row_number().over(Window.partitionBy("process_name").orderBy("log_id"))
    return log.select("process_name", run.cast("long").alias("run"), "status", "rows_processed")


def q_customer_metrics_table(spark, sf_dir):
    """The metrics table as the procedure stored it, read from a reopened warehouse."""
    wh = _wh(spark, sf_dir)
    if not wh.store.has("customer_metrics"):
        refresh_customer_metrics(wh, C.AS_OF_TS)
    return open_warehouse(spark, wh.store.root).table("customer_metrics").drop("calculated_at")


def q_group_performance_json(spark, sf_dir):
    """The JSON form, parsed back field by field."""
    wh = _wh(spark, sf_dir)
    perf = M.group_performance(wh.table("dwh_fact_sales"), wh.table("dwh_dim_products"))
    fields = perf.schema.simpleString()[len("struct<"):-1]
    return (M.group_performance_json(perf)
            .select(F.from_json("performance", f"struct<{fields}>").alias("j")).select("j.*"))


def q_orphans(spark, sf_dir):
    """All source sales whose customer or product the run-1 snapshots lack (C5) and
    warehouse facts without a customer, product or calendar row (C6); each
    child table is read once."""
    wh = _wh(spark, sf_dir)
    sales = A.source_sales(spark, sf_dir, 2).select(F.col("id").alias("sale_id"), "customer_id",
                                                    "product_id")
    c1, p1 = A.source_customers(spark, sf_dir, 1), A.source_products(spark, sf_dir, 1)
    source = Q.orphan_report(sales, [(c1, "customer_id", "id", "missing customer"),
                                  (p1, "product_id", "id", "missing product")], ["sale_id"])
    fact = wh.table("dwh_fact_sales").select(F.col("original_sale_id").alias("sale_id"),
                                             "customer_key", "product_key", "date_key")
    dims = [(wh.table("dwh_dim_customers"), "customer_key", "customer_key", "missing customer",
             wh.rows.get("dwh_dim_customers")),
            (wh.table("dwh_dim_products"), "product_key", "product_key", "missing product",
             wh.rows.get("dwh_dim_products")),
            (wh.table("dwh_dim_date"), "date_key", "date_key", "missing date",
             wh.rows.get("dwh_dim_date"))]
    warehouse_side = Q.orphan_report(fact, dims, ["sale_id"])
    return (source.withColumn("layer", F.lit("source"))
            .unionByName(warehouse_side.withColumn("layer", F.lit("warehouse")))
            .select("layer", "sale_id", "reason"))


def q_duplicate_keys(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return (Q.duplicate_keys(A.source_sales(spark, sf_dir, 2), ["id"], "sales")
            .unionByName(Q.duplicate_keys(wh.table("dwh_fact_sales"), ["original_sale_id"],
                                          "dwh_fact_sales"))
            .unionByName(Q.duplicate_keys(wh.table("dwh_dim_date"), ["date_key"],
                                          "dwh_dim_date")))


def q_cascade_delete(spark, sf_dir):
    """Run-2 sales that survive deleting the customers and products missing
    from the run-1 snapshots (``ON DELETE CASCADE``)."""
    s = A.source_sales(spark, sf_dir, 2).select("id", "customer_id", "product_id", "qty",
                                                "transaction_date")
    s = Q.cascade_keep(s, A.source_customers(spark, sf_dir, 1), "customer_id", "id",
                       check_broadcast=True)
    return Q.cascade_keep(s, A.source_products(spark, sf_dir, 1), "product_id", "id",
                          check_broadcast=True)


def q_top_customer_metrics(spark, sf_dir):
    from tidewater.plans.procedures import top_by_transactions
    wh = _wh(spark, sf_dir)
    return top_by_transactions(M.customer_metrics(wh.table("dwh_fact_sales"),
                                                  wh.table("dwh_dim_customers")))


# --------------------------------------------------------------- streaming form
_STREAMED: dict[tuple, DataFrame] = {}
_STREAM_LOCK = threading.Lock()


def q_stream_mirror_sales(spark, sf_dir):
    """Mirror of sales kept by the file stream: the source rows created
    before the cut land first, the rest later; each arrival is one
    availableNow run, and a later arrival replaces an id's earlier row."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _STREAM_LOCK:
        if key not in _STREAMED:
            _STREAMED[key] = _stream_mirror(spark, sf_dir)
    return _STREAMED[key]


def _stream_mirror(spark, sf_dir):
    """Land the two arrivals and run the stream once per arrival."""
    from tidewater.sources.store import LayerStore
    from tidewater.streaming.incremental import StreamingMirror
    store = LayerStore(spark)
    landing, ckpt = f"{store.root}/landing/sales", f"{store.root}/_stream_checkpoint"
    mirror = StreamingMirror(spark, store, "mrr_fact_sales_stream", landing, ckpt)
    sales = A.source_sales(spark, sf_dir, 2)
    first = F.col("created_at") < ntz(C.RUN1_CUT)
    for i, part in enumerate([sales.filter(first), sales.filter(~first)]):
        part.write.parquet(f"{landing}/arrival={i + 1}")
        mirror.run_available()
    return mirror.result().drop("batch_id")


def registry() -> dict[str, Query]:
    return {
        "sales_report": q_sales_report,
        "delta_customers": _delta("customers", "created_at", ["id", "name", "country", "created_at"]),
        "delta_products": _delta("products", "created_at", ["id", "name", "group_name", "created_at"]),
        "delta_sales": _delta("sales", "transaction_date",
                              ["id", "customer_id", "product_id", "qty", "transaction_date"]),
        "mrr_upsert_sales": _t("mrr_fact_sales"),
        "mrr_upsert_customers": _t("mrr_dim_customers"),
        "mrr_upsert_products": _t("mrr_dim_products"),
        "upsert_partial": q_upsert_partial,
        "upsert_do_nothing": q_upsert_do_nothing,
        "high_water_mark": q_high_water_mark,
        "late_rows": q_late_rows,
        "stg_customers": _t("stg_dim_customers"),
        "stg_products": _t("stg_dim_products"),
        "stg_sales": _t("stg_fact_sales"),
        "dim_date": q_dim_date,
        "scd2_customers": _t("dwh_dim_customers"),
        "scd2_products": _t("dwh_dim_products"),
        "fact_sales": _t("dwh_fact_sales"),
        "fact_skipped": q_fact_skipped,
        "customer_metrics": lambda s, d: M.customer_metrics(
            _wh(s, d).table("dwh_fact_sales"), _wh(s, d).table("dwh_dim_customers")),
        "avg_quantity": q_avg_quantity,
        "velocity": q_velocity,
        "lifetime_quantity": lambda s, d: M.lifetime_quantity(
            _wh(s, d).table("dwh_fact_sales"), _wh(s, d).table("dwh_dim_customers")),
        "recency": lambda s, d: M.recency(
            _wh(s, d).table("dwh_fact_sales"), _wh(s, d).table("dwh_dim_customers")),
        "group_performance": q_group_performance,
        "mom_growth": q_mom_growth,
        "top_customers": lambda s, d: M.top_customers(
            _wh(s, d).table("dwh_fact_sales"), _wh(s, d).table("dwh_dim_customers")),
        "monthly_group_sales": q_monthly_group_sales,
        "top_groups": q_top_groups,
        "source_profile": q_source_profile,
        "current_counts": _star(M.current_counts),
        "point_in_time_sales": q_point_in_time_sales,
        "weekend_quantity": q_weekend_quantity,
        "recent_runs": _log(L.recent_runs),
        "performance_summary": _log(L.performance_summary),
        "daily_trend": _log(L.daily_trend),
        "failed_runs": _log(L.failed_runs),
        "runs_like": _log(L.runs_like),
        "freshness": q_freshness,
        "layer_counts": q_layer_counts,
        "rejected_sales": q_rejected_sales,
        "rule_summary": q_rule_summary,
        "orphans": q_orphans,
        "broken_rules": q_broken_rules,
        "rejected_documents": q_rejected_documents,
        **{name: _sql(text) for name, text in SQL_QUERIES.items()},
        "monthly_group_sales_table": q_monthly_group_sales_table,
        "load_rejected": q_load_rejected,
        "load_accepted": q_load_accepted,
        "etl_run_log": q_etl_run_log,
        "customer_metrics_table": q_customer_metrics_table,
        "group_performance_json": q_group_performance_json,
        "duplicate_keys": q_duplicate_keys,
        "cascade_delete": q_cascade_delete,
        "stream_mirror_sales": q_stream_mirror_sales,
        "top_customer_metrics": q_top_customer_metrics,
    }


