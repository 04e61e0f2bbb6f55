"""SQL surface: the warehouse tables and the two run-log views as temp views
under the reference's names, so existing SQL runs unchanged, e.g.
``SELECT * FROM vw_recent_etl_runs`` or a join of ``dwh_fact_sales`` with
``dwh_dim_customers``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewater.operators.joins import max_broadcast_rows, shuffled
from tidewater.plans import monitoring as L
from tidewater.plans.pipeline import Warehouse

TABLES = ["mrr_fact_sales", "mrr_dim_customers", "mrr_dim_products", "stg_fact_sales",
          "stg_dim_customers", "stg_dim_products", "dwh_fact_sales", "dwh_dim_customers",
          "dwh_dim_products", "dwh_dim_date", "high_water_mark"]
#: Tables that other ones are joined with.
DIMENSIONS = ["mrr_dim_customers", "mrr_dim_products", "stg_dim_customers", "stg_dim_products",
              "dwh_dim_customers", "dwh_dim_products"]


def register_views(wh: Warehouse, run_log: DataFrame | None = None) -> list[str]:
    """Create temp views for every stored table; with a run log (the
    ``etl_logs`` schema plus ``duration_us``) also ``etl_logs``,
    ``vw_recent_etl_runs`` and ``vw_etl_performance_summary``.

    A dimension above the broadcast limit is marked to be shuffled where SQL
    joins it (:func:`tidewater.operators.joins.shuffled`).
    """
    names = []
    for t in TABLES:
        if wh.store.has(t):
            df = wh.table(t)
            if t in DIMENSIONS and wh.rows.get(t, 0) > max_broadcast_rows(df):
                df = shuffled(df)
            df.createOrReplaceTempView(t)
            names.append(t)
    log = run_log if run_log is not None else (
        wh.store.read("etl_logs") if wh.store.has("etl_logs") else None)
    if log is not None:
        log.createOrReplaceTempView("etl_logs")
        L.recent_runs(log).createOrReplaceTempView("vw_recent_etl_runs")
        L.performance_summary(log).createOrReplaceTempView("vw_etl_performance_summary")
        names += ["etl_logs", "vw_recent_etl_runs", "vw_etl_performance_summary"]
    return names
