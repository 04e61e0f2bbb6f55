"""The reference's two stored procedures as logged Spark jobs.

Each logs its start (RUNNING), runs one set-based plan - the row cursor of
the original disappears - and logs SUCCESS with the row count, or FAILED
with the error and re-raises.  Results are published only when complete.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidewater.functions import ntz
from tidewater.plans import metrics as M
from tidewater.plans.pipeline import Warehouse


def _run(wh: Warehouse, process: str, info: dict | None, body) -> DataFrame:
    log_id = wh.log.start(process, info)
    wh.log.flush()
    try:
        df, rows, out = body()
    except Exception as exc:
        wh.log.end(log_id, "FAILED", error=str(exc))
        wh.log.flush()
        raise
    wh.log.end(log_id, "SUCCESS", rows, rows, info={"output_table": out})
    wh.log.flush()
    return df


def _stored(wh: Warehouse, table: str, df: DataFrame) -> tuple[DataFrame, int]:
    """Write ``df`` as a table; its rows are counted by the write."""
    obs = Observation(f"{table}_{uuid.uuid4().hex[:8]}")
    out = wh.store.write(table, df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return out, int(obs.get["rows"])


def aggregate_sales_report(wh: Warehouse, start: dt.date, end: dt.date,
                           view: str = "temp_sales_report") -> DataFrame:
    """``CALL sp_aggregate_sales_report(start, end)``: the report as a temp view."""
    def body():
        df = M.sales_report(wh.facts_between(start, end), wh.table("dwh_dim_customers"),
                            wh.table("dwh_dim_products"), start, end,
                            wh.rows.get("dwh_dim_customers"), wh.rows.get("dwh_dim_products"))
        df, rows = _stored(wh, view, df)
        df.createOrReplaceTempView(view)
        return df, rows, view
    return _run(wh, "sp_aggregate_sales_report",
                {"start_date": str(start), "end_date": str(end)}, body)


def refresh_customer_metrics(wh: Warehouse, calculated_at: str,
                             table: str = "customer_metrics") -> DataFrame:
    """``CALL sp_refresh_customer_metrics()``: rebuild the metrics table
    (create-table-as-select as a new store version)."""
    def body():
        df = M.customer_metrics(wh.table("dwh_fact_sales"), wh.table("dwh_dim_customers"))
        df = df.withColumn("calculated_at", ntz(calculated_at))
        out, rows = _stored(wh, table, df)
        wh.rows[table] = rows
        if wh.runs:  # publish it with the last run, so that later processes see it
            last = max(wh.runs)
            wh.runs[last]["versions"][table] = version = wh.store.versions[table]
            wh.store.commit(last, {table: version}, {table: rows}, {}, wh.runs[last]["marks"],
                            calculated_at, name=f"run-{last:08d}-{table}-{version:04d}")
        return out, rows, table
    return _run(wh, "sp_refresh_customer_metrics", None, body)


def top_by_transactions(metrics: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` customers with most transactions, ties by customer id."""
    return metrics.orderBy(F.desc("total_transactions"), F.asc("customer_id")).limit(n)
