"""The reference's source system, derived from the driver tables.

The driver ships TPC-H-like tables; the reference's operational database has
``customers``, ``products`` and ``sales``.  Each function returns the source
table as it looks at run 1 or run 2 of the scenario (README, "Scenario").
All work is joins and projections on the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import config as C
from tidewater.functions import micros_between, ntz
from tidewater.operators.joins import broadcast_if_small, shuffled
from tidewater.sources.tables import read_table


def _check_run(run: int) -> None:
    if run not in (1, 2):
        raise ValueError(f"run must be 1 or 2, got {run}")


def source_customers(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    """customers(id, name, country, created_at, updated_at) at ``run``."""
    _check_run(run)
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    if run == 1:
        cust = cust.filter(F.col("c_custkey") % C.NEW_CUSTOMER_MOD != 0)
        nation_key = F.col("c_nationkey")
    else:
        nation_key = F.when(F.col("c_custkey") % C.MOVED_CUSTOMER_MOD == 0,
                            (F.col("c_nationkey") + 1) % C.NATION_COUNT
                            ).otherwise(F.col("c_nationkey"))
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    first_order = (read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
                   .groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order")))
    created = F.coalesce(F.col("first_order"), ntz(C.DEFAULT_CREATED))
    return (cust.withColumn("nk", nation_key.cast("int"))
            .join(broadcast_if_small(nation), F.col("nk") == F.col("n_nationkey"), "left")
            .join(shuffled(first_order), F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    F.col("n_name").alias("country"), created.alias("created_at"),
                    created.alias("updated_at")))


def source_products(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    """products(id, name, group_name, created_at, updated_at) at ``run``."""
    _check_run(run)
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type"])
    if run == 1:
        part = part.filter(F.col("p_partkey") % C.NEW_PRODUCT_MOD != 0)
        name: Column = F.col("p_name")
    else:
        name = F.when(F.col("p_partkey") % C.RENAMED_PRODUCT_MOD == 0,
                      F.concat(F.col("p_name"), F.lit(C.RENAMED_SUFFIX))
                      ).otherwise(F.col("p_name"))
    created = ntz(C.DEFAULT_CREATED)
    return part.select(F.col("p_partkey").alias("id"), name.alias("name"),
                       F.col("p_type").alias("group_name"),
                       created.alias("created_at"), created.alias("updated_at"))


def source_sales(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    """sales(id, customer_id, product_id, qty, transaction_date, created_at).

    One row per line item; ``id = l_orderkey * 10 + l_linenumber`` repeats by
    design (a re-sent sale).  A row reaches the source when both its order
    was placed and it shipped: ``created_at = greatest(o_orderdate,
    l_shipdate)``.  Run 1 sees the rows created before the cut; both halves
    of that predicate are pushed to their Parquet scans.
    """
    _check_run(run)
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    line = read_table(spark, sf_dir, "lineitem",
                      ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"])
    if run == 1:
        orders = orders.filter(F.col("o_orderdate") < ntz(C.RUN1_CUT))
        line = line.filter(F.col("l_shipdate") < ntz(C.RUN1_CUT))
    return (line.join(shuffled(orders), F.col("l_orderkey") == F.col("o_orderkey"))
            .select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                    F.col("o_custkey").alias("customer_id"),
                    F.col("l_partkey").alias("product_id"),
                    F.col("l_quantity").cast("int").alias("qty"),
                    F.col("l_shipdate").alias("transaction_date"),
                    F.greatest("o_orderdate", "l_shipdate").alias("created_at")))


RUN_LOG_COLS = ["log_id", "process_name", "start_time", "end_time", "duration_us",
                "status", "rows_processed", "rows_inserted", "rows_updated",
                "rows_deleted", "error_message", "additional_info", "created_at"]


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log (``etl_logs``) mapped from the ``events`` table.

    process = 'job_' || user_id % 10; start = ts; end = ts + value seconds,
    null (still running) when event_id % 10 = 0; status RUNNING / FAILED
    (error) / WARNING (signup) / SUCCESS; rows = props.k.
    ``duration_us`` is the generated duration in whole microseconds.
    """
    ev = read_table(spark, sf_dir, "events",
                    ["event_id", "ts", "user_id", "event_type", "value", "props"])
    span_us = F.round(F.col("value") * 1_000_000).cast("long")
    end = F.when(F.col("event_id") % C.RUNNING_EVERY == 0, F.lit(None)).otherwise(
        F.timestamp_add("MICROSECOND", span_us, F.col("ts")))
    status = (F.when(end.isNull(), "RUNNING")
              .when(F.col("event_type") == "error", "FAILED")
              .when(F.col("event_type") == "signup", "WARNING")
              .otherwise("SUCCESS"))
    rows = F.get_json_object("props", "$.k").cast("int")
    return (ev.select(
        F.col("event_id").alias("log_id"),
        F.concat(F.lit(C.RUN_LOG_PREFIX),
                 (F.col("user_id") % C.RUN_LOG_JOBS).cast("string")).alias("process_name"),
        F.col("ts").alias("start_time"),
        end.alias("end_time"),
        status.alias("status"),
        rows.alias("rows_processed"),
        F.col("event_type"),
        F.col("props").alias("additional_info"),
        F.col("ts").alias("created_at"))
        .withColumn("duration_us", micros_between(F.col("start_time"), F.col("end_time")))
        .withColumn("rows_inserted", F.when(F.col("status") == "SUCCESS", F.col("rows_processed"))
                    .otherwise(F.lit(0)))
        .withColumn("rows_updated", F.lit(0))
        .withColumn("rows_deleted", F.lit(0))
        .withColumn("error_message", F.when(F.col("status") == "FAILED",
                                            F.concat(F.lit("error in "), F.col("process_name"))))
        .select(*RUN_LOG_COLS))
