"""The reference's callable surface, one call per key, with its result rules.

Each function returns a one-row DataFrame, also for an unknown id (a global
aggregate always yields one row): average, velocity and lifetime value give
0, recency gives null, group performance gives zeros.  The work is a filter
pushed to the scans, a join to the one matching current version and one
aggregate.  For all keys at once use the grouped forms in ``metrics``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater import config as C
from tidewater.functions import month_start, round_half_away_ratio, round_half_up_ratio
from tidewater.plans.metrics import _optional_range, group_performance, group_performance_json


def _customer_facts(fact: DataFrame, customers: DataFrame, customer_id: int) -> DataFrame:
    cur = customers.filter(F.col("is_current") & (F.col("customer_id") == F.lit(customer_id)))
    return fact.join(F.broadcast(cur.select("customer_key")), "customer_key")  # at most 1 row


def avg_quantity_per_customer(fact: DataFrame, customers: DataFrame, customer_id: int,
                              start: dt.date | None = None,
                              end: dt.date | None = None) -> DataFrame:
    f = _optional_range(_customer_facts(fact, customers, customer_id), "transaction_date",
                        start, end)
    return f.agg(F.coalesce(round_half_up_ratio(F.sum("quantity"), F.count("quantity")),
                            F.lit(0.0)).alias("avg_quantity"))


def product_sales_velocity(fact: DataFrame, products: DataFrame, product_id: int,
                           days: int = C.VELOCITY_DAYS,
                           as_of: dt.date = C.AS_OF_DAY) -> DataFrame:
    if days <= 0:
        raise ValueError("days must be positive")
    cur = products.filter(F.col("is_current") & (F.col("product_id") == F.lit(product_id)))
    f = (fact.filter(F.col("transaction_date") >= F.lit(as_of - dt.timedelta(days=days)))
         .join(F.broadcast(cur.select("product_key")), "product_key"))
    return f.agg(F.coalesce(round_half_up_ratio(F.sum("quantity"), F.lit(days)),
                            F.lit(0.0)).alias("velocity"))


def customer_lifetime_value(fact: DataFrame, customers: DataFrame, customer_id: int) -> DataFrame:
    f = _customer_facts(fact, customers, customer_id)
    return f.agg(F.coalesce(F.sum("quantity"), F.lit(0)).cast("long").alias("lifetime_quantity"))


def customer_recency(fact: DataFrame, customers: DataFrame, customer_id: int,
                     as_of: dt.date = C.AS_OF_DAY) -> DataFrame:
    f = _customer_facts(fact, customers, customer_id)
    return f.agg(F.datediff(F.lit(as_of), F.max("transaction_date"))
                 .alias("days_since_last_purchase"))


def product_group_performance(fact: DataFrame, products: DataFrame, group: str,
                              start: dt.date | None = None,
                              end: dt.date | None = None) -> DataFrame:
    """One row: the group's JSON object; zeros (and the given dates) when the
    group is unknown or has no sales."""
    cur = products.filter(F.col("product_group") == F.lit(group))
    perf = group_performance(fact, cur, start, end)
    empty = fact.sparkSession.createDataFrame(
        [(group, 0, 0, 0, 0, 0.0, start, end)],
        "product_group string, total_quantity bigint, total_transactions bigint, "
        "unique_customers bigint, unique_products bigint, avg_quantity_per_transaction double, "
        "start_date date, end_date date")
    one = perf.unionByName(empty).agg(*[
        (F.first(c, ignorenulls=True) if c == "product_group" else F.max(c)).alias(c)
        for c in empty.columns])
    return group_performance_json(one).select("performance")


def month_over_month_growth(fact: DataFrame, year: int, month: int) -> DataFrame:
    """Growth % of ``year-month`` over the month before; null when that was 0."""
    cur_start = dt.date(year, month, 1)
    prev_start = (cur_start - dt.timedelta(days=1)).replace(day=1)
    nxt = (cur_start + dt.timedelta(days=32)).replace(day=1)
    d = F.col("transaction_date")
    f = fact.filter((d >= F.lit(prev_start)) & (d < F.lit(nxt)))
    cur_q = F.coalesce(F.sum(F.when(month_start(d) == F.lit(cur_start), F.col("quantity"))),
                       F.lit(0)).cast("long")
    prev_q = F.coalesce(F.sum(F.when(month_start(d) == F.lit(prev_start), F.col("quantity"))),
                        F.lit(0)).cast("long")
    return f.agg(round_half_away_ratio(cur_q - prev_q, prev_q, 2, factor=100).alias("growth_pct"))
