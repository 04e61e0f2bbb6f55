"""Seeded synthetic source rows (the reference's sample-data generator).

Set-based: ``spark.range`` plus seeded ``rand``; no driver loop.  Used by
unit tests only, since registered queries must read the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: the generator's country and product group lists ---------
COUNTRIES = ["USA", "Canada", "UK", "Germany", "France", "Japan",
             "Australia", "Brazil", "India", "China"]
GROUPS = ["Electronics", "Clothing", "Food", "Books", "Toys", "Sports",
          "Home", "Beauty", "Automotive", "Garden"]


def _pick(values: list[str], idx):
    # CASE idx WHEN 0 THEN v0 ... ELSE last
    expr = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        expr = F.when(idx == i, F.lit(values[i])).otherwise(expr)
    return expr


def synthetic_sources(spark: SparkSession, customers: int = 1000, products: int = 100,
                      sales: int = 10000, seed: int = 7,
                      now: str = "2025-01-31 00:00:00") -> dict[str, DataFrame]:
    """customers, products and sales as in the sample-data script.

    country = CASE (random()*10)::int ...; group = CASE (random()*9)::int ...;
    qty in 1..10; transaction_date up to 30 days before ``now``.
    """
    now_ts = F.lit(now).cast("timestamp_ntz")
    cust = spark.range(1, customers + 1).select(
        F.col("id"),
        F.concat(F.lit("Customer "), F.col("id").cast("string")).alias("name"),
        _pick(COUNTRIES, F.round(F.rand(seed) * 10).cast("int")).alias("country"),
        now_ts.alias("created_at"), now_ts.alias("updated_at"))
    prod = spark.range(1, products + 1).select(
        F.col("id"),
        F.concat(F.lit("Product "), F.col("id").cast("string")).alias("name"),
        _pick(GROUPS, F.round(F.rand(seed + 1) * 9).cast("int")).alias("group_name"),
        now_ts.alias("created_at"), now_ts.alias("updated_at"))
    age_us = (F.rand(seed + 5) * 30 * 86_400_000_000).cast("long")
    sale = spark.range(1, sales + 1).select(
        F.col("id"),
        F.round(F.rand(seed + 2) * (customers - 1) + 1).cast("long").alias("customer_id"),
        F.round(F.rand(seed + 3) * (products - 1) + 1).cast("long").alias("product_id"),
        F.round(F.rand(seed + 4) * 9 + 1).cast("int").alias("qty"),
        F.timestamp_add("MICROSECOND", -age_us, now_ts).alias("transaction_date"),
        now_ts.alias("created_at"))
    return {"customers": cust, "products": prod, "sales": sale}
