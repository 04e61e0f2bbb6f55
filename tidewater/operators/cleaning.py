"""Mirror -> staging cleaning and derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import day_of_week0, ntz, strip_all, upper_strip


def _clean_dimension(mrr: DataFrame, id_out: str, name_out: str, attr_in: str, attr_out: str,
                     batch_ts: str) -> DataFrame:
    ts = ntz(batch_ts)
    return mrr.select(
        F.col("id").alias(id_out),
        F.coalesce(strip_all(F.col("name")), F.lit("")).alias(name_out),
        F.col(attr_in).alias(attr_out),
        F.coalesce(upper_strip(F.col(attr_in)), F.lit("")).alias(f"{attr_out}_normalized"),
        ts.alias("valid_from"), ts.alias("loaded_at"))


def clean_customers(mrr: DataFrame, batch_ts: str) -> DataFrame:
    """stg_dim_customers rows: name stripped ('' for null), raw country kept,
    country_normalized = country.upper().strip()."""
    return _clean_dimension(mrr, "customer_id", "customer_name", "country", "country", batch_ts)


def clean_products(mrr: DataFrame, batch_ts: str) -> DataFrame:
    return _clean_dimension(mrr, "product_id", "product_name", "group_name", "product_group",
                            batch_ts)


def date_parts(t: Column) -> list[Column]:
    """The parts that staging derives from a sale's time (DOW 0 = Sunday)."""
    return [F.year(t).alias("transaction_year"), F.month(t).alias("transaction_month"),
            F.dayofmonth(t).alias("transaction_day"), F.quarter(t).alias("transaction_quarter"),
            day_of_week0(t).alias("day_of_week")]


def stage_sales(mrr: DataFrame, batch_ts: str, keep: Sequence[str] = ()) -> DataFrame:
    """stg_fact_sales rows: renamed columns and date parts; ``keep`` names
    columns that pass unchanged."""
    t = F.col("transaction_date")
    return mrr.select(
        F.col("id").alias("sale_id"), "customer_id", "product_id",
        F.col("qty").alias("quantity"), t.alias("transaction_date"),
        *date_parts(t), ntz(batch_ts).alias("loaded_at"), *keep)
