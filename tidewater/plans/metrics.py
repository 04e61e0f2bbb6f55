"""Sales metrics over the star schema.

The reference's scalar functions (one customer, product or group per call)
become grouped DataFrames over all of them; the scalar form is a filter on
the result (:func:`scalar`).  ``COUNT(DISTINCT sale_key)`` is ``count(*)``
because a sale key is unique and every join goes to a dimension key.  Where
a metric allows it, facts are aggregated by dimension key before the join to
the (size-checked) dimension, so the shuffle carries groups, not rows, and a
hot customer is collapsed by the map-side partial aggregate; the sales report
and the point-in-time join still join fact rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater import config as C
from tidewater.functions import month_start, round_half_away_ratio, round_half_up_ratio
from tidewater.operators.joins import as_of_join, broadcast_if_small, max_broadcast_rows


def _optional_range(df: DataFrame, col: str, start: dt.date | None,
                    end: dt.date | None) -> DataFrame:
    """``(p IS NULL OR x >= p) AND (q IS NULL OR x <= q)``: add only given bounds."""
    if start is not None:
        df = df.filter(F.col(col) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(col) <= F.lit(end))
    return df


def current(dim: DataFrame, *cols: str, known_rows: int | None = None) -> DataFrame:
    return broadcast_if_small(dim.filter(F.col("is_current")).select(*cols), known_rows)


def sales_report(fact: DataFrame, customers: DataFrame, products: DataFrame,
                 start: dt.date = C.REPORT_START, end: dt.date = C.REPORT_END,
                 rows_c: int | None = None, rows_p: int | None = None) -> DataFrame:
    """Monthly sales by customer name, country and product group (both ends
    of the period included), current dimension versions only."""
    f = fact.filter(F.col("transaction_date").between(F.lit(start), F.lit(end))).select(
        "customer_key", "product_key", month_start(F.col("transaction_date")).alias("sales_month"),
        F.col("quantity").alias("_q"), F.lit(1).alias("_n"))
    limit = max_broadcast_rows(fact)
    if not all(n is not None and n <= limit for n in (rows_c, rows_p)):
        # a dimension may be shuffled: reduce the fact first, so that the join
        # moves one row per customer, product and month instead of raw sales
        f = f.groupBy("customer_key", "product_key", "sales_month").agg(
            F.sum("_q").alias("_q"), F.sum("_n").alias("_n"))
    j = (f.join(current(customers, "customer_key", "customer_name", "country", known_rows=rows_c),
                "customer_key")
         .join(current(products, "product_key", "product_group", known_rows=rows_p),
               "product_key"))
    g = j.groupBy("customer_name", "country", "product_group", "sales_month").agg(
        F.sum("_q").alias("total_quantity"),
        F.sum("_n").cast("long").alias("transaction_count"),
        F.countDistinct("product_key").alias("unique_products"))
    return (g.withColumn("avg_quantity_per_transaction",
                         round_half_up_ratio(F.col("total_quantity"), F.col("transaction_count")))
            .orderBy("sales_month", "customer_name", "product_group"))


def _per_customer(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("quantity").alias("_q"),
        F.countDistinct("product_key").alias("_p"),
        F.min("transaction_date").alias("_first"), F.max("transaction_date").alias("_last"))


def customer_metrics(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Per current customer; customers without sales get 0 counts and null
    sums, dates and averages (left join)."""
    cur = customers.filter(F.col("is_current")).select(
        "customer_key", "customer_id", "customer_name", "country")
    j = cur.join(_per_customer(fact), "customer_key", "left")
    return j.select(
        "customer_key", "customer_id", "customer_name", "country",
        F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("total_transactions"),
        F.col("_q").alias("total_quantity_purchased"),
        F.coalesce(F.col("_p"), F.lit(0)).cast("long").alias("unique_products_purchased"),
        F.col("_first").alias("first_purchase_date"),
        F.col("_last").alias("last_purchase_date"),
        round_half_up_ratio(F.col("_q"), F.col("_n")).alias("avg_quantity_per_transaction"))


def _customer_sales(fact: DataFrame, customers: DataFrame, start=None, end=None) -> DataFrame:
    """Per current customer id: count and sum of its (optionally dated) sales,
    left-joined so every current customer has a row."""
    per = _optional_range(fact, "transaction_date", start, end).groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("quantity").alias("_q"),
        F.max("transaction_date").alias("_last"))
    cur = customers.filter(F.col("is_current")).select("customer_key", "customer_id")
    return cur.join(per, "customer_key", "left")


def avg_quantity(fact: DataFrame, customers: DataFrame, start: dt.date | None = None,
                 end: dt.date | None = None) -> DataFrame:
    """COALESCE(ROUND(AVG(quantity), 2), 0) per current customer."""
    j = _customer_sales(fact, customers, start, end)
    return j.select("customer_id", F.coalesce(round_half_up_ratio(F.col("_q"), F.col("_n")),
                                              F.lit(0.0)).alias("avg_quantity"))


def lifetime_quantity(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """COALESCE(SUM(quantity), 0) per current customer."""
    j = _customer_sales(fact, customers)
    return j.select("customer_id", F.coalesce(F.col("_q"), F.lit(0)).cast("long")
                    .alias("lifetime_quantity"))


def recency(fact: DataFrame, customers: DataFrame, as_of: dt.date = C.AS_OF_DAY) -> DataFrame:
    """Days since the last sale; null for a customer without sales."""
    j = _customer_sales(fact, customers)
    return j.select("customer_id", F.datediff(F.lit(as_of), F.col("_last"))
                    .alias("days_since_last_purchase"))


def velocity(fact: DataFrame, products: DataFrame, days: int = C.VELOCITY_DAYS,
             as_of: dt.date = C.AS_OF_DAY) -> DataFrame:
    """Quantity since ``as_of - days`` (inclusive, no upper bound) / days,
    rounded to 2; 0 for a product without such sales."""
    if days <= 0:
        raise ValueError("days must be positive")
    since = as_of - dt.timedelta(days=days)
    per = (fact.filter(F.col("transaction_date") >= F.lit(since))
           .groupBy("product_key").agg(F.sum("quantity").alias("_q")))
    cur = products.filter(F.col("is_current")).select("product_key", "product_id")
    j = cur.join(per, "product_key", "left")
    return j.select("product_id", F.coalesce(round_half_up_ratio(F.col("_q"), F.lit(days)),
                                             F.lit(0.0)).alias("velocity"))


def group_performance(fact: DataFrame, products: DataFrame, start: dt.date | None = None,
                      end: dt.date | None = None, rows_p: int | None = None) -> DataFrame:
    """Per product group of the current products: the eight fields of the
    reference's JSON object, as typed columns.  Unset dates default to the
    first and last sale found; a group without sales gets zeros."""
    cur = products.filter(F.col("is_current")).select("product_key", "product_group")
    f = _optional_range(fact, "transaction_date", start, end)
    # the fact is reduced to (product, customer) before any join; the two
    # distinct counts are then counts of groups, one aggregate each
    pairs = f.groupBy("product_key", "customer_key").agg(
        F.sum("quantity").alias("_q"), F.count(F.lit(1)).alias("_n"),
        F.min("transaction_date").alias("_min"), F.max("transaction_date").alias("_max"))
    totals = [F.sum("_q").alias("_q"), F.sum("_n").alias("_n"),
              F.min("_min").alias("_min"), F.max("_max").alias("_max")]
    j = pairs.join(broadcast_if_small(cur, rows_p), "product_key")
    agg = (j.groupBy("product_group", "customer_key").agg(*totals).groupBy("product_group")
           .agg(*totals, F.count("customer_key").alias("_c")))
    sold = (j.groupBy("product_group", "product_key").agg(F.lit(1).alias("_one"))
            .groupBy("product_group").agg(F.count("product_key").alias("_p")))
    groups = cur.select("product_group").distinct()
    r = groups.join(agg.join(sold, "product_group"), "product_group", "left")
    return r.select(
        "product_group",
        F.coalesce(F.col("_q"), F.lit(0)).cast("long").alias("total_quantity"),
        F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("total_transactions"),
        F.coalesce(F.col("_c"), F.lit(0)).cast("long").alias("unique_customers"),
        F.coalesce(F.col("_p"), F.lit(0)).cast("long").alias("unique_products"),
        F.coalesce(round_half_up_ratio(F.col("_q"), F.col("_n")), F.lit(0.0))
        .alias("avg_quantity_per_transaction"),
        (F.lit(start) if start else F.col("_min")).alias("start_date"),
        (F.lit(end) if end else F.col("_max")).alias("end_date"))


def group_performance_json(perf: DataFrame) -> DataFrame:
    """The reference's JSONB object per group (``jsonb_build_object``)."""
    fields = ["product_group", "total_quantity", "total_transactions", "unique_customers",
              "unique_products", "avg_quantity_per_transaction", "start_date", "end_date"]
    return perf.select("product_group", F.to_json(
        F.struct(*fields), {"ignoreNullFields": "false"}).alias("performance"))


def mom_growth(fact: DataFrame) -> DataFrame:
    """Month-over-month growth % of quantity for every month from the first to
    the last month with sales.  A missing month counts as 0; growth is null
    when the previous month is 0.  The previous month is looked up by date (not
    ``lag``, which would jump gaps)."""
    monthly = fact.groupBy(month_start(F.col("transaction_date")).alias("m")).agg(
        F.sum("quantity").alias("q"))
    # one row with all months: bounded by the calendar, one pass over the fact
    all_months = monthly.agg(
        F.min("m").alias("lo"), F.max("m").alias("hi"),
        F.map_from_entries(F.collect_list(F.struct("m", "q"))).alias("by_month"))
    j = all_months.select("by_month", F.explode(
        F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("m"))
    cur_q = F.coalesce(F.try_element_at("by_month", F.col("m")), F.lit(0)).cast("long")
    prev_q = F.coalesce(F.try_element_at("by_month", F.add_months("m", -1)), F.lit(0)).cast("long")
    return j.select(F.year("m").alias("year"), F.month("m").alias("month"),
                    cur_q.alias("current_quantity"), prev_q.alias("previous_quantity"),
                    round_half_away_ratio(cur_q - prev_q, prev_q, 2, factor=100)
                    .alias("growth_pct"))


def top_customers(fact: DataFrame, customers: DataFrame, n: int = C.TOP_N,
                  start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Top n current customers by quantity; ties by customer_id (the
    reference leaves ties open).  ``orderBy + limit`` plans as a top-k per
    partition (TakeOrderedAndProject), never a full sort."""
    per = _optional_range(fact, "transaction_date", start, end).groupBy("customer_key").agg(
        F.sum("quantity").alias("_q"), F.count(F.lit(1)).alias("_n"))
    cur = customers.filter(F.col("is_current")).select("customer_key", "customer_id",
                                                       "customer_name", "country")
    j = per.join(cur, "customer_key")
    g = j.groupBy("customer_id", "customer_name", "country").agg(
        F.sum("_q").alias("total_quantity"), F.sum("_n").alias("total_transactions"))
    return (g.withColumn("avg_quantity_per_transaction",
                         round_half_up_ratio(F.col("total_quantity"), F.col("total_transactions")))
            .orderBy(F.desc("total_quantity"), F.asc("customer_id")).limit(n))


def monthly_group_sales(fact: DataFrame, products: DataFrame,
                        rows_p: int | None = None) -> DataFrame:
    """Year, month, product group (of the version each sale points to), sum."""
    per = fact.groupBy(F.year("transaction_date").alias("year"),
                       F.month("transaction_date").alias("month"), "product_key").agg(
        F.sum("quantity").alias("_q"))
    dim = broadcast_if_small(products.select("product_key", "product_group"), rows_p)
    return (per.join(dim, "product_key").groupBy("year", "month", "product_group")
            .agg(F.sum("_q").alias("total_quantity")))


def product_months(fact: DataFrame, cluster: Sequence[str] = ()) -> DataFrame:
    """Sums per product version and day's month: the rollup that runs keep.
    ``cluster`` names columns, functions of the product, by which (and the
    month) the rows lie together already."""
    return fact.groupBy("month_key", *cluster, "product_key").agg(
        F.sum("quantity").alias("total_quantity"), F.count(F.lit(1)).alias("transaction_count"))


def monthly_group_sales_of(rollup: DataFrame, products: DataFrame, rows_p: int | None = None) -> DataFrame:
    """:func:`monthly_group_sales` from the stored rollup."""
    dim = broadcast_if_small(products.select("product_key", "product_group"), rows_p)
    return (rollup.join(dim, "product_key")
            .groupBy(F.expr("cast(month_key div 100 as int)").alias("year"),
                     F.expr("cast(month_key % 100 as int)").alias("month"), "product_group")
            .agg(F.sum("total_quantity").alias("total_quantity")))


def top_groups(sales: DataFrame, products: DataFrame, n: int = C.TOP_GROUPS) -> DataFrame:
    """Source-side top groups by number of sales (seed summary)."""
    per = sales.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n"),
                                          F.sum("qty").alias("_q"))
    j = per.join(products.select(F.col("id").alias("product_id"), "group_name"), "product_id")
    return (j.groupBy("group_name").agg(F.sum("_n").alias("sales_count"),
                                        F.sum("_q").alias("total_quantity"))
            .orderBy(F.desc("sales_count"), "group_name").limit(n))


def source_profile(customers: DataFrame, products: DataFrame, sales: DataFrame) -> DataFrame:
    """Row counts per source table and the sale date range."""
    c = customers.agg(F.count(F.lit(1)).alias("customers"))
    p = products.agg(F.count(F.lit(1)).alias("products"))
    s = sales.agg(F.count(F.lit(1)).alias("sales"),
                  F.to_date(F.min("transaction_date")).alias("earliest"),
                  F.to_date(F.max("transaction_date")).alias("latest"))
    return one_row([c, p, s])


def one_row(frames: list[DataFrame]) -> DataFrame:
    """Side by side one-row aggregates with distinct column names, without a
    join: union them (missing columns null) and take the non-null value."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


def current_counts(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    f = fact.agg(F.count(F.lit(1)).alias("fact_rows"))
    c = customers.filter(F.col("is_current")).agg(F.count(F.lit(1)).alias("current_customers"))
    p = products.filter(F.col("is_current")).agg(F.count(F.lit(1)).alias("current_products"))
    return one_row([f, c, p])


def point_in_time_sales(fact: DataFrame, customers: DataFrame,
                        rows_c: int | None = None) -> DataFrame:
    """Sales by the customer's country *on the sale date* (the version valid
    then), by year: the corrected form of the current-version metrics."""
    # one row per customer version and day before any join; the versions valid
    # for a customer are looked up by the key that the facts already carry
    per = fact.groupBy("customer_key", "transaction_date").agg(
        F.sum("quantity").alias("_q"), F.count(F.lit(1)).alias("_n"))
    ids = broadcast_if_small(customers.select("customer_key", "customer_id"), rows_c)
    versions = customers.select("customer_id", "country", "valid_from", "valid_to").join(ids, "customer_id")
    j = as_of_join(per, versions.drop("customer_id"), "customer_key", "transaction_date", versions_rows=rows_c)
    return j.groupBy(F.col("v.country").alias("country_at_sale"),
                     F.year(F.col("f.transaction_date")).alias("sales_year")).agg(
        F.sum(F.col("f._q")).alias("total_quantity"),
        F.sum(F.col("f._n")).alias("transaction_count"))


def weekend_quantity(fact: DataFrame, calendar: DataFrame,
                     rows_cal: int | None = None) -> DataFrame:
    """Quantity on weekend and weekday dates through the calendar dimension."""
    per = fact.groupBy("date_key").agg(F.sum("quantity").alias("_q"),
                                       F.count(F.lit(1)).alias("_n"))
    cal = broadcast_if_small(calendar.select("date_key", "is_weekend"), rows_cal)
    return (per.join(cal, "date_key").groupBy("is_weekend")
            .agg(F.sum("_q").alias("total_quantity"), F.sum("_n").alias("transaction_count")))


def scalar(result: DataFrame, key: str, value) -> DataFrame:
    """Scalar form of a grouped metric: the row for one key (may be empty)."""
    return result.filter(F.col(key) == F.lit(value))


