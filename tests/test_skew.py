"""One customer, product and day hold a third of all rows: results stay exact
and the plans combine the hot key map-side before any shuffle."""

import contextlib
import io
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import D
from tidewater.operators.upsert import latest_per_key
from tidewater.plans import metrics as M
from tidewater.plans.pipeline import fact_layout

N = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    fact = spark.range(N).select(
        (F.col("id") + 1).alias("sale_key"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).cast("long").alias("customer_key"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7 + 2).cast("long").alias("product_key"),
        (F.col("id") % 5 + 1).cast("int").alias("quantity"),
        F.when(F.col("id") % 3 == 0, F.lit(D("2024-01-01")))
        .otherwise(F.date_add(F.lit(D("2024-01-01")), (F.col("id") % 90).cast("int")))
        .alias("transaction_date"),
        (F.col("id") + 1).alias("original_sale_id"))
    cust = spark.range(1, 52).select(
        F.col("id").alias("customer_key"), F.col("id").alias("customer_id"),
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_name"),
        F.lit("X").alias("country"), F.lit(True).alias("is_current"))
    return fact, cust


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_hot_customer_metrics_exact(skewed):
    fact, cust = skewed
    rows = fact.collect()
    qty, n, prods = defaultdict(int), defaultdict(int), defaultdict(set)
    for r in rows:
        qty[r["customer_key"]] += r["quantity"]
        n[r["customer_key"]] += 1
        prods[r["customer_key"]].add(r["product_key"])
    got = {r["customer_key"]: r for r in M.customer_metrics(fact, cust).collect()}
    assert n[1] == N // 3
    for k in qty:
        assert got[k]["total_quantity_purchased"] == qty[k]
        assert got[k]["total_transactions"] == n[k]
        assert got[k]["unique_products_purchased"] == len(prods[k])
    top = M.top_customers(fact, cust, n=1).collect()
    assert top[0]["customer_id"] == 1


def test_partial_aggregation_before_shuffle(skewed):
    fact, cust = skewed
    text = plan(M.customer_metrics(fact, cust))
    # the per-customer sums and counts are computed map-side (partial) first
    assert "partial_sum(quantity" in text and "partial_count(1)" in text


def test_hot_id_latest_row(spark):
    batch = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).cast("long").alias("id"),
        F.date_add(F.lit(D("2024-01-01")), (F.col("id") % 400).cast("int")).alias("d"),
        F.col("id").alias("v"))
    latest = {r["id"]: r for r in latest_per_key(batch, ["id"], ["d", "v"]).collect()}
    hot = max((r for r in batch.collect() if r["id"] == 7), key=lambda r: (r["d"], r["v"]))
    assert latest[7]["v"] == hot["v"] and len(latest) == N - N // 3 + 1
    assert "partial_max" in plan(latest_per_key(batch, ["id"], ["d", "v"]))


def test_hot_month_layout(spark, skewed):
    fact, _ = skewed
    out = fact_layout(fact)
    assert out.count() == N
    assert "month_key" in out.columns
    assert out.filter("month_key = 202401").count() >= N // 3
