"""Invariants of the warehouse the two-run scenario builds."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SMALL


@pytest.fixture(scope="module")
def wh(spark):
    from tidewater.plans.scenario import warehouse
    return warehouse(spark, SMALL)


@pytest.mark.parametrize("dim,nk,key", [("dwh_dim_customers", "customer_id", "customer_key"),
                                        ("dwh_dim_products", "product_id", "product_key")])
def test_dimension_invariants(wh, dim, nk, key):
    d = wh.table(dim)
    # one current version per natural key, unique surrogate keys
    assert d.filter("is_current").groupBy(nk).count().filter("count > 1").count() == 0
    assert d.groupBy(key).count().filter("count > 1").count() == 0
    # versions of one key do not overlap and follow each other
    w = Window.partitionBy(nk).orderBy("valid_from", key)
    gaps = d.withColumn("next_from", F.lead("valid_from").over(w)).filter(
        F.col("next_from").isNotNull() & (F.col("next_from") != F.col("valid_to")))
    assert gaps.count() == 0
    # keys never change: every run-1 row keeps its key and natural key
    old = wh.table(dim, 1).select(key, nk)
    assert old.join(d.select(key, nk), [key, nk], "left_anti").count() == 0


def test_fact_invariants(wh):
    f = wh.table("dwh_fact_sales")
    assert f.groupBy("original_sale_id").count().filter("count > 1").count() == 0
    assert f.groupBy("sale_key").count().filter("count > 1").count() == 0
    assert f.select(F.min("sale_key"), F.max("sale_key")).first() == (1, f.count())
    # run 2 skips nothing, so every staged quantity reaches the fact
    stg = wh.table("stg_fact_sales").agg(F.sum("quantity")).first()[0]
    assert f.agg(F.sum("quantity")).first()[0] == stg
    # facts of run 1 keep their keys and dates
    f1 = wh.table("dwh_fact_sales", 1).select("sale_key", "customer_key", "product_key",
                                               "transaction_date")
    assert f1.join(f, ["sale_key", "customer_key", "product_key", "transaction_date"],
                   "left_anti").count() == 0


def test_mirror_matches_latest_source(wh, spark):
    from tidewater.sources.adapter import source_sales
    m = wh.table("mrr_fact_sales")
    assert m.groupBy("id").count().filter("count > 1").count() == 0
    assert m.count() <= source_sales(spark, SMALL, 2).select("id").distinct().count()
