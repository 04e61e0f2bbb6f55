"""Nothing beyond the checked limit is broadcast, in sessions too that broadcast by file size."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import D, T
from tests.test_pipeline import PROD, sales
from tidewater.operators.joins import broadcast_if_small
from tidewater.operators.upsert import insert_if_absent, new_rows, upsert
from tidewater.plans.pipeline import Run, current_keys, new_warehouse, run_pipeline
from tidewater.plans.sql_functions import register_functions
from tidewater.sources.adapter import source_customers, source_sales
from tidewater.sources.store import LayerStore

LIMIT, BY_SIZE = "tidewater.broadcast.maxRows", "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def by_size(spark):
    """Spark's own default of what is broadcast, and a small limit."""
    before = spark.conf.get(BY_SIZE)
    spark.conf.set(BY_SIZE, "10m")
    spark.conf.set(LIMIT, "1")
    yield spark
    spark.conf.set(BY_SIZE, before)
    spark.conf.unset(LIMIT)


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_joins_beyond_the_limit_are_shuffled(by_size, tmp_path):
    a = stored(by_size.range(40).withColumn("v", F.lit("a")), tmp_path / "a")
    b = stored(by_size.range(20, 60).withColumn("v", F.lit("b")), tmp_path / "b")
    assert "BroadcastExchange" in planned(a.join(b, "id"))  # what Spark does by itself
    for df, n in ((a.join(broadcast_if_small(b.select("id")), "id", "left"), 40),
                  (upsert(a, b, ["id"]), 60), (new_rows(a, b, ["id"]), 20), (insert_if_absent(a, b, ["id"]), 60)):
        assert "BroadcastExchange" not in planned(df)
        assert df.count() == n
    assert "BroadcastExchange" in planned(upsert(a, b, ["id"], broadcast_batch=True))
    by_size.conf.set(LIMIT, "40")
    assert "BroadcastExchange" in planned(a.join(broadcast_if_small(b.select("id")), "id", "left"))


def test_sources_are_shuffled(by_size, tmp_path):
    at = T("1998-05-05 00:00:00")
    for name, schema, rows in (
            ("customer", "c_custkey long, c_name string, c_nationkey int", [(1, "a", 0), (2, "b", 0), (2, "b", 0)]),
            ("nation", "n_nationkey int, n_name string", [(0, "X")]),
            ("orders", "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz", [(1, 1, at), (2, None, at), (None, 2, at)]),
            ("lineitem", "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_shipdate timestamp_ntz",
             [(1, 1, 5, 2.0, at), (1, 1, 5, 3.0, at), (None, 2, 6, 1.0, at)])):
        by_size.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    sales, customers = source_sales(by_size, str(tmp_path), 2), source_customers(by_size, str(tmp_path), 2)
    assert "Broadcast" not in planned(sales) and sales.count() == 2
    assert planned(customers).count("BroadcastExchange") == 1  # the nation
    assert sorted((r.id, r.created_at) for r in customers.collect()) == [(1, at)] + [(2, at)] * 2


def test_a_run_broadcasts_nothing_beyond_the_limit(by_size, monkeypatch):
    """Tables as they are planned before a row has moved, and joins with what was stored."""
    plans, write = {}, LayerStore.write
    monkeypatch.setattr(LayerStore, "write", lambda self, name, df, **k: (
        plans.setdefault(name, planned(df)), write(self, name, df, **k))[1])
    c0 = T("2024-01-01 00:00:00")
    w = new_warehouse(by_size)
    named = stored(by_size.createDataFrame([(i, f"p{i}", "g", c0, c0) for i in range(30)], PROD), f"{w.store.root}/given")
    items = sales(by_size, [(100, 1, 2, 3, "2024-01-05 00:00:00"), (101, 1, 2, 6, "2024-01-06 00:00:00"),
                            (102, 99, 2, 6, "2024-01-07 00:00:00")])
    run_pipeline(w, Run(1, D("2024-02-01"), "2024-02-01 06:00:00", {
        "customers": named.withColumnRenamed("group_name", "country"), "products": named, "sales": items}))
    assert w.rows["mrr_dim_products"] == 30 and w.rows["dwh_fact_sales"] == 2
    for t in ("mrr_dim_products", "mrr_dim_customers"):
        assert "BroadcastExchange" not in plans[t], t
    keyed = w.table("stg_fact_sales").join(current_keys(w, "customers"), "customer_id", "left")
    assert "BroadcastExchange" not in planned(keyed)
    register_functions(w)
    keys = "(SELECT DISTINCT customer_id AS k FROM dwh_dim_customers UNION ALL SELECT -1)"
    got = by_size.sql(f"SELECT k, fn_avg_quantity_per_customer(k, DATE'2024-01-01', DATE'2024-12-31') AS q FROM {keys}")
    # facts and stored customers meet by a shuffle, whatever becomes of the list that they give
    assert "BroadcastHashJoin [customer_key" not in planned(got) and "SortMergeJoin [customer_key" in planned(got)
    assert {r.k: r.q for r in got.collect()} == {**dict.fromkeys(range(-1, 30), 0.0), 1: 4.5}
