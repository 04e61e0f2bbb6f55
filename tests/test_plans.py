"""Plan checks: every registered query stays JVM-side, joins on keys, and
pushes its filters to the scans."""

import contextlib
import io

import pytest

from tests.conftest import SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"]


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def registry(spark):
    from tidewater.plans.queries import registry
    return registry()


def test_no_cross_joins_or_python_in_any_query(spark, registry):
    bad = {}
    for name, fn in registry.items():
        text = plan(fn(spark, SMALL))
        found = [op for op in FORBIDDEN if op in text]
        if found:
            bad[name] = found
    assert bad == {}


def test_report_prunes_partitions_and_broadcasts_checked_dims(spark, registry):
    text = plan(registry["sales_report"](spark, SMALL))
    assert "PartitionFilters: [isnotnull(month_key" in text
    assert "GreaterThanOrEqual(transaction_date,1998-01-01)" in text
    assert "EqualTo(is_current,true)" in text
    assert text.count("BroadcastExchange") >= 2 and "SortMergeJoin" not in text
    # only the needed fact columns are read
    assert "ReadSchema: struct<customer_key:bigint,product_key:bigint,quantity:int," \
           "transaction_date:date>" in text


def test_delta_extract_pushes_mark(spark, registry):
    text = plan(registry["delta_sales"](spark, SMALL))
    assert "GreaterThan(l_shipdate,1998-12-31T00:00)" in text


def test_broadcast_only_with_bound(spark):
    from tidewater.operators.joins import broadcast_if_small
    small, big = spark.range(10), spark.range(100)
    fact = spark.range(1000).withColumnRenamed("id", "k")
    hinted = plan(fact.join(broadcast_if_small(small, max_rows=50), fact.k == small.id), "extended")
    plain = plan(fact.join(broadcast_if_small(big, max_rows=50), fact.k == big.id), "extended")
    assert "strategy=broadcast" in hinted
    assert "strategy=broadcast" not in plain
    # a known bound skips the count
    assert "strategy=broadcast" in plan(
        fact.join(broadcast_if_small(big, known_rows=5, max_rows=50), fact.k == big.id), "extended")
