"""Every registered query against its DuckDB oracle on the smallest data."""

import math

import duckdb
import pytest

from tests.conftest import SMALL
from tidewater.plans.oracle import queries_sql
from tidewater.plans.queries import registry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents"]


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 9)
        return v.isoformat() if hasattr(v, "isoformat") else v
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_oracle():
    import __spark_entry__ as entry
    assert set(registry()) == set(queries_sql())
    assert len(registry()) >= 50
    assert set(registry()) <= set(entry.queries()) and set(queries_sql()) <= set(entry.oracle_sql())


def test_entry_without_the_llm_subpackage(monkeypatch):
    import importlib.util

    import __spark_entry__ as entry
    found = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec",
                        lambda name, *a: None if ".llm" in name else found(name, *a))
    assert set(entry.queries()) == set(registry())
    assert set(entry.oracle_sql()) == set(queries_sql())


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["customer_name", "country", "product_group", "sales_month",
                          "total_quantity", "transaction_count", "unique_products",
                          "avg_quantity_per_transaction"]
    assert df.count() > 0


def test_queries_match_oracle(spark, duck):
    sqls = queries_sql()
    bad = []
    for name, fn in registry().items():
        df = fn(spark, SMALL)
        s_rows, s_cols = [tuple(r) for r in df.collect()], df.columns
        rel = duck.sql(sqls[name])
        o_cols, o_rows = rel.columns, rel.fetchall()
        if sorted(s_cols) != sorted(o_cols) or canon(s_rows, s_cols) != canon(o_rows, o_cols):
            bad.append(name)
    assert bad == []
