"""Operators that SQL expresses, against DuckDB on the given tables."""

from __future__ import annotations

import duckdb
import pytest

from tests.llm.helpers import SMALL
from tidewater.llm.oracle import queries_sql
from tidewater.llm.queries import registry


@pytest.mark.parametrize("name", sorted(queries_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = registry()[name](spark, SMALL)
    want = con.execute(queries_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.select(names).collect()), key=key) == sorted(want.fetchall(), key=key)


def test_one_query_per_operator():
    names = list(registry())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names
