from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def rows(df, *order):
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]
