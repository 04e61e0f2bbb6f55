from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import T, rows
from tidewater.operators.upsert import (insert_if_absent, latest_per_key, update_matched,
                                        upsert)

SCHEMA = "id long, v string, ts timestamp_ntz"


def test_latest_per_key_repeated_key(spark):
    batch = spark.createDataFrame([
        (1, "a", T("2024-01-01 00:00:00")), (1, "b", T("2024-01-02 00:00:00")),
        (2, "x", T("2024-01-01 00:00:00")), (2, "y", T("2024-01-01 00:00:00")),
    ], SCHEMA)
    got = rows(latest_per_key(batch, ["id"], ["ts"]), "id")
    # later time wins; an exact tie is broken by the remaining columns
    assert [(r["id"], r["v"]) for r in got] == [(1, "b"), (2, "y")]


def test_upsert_all_columns_and_replay(spark):
    target = spark.createDataFrame([(1, "old", T("2024-01-01 00:00:00")),
                                    (2, "keep", T("2024-01-01 00:00:00"))], SCHEMA)
    batch = spark.createDataFrame([(1, "new", T("2024-02-01 00:00:00")),
                                   (3, "ins", T("2024-02-01 00:00:00"))], SCHEMA)
    once = upsert(target, batch, ["id"])
    twice = upsert(once, batch, ["id"])
    expect = [(1, "new"), (2, "keep"), (3, "ins")]
    assert [(r["id"], r["v"]) for r in rows(once, "id")] == expect
    assert rows(twice, "id") == rows(once, "id")


def test_upsert_partial_keeps_unlisted_columns(spark):
    schema = "id long, qty int, customer string, first_seen string"
    target = spark.createDataFrame([(1, 5, "c1", "run1")], schema)
    batch = spark.createDataFrame([(1, 9, "c2", "run2"), (2, 1, "c3", "run2")], schema)
    got = rows(upsert(target, batch, ["id"], update_cols=["qty"]), "id")
    assert got == [dict(id=1, qty=9, customer="c1", first_seen="run1"),
                   dict(id=2, qty=1, customer="c3", first_seen="run2")]
    # a null in the batch is a value, not "missing"
    nul = spark.createDataFrame([(1, None, "c9", "x")], schema)
    assert rows(upsert(target, nul, ["id"], update_cols=["qty"]))[0]["qty"] is None


def test_update_matched_and_insert_if_absent(spark):
    schema = "id long, qty int, key long"
    target = spark.createDataFrame([(1, 5, 100), (2, 6, 200)], schema)
    batch = spark.createDataFrame([(1, 50, 999), (3, 7, 300)], schema)
    upd = rows(update_matched(target, batch, ["id"], ["qty"]), "id")
    assert upd == [dict(id=1, qty=50, key=100), dict(id=2, qty=6, key=200)]
    ins = rows(insert_if_absent(target, batch, ["id"]), "id")
    assert ins == [dict(id=1, qty=5, key=100), dict(id=2, qty=6, key=200),
                   dict(id=3, qty=7, key=300)]


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.integers(0, 5), st.integers(0, 3), max_size=6),
       st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), max_size=12))
def test_upsert_replay_is_idempotent(spark, old, new):
    t = spark.createDataFrame(sorted(old.items()), "id long, v long")
    b = spark.createDataFrame(new, "id long, v long")
    once = upsert(t, b, ["id"], order_cols=["v"])
    again = upsert(once, b, ["id"], order_cols=["v"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))
    want = dict(old)
    latest: dict[int, int] = {}
    for k, v in new:
        latest[k] = max(v, latest.get(k, v))
    want.update(latest)  # the batch's latest row replaces the target row
    assert dict(map(tuple, once.collect())) == want
