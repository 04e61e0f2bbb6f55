"""Two writers on one folder: nobody's work is lost, no id is given twice."""

import tempfile
import threading

import pytest

from tests.conftest import D, T, rows
from tests.test_pipeline import C0, CUST, PROD, sales
from tidewater.operators.runlog import RunLog
from tidewater.plans import pipeline as P
from tidewater.sources.commits import Conflict, claim, publish
from tidewater.sources.store import LayerStore
from tidewater.streaming.incremental import SALES_SCHEMA, StreamingMirror


def test_one_of_many_writers_creates_a_file(spark, tmp_path):
    for make in (lambda k: publish(spark, f"{tmp_path}/p/x", f"text {k}"), lambda k: claim(spark, f"{tmp_path}/c/x")):
        won = []
        threads = [threading.Thread(target=lambda k=k, make=make: won.append((make(k), k))) for k in range(12)]
        [t.start() for t in threads]
        [t.join() for t in threads]
        assert sum(w for w, _ in won) == 1
        if make.__code__.co_names[0] == "publish":
            assert (tmp_path / "p" / "x").read_text() == f"text {dict(won)[True]}"


def test_two_run_logs_share_their_ids(spark, tmp_path):
    one, two = RunLog(spark, str(tmp_path / "log")), RunLog(spark, str(tmp_path / "log"))
    ids = [log.start(f"p{k}") for k in range(3) for log in (one, two)]
    assert sorted(ids) == list(range(1, 7))
    for k, i in enumerate(ids):
        (one, two)[k % 2].end(i, "FAILED" if k == 0 else "SUCCESS")
    one.flush()
    two.flush()
    stored = {r["log_id"]: r["status"] for r in rows(RunLog(spark, str(tmp_path / "log")).stored())}
    assert stored == {i: "FAILED" if i == ids[0] else "SUCCESS" for i in ids}


def test_the_second_of_two_runs_starts_over(spark, tmp_path):
    root = str(tmp_path / "wh")
    prods = spark.createDataFrame([(10, "Widget", "Tools", C0, C0)], PROD)
    custs = spark.createDataFrame([(1, "Ann", "US", C0, C0)], CUST)

    def make(items, day):
        return lambda n: P.Run(n, D(day), f"{day} 06:00:00", {
            "customers": custs, "products": prods, "sales": sales(spark, items)})

    a, b = [(1, 1, 10, 5, "2024-01-10 00:00:00")], [(2, 1, 10, 6, "2024-02-10 00:00:00")]
    slow, fast = P.open_warehouse(spark, root), P.open_warehouse(spark, root)
    P.run_pipeline(fast, make(a, "2024-01-15")(1))
    with pytest.raises(Conflict):
        P.run_pipeline(slow, make(b, "2024-02-15")(1))
    wh = P.run_until_committed(spark, root, make(b, "2024-02-15"))
    assert sorted(wh.runs) == [1, 2]
    assert {r["original_sale_id"] for r in rows(P.open_warehouse(spark, root).table("dwh_fact_sales"))} == {1, 2}


def test_a_new_stream_checkpoint_loses_no_rows(spark):
    store = LayerStore(spark)
    landing, stamp = f"{store.root}/landing", T("2024-01-01 00:00:00")

    def arrive(name, ids, checkpoint):
        spark.createDataFrame([(i, 1, 1, i, stamp, stamp) for i in ids], SALES_SCHEMA).write.parquet(
            f"{landing}/{name}")
        mirror = StreamingMirror(spark, LayerStore(spark, store.root), "mirror", landing, checkpoint)
        mirror.run_available()
        return mirror.result().count()

    first, second = (tempfile.mkdtemp(prefix="ckpt-") for _ in range(2))
    assert arrive("a", range(100), first) == 100
    assert arrive("b", range(100, 150), second) == 150   # batch ids start again at 0
    assert arrive("c", range(150, 160), second) == 160
    assert arrive("d", range(160, 165), first) == 165    # the old checkpoint goes on as well
