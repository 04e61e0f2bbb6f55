from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import SMALL, with_clashes
from tidewater.llm import ann
from tidewater.llm.ann import Centroids, fit, search
from tidewater.llm.queries import op5_ann

VECS = "vec_id long, embedding array<float>"


def brute(rows, keep=5, every=50):
    data = [(i, np.array(v, dtype=float)) for i, v in rows if v is not None and len(v) and None not in v
            and np.isfinite(v).all() and np.any(np.array(v))]
    out = {}
    for i, v in data:
        if i % every == 0:
            s = [(-round(float((x * v).sum() / (np.sqrt((x * x).sum()) * np.sqrt((v * v).sum()))), 12), j)
                 for j, x in data if j != i]
            out[i] = [j for _, j in sorted(s)[:keep]]
    return out


def got(df):
    out: dict[int, list[int]] = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    return out


def test_small_tables_are_exact_with_ties_and_invalid_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=8).astype("float32").tolist()) for k in range(40)]
    rows += [(50, rows[3][1]), (51, rows[3][1]), (100, None), (101, [0.0] * 8), (102, [None] * 8),
             (103, [float("nan")] * 8), (104, [float("inf")] * 8), (150, [-0.0] * 8), (200, (np.array(rows[3][1]) * 2).tolist())]
    df = with_clashes(spark.createDataFrame(rows, VECS), "id", "vec", "list", "score")
    assert got(search(df, F.col("vec_id") % 50 == 0)) == brute(rows)


def test_a_hot_vector_keeps_its_smallest_ids(spark):
    rows = [(k, [1.0, 2.0, 3.0] if k % 3 == 0 else [float(k), 1.0, -1.0]) for k in range(600)]
    want = brute(rows)
    assert got(search(spark.createDataFrame(rows, VECS).repartition(4), F.col("vec_id") % 50 == 0)) == want


def test_vectors_of_each_length_are_searched(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP", 2)  # several groups a list
    rng = np.random.default_rng(9)
    rows = [(k, rng.normal(size=(8, 8, 2, 3)[k % 4]).astype("float32").tolist()) for k in range(400)]
    rows += [(450, [1.0] * 9), (500, rows[0][1] + [1.0]), (501, [2.0] * 9)]
    by_length: dict = {}
    for r in rows:
        by_length.setdefault(len(r[1]), []).append(r)
    want = {q: x for part in by_length.values() for q, x in brute(part).items()}
    assert len(want[450]) == 2 and {len(dict(rows)[q]) for q in want} == {8, 2, 9}
    have = got(search(spark.createDataFrame(rows, VECS), F.col("vec_id") % 50 == 0))
    assert {q: len(x) for q, x in have.items()} == {q: len(x) for q, x in want.items()}
    assert recall(want, have) >= 0.95


def test_fewer_candidates_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], VECS)
    assert got(search(df, F.col("vec_id") % 50 == 0)) == {0: [1]}
    assert search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_graph_finds_the_nearest_centroids():
    x = np.random.default_rng(2).normal(size=(900, 16))
    c = fit(x / np.linalg.norm(x, axis=1, keepdims=True), 120)
    hits = 0
    for v in x[:60] / np.linalg.norm(x[:60], axis=1, keepdims=True):
        best = set(np.argsort(-(c.centers @ v))[:10].tolist())
        hits += len(best & {k for _, k in c.search(v, 40)[:10]})
    assert hits >= 0.95 * 600 and isinstance(c, Centroids)


def test_recall_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want, have = brute(rows), got(op5_ann(spark, SMALL))
    assert sum(len(set(want[q]) & set(have[q])) for q in want) >= 0.9 * sum(map(len, want.values()))


def recall(want, have):
    return sum(len(set(want[q]) & set(have.get(q, []))) for q in want) / sum(map(len, want.values()))


def test_given_tables_are_searched_through_many_lists(spark, monkeypatch):
    made = []
    monkeypatch.setattr(ann, "fit", lambda sample, lists: made.append(lists) or fit(sample, lists))
    for sf, lists in (("sf0.001", 22), ("sf0.1", 45)):
        path = SMALL.replace("sf0.001", sf)
        rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()]
        want, have = brute(rows), got(op5_ann(spark, path))
        assert made.pop() == lists
        assert recall(want, have) >= 0.9 and {q: len(x) for q, x in want.items()} == {q: len(x) for q, x in have.items()}


def test_recall_over_tens_of_thousands_of_rows(spark):
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(300, 24))[rng.integers(0, 300, 20_000)] + 0.5 * rng.normal(size=(20_000, 24))).astype("float32")
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    have = got(search(spark.createDataFrame(rows, VECS).repartition(8), F.col("vec_id") % 500 == 0))
    assert recall(brute(rows, every=500), have) >= 0.9


def test_probes_widen_until_there_are_enough_rows():
    x = np.random.default_rng(3).normal(size=(400, 8))
    c = fit(x / np.linalg.norm(x, axis=1, keepdims=True), 40)
    order = np.argsort(-(c.centers @ c.centers[0])).tolist()
    rows = np.zeros(40, dtype=np.int64)
    rows[order[-2:]] = 24
    assert order[-2] in c.probes_of(c.centers[0], rows, 24) and order[-1] not in c.probes_of(c.centers[0], rows, 24)
    assert len(c.probes_of(c.centers[0], rows + 24, 24)) >= ann.LEAST
