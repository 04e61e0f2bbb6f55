from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.helpers import SMALL, with_clashes
from tidewater.llm.whitening import Wide, eigen, product, whiten

SCHEMA = "vec_id long, embedding array<double>"


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def brute(rows):
    """vec_id -> (deviation, {component: whitened}), n, explained; one length."""
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in rows}
    n, d = len(x), len(next(iter(x.values())))
    s = [sum(v[k] for v in x.values()) for k in range(d)]
    cov = np.array([[float(sum(Fraction((n * v[a] - s[a]) * (n * v[b] - s[b]), n * n) for v in x.values()) / n)
                     for b in range(d)] for a in range(d)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    dev = {i: sum((n * c - t) ** 2 for c, t in zip(v, s, strict=True)) for i, v in x.items()}
    z = {i: np.array([float(Fraction(n * c - t, n)) for c, t in zip(v, s, strict=True)]) @ u / np.sqrt(e)
         for i, v in x.items()}
    return n, dev, z, e / e.sum()


def residual(a, values, x):
    a, x = a.astype(Wide), x.astype(Wide)
    return float(np.abs(a @ x - x * values.astype(Wide)).max()), float(np.abs(x.T @ x - np.eye(len(a))).max())


@pytest.mark.parametrize("values", [
    np.linspace(1, 50, 48), np.r_[np.full(10, 3.0), np.full(10, 3.0 + 1e-9), np.linspace(5, 9, 20)],
    np.r_[np.full(5, 2.0), 2.0 + 1e-12 * np.arange(5), 1e6, 1e-3], np.r_[np.zeros(6), np.full(6, 7.0)],
    np.r_[1.0 + 1e-7 * np.arange(12), 4.0]])
def test_eigenvectors_to_double_precision(values):
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    q = q.astype(Wide)
    for _ in range(2):  # orthogonal beyond double precision
        q = q + q @ (np.eye(len(values)) - q.T @ q) / 2
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, x = eigen(a)
    off, skew = residual(a, got, x)
    assert off < 2e-15 * values.max() and skew < 2e-15
    assert np.abs(got - np.sort(values)[::-1]).max() < 2e-15 * values.max()
    # a vector whose eigenvalue stands alone is right to double precision
    order = np.argsort(-values, kind="stable")
    for k, i in enumerate(order):
        gap = np.abs(np.delete(values, i) - values[i]).min()
        if gap > 1e-10 * values.max():
            miss = 1 - abs(float(x[:, k].astype(Wide) @ q[:, i]))
            assert miss < 1e-13


def test_close_values_are_told_apart_better_than_in_double():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(16, 16)))
    q = q.astype(Wide)
    q = q + q @ (np.eye(16) - q.T @ q) / 2
    values = 1 + 1e-9 * np.arange(16)
    a = (q * values.astype(Wide)) @ q.T
    _, x = eigen((a + a.T) / 2)
    # double precision leaves 1e-16 / 1e-9; the refined vectors have twice the digits
    assert np.abs(np.abs(x[:, ::-1]) - np.abs(q)).max() < 1e-9


def test_products_are_exact():
    rng = np.random.default_rng(2)
    for top in (10, 1 << 22, 1 << 30, 1 << 44):
        x = rng.integers(-top, top, (50, 4))
        want = [[sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j], strict=True)) for j in range(4)]
                for i in range(4)]
        assert product(x, x).tolist() == want


def test_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    mix = rng.normal(size=(6, 6))
    rows = [(i, (rng.normal(size=6) @ mix).tolist()) for i in range(400)]
    n, dev, z, explained = brute(rows)
    bad = [(1000, None), (1001, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (1002, [float("nan")] * 6), (1003, []),
           (1004, [float("inf")] + [0.0] * 5)]
    got = whiten(with_clashes(frame(spark, rows + bad), "n", "component", "whitened", "d")).collect()
    assert len(got) == 400 * 6
    sign = {}
    for r in got:
        assert r["n"] == n and r["deviation"] == dev[r["vec_id"]]
        k = r["component"] - 1
        want = z[r["vec_id"]][k]
        sign.setdefault(k, 1 if abs(r["whitened"] - want) < 1e-6 else -1)
        assert abs(r["whitened"] - sign[k] * want) < 1e-9
        assert abs(r["explained"] / explained[k] - 1) < 1e-9 and 0 <= r["identity_error"] < 1e-9


def test_lengths_repeats_ties_and_flat_dimensions(spark):
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [-2.0, 1.0]), (2, [7.0]), (3, [1.0, 2.0, 3.0]),
            (4, [1.0, 2.0, 3.0])]
    got = whiten(frame(spark, rows)).collect()
    assert sorted((r["vec_id"] or -1, r["component"], r["n"]) for r in got) == sorted(
        [(1, 1, 3), (1, 2, 3)] * 2 + [(-1, 1, 3), (-1, 2, 3), (2, 1, 1)]
        + [(i, k, 2) for i in (3, 4) for k in (1, 2, 3)])
    for r in got:
        flat = r["n"] != 3 or r["component"] == 2
        assert (r["whitened"] == 0 and r["explained"] == 0) if flat else abs(abs(r["whitened"]) - (
            math.sqrt(2) if r["vec_id"] is None else math.sqrt(0.5))) < 1e-12
        assert r["identity_error"] < 1e-12
    assert whiten(frame(spark, [])).count() == 0
    assert whiten(frame(spark, [(1, None)])).count() == 0


def test_large_entries_stay_exact_and_larger_ones_are_refused(spark):
    rows = [(i, [float(i) * 2 ** 20, 1.0 + i]) for i in range(5)]
    n, dev, _, _ = brute(rows)
    assert {r["vec_id"]: r["deviation"] for r in whiten(frame(spark, rows)).collect()} == dev
    with pytest.raises(Exception, match="no exact integer form"):
        whiten(frame(spark, [(1, [1e300, 0.0]), (2, [0.0, 1.0])])).collect()


def test_given_table(spark):
    from tidewater.llm.queries import op12_whitening
    got = op12_whitening(spark, SMALL)
    n = spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
    assert got.count() == n * 32
    w = np.array([r["whitened"] for r in got.orderBy("vec_id", "component").collect()]).reshape(n, 32)
    cov = (w - w.mean(0)).T @ (w - w.mean(0)) / n
    assert np.abs(cov - np.eye(32)).max() < 1e-10
