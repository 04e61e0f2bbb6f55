"""Embedding whitening: float32 eigenvectors refined in higher precision.

An entry c of a vector becomes the integer x = floor(64 * c) + 1000000.  Three
passes read the vectors, each in ``mapInArrow`` blocks whose sums Spark adds up:

1. rows and sums per dimension (exact);
2. products of the entries less their rounded means.  The centred entries are
   integers, and their products are summed exactly, so neither the order of the
   rows nor a lost executor changes a digit.  The part of the mean that rounding
   left over is taken off exactly afterwards;
3. products of the whitened components, which give ``identity_error``.

The driver gets the d * (d + 1) / 2 entries of the covariance, whatever the
number of rows.  Its eigenvectors are found in float32 and then corrected by the
matrix products of Ogita and Aishima in extended precision, until a step
changes nothing more.  Eigenvalues nearer to each other than the correction can
tell apart form a cluster; the matrix is restricted to the span of its vectors,
shifted by their mean, solved there, and the vectors are turned accordingly
before the correction goes on.

Vectors of each length are a fit list of their own, with its own n.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
entries are dropped; repeated rows and ids count and stay as often as they
occur; a null id stays; an empty table gives no rows.  A component without
variance (one vector, equal vectors, a constant or dependent dimension) has
``whitened`` 0 and takes no part in ``identity_error``, which is 0 where no
component has any.  Equal eigenvalues have no order of their own; any
orthonormal basis of their space is right.  The sign makes a component's
largest entry positive.  Entries beyond 2 ** 46 in size, and a ``deviation``
beyond a long, cannot be held exactly and raise an error.  Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ship

SCALE, OFFSET = 64, 1_000_000
#: Entries above this have no exact integer form here.
LARGEST = float(1 << 46)
#: Rows whose products are summed at once.
BLOCK = 4096
#: Components returned.
COMPONENTS = 32
#: Corrections at most; each squares the error, so a handful are needed.
STEPS = 30

Wide = np.longdouble


def vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x-vectors as a matrix of long) of each length, for the rows
    of a batch whose second column is a vector that takes part."""
    column = batch.column(1)
    lists = np.flatnonzero(~np.asarray(column.is_null()))
    if not len(lists):
        return
    offsets = np.asarray(column.offsets).astype(np.int64)
    lengths = np.diff(offsets)
    flat = column.values.cast(pa.float64())
    bad = np.asarray(flat.is_null())
    values = flat.to_numpy(zero_copy_only=False)
    bad = bad | ~np.isfinite(values)
    for d in np.unique(lengths[lists]).tolist():
        rows = lists[lengths[lists] == d]
        if not d:
            continue
        at = offsets[rows][:, None] + np.arange(d)
        rows, at = rows[fine := ~bad[at].any(axis=1)], at[fine]
        if len(rows):
            c = values[at]
            if np.abs(c).max() > LARGEST:
                raise ValueError(f"an entry is beyond {LARGEST:g} and has no exact integer form")
            yield rows, np.floor(SCALE * c).astype(np.int64) + OFFSET


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left.T @ right of integer matrices, exactly, as Python integers."""
    most = max(1, int(np.abs(left).max())) * max(1, int(np.abs(right).max())) * len(left)
    if most < 1 << 53:
        return (left.astype(np.float64).T @ right.astype(np.float64)).astype(np.int64).astype(object)
    if most < 1 << 63:
        return (left.T @ right).astype(object)
    high, low = right >> 24, right & 0xFFFFFF
    if int(np.abs(high).max(initial=0)) == 0 or len(left) == 1:
        return left.T.astype(object) @ right.astype(object)
    return product(left, high) * (1 << 24) + product(left, low)


def upper(d: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(d)


SUMS = "d int, i int, j int, total decimal(38,0)"


def sums(rows: DataFrame, of) -> list:
    """Rows (d, i, j, total): the sums of what ``of`` gives for each block.

    ``of(x)`` returns (i, j, totals).  A task adds its blocks up and Spark adds
    up the tasks; only the totals, whose number depends on the length of the
    vectors alone, come to the driver.
    """
    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for _, x in vectors(batch):
                for k in range(0, len(x), BLOCK):
                    i, j, totals = of(x[k:k + BLOCK])
                    d = x.shape[1]
                    held[d] = [i, j, held[d][2] + totals if d in held else totals]
        for d, (i, j, totals) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), d, np.int32)), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 pa.array([int(t) for t in totals], pa.decimal128(38, 0))], names=["d", "i", "j", "total"])

    return (rows.mapInArrow(run, SUMS).groupBy("d", "i", "j")
            .agg(F.sum("total").cast("string").alias("total")).collect())


@dataclass
class Fit:
    """The x-vectors of one length: n, sums, and unit eigenvectors (columns)
    with their eigenvalues, largest first."""
    n: int
    sum: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def wide(x: Fraction) -> np.longdouble:
    high = float(x)
    return Wide(high) + Wide(float(x - Fraction(high)))


def covariance(n: int, rest: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """From the sums and products of entries less an integer: exact, then
    rounded once to extended precision."""
    d = len(rest)
    out = np.zeros((d, d), Wide)
    for (i, j), p in products.items():
        out[i, j] = out[j, i] = wide(Fraction(n * p - rest[i] * rest[j], n * n))
    return out


def clusters(values: np.ndarray, limit) -> list[np.ndarray]:
    """Groups of two or more neighbouring eigenvalues that lie within ``limit``."""
    order = np.argsort(values)
    breaks = np.flatnonzero(np.diff(values[order]) > limit) + 1
    return [g for g in np.split(order, breaks) if len(g) > 1]


def correct(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.longdouble]:
    """One correction of the eigenvectors x of a: (vectors, eigenvalues, size of
    the smallest gap that this step could tell apart)."""
    r = np.eye(len(a), dtype=Wide) - x.T @ x
    s = x.T @ a @ x
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    norm = np.sqrt((a * a).sum())
    limit = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum())) + 1000 * norm * np.finfo(Wide).eps
    gap = values[None, :] - values[:, None]
    far = np.abs(gap) > limit
    middle = (values[None, :] + values[:, None]) / 2
    # r / 2 restores the angles; the rest is a rotation, antisymmetric to the
    # last digit, so that rounding over a small gap cannot skew the vectors
    e = r / 2 + np.where(far, (s + middle * r) / np.where(far, gap, 1), 0)
    return x + x @ e, values, limit


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a symmetric matrix in
    extended precision, largest first."""
    size = np.abs(a).max(initial=0)
    if not size:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / size
    _, start = np.linalg.eigh(a.astype(np.float32))
    x, tiny = start.astype(Wide), np.finfo(Wide).eps * len(a)
    for step in range(STEPS):
        before = x
        x, values, limit = correct(a, x)
        turned = False
        for group in clusters(values, limit) if step else ():  # after one step the vectors are orthogonal
            v, middle = x[:, group], values[group].mean()
            part = v.T @ (a @ v) - middle * (v.T @ v)
            part = (part + part.T) / 2
            if np.abs(part - np.diag(np.diag(part))).max() > 4 * tiny:  # they still mix
                _, turn = np.linalg.eigh((part / np.abs(part).max()).astype(np.float64))
                x[:, group] = v @ turn.astype(Wide)
                turned = True
        if step > 2 and not turned and np.abs(x - before).max() < tiny:
            break
    x, _, _ = correct(a, x)
    values = np.diag(x.T @ a @ x) / np.diag(x.T @ x)
    x = x / np.sqrt((x * x).sum(axis=0))
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order] * size
    top = np.abs(x).argmax(axis=0)
    x = x * np.where(x[top, np.arange(len(a))] < 0, -1, 1)
    return values.astype(np.float64), x.astype(np.float64)


def fit(rows: DataFrame) -> dict[int, Fit]:
    """Length -> fit, over all the vectors of a frame (id, vector)."""
    ship(rows.sparkSession)

    def totals(x):
        d = x.shape[1]
        index = np.arange(-1, d)
        return index, index, np.array([len(x), *x.sum(axis=0).tolist()], object)

    first: dict[int, dict[int, int]] = {}
    for r in sums(rows, totals):
        first.setdefault(r["d"], {})[r["i"]] = int(r["total"])
    means = {d: np.array([round(Fraction(t[i], t[-1])) for i in range(d)], np.int64) for d, t in first.items()}

    def products(x):
        i, j = upper(x.shape[1])
        y = x - means[x.shape[1]]
        return i, j, product(y, y)[i, j]

    second: dict[int, dict] = {}
    if first:
        for r in sums(rows, products):
            second.setdefault(r["d"], {})[r["i"], r["j"]] = int(r["total"])
    out = {}
    for d, t in first.items():
        n, s = t[-1], [t[i] for i in range(d)]
        v = covariance(n, [s[i] - n * int(means[d][i]) for i in range(d)], second[d])
        values, x = eigen(v)
        out[d] = Fit(n, np.array(s, object), x, values, float(np.trace(v)))
    return out


class Whitener:
    """Whitened components of the x-vectors of one fit."""

    def __init__(self, fitted: Fit, components: int):
        self.n, d = fitted.n, len(fitted.sum)
        self.k = min(components, d)
        self.mean = np.array([round(Fraction(int(s), self.n)) for s in fitted.sum], np.int64)
        self.rest = np.array([int(s) - self.n * int(m) for s, m in zip(fitted.sum, self.mean, strict=True)],
                             np.int64)
        values = fitted.values[:self.k]
        #: components that have variance beyond rounding
        self.live = values > fitted.values[0] * d * np.finfo(np.float64).eps if fitted.values[0] > 0 \
            else np.zeros(self.k, bool)
        scale = np.where(self.live, 1 / np.sqrt(np.where(self.live, values, 1)), 0)
        self.axes = fitted.vectors[:, :self.k] * scale
        self.explained = values / fitted.trace if fitted.trace > 0 else np.zeros(self.k)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly."""
        y = x - self.mean
        if self.n * max(1, int(np.abs(y).max(initial=0))) >= 1 << 62:
            return y.astype(object) * self.n - self.rest
        return y * self.n - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) / self.n).astype(np.float64) @ self.axes

    def deviation(self, x: np.ndarray) -> list[int]:
        z = self.centred(x)
        if z.shape[1] * max(1, int(np.abs(z).max(initial=0))) ** 2 >= 1 << 63:
            z = z.astype(object)
        return (z * z).sum(axis=1).tolist()


def identity_errors(rows: DataFrame, fits: dict[int, Fit], components: int) -> dict[int, float]:
    """Length -> largest absolute entry of the whitened rows' covariance less
    the identity, over the components that have variance."""
    def run(batches):
        held: dict[int, np.ndarray] = {}
        tools = {d: Whitener(f, components) for d, f in fits.items()}
        for batch in batches:
            for _, x in vectors(batch):
                d = x.shape[1]
                for k in range(0, len(x), BLOCK):
                    w = tools[d].whitened(x[k:k + BLOCK])
                    w = np.hstack([np.ones((len(w), 1)), w])
                    held[d] = held.get(d, 0) + w.T @ w
        for d, m in held.items():
            i, j = upper(len(m))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)),
                 pa.array(j.astype(np.int32)), pa.array(m[i, j])], names=["d", "i", "j", "total"])

    out = dict.fromkeys(fits, 0.0)
    got: dict[int, dict] = {}
    for r in (rows.mapInArrow(run, "d int, i int, j int, total double").groupBy("d", "i", "j")
              .agg(F.sum("total").alias("total")).collect() if fits else []):
        got.setdefault(r["d"], {})[r["i"], r["j"]] = r["total"] / fits[r["d"]].n
    for d, m in got.items():
        live = np.flatnonzero(Whitener(fits[d], components).live) + 1
        out[d] = max((abs(m[i, j] - m[0, i] * m[0, j] - (i == j))
                      for i in live.tolist() for j in live.tolist() if i <= j), default=0.0)
    return out


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: id, component, n, deviation, whitened,
    explained, identity_error.

    The components of a row leave its task together; no shuffle moves a vector.
    """
    rows = rows.select(id_col, vector_col)
    fits = fit(rows)
    errors = identity_errors(rows, fits, components)
    kind = dict(rows.dtypes)[id_col]
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches):
        tools = {d: Whitener(f, components) for d, f in fits.items()}
        for batch in batches:
            for at, x in vectors(batch):
                t = tools[x.shape[1]]
                size = len(at) * t.k
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(at, t.k))),
                     pa.array(np.tile(np.arange(1, t.k + 1, dtype=np.int32), len(at))),
                     pa.array(np.full(size, t.n, np.int64)),
                     pa.array(t.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), t.k))),
                     pa.array(t.whitened(x).ravel()), pa.array(np.tile(t.explained, len(at))),
                     pa.array(np.full(size, errors[x.shape[1]]))], names=names)

    return rows.mapInArrow(run, f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, "
                                "explained double, identity_error double")
