"""Embedding whitening by FEAST contour integration.

Entries become whole numbers ``x = floor(64 c) + 1000000``.  The covariance V
of the distinct vectors is a sum of whole numbers: tasks subtract the whole
part of the mean, multiply, and add up exactly; only the division at the end
rounds.  V has one row per dimension, so it, and nothing that grows with the
rows, goes to the driver.

There the components are found by contour integration.  Householder reflections bring V to
three diagonals, where the signs of the pivots of V - s (its inertia) count the
eigenvalues above any s.  Bisection on that count places an interval around the
largest ones, with its lower end in the widest gap behind them.  A quadrature of
complex shifted solves (z - V)^-1 Y along a circle through both ends projects
a random start onto the eigenvectors inside, Rayleigh-Ritz extracts them, and
both are repeated until the residuals vanish.  The number found must equal the
inertia count, else the subspace is widened.

Rows whose vector is null or holds null or non-finite entries are dropped;
a null vec_id stays null.  Shorter vectors count as if they ended in zeros, and
entries beyond 2^40 count as 2^40.  Repeated rows are whitened each; the
covariance holds each distinct vector once.  Directions without variance (below
1e-12 of the largest) are no components: fewer than ``k`` rows per vector
are returned, none for an empty table or a single distinct vector.  Of equal
eigenvalues any basis is returned, the same on every run; the largest entry of
a component is positive.  A ``deviation`` beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import materialize

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
LARGEST = 2.0**40
NODES = 8
# Eigenvalues below this part of the largest are rounding.
NO_VARIANCE = 1e-12
_LONG = np.iinfo(np.int64).max
_WHOLE = pa.decimal128(38, 0)


class Basis(NamedTuple):
    """What the executors need to whiten a vector: all of it is dims x k at most."""

    n: int
    whole: np.ndarray  # whole part of the mean
    rest: np.ndarray  # sum - n * whole
    vectors: np.ndarray  # dims x k, unit columns
    values: np.ndarray  # k, falling
    trace: float


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, x``: whole-number vectors of one length."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    rows = vectors.where(F.col("embedding").isNotNull() & F.forall("embedding", finite)).select("vec_id", "embedding")
    dims = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    entry = lambda c: F.floor(F.greatest(F.least(c.cast("double"), F.lit(LARGEST)), F.lit(-LARGEST)) * F.lit(float(SCALE))) + F.lit(SHIFT)
    padding = F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(dims) - F.size("embedding"))
    return rows.select("vec_id", F.concat(F.transform("embedding", entry), padding).alias("x"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _wholes(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], type=_WHOLE)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for b in batches:
        if b.num_rows:
            own = _matrix(b.column("x")).sum(axis=0).astype(object)  # 10,000 rows of 2^47 stay below 2^63
            n, total = n + b.num_rows, own if total is None else total + own
    if n:
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(total)), type=pa.int32()), "n": pa.array([n] * len(total), type=pa.int64()), "s": _wholes(total)})


def squares(y: np.ndarray) -> np.ndarray:
    """y.T @ y in whole numbers: in doubles while every sum stays below 2^53,
    else in Python's integers."""
    most = int(np.abs(y).max(initial=0))
    if most * most * max(1, len(y)) < 1 << 53:
        y = y.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def _products(whole: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                own = squares(_matrix(b.column("x")) - whole)
                total = own if total is None else total + own
        if total is not None:
            i, j = np.tril_indices(len(total))
            yield pa.RecordBatch.from_pydict({"i": pa.array(i, type=pa.int32()), "j": pa.array(j, type=pa.int32()), "s": _wholes(total[i, j])})

    return run


def covariance(fit: DataFrame) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(n, whole part of the mean, sum - n * whole, V) of the vectors ``x``: V is
    exact up to the rounding of its entries."""
    sums = fit.mapInArrow(_sums, "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).orderBy("i").collect()
    if not sums:
        return 0, np.zeros(0, np.int64), np.zeros(0, object), np.zeros((0, 0))
    n = sums[0]["n"]
    total = [int(r["s"]) for r in sums]
    whole = np.array([(2 * s + n) // (2 * n) for s in total], dtype=np.int64)
    rest = np.array([s - n * int(w) for s, w in zip(total, whole, strict=True)], dtype=object)
    cells = fit.mapInArrow(_products(whole), "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()
    v = np.zeros((len(whole), len(whole)))
    for r in cells:
        v[r["i"], r["j"]] = v[r["j"], r["i"]] = (n * int(r["s"]) - rest[r["i"]] * rest[r["j"]]) / (n * n)
    return n, whole, rest, v


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(diagonal, squares of the off-diagonal) of a tridiagonal matrix with the eigenvalues of v."""
    a = v.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        x[0] += length if x[0] >= 0 else -length
        size = x @ x
        if size:
            w = a[k + 1 :, k + 1 :]
            p = w @ x * (2 / size)
            q = p - x * ((x @ p) / size)
            w -= np.outer(x, q) + np.outer(q, x)
            a[k + 1, k] = -length if a[k + 1, k] >= 0 else length
    return np.diag(a).copy(), np.diag(a, -1) ** 2


def above(t: tuple[np.ndarray, np.ndarray], s: float) -> int:
    """How many eigenvalues are larger than s: the positive pivots of T - s."""
    found, pivot = 0, 1.0
    least = np.finfo(float).tiny
    for x, e in zip(t[0], np.concatenate([[0.0], t[1]]), strict=True):
        pivot = x - s - e / pivot
        if abs(pivot) < least:
            pivot = -least
        found += pivot > 0
    return found


def nth(t: tuple[np.ndarray, np.ndarray], n: int, low: float, high: float) -> float:
    """The n-th largest eigenvalue, by bisection on the inertia."""
    while True:
        middle = (low + high) / 2
        if not low < middle < high:
            return middle
        low, high = (middle, high) if above(t, middle) >= n else (low, middle)


def interval(v: np.ndarray, k: int) -> tuple[float, float, int]:
    """(low, high, count): an interval with the k largest eigenvalues, its lower
    end in the widest gap within the next few."""
    t = tridiagonal(v)
    reach = float(np.abs(v).sum(axis=1).max(initial=0.0))
    top = nth(t, 1, -reach, reach)
    k = min(k, above(t, NO_VARIANCE * top) if top > 0 else 0)
    if not k:
        return 0.0, 0.0, 0
    near, reached = [nth(t, k, -reach, reach)], k
    while True:
        # look further while the eigenvalues behind are one cluster
        until = min(len(v), reached + k // 2 + 1)
        near += [nth(t, i, -reach, reach) for i in range(reached + 1, until + 1)]
        reached = until
        ends = [*near, near[-1] - top] if reached == len(v) else near  # nothing stands below the last
        gaps = -np.diff(ends)
        at = int(np.argmax(gaps))
        if gaps[at] > 1e-6 * top or reached == len(v):
            break
    low = (ends[at] + ends[at + 1]) / 2
    return low, top + (top - low) * 0.05, above(t, low)


def feast(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns): the k largest, falling."""
    low, high, count = interval(v, k)
    if not count:
        return np.zeros(0), np.zeros((len(v), 0))
    scale = float(np.abs(v).sum(axis=1).max())
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (1 - nodes))
    radius = (high - low) / 2
    shifted = [(low + radius + radius * w) * np.eye(len(v)) - v for w in turn]
    width = min(len(v), count + count // 2 + 2)
    while True:
        y = np.linalg.qr(np.random.default_rng(0).standard_normal((len(v), width)))[0]
        last = np.inf
        for _ in range(30):
            projected = sum((0.5 * g * radius * w * np.linalg.solve(s, y)).real for g, w, s in zip(weights, turn, shifted, strict=True))
            q = np.linalg.qr(projected)[0]
            values, turned = np.linalg.eigh(q.T @ v @ q)
            y = q @ turned
            inside = values > low
            residual = np.abs(v @ y[:, inside] - y[:, inside] * values[inside]).max(initial=0.0) if inside.any() else np.inf
            if residual < 1e-15 * scale or residual >= last / 2 and residual < 1e-11 * scale:
                break
            last = min(last, residual)
        if inside.sum() == count or width == len(v):
            break
        width = min(len(v), 2 * width)  # the inertia says that some are missing
    if inside.sum() != count:
        raise ArithmeticError(f"{inside.sum()} eigenvalues found where the inertia counts {count}")
    order = np.argsort(-values[inside], kind="stable")
    values, y = values[inside][order], y[:, inside][:, order]
    good = values > NO_VARIANCE * values[0]
    values, y = values[good][:k], y[:, good][:, :k]
    y = y / np.linalg.norm(y, axis=0)
    largest = y[np.abs(y).argmax(axis=0), np.arange(y.shape[1])]
    return values, y * np.where(largest < 0, -1.0, 1.0)


def whiten(x: np.ndarray, basis: Basis) -> np.ndarray:
    y = (x - basis.whole).astype(np.float64) - basis.rest.astype(np.float64) / basis.n
    return y @ basis.vectors / np.sqrt(basis.values)


def deviations(x: np.ndarray, basis: Basis) -> list[int | None]:
    """Sum of (n x - S)^2 over the dimensions, exact; None beyond a long."""
    y = x - basis.whole
    most = basis.n * (int(np.abs(y).max(initial=0)) + 1)
    if most * most * max(1, x.shape[1]) < _LONG:
        z = basis.n * y - basis.rest.astype(np.int64)
        return (z * z).sum(axis=1).tolist()
    z = basis.n * y.astype(object) - basis.rest
    return [int(s) if s <= _LONG else None for s in (z * z).sum(axis=1)]


def _second_moments(basis: Basis):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(basis.values)
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            if b.num_rows:
                w = whiten(_matrix(b.column("x")), basis)
                first += w.sum(axis=0)
                second += w.T @ w
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, type=pa.int32()), "j": pa.array(j, type=pa.int32()), "s": pa.array(second[i, j]), "m": pa.array(np.where(i == j, first[i], 0.0))})

    return run


def identity_error(fit: DataFrame, basis: Basis) -> float:
    """The largest entry of the whitened covariance less the identity, measured
    over the fit list; the vectors are centred before they are multiplied."""
    cells = fit.mapInArrow(_second_moments(basis), "i int, j int, s double, m double").groupBy("i", "j").agg(F.sum("s").alias("s"), F.sum("m").alias("m")).collect()
    mean = {r["i"]: r["m"] / basis.n for r in cells if r["i"] == r["j"]}
    return max(abs(r["s"] / basis.n - mean[r["i"]] * mean[r["j"]] - (r["i"] == r["j"])) for r in cells)


def train(rows: DataFrame, k: int = COMPONENTS) -> tuple[Basis, DataFrame]:
    """The basis of ``rows`` (``usable``), and the fit list, written."""
    # equal vectors meet in each task before they are shuffled
    fit = materialize(rows.select("x").distinct(), "fit-list")
    n, whole, rest, v = covariance(fit)
    values, vectors = feast(v, k)
    return Basis(n, whole, rest, vectors, values, float(np.trace(v))), fit


_OUT = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whitened(basis: Basis, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(basis.values)
        for b in batches:
            if not b.num_rows or not k:
                continue
            x = _matrix(b.column("x"))
            at = np.repeat(np.arange(len(x)), k)
            deviation = pa.array(deviations(x, basis), type=pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": b.column("vec_id").take(pa.array(at)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(len(at), basis.n, dtype=np.int64)),
                    "deviation": deviation.take(pa.array(at)),
                    "whitened": pa.array(whiten(x, basis).ravel()),
                    "explained": pa.array(np.tile(basis.values / basis.trace, len(x))),
                    "identity_error": pa.array(np.full(len(at), error)),
                }
            )

    return run


def whitened(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``."""
    rows = usable(vectors)
    basis, fit = train(rows, k)
    error = identity_error(fit, basis) if len(basis.values) else 0.0
    return rows.mapInArrow(_whitened(basis, error), _OUT.format(vectors.schema["vec_id"].dataType.simpleString()))
