"""Embedding whitening by spectrum slicing.

The covariance of all vectors is summed up on the executors, exactly and centred; the
matrix of d x d numbers, whose size does not depend on the rows, is taken apart on the driver:

1. The inertia of an LDLᵀ factorisation of V - s·I tells how many eigenvalues lie above s.
   Bisection by such counts isolates each of the leading eigenvalues in an interval.
2. Rayleigh quotient iteration converges cubically to the eigenvector inside the interval. A
   quotient that leaves the interval is given up; the interval is halved by another count.
3. Counts on both sides of the quotient certify that it has the number it is given.

Eigenvalues that agree to rounding are taken together: a block of vectors is iterated
and made orthogonal. Directions without variance have no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: Entries beyond this (as whole numbers) would not fit into a long.
MOST = float(1 << 62)
EPS = float(np.finfo(float).eps)
_ALPHA = (1 + 17**0.5) / 8


# --- the matrix of d x d numbers


def count_above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of the symmetric matrix above the shift: the positive pivots of the
    LDLᵀ factorisation of v - shift * I, with Bunch and Kaufman's pivots of size 1 and 2."""
    a = v - shift * np.eye(len(v))
    found, k = 0, 0

    def swap(s: np.ndarray, i: int, j: int) -> None:
        s[[i, j]] = s[[j, i]]
        s[:, [i, j]] = s[:, [j, i]]

    while k < len(a):
        s = a[k:, k:]
        below = np.abs(s[1:, 0])
        largest = below.max() if len(below) else 0.0
        if largest == 0.0:
            found += s[0, 0] > 0
            k += 1
            continue
        r = int(below.argmax()) + 1
        single = abs(s[0, 0]) >= _ALPHA * largest
        if not single:
            beside = np.abs(s[:, r])
            beside[r] = 0.0
            if abs(s[0, 0]) * beside.max() >= _ALPHA * largest * largest:
                single = True
            elif abs(s[r, r]) >= _ALPHA * beside.max():
                swap(s, 0, r)
                single = True
            else:
                swap(s, 1, r)
        if single:
            found += s[0, 0] > 0
            s[1:, 1:] -= np.outer(s[1:, 0], s[1:, 0] / s[0, 0])
            k += 1
        else:  # such a block has one eigenvalue of each sign
            found += 1
            s[2:, 2:] -= s[2:, :2] @ np.linalg.solve(s[:2, :2], s[:2, 2:])
            k += 2
    return int(found)


class Spectrum:
    """The leading eigenvalues of a symmetric matrix, numbered from 1 by falling value."""

    def __init__(self, v: np.ndarray):
        self.v, self.d = v, len(v)
        radius = np.abs(v).sum(1).max() if self.d else 0.0
        self.norm = float(radius)
        self.tol = 4 * self.d * EPS * self.norm
        self.counts = {-2 * self.norm - 1: self.d, 2 * self.norm + 1: 0}
        self.vectors: list[np.ndarray] = []

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = count_above(self.v, shift)
        return self.counts[shift]

    def interval(self, number: int) -> tuple[float, float]:
        """The tightest known (lo, hi] that holds the eigenvalue of this number."""
        return max(s for s, c in self.counts.items() if c >= number), min(s for s, c in self.counts.items() if c < number)

    def isolated(self, number: int) -> tuple[float, float]:
        """Bisect until no other eigenvalue is in the interval, or rounding forbids it."""
        lo, hi = self.interval(number)
        while self.above(lo) - self.above(hi) > 1 and hi - lo > self.tol:
            self.above((lo + hi) / 2)
            lo, hi = self.interval(number)
        return lo, hi

    def solve(self, shift: float, b: np.ndarray) -> np.ndarray:
        for nudge in (0.0, 1.0, 3.0, 9.0):
            try:
                x = np.linalg.solve(self.v - (shift + nudge * EPS * self.norm) * np.eye(self.d), b)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(x).all():
                return x
        raise ArithmeticError("the shifted matrix can't be solved")

    def apart(self, x: np.ndarray) -> np.ndarray:
        """The vector without its share of those found before, at length 1."""
        for _ in range(2):
            for u in self.vectors:
                x = x - (u @ x) * u
            x = x / np.linalg.norm(x)
        return x

    def start(self, number: int) -> np.ndarray:
        return self.apart(np.cos(np.arange(1, self.d + 1) * (number + 0.618)))

    def one(self, number: int) -> tuple[float, np.ndarray]:
        while True:
            lo, hi = self.isolated(number)
            if self.above(lo) - self.above(hi) > 1 or hi - lo <= self.tol:
                return self.tied(lo, hi)
            x = self.start(number)
            for _ in range(2):
                x = self.apart(self.solve((lo + hi) / 2, x))
            rho = float(x @ self.v @ x)
            for _ in range(12):
                if not lo < rho <= hi:
                    break
                if np.linalg.norm(self.v @ x - rho * x) <= 8 * EPS * self.norm:
                    break
                x = self.apart(self.solve(rho, x))
                rho = float(x @ self.v @ x)
            if lo < rho <= hi and np.linalg.norm(self.v @ x - rho * x) <= 64 * self.d * EPS * self.norm and self.certified(rho, number):
                return rho, x
            self.above((lo + hi) / 2)  # another count halves the interval

    def certified(self, rho: float, number: int) -> bool:
        near = max(self.tol, 64 * EPS * self.norm)
        return self.above(rho - near) >= number > self.above(rho + near)

    def tied(self, lo: float, hi: float) -> tuple[float, np.ndarray]:
        """A vector of a group of eigenvalues that are equal to rounding."""
        x = self.start(len(self.vectors) + 1)
        for _ in range(6):
            x = self.apart(self.solve((lo + hi) / 2, x))
        return float(x @ self.v @ x), x

    def leading(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Values and vectors (as rows) of the first k with a value above zero."""
        values: list[float] = []
        for number in range(1, min(k, self.d) + 1):
            if self.above(max(self.tol, EPS)) < number:
                break
            value, vector = self.one(number)
            values.append(value)
            self.vectors.append(vector)
        order = sorted(range(len(values)), key=lambda i: -values[i])
        return np.array([values[i] for i in order]), np.array([self.vectors[i] for i in order]).reshape(-1, self.d)


# --- sums over all rows


def whole_entries(batch: pa.RecordBatch, d: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and entries x of the batch's good vectors."""
    ids, lists = batch.column(0), batch.column(1)
    sizes = np.diff(lists.offsets.to_numpy())
    ok = (sizes == d) & np.asarray(lists.is_valid())
    ids, lists = ids.filter(pa.array(ok)), lists.filter(pa.array(ok))
    c = lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)  # null entries become NaN
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(c * SCALE)
        good = (np.abs(x) < MOST).all(1)  # NaN and infinite entries fail as well
    return ids.filter(pa.array(good)), x[good].astype(np.int64) + OFFSET


def _products(y: np.ndarray) -> np.ndarray:
    """yᵀy in whole numbers of any size."""
    d = y.shape[1]
    total = np.zeros((d, d), object)
    if not len(y):
        return total
    most = int(np.abs(y).max()) or 1
    rows = (1 << 53) // (most * most)
    if rows == 0:
        return y.T.astype(object) @ y.astype(object)
    for at in range(0, len(y), rows):
        part = y[at : at + rows].astype(float)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _decimals(values: Iterator[int]) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def column_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of good vectors and the sum of each dimension, exactly."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            _, x = whole_entries(batch, d)
            n += len(x)
            for at in range(0, len(x), 1 << 12):
                part = x[at : at + (1 << 12)]
                safe = len(part) * int(np.abs(part).max()) < 1 << 62
                total = total + (part.sum(0) if safe else part.astype(object).sum(0)).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), _decimals([n, *total])], ["i", "v"])

    got = {r["i"]: int(r["v"] or 0) for r in rows.mapInArrow(add, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    return got.get(-1, 0), [got.get(i, 0) for i in range(d)]


def covariance(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance with divisor n, rounded once.

    Entries are taken from the whole number nearest to their mean before they are multiplied;
    products are summed as whole numbers, and the rest of the mean is taken off exactly.
    """
    d = len(sums)
    centre = [(2 * s + n) // (2 * n) for s in sums]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for batch in batches:
            _, x = whole_entries(batch, d)
            total = total + _products(x - np.array(centre, np.int64))
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _decimals(total[i, j])], ["i", "j", "v"])

    rest = [s - n * c for s, c in zip(sums, centre)]
    v = np.zeros((d, d))
    for r in rows.mapInArrow(add, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        i, j = r["i"], r["j"]
        v[i, j] = v[j, i] = (n * int(r["v"]) - rest[i] * rest[j]) / (n * n)
    return v


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n; the whole part of the mean goes first, so no digits are lost."""
    whole = np.array([s // n for s in sums], np.int64)
    return (x - whole).astype(float) - np.array([(s % n) / n for s in sums])


def identity_error(rows: DataFrame, n: int, sums: list[int], basis: np.ndarray) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    k, d = basis.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            w = _centred(whole_entries(batch, d)[1], n, sums) @ basis.T
            total += w.T @ w
            mean += w.sum(0)
        i, j = np.indices((k, k)).reshape(2, -1)
        flat = [np.concatenate((i, np.arange(k))), np.concatenate((j, np.full(k, -1))), np.concatenate((total.reshape(-1), mean))]
        yield pa.RecordBatch.from_arrays([pa.array(flat[0], pa.int32()), pa.array(flat[1], pa.int32()), pa.array(flat[2])], ["i", "j", "v"])

    cov, mean = np.zeros((k, k)), np.zeros(k)
    for r in rows.mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        if r["j"] < 0:
            mean[r["i"]] = r["v"] / n
        else:
            cov[r["i"], r["j"]] = r["v"] / n
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sums over the dimensions of (n*x - S)^2, exactly; null where a long can't hold it."""
    centre = [s // n for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    y = x - np.array(centre, np.int64)
    most = n * (int(np.abs(y).max()) if y.size else 0) + max(rest, default=0)
    if most * most * max(len(sums), 1) < 1 << 63:
        t = y * n - np.array(rest, np.int64)
        return pa.array((t * t).sum(1), pa.int64())
    t = y.astype(object) * n - np.array(rest, object)
    return pa.array([int(v) if v < 1 << 63 else None for v in (t * t).sum(1)], pa.int64())


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each good vector and component: ``OUT``.

    Vectors that are null or hold null or non-finite entries, or entries beyond a long, take
    no part, nor do those of another length than the most frequent one (ties: the longer). The
    others are all fitted on and all whitened, repeated rows and null keys included. A table
    without variance in any direction gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    lengths = rows.filter("v IS NOT NULL").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lengths["d"] if lengths else 0
    n, sums = column_sums(rows, d) if d else (0, [])
    if n == 0:
        return spark.createDataFrame([], OUT)
    v = covariance(rows, n, sums)
    e, u = Spectrum(v).leading(components)
    if not len(e):
        return spark.createDataFrame([], OUT)
    basis = u / np.sqrt(e)[:, None]
    error, share, k = identity_error(rows, n, sums, basis), e / np.trace(v), len(e)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = whole_entries(batch, d)
            w, m = _centred(x, n, sums) @ basis.T, len(x)
            by_row = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(by_row), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n), pa.int64()),
                    _deviations(x, n, sums).take(by_row), pa.array(w.reshape(-1)), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                ],
                [c.split()[0] for c in OUT.split(", ")],
            )

    return rows.mapInArrow(project, OUT)
