"""Operator 11: whitening of embeddings by FEAST contour integration.

Whole numbers x = floor(scale * c) + shift stand for the components.  Their counts, sums and products about a whole
number near the mean are added up exactly, task by task and then by Spark, so the covariance (divisor n) is the
correctly rounded quotient of two whole numbers, the same however the rows are dealt.  Its leading eigenpairs are found
without a full decomposition:

1. *Inertia counts.*  The negative pivots of a Bunch-Kaufman factorization of V - s count the eigenvalues below s.
   Bisection cuts the spectrum into intervals of at most ``most`` eigenvalues, down to the wanted number from above; a
   cut is moved until no eigenvalue lies close to it.
2. *Contour integration.*  Each interval is a row of a Spark table, and a task of its own.  Gauss quadrature of solves
   with the complex shifted covariance, over a circle through the interval's ends, projects a block of vectors onto
   the interval's eigenvectors; Rayleigh-Ritz on that block gives the pairs, and the step repeats until the residuals
   are at rounding.
3. *Verification.*  An interval must give as many eigenvalues as its inertia counts say; else its block grows and the
   step is repeated, and a difference that stays is an error.  Rayleigh-Ritz over all intervals together makes the
   vectors orthogonal across cuts.

Scale: rows are read four times (sums, products, the whitened covariance, the result) and never shuffled; what is
shuffled, sent to the driver and broadcast is the square of the dimension, whatever the number of rows.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped; of vectors of different
lengths those of the most frequent length stay (of equally frequent ones, the longest).  Repeated rows count as often as they
stand.  Components without variance (eigenvalues at the rounding of the largest) have no scale to divide by and are
left out, so one row alone, or equal rows, give no components; so does an empty table.  A deviation
beyond a long is null.  Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from rollcall.llm.common import map_arrow
from rollcall.llm.hard_negatives import finite

SCALE, SHIFT, COMPONENTS, MOST, NODES = 64, 1_000_000, 32, 8, 8
_ROWS, _EPS = 1024, np.finfo(np.float64).eps
_LONG = (1 << 63) - 1


# ---------------------------------------------------------------- exact moments

def whole(vectors: pa.Array, size: int, scale: int, shift: int) -> np.ndarray:
    """Rows of a list column of ``size`` doubles as whole numbers floor(scale * c) + shift."""
    return np.floor(scale * vectors.flatten().to_numpy().reshape(-1, size)).astype(np.int64) + shift


def kept(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    return vectors.where(finite(F.col(vector))).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))


def of_size(rows: DataFrame, size: int) -> DataFrame:
    return rows.where(F.size("v") == size)


def sums(rows: DataFrame, scale: int, shift: int) -> tuple[int, int, list[int]]:
    """The most frequent length, its rows, and their sums by dimension."""
    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            v = batch.column(0)
            sizes = np.diff(v.offsets.to_numpy())
            for size in np.unique(sizes).tolist():
                x = whole(v.filter(pa.array(sizes == size)), size, scale, shift) if size else np.zeros((int((sizes == 0).sum()), 0), np.int64)
                here = np.concatenate([[len(x)], x.sum(axis=0)])
                total[size] = total.get(size, 0) + here
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tolist() for t in total.values()], pa.list_(pa.int64()))], ["size", "sums"])

    found = map_arrow(rows.select("v"), add, "size int, sums array<long>").select("size", F.posexplode("sums").alias("at", "x"))
    found = found.groupBy("size", "at").agg(F.sum("x").alias("x"))
    counts = found.where("at = 0").orderBy(F.col("x").desc(), F.col("size").desc()).first()
    if counts is None or counts["size"] == 0:
        return 0, 0, []
    size = counts["size"]
    each = {r["at"]: r["x"] for r in found.where(F.col("size") == size).collect()}  # dimension + 1 rows
    return size, each[0], [each[i + 1] for i in range(size)]


def _exact_gram(y: np.ndarray) -> np.ndarray:
    """y^T y in whole numbers."""
    greatest = max(int(y.max(initial=0)), -int(y.min(initial=0)))
    if greatest * greatest * max(len(y), 1) < 1 << 53:
        return (y.astype(np.float64).T @ y.astype(np.float64)).astype(np.int64).astype(object)
    return y.astype(object).T @ y.astype(object)


def _cells(parts: DataFrame, kind: str) -> list:
    """Element by element sums of the arrays in column ``cells``, in order."""
    each = parts.select(F.posexplode("cells").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast(kind)).alias("x"))
    return [r["x"] for r in each.orderBy("at").collect()]  # as many as the square of the dimension


def covariance(rows: DataFrame, size: int, n: int, total: list[int], scale: int, shift: int) -> np.ndarray:
    """The covariance of the whole numbers, each entry rounded once."""
    about = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)  # a whole number near the mean
    upper = np.triu_indices(size)

    def gram(batches):
        cells = np.zeros(len(upper[0]), object)
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                cells = cells + _exact_gram(whole(batch.column(0).slice(a, _ROWS), size, scale, shift) - about)[upper]
        yield pa.RecordBatch.from_arrays([pa.array([[int(c) for c in cells]], pa.list_(pa.decimal128(38, 0)))], ["cells"])

    cells = _cells(map_arrow(of_size(rows, size).select("v"), gram, "cells array<decimal(38,0)>"), "decimal(38,0)")
    rest = [s - n * int(m) for s, m in zip(total, about)]
    out = np.zeros((size, size))
    for i, j, cell in zip(*upper, cells):
        out[i, j] = out[j, i] = (n * int(cell) - rest[i] * rest[j]) / (n * n)  # whole numbers: rounded once
    return out


# ---------------------------------------------------------------- eigenpairs

def below(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric matrix lie below the shift: the negative pivots of V - shift (Bunch-Kaufman)."""
    a = v - shift * np.eye(len(v))
    n, k, count, alpha = len(a), 0, 0, (1 + 17**0.5) / 8
    while k < n:
        step, column = 1, np.abs(a[k + 1:, k])
        most = column.max(initial=0.0)
        if most > 0 and abs(a[k, k]) < alpha * most:
            r = k + 1 + int(column.argmax())
            across = np.abs(a[r, k:])
            across[r - k] = 0
            if abs(a[k, k]) * across.max() < alpha * most * most:
                step = 1 if abs(a[r, r]) >= alpha * across.max() else 2
                to = k + step - 1
                a[[to, r]] = a[[r, to]]
                a[:, [to, r]] = a[:, [r, to]]
        block, tail = a[k:k + step, k:k + step], a[k + step:, k:k + step].copy()
        if step == 2:
            count += 1 if np.linalg.det(block) < 0 else 2 * int(block[0, 0] < 0)
            a[k + 2:, k + 2:] -= tail @ np.linalg.solve(block, tail.T)
        else:
            count += int(block[0, 0] < 0)
            if block[0, 0]:
                a[k + 1:, k + 1:] -= np.outer(tail, tail / block[0, 0])
        k += step
    return count


def intervals(v: np.ndarray, wanted: int, most: int = MOST) -> list[tuple[float, float, int]]:
    """(from, to, eigenvalues inside) in falling order, of at most ``most`` eigenvalues each (more only where they
    coincide), that together hold the ``wanted`` greatest."""
    size = len(v)
    reach = float(np.abs(v).sum(axis=1).max(initial=0.0))
    if reach == 0:
        return []
    ends = (-reach * 1e-3, reach * (1 + 1e-3))
    todo, done = [(*ends, below(v, ends[0]), size)], []
    while todo:
        lo, hi, under_lo, under_hi = todo.pop()
        if under_hi == under_lo or size - under_hi >= wanted:
            continue
        if under_hi - under_lo <= most or hi - lo < 1e-9 * reach:
            done.append((lo, hi, under_hi - under_lo))
            continue
        near = 1e-4 * (hi - lo)
        for part in (0.5, 0.46, 0.54, 0.42, 0.58, 0.38, 0.62):
            cut = lo + part * (hi - lo)
            under = below(v, cut - near)
            if under == below(v, cut + near):
                break
        else:
            under = below(v, cut)
        todo += [(lo, cut, under_lo, under), (cut, hi, under, under_hi)]
    return sorted(done, reverse=True)


def ritz(v: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: values and vectors of the matrix within the span of the block's columns."""
    basis = np.linalg.qr(block)[0]
    small = basis.T @ (v @ basis)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return values, basis @ turn


def feast(v: np.ndarray, lo: float, hi: float, count: int, nodes: int = NODES, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs between ``lo`` and ``hi``."""
    size, middle, radius = len(v), (lo + hi) / 2, (hi - lo) / 2
    angle, weight = np.polynomial.legendre.leggauss(nodes)
    turn = np.exp(-0.5j * np.pi * (angle - 1))  # half a circle: the other half is its conjugate
    goal = 4 * _EPS * np.linalg.norm(v, 2 if size < 256 else "fro")
    width = min(size, count + count // 2 + 4)
    while True:
        block = np.random.default_rng(width).standard_normal((size, width))
        least, stale = np.inf, 0
        for _ in range(rounds):
            projected = np.zeros((size, width))
            for t, w in zip(turn, weight):
                solved = np.linalg.solve((middle + radius * t) * np.eye(size) - v, block.astype(complex))
                projected += 0.5 * w * (radius * t * solved).real
            values, block = ritz(v, projected)
            inside = (values > lo) & (values < hi)
            residual = np.linalg.norm(v @ block[:, inside] - block[:, inside] * values[inside], axis=0).max(initial=0.0)
            if inside.sum() == count:
                stale = stale + 1 if residual > least / 2 else 0
                least = min(least, residual)
                if residual <= goal or stale >= 3:
                    break
        if inside.sum() == count and least <= 1e4 * goal:
            return values[inside], block[:, inside]
        if width == size:
            raise ArithmeticError(f"{count} eigenvalues lie between {lo} and {hi}, {inside.sum()} were found")
        width = min(size, 2 * width)


def leading(spark, v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues, falling, and their unit vectors as columns; one task for each interval."""
    found = intervals(v, wanted)
    if not found:
        return np.zeros(0), np.zeros((len(v), 0))
    shared = spark.sparkContext.broadcast(v)

    def solve(batches):
        for batch in batches:
            for lo, hi, count in zip(*[c.to_pylist() for c in batch.columns]):
                values, vectors = feast(shared.value, lo, hi, count)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))], ["value", "vector"])

    cut = spark.createDataFrame(found, "lo double, hi double, n long").repartition(len(found), "lo", "hi")
    pairs = map_arrow(cut, solve, "value double, vector array<double>").orderBy("value").collect()  # of bounded intervals
    if len(pairs) != sum(n for _, _, n in found):
        raise ArithmeticError("the intervals' eigenpairs do not add up to their inertia counts")
    values, vectors = ritz(v, np.array([p["vector"] for p in pairs]).T)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    some = values > 16 * len(v) * _EPS * values[0]
    values, vectors = values[some], vectors[:, some]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * sign


# ---------------------------------------------------------------- the operator

@dataclass
class Whitening:
    """What was fitted: n, the sums S, the components (columns) and their eigenvalues, and the trace."""

    n: int
    total: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: int = SCALE
    shift: int = SHIFT

    def __post_init__(self):
        self.about = np.array([(2 * s + self.n) // (2 * self.n) for s in self.total], np.int64)
        self.rest = np.array([s - self.n * int(m) for s, m in zip(self.total, self.about)], object)
        self.map = self.vectors / np.sqrt(self.values)

    def centred(self, v: pa.Array) -> np.ndarray:
        """x less a whole number near the mean."""
        return whole(v, len(self.total), self.scale, self.shift) - self.about

    def white(self, y: np.ndarray) -> np.ndarray:
        return (y - (self.rest / self.n).astype(np.float64)) @ self.map

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)^2."""
        most = self.n * max(int(y.max(initial=0)), -int(y.min(initial=0))) + max((abs(r) for r in self.rest), default=0)
        kind = np.int64 if most * most * y.shape[1] <= _LONG else object
        each = ((self.n * y.astype(kind) - self.rest.astype(kind)) ** 2).sum(axis=1).tolist()
        return [d if d <= _LONG else None for d in each]


def fit(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """Fit on all rows (``kept``); None if there is no component."""
    size, n, total = sums(rows, scale, shift)
    if not size:
        return None
    v = covariance(rows, size, n, total, scale, shift)
    values, vectors = leading(rows.sparkSession, v, min(components, size))
    return Whitening(n, total, values, vectors, float(np.trace(v)), scale, shift) if len(values) else None


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    shared = rows.sparkSession.sparkContext.broadcast(w)
    k = len(w.values)

    def moments(batches):
        first, second, fitted = np.zeros(k), np.zeros((k, k)), shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                z = fitted.white(fitted.centred(batch.column(0).slice(a, _ROWS)))
                first += z.sum(axis=0)
                second += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([first, second.ravel()]).tolist()], pa.list_(pa.float64()))], ["cells"])

    cells = np.array(_cells(map_arrow(of_size(rows, len(w.total)).select("v"), moments, "cells array<double>"), "double")) / w.n
    mean = cells[:k]  # of centred rows: zero but for rounding
    return float(np.abs(cells[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whitened(rows: DataFrame, w: Whitening) -> DataFrame:
    """(key, deviation, whitened array<double>) of the rows of the fitted length."""
    shared = rows.sparkSession.sparkContext.broadcast(w)

    def run(batches):
        for batch in batches:
            fitted = shared.value
            for a in range(0, batch.num_rows, _ROWS):
                y = fitted.centred(batch.column(1).slice(a, _ROWS))
                z = fitted.white(y)
                offsets = np.arange(len(z) + 1) * z.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, _ROWS), pa.array(fitted.deviations(y), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(z.ravel()))], ["key", "deviation", "whitened"])

    schema = rows.select("key").schema.add("deviation", "long").add("whitened", ArrayType(DoubleType()))
    return map_arrow(of_size(rows, len(w.total)).select("key", "v"), run, schema)


def report(vectors: DataFrame, **options) -> DataFrame:
    """The contract's query over ``embeddings``: one row for each remaining row and component."""
    rows = kept(vectors, "vec_id", "embedding")
    w = fit(rows, **options)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if w is None:
        return rows.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    share = F.array(*[F.lit(float(e / w.trace)) for e in w.values])
    each = whitened(rows, w).select(F.col("key").cast("long").alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation",
                       "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(identity_error(rows, w)).alias("identity_error")).select(*names)
