"""Whitening of embeddings with principal components found by FEAST.

The rows' entries become integers x.  The fit list holds each distinct x vector
once; Spark finds it by a grouped aggregate (copies merge in the tasks), sums it
exactly and adds up its covariance V from exactly centred rows in partial
matrices per task, met row by row of the matrix.

The components are the eigenvectors of V with the largest eigenvalues:

* Inertia counts (Sylvester: a symmetric factorisation of V - s I has as many
  negative pivots as V has eigenvalues below s) bisect the spectrum for the
  bound above which the wanted eigenvalues lie, and cut that range into slices
  of at most ``SLICE`` eigenvalues.
* FEAST treats every slice in a task of its own.  The integral of the resolvent
  (z I - V)^-1 Y around the slice, by Gauss quadrature on a circle with complex
  shifts z, projects a block Y onto the slice's eigenvectors; Rayleigh-Ritz in
  the projected block gives eigenpairs, and the block goes round again until
  their residuals are at rounding level.
* A slice is right only if it has as many converged pairs as the inertia counts
  say; otherwise its block grows, at last to the whole space.  A last
  Rayleigh-Ritz step over all slices makes the vectors orthogonal between slices.

A dimension of d needs d * d doubles per partial matrix and in the driver,
whatever the number of rows.  All rows are then projected where they are read.

Odd rows: a null vector, an empty one and one with null or non-finite entries
are dropped, and so are vectors whose length is not the commonest (of equally
common lengths the smallest) and those with an entry of 2^45 / 64 or more, whose
x has no exact sums; repeated rows are rows of the result and one vector of the
fit list; equal eigenvalues have some orthonormal basis; directions without
variance are no components, so an empty table, one vector or equal vectors give
no rows; other columns are not read.  ``deviation`` is null beyond a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_dir

COMPONENTS = 16
# Eigenvalues in one slice of the spectrum.
SLICE = 6
# Quadrature points on the upper half of a circle.
POINTS = 12
ROUNDS = 30
# Residuals count as rounding errors below this share of the largest eigenvalue.
CONVERGED = 1e-13
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 45)
# Eigenvalues nearer than this share of it count as equal.
APART = 1e-10
# Groups in which partial rows of the matrix meet first.
SALTS = 32

RESULT = ("vec_id long, component int, n long, deviation long, whitened double, "
          "explained double, identity_error double")


def integer_vectors(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, x``: the usable rows with x = floor(scale * entry) + shift."""
    entries = F.col("embedding").cast("array<double>")
    fine = (F.size("c") > 0) & F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e)
                                        & (F.abs(e * scale) < LARGEST))
    usable = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), entries.alias("c"))
              .filter(F.col("c").isNotNull() & fine))
    lengths = usable.groupBy(F.size("c").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), "d").first()
    usable = usable.filter(F.size("c") == (common["d"] if common else 0))
    whole: Column = F.transform("c", lambda e: F.floor(e * scale) + shift)
    return usable.select("vec_id", whole.alias("x"))


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    column = batch.column(name)
    return np.asarray(column.flatten()).reshape(batch.num_rows, -1)


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, None, None
        for b in batches:
            if b.num_rows:
                x = _matrix(b)
                # halves of 32 bits: no sum of a task leaves 64 bits
                h, w = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                high, low = (h, w) if high is None else (high + h, low + w)
                n += b.num_rows
        if n:
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(range(len(high)), pa.int32()), "n": pa.array([n] * len(high), pa.int64()),
                "high": pa.array(high, pa.int64()), "low": pa.array(low, pa.int64())})

    wide = "decimal(38,0)"
    rows = (fit.mapInArrow(add, "i int, n long, high long, low long").groupBy("i")
            .agg(F.sum("n").alias("n"), F.sum(F.col("high").cast(wide)).alias("high"),
                 F.sum(F.col("low").cast(wide)).alias("low")).orderBy("i").collect())
    return (rows[0]["n"] if rows else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: as 64-bit numbers, or Python's where those are too short."""
    most = int(np.abs(x).max()) if x.size else 0
    if n * most < 1 << 62 and max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_deviations(x, n, sums) / n).astype(np.float64)


def _summed_rows(frame: DataFrame, of, width: int) -> np.ndarray:
    """Sum over all tasks of the matrices ``of(batches)``; matrix rows meet by
    row number, in ``SALTS`` groups first, so that no group grows with the tasks."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = of(b for b in batches if b.num_rows)
        if total is not None:
            salt = TaskContext.get().partitionId() % SALTS
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(range(width), pa.int32()), "salt": pa.array([salt] * width, pa.int32()),
                "row": pa.array([r.tobytes() for r in total], pa.binary())})

    def meet(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(r.as_py(), np.float64) for r in table.column("row"))
        return pa.table({"i": table.column("i").slice(0, 1), "salt": table.column("salt").slice(0, 1),
                         "row": pa.array([total.tobytes()], pa.binary())})

    shape = "i int, salt int, row binary"
    rows = (frame.mapInArrow(partial, shape).groupBy("i", "salt").applyInArrow(meet, shape)
            .groupBy("i").applyInArrow(meet, shape).collect())  # width rows
    out = np.zeros((width, width))
    for r in rows:
        out[r["i"]] = np.frombuffer(r["row"], np.float64)
    return out


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of the fit list (divisor n), centred before multiplying."""

    def products(batches):
        total = None
        for b in batches:
            y = _centred(_matrix(b), n, sums)
            total = y.T @ y if total is None else total + y.T @ y
        return total

    v = _summed_rows(fit, products, len(sums)) / n
    return (v + v.T) / 2


# -- FEAST ---------------------------------------------------------------------

def eigenvalues_below(v: np.ndarray, shift: float) -> int:
    """Inertia of V - shift I: number of eigenvalues of V below ``shift``, by a
    symmetric factorisation with pivots of one or two rows."""
    a = v - shift * np.eye(len(v))
    negative = 0
    tiny = np.finfo(float).eps * max(1e-300, float(np.abs(v).max()))
    while len(a):
        diagonal = np.abs(np.diag(a))
        i = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        p, q = np.unravel_index(int(off.argmax()), off.shape)
        if diagonal[i] >= 0.6403882032022076 * off[p, q]:  # (1 + sqrt 17) / 8
            pivot = a[i, i] if abs(a[i, i]) > tiny else tiny
            negative += pivot < 0
            rest = np.delete(np.arange(len(a)), i)
            c = a[rest, i]
            a = a[np.ix_(rest, rest)] - np.outer(c, c) / pivot
        else:
            block = a[np.ix_([p, q], [p, q])]
            det = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
            negative += 1 if det < 0 else 2 * int(block[0, 0] < 0)
            rest = np.delete(np.arange(len(a)), [p, q])
            c = a[np.ix_(rest, [p, q])]
            a = a[np.ix_(rest, rest)] - c @ np.linalg.solve(block, c.T)
            a = (a + a.T) / 2
    return negative


def bound_above(v: np.ndarray, wanted: int, low: float, high: float, apart: float) -> float:
    """A bound just below the ``wanted``-th largest eigenvalue, with no eigenvalue
    nearer than ``apart``: those that cannot be told from it are above, too."""
    d = len(v)
    floor = low
    if d - eigenvalues_below(v, low) <= wanted:
        return low
    while high - low > apart:
        mid = (low + high) / 2
        low, high = (mid, high) if d - eigenvalues_below(v, mid) >= wanted else (low, mid)
    bound, step = low - 2 * apart, 2 * apart
    while bound > floor and eigenvalues_below(v, bound - apart) < eigenvalues_below(v, bound + apart):
        bound, step = bound - step, 2 * step
    return max(bound, floor)


def slices(v: np.ndarray, low: float, high: float, apart: float) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) of parts of the range with at most ``SLICE``
    eigenvalues, or with more that cannot be told apart."""
    count = eigenvalues_below(v, high) - eigenvalues_below(v, low)
    if count == 0:
        return []
    if count > SLICE:
        mid = bound_above(v, len(v) - eigenvalues_below(v, low) - count // 2, low, high, apart)
        if low < mid < high:
            return slices(v, low, mid, apart) + slices(v, mid, high, apart)
    return [(float(low), float(high), int(count))]


def feast(v: np.ndarray, low: float, high: float, count: int, norm: float
          ) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of V between ``low`` and ``high``."""
    d = len(v)
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    angles = np.pi / 2 * (nodes + 1)
    centre, radius = (low + high) / 2, max((high - low) / 2, 1e-12 * norm)
    size = min(d, 2 * count + 4)
    rng = np.random.default_rng(13)
    while True:
        y, before = rng.standard_normal((d, size)), False
        for _ in range(ROUNDS):
            q = np.zeros((d, size))
            for angle, weight in zip(angles, weights, strict=True):
                turn = np.exp(1j * angle)
                solved = np.linalg.solve((centre + radius * turn) * np.eye(d) - v, y)
                # the lower half of the circle is the conjugate of the upper one
                q += (weight / 2 * radius * turn * solved).real
            basis, _ = np.linalg.qr(q)
            values, inner = np.linalg.eigh(basis.T @ v @ basis)  # Rayleigh-Ritz
            y = basis @ inner
            residuals = np.linalg.norm(v @ y - y * values, axis=0)
            good = (values > low) & (values < high) & (residuals <= CONVERGED * d * norm)
            if good.sum() == count and before:  # one round more than converged
                return values[good], y[:, good]
            before = good.sum() == count
        if size == d:
            break
        size = min(d, 2 * size)
    raise ArithmeticError(f"{int(good.sum())} of {count} eigenvalues found in ({low}, {high})")


@dataclass
class Components:
    n: int
    sums: list[int]
    vectors: np.ndarray      # unit columns, by falling eigenvalue
    values: np.ndarray
    trace: float


def leading_components(fit: DataFrame, wanted: int = COMPONENTS) -> Components:
    """The components of a written fit list (``x``)."""
    spark = fit.sparkSession
    n, sums = exact_sums(fit)
    if not n:
        return Components(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    v = covariance(fit, n, sums)
    d, trace = len(v), float(np.trace(v))
    norm = float(np.abs(v).sum(axis=1).max())      # no eigenvalue is larger
    floor = 16 * d * float(np.finfo(float).eps) * norm  # below: no variance
    if norm == 0 or d == eigenvalues_below(v, floor):
        return Components(n, sums, np.zeros((d, 0)), np.zeros(0), trace)
    top = norm * (1 + 1e-9)
    bound = bound_above(v, wanted, floor, top, APART * norm)
    parts = slices(v, bound, top, APART * norm)
    raw = v.tobytes()  # d * d doubles

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = np.frombuffer(raw).reshape(d, d)
        for b in batches:
            for part in b.to_pylist():
                _, vectors = feast(matrix, part["low"], part["high"], part["count"], norm)
                yield pa.RecordBatch.from_pydict({
                    "vector": pa.array([c.tobytes() for c in vectors.T], pa.binary())})

    found = (spark.createDataFrame(parts, "low double, high double, count int")
             .repartition(len(parts)).mapInArrow(solve, "vector binary").collect())
    basis, _ = np.linalg.qr(np.array([np.frombuffer(r["vector"]) for r in found]).T)
    values, inner = np.linalg.eigh(basis.T @ v @ basis)
    order = np.argsort(values)[::-1][:wanted]
    return Components(n, sums, basis @ inner[:, order], values[order], trace)


def identity_error(fit: DataFrame, c: Components) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity."""
    k = len(c.values)
    if not k:
        return 0.0
    turn = c.vectors / np.sqrt(c.values)

    def products(batches):
        # one more column of ones: the sums for the means
        total = None
        for b in batches:
            w = _centred(_matrix(b), c.n, c.sums) @ turn
            w = np.hstack([w, np.ones((len(w), 1))])
            total = w.T @ w if total is None else total + w.T @ w
        return total

    m = _summed_rows(fit, products, k + 1) / c.n
    return float(np.abs(m[:k, :k] - np.outer(m[k, :k], m[k, :k]) - np.eye(k)).max())


def whiten(rows: DataFrame, c: Components, error: float) -> DataFrame:
    """Every row of ``rows`` (``vec_id, x``) on every component."""
    k = len(c.values)
    if not k:
        return rows.sparkSession.createDataFrame([], RESULT)
    turn = c.vectors / np.sqrt(c.values)
    explained = c.values / c.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b)
            m = len(x)
            apart = _deviations(x, c.n, c.sums)
            if apart.dtype != object and x.shape[1] * int(np.abs(apart).max()) ** 2 < 1 << 63:
                total = pa.array((apart * apart).sum(axis=1), pa.int64())
            else:
                exact = [sum(int(e) ** 2 for e in r) for r in apart]
                total = pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())
            w = (apart / c.n).astype(np.float64) @ turn
            at = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_pydict({
                "vec_id": b.column("vec_id").take(pa.array(at)),
                "component": pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                "n": pa.array(np.full(m * k, c.n), pa.int64()),
                "deviation": total.take(pa.array(at)),
                "whitened": pa.array(w.ravel(), pa.float64()),
                "explained": pa.array(np.tile(explained, m), pa.float64()),
                "identity_error": pa.array(np.full(m * k, error), pa.float64())})

    return rows.mapInArrow(project, RESULT)


def whitened_embeddings(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """Rows of ``vectors`` (``vec_id, embedding``) on the leading components of
    the distinct ones."""
    path = work_dir(vectors.sparkSession, "whitening")
    rows = integer_vectors(vectors)
    rows.select("x").distinct().write.parquet(path)
    fit = vectors.sparkSession.read.parquet(path)
    c = leading_components(fit, wanted)
    return whiten(rows, c, identity_error(fit, c))
