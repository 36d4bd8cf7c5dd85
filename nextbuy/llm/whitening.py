"""Whitening of vectors by sliced spectra (operator 13).

Entries become integers ``floor(64 * c) + 1000000``; the fit list is each
distinct integer vector once.  Spark sums it per dimension, then sums the
centred products (a partial matrix per task).  The leading eigenpairs of the
d x d covariance, whose size no row count changes, are found by slicing:

* the number of negative pivots of an LDL^T factorisation of V - sigma I is the
  number of eigenvalues below sigma (Sylvester's law of inertia), so counts at
  a few shifts isolate each leading eigenvalue in an interval of its own;
* Rayleigh quotient iteration, started inside the interval, converges cubically
  to its eigenvector;
* counts on both sides of the found value certify that it is number k.

Eigenvalues too close to be told apart (``CLUSTER``) share an interval; inverse
iteration with orthogonalisation gives them an orthonormal basis.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from nextbuy.llm.ship import ship
from nextbuy.session import materialize

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
#: Relative width below which eigenvalues count as equal, and share of the trace below which one counts as zero.
CLUSTER, ZERO = 1e-10, 1e-13
#: Entries beyond this have no exact 64-bit form.
LARGEST = 2.0 ** 55


def below(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix that are smaller than ``shift``: negative pivots of LDL^T with 1 x 1 and 2 x 2 blocks."""
    a = matrix - shift * np.eye(len(matrix))
    tiny = np.finfo(float).eps * max(np.abs(matrix).max(), abs(shift), np.finfo(float).tiny)
    count = 0
    while len(a):
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1 if len(column) else 0
        largest = column[r - 1] if r else 0.0
        ratio = (1 + 17 ** 0.5) / 8
        pair = False
        if max(abs(a[0, 0]), largest) <= tiny:
            # a zero column: the eigenvalue lies on the shift, which is not below it
            a = a[1:, 1:]
            continue
        if abs(a[0, 0]) < ratio * largest:
            other = np.abs(a[r]).copy()
            other[r] = 0
            if abs(a[0, 0]) * other.max() < ratio * largest ** 2:
                if abs(a[r, r]) >= ratio * other.max():
                    a = _swapped(a, 0, r)
                else:
                    a = _swapped(a, 1, r)
                    pair = True
        if pair:
            e, c = a[:2, :2], a[2:, :2]
            determinant = e[0, 0] * e[1, 1] - e[0, 1] ** 2
            count += 1 if determinant < 0 else 2 * (e[0, 0] + e[1, 1] < 0)
            a = a[2:, 2:] - c @ np.linalg.solve(e, c.T)
        else:
            count += a[0, 0] < 0
            a = a[1:, 1:] - np.outer(a[1:, 0], a[0, 1:] / a[0, 0])
    return int(count)


def _swapped(a: np.ndarray, i: int, j: int) -> np.ndarray:
    order = np.arange(len(a))
    order[[i, j]] = order[[j, i]]
    return a[np.ix_(order, order)]


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray, size: float) -> np.ndarray:
    for nudge in (0.0, 1.0, 7.0, 63.0):
        try:
            out = np.linalg.solve(matrix - (shift + nudge * np.finfo(float).eps * size) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(out).all():
            return out
    raise ArithmeticError("no shift near the eigenvalue gives a regular matrix")


def _orthonormal(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = np.linalg.qr(x - known @ (known.T @ x))[0]
    return x


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    d = len(matrix)
    wanted = min(wanted, d)
    size = float(np.abs(matrix).sum(axis=1).max())
    if size == 0.0:
        return np.zeros(wanted), np.eye(d)[:, :wanted]
    least = CLUSTER * size
    above = {}

    def over(shift: float) -> int:
        if shift not in above:
            above[shift] = d - below(matrix, shift)
        return above[shift]

    top, bottom = size * (1 + 1e-9), -size * (1 + 1e-9)
    above[top], above[bottom] = 0, d
    rng = np.random.default_rng(13)
    values, vectors = np.zeros(0), np.zeros((d, 0))
    while len(values) < wanted:
        k = len(values) + 1
        low, high = bottom, top
        for shift, count in above.items():
            low, high = (max(low, shift), high) if count >= k else (low, min(high, shift))
        while True:
            inside = over(low) - over(high)
            if over(high) == k - 1 and (inside == 1 or high - low <= least):
                found = _pairs(matrix, low, high, inside, vectors, rng, size)
                if found is not None and _certified(over, found, k, inside, low, high, least):
                    break
                if high - low <= least:
                    raise ArithmeticError(f"eigenvalue {k} is not certified by the counts at its sides")
            middle = (low + high) / 2
            if over(middle) >= k:
                low = middle
            else:
                high = middle
        values, vectors = np.append(values, found[0]), np.hstack([vectors, found[1]])
    return values[:wanted], vectors[:, :wanted]


def _pairs(matrix: np.ndarray, low: float, high: float, many: int, known: np.ndarray, rng: np.random.Generator,
           size: float) -> tuple[np.ndarray, np.ndarray] | None:
    """The eigenpairs of an interval, falling; None if the iteration leaves it."""
    shift = (low + high) / 2
    x = _orthonormal(rng.standard_normal((len(matrix), many)), known)
    for _ in range(2 if many == 1 else 6):
        x = _orthonormal(_solve(matrix, shift, x, size), known)
    if many > 1:
        e = np.einsum("ij,ij->j", x, matrix @ x)
        order = np.argsort(-e)
        return e[order], x[:, order]
    v = x[:, 0]
    for _ in range(30):
        e = float(v @ matrix @ v)
        if not low <= e <= high:
            return None
        if np.linalg.norm(matrix @ v - e * v) <= 4 * np.finfo(float).eps * size * len(v) ** 0.5:
            break
        v = _orthonormal(_solve(matrix, e, v[:, None], size), known)[:, 0]
    return np.array([float(v @ matrix @ v)]), v[:, None]


def _certified(over: Callable[[float], int], found: tuple[np.ndarray, np.ndarray], k: int, many: int,
               low: float, high: float, least: float) -> bool:
    """Whether the values are numbers k .. k + many - 1: by the counts just outside them, within their interval."""
    e = found[0]
    return over(min(high, float(e.max()) + least)) <= k - 1 and over(max(low, float(e.min()) - least)) >= k + many - 1


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, x: the integer vectors of the rows that have one."""
    entry = lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET
    whole = vectors.select("vec_id", "embedding").filter(
        F.col("embedding").isNotNull() & (F.size("embedding") > 0)
        & F.forall("embedding", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST / SCALE), F.lit(False))))
    common = whole.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return whole.filter(F.size("embedding") == (common["d"] if common else 0)).select("vec_id", F.transform("embedding", entry).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            total = _matrix(batch.column(0)).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)).astype(np.int32)), pa.array(total)], names=["i", "s"])


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exactly: 64-bit integers where they hold it, else Python's."""
    if n * (int(np.abs(x).max(initial=0)) + OFFSET) + max(abs(int(s)) for s in sums) < 2 ** 62:
        return n * x - np.array([int(s) for s in sums], np.int64)
    return n * x.astype(object) - np.array([int(s) for s in sums], object)


def _products(n: int, sums: list[int], project: np.ndarray | None) -> Callable:
    """Sums of the products of centred, if asked projected, entries: one matrix for each task, with the entries' sums as last row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            y = (_centred(_matrix(batch.column(0)), n, sums) / n).astype(np.float64)
            y = y if project is None else y @ project
            part = np.vstack([y.T @ y, y.sum(axis=0)])
            total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel())],
                                             names=["i", "j", "v"])
    return run


def _covariance(fit: DataFrame, n: int, sums: list[int], project: np.ndarray | None = None) -> np.ndarray:
    rows = fit.mapInArrow(_products(n, sums, project), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    d = max(r["j"] for r in rows) + 1
    out = np.zeros((d + 1, d))
    for r in rows:
        out[r["i"], r["j"]] = r["v"]
    mean = out[d] / n
    cov = out[:d] / n - np.outer(mean, mean)
    return (cov + cov.T) / 2


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector and component.

    Rows without a whole finite vector are dropped (null vector, null, NaN or
    infinite entries), as are empty vectors, vectors of another length than the
    most common one (of two, the longer) and entries beyond 2^49, which have no
    exact integer form.  Rows that repeat a vector, also under one id, each get
    their rows and count once in the fit; a null id stays null.  Where the
    covariance has a rank below ``components`` there are as many components as
    the rank, so one distinct vector or an empty table gives an empty result.
    A deviation beyond 64 bits is null.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = integer_vectors(vectors)
    fit = materialize(rows.select("x").distinct(), "op13-fit")
    n = fit.count()
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    sums = [int(r["s"]) for r in fit.mapInArrow(_sums, "i int, s long").groupBy("i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()]
    if not sums:
        return spark.createDataFrame([], schema)
    cov = _covariance(fit, n, sums)
    trace = float(np.trace(cov))
    values, axes = leading(cov, components)
    real = values > ZERO * trace
    values, axes = values[real], axes[:, real]
    if not len(values):
        return spark.createDataFrame([], schema)
    project = axes / np.sqrt(values)
    error = float(np.abs(_covariance(fit, n, sums, project) - np.eye(len(values))).max())
    explained = values / trace

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(explained)
        for whole in batches:
            for a in range(0, whole.num_rows, 8192):
                batch = whole.slice(a, 8192)
                y = _centred(_matrix(batch.column(1)), n, sums)
                m = len(y)
                wide = y.dtype == object or int(np.abs(y).max(initial=0)) ** 2 * y.shape[1] >= 2 ** 62
                square = [int(s) for s in (y.astype(object) ** 2).sum(axis=1)] if wide else (y ** 2).sum(axis=1)
                square = pa.array([s if s < 2 ** 63 else None for s in square] if wide else square, pa.int64())
                at = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), square.take(at),
                     pa.array(((y / n).astype(np.float64) @ project).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(apply, schema)
