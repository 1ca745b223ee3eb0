"""Whitening of embeddings on their leading principal components.

Entries become integers, so the fit list (every distinct integer vector once) and its sums
are exact.  Spark tasks add up outer products of centred vectors; only the covariance,
whose size depends on the dimensions alone, goes to the driver.  There Householder
reflections make it tridiagonal, Sturm counts and bisection find the leading eigenvalues,
and inverse iteration, orthogonalised inside clusters of close eigenvalues, their vectors.
The components go back to the tasks, which project every row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import bounded_batches, map_batches, pack_scratch

#: Entries beyond this are held at it, so that they are longs.
_MOST = float(1 << 62)
#: Eigenvalues closer than this share of the matrix norm form a cluster.
CLUSTER = 1e-3


def levels(df: DataFrame, id_col: str, vec_col: str, scale: float, shift: int) -> DataFrame:
    """``id, x``: the rows whose vector has entries, all of them finite, as ``floor(scale * c) + shift``."""
    v = F.col(vec_col).cast("array<double>")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    whole = lambda c: F.floor(F.greatest(F.least(c * F.lit(scale), F.lit(_MOST)), F.lit(-_MOST))) + F.lit(shift)
    rows = df.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", finite))
    return rows.select("id", F.transform("v", whole).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Rows of the fit list and their exact sums in each dimension.  A task gives one row a dimension, with the
    upper and lower 31 bits added up apart, so that no sum leaves 64 bits."""

    def run(batches):
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0))
            if len(x):
                n += len(x)
                high += (x >> 31).sum(axis=0)
                low += (x & ((1 << 31) - 1)).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(np.full(dims, n)), pa.array(high), pa.array(low)],
                                             names=["i", "n", "high", "low"])

    bounded_batches(fit.sparkSession)
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = fit.select("x").mapInArrow(run, "i int, n bigint, high bigint, low bigint").groupBy("i").agg(total("n"), total("high"), total("low")).collect()
    out = [0] * dims
    for r in rows:
        out[r["i"]] = (int(r["high"]) << 31) + int(r["low"])
    return (int(rows[0]["n"]) if rows else 0), out


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """``x - total / n``: the whole part is taken off in integers, the fraction in doubles."""
    whole = np.array([s // n for s in total], np.int64)
    part = np.array([(s % n) / n for s in total])
    return (x - whole) - part


def outer_sums(fit: DataFrame, width: int, values) -> np.ndarray:
    """Sum over the fit list of ``values(x)^T values(x)`` (``width`` columns).  Every task adds up its own rows and
    gives the matrix row by row; the matrix rows are added in Spark, in the order of the tasks."""

    def part(batches):
        m, any_ = np.zeros((width, width)), False
        for batch in batches:
            if batch.num_rows:
                y, any_ = values(_matrix(batch.column(0))), True
                m += y.T @ y
        if any_:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, task)), pa.array(list(m), pa.list_(pa.float64()))],
                                             names=["i", "task", "row"])

    def add(batches):
        now, held = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([held], pa.list_(pa.float64()))], names=["i", "row"])
        for batch in batches:
            for i, values_ in zip(batch.column(0).to_pylist(), _matrix(batch.column(2))):
                if i != now:
                    if held is not None:
                        yield row()
                    now, held = i, np.zeros(width)
                held = held + values_
        if held is not None:
            yield row()

    parts = fit.select("x").mapInArrow(part, "i int, task bigint, row array<double>")
    rows = parts.repartition("i").sortWithinPartitions("i", "task").mapInArrow(add, "i int, row array<double>").collect()
    out = np.zeros((width, width))
    for r in rows:
        out[r["i"]] = r["row"]
    return out


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and off-diagonal of ``H a H^T`` and the Householder vectors, first reflection first."""
    a = a.copy()
    d, reflections = len(a), []
    for k in range(d - 2):
        x = a[k + 1:, k]
        v = x.copy()
        norm = np.linalg.norm(x)
        if norm > 0:
            v[0] += np.copysign(norm, x[0])
            v /= np.linalg.norm(v)
            b = a[k + 1:, k + 1:]
            p = b @ v
            w = 2 * (p - (p @ v) * v)
            b -= np.outer(v, w) + np.outer(w, v)
            a[k + 1:, k] = a[k, k + 1:] = 0
            a[k + 1, k] = a[k, k + 1] = -np.copysign(norm, v[0])
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def sturm_count(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of eigenvalues below each of ``at``: negative pivots of ``T - at``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    q = diag[0] - at
    below = (q < 0).astype(np.int64)
    for i in range(1, len(diag)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        with np.errstate(over="ignore"):
            q = diag[i] - at - off[i - 1] ** 2 / q
        below += q < 0
    return below


def leading_values(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection down to neighbouring doubles."""
    reach = np.r_[np.abs(off), 0] + np.r_[0, np.abs(off)]
    span = max(np.abs(diag - reach).max(), np.abs(diag + reach).max()) * (1 + 1e-12) + np.finfo(float).tiny
    low, high = np.full(k, (diag - reach).min() - span * 1e-12), np.full(k, (diag + reach).max() + span * 1e-12)
    want = len(diag) - np.arange(k)  # at the j-th largest value and above, so many lie below
    for _ in range(200):
        mid = low + (high - low) / 2
        if ((mid <= low) | (mid >= high)).all():
            break
        above = sturm_count(diag, off, mid) >= want
        high, low = np.where(above, mid, high), np.where(above, low, mid)
    return low + (high - low) / 2


def _solve(diag: np.ndarray, off: np.ndarray, shift: float, rhs: np.ndarray, least: float) -> np.ndarray:
    """Solution of ``(T - shift) x = rhs`` by elimination with row exchanges; pivots of at least ``least``."""
    n = len(diag)
    a, b, c, y = diag - shift, np.r_[off, 0.0], np.zeros(n), rhs.copy()  # diagonal, first and second upper diagonals
    for i in range(n - 1):
        low = off[i]
        if abs(a[i]) >= abs(low):
            p = a[i] if abs(a[i]) >= least else np.copysign(least, a[i])
            a[i], f = p, low / p
            a[i + 1] -= f * b[i]
            y[i + 1] -= f * y[i]
        else:
            f = a[i] / low
            a[i], b[i], c[i], a[i + 1], b[i + 1] = low, a[i + 1], b[i + 1], b[i] - f * a[i + 1], -f * b[i + 1]
            y[i], y[i + 1] = y[i + 1], y[i] - f * y[i + 1]
    x = np.zeros(n)
    for i in range(n - 1, -1, -1):
        s = y[i]
        if i + 1 < n:
            s -= b[i] * x[i + 1]
        if i + 2 < n:
            s -= c[i] * x[i + 2]
        x[i] = s / (a[i] if abs(a[i]) >= least else np.copysign(least, a[i]))
    return x


def leading_vectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray, seed: int = 3) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix by inverse iteration."""
    rng = np.random.default_rng(seed)
    norm = max(np.abs(diag).max(), np.abs(off).max() if len(off) else 0.0)
    least = np.finfo(float).eps * norm
    out = np.zeros((len(diag), len(values)))
    first = 0
    for j, e in enumerate(values):
        if j and values[j - 1] - e > CLUSTER * norm:
            first = j
        # equal shifts are set apart a little, or every start would go to one direction of the cluster
        shift = min(e, (values[j - 1] - 4 * least)) if j > first else e
        x = rng.normal(size=len(diag))
        for _ in range(5):
            x = _solve(diag, off, shift, x / np.linalg.norm(x), least)
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
            x /= np.linalg.norm(x)
        out[:, j] = x
    return out


def principal(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors (columns); those that are zero
    beside the trace are left out."""
    k = min(k, len(cov))
    trace = np.trace(cov)
    if not len(cov) or not trace > 0:
        return np.zeros(0), np.zeros((len(cov), 0))
    diag, off, reflections = tridiagonal(cov)
    values = leading_values(diag, off, k)
    values = values[values > len(cov) * np.finfo(float).eps * trace]
    vectors = leading_vectors(diag, off, values)
    for i in range(len(reflections) - 1, -1, -1):
        v = reflections[i]
        vectors[i + 1:] -= 2 * np.outer(v, v @ vectors[i + 1:])
    return values, vectors / np.linalg.norm(vectors, axis=0)


@dataclass
class Whitening:
    """Fitted on ``n`` distinct integer vectors with the sums ``total``: ``axes`` are the components over the square
    roots of their ``values``; ``error`` is the largest entry of (covariance of the whitened fit list) - identity."""

    n: int
    total: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float
    error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.total) @ self.axes

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sum over the dimensions of ``(n * x - total)**2``; None beyond 64 bits."""
        n, whole = self.n, np.array([s // self.n for s in self.total], np.int64)
        rest = np.array([s % self.n for s in self.total], np.int64)
        away = x - whole
        most = int(max(abs(int(away.max(initial=0))), abs(int(away.min(initial=0))))) + 1
        if (n * most) ** 2 * x.shape[1] < 1 << 63:
            y = away * n - rest
            return (y * y).sum(axis=1).tolist()
        y = away.astype(object) * n - rest.astype(object)
        return [v if v < 1 << 63 else None for v in (y * y).sum(axis=1).tolist()]


def fit(rows: DataFrame, k: int) -> tuple[Whitening | None, int]:
    """The whitening of ``rows`` (``id, x``) and its dimensions; None without any rows.  Vectors have the length that
    most rows have (of equally common lengths, the smaller)."""
    # copies of a vector meet before the shuffle, so a vector that very many rows share is one row a task
    found = pack_scratch(rows.groupBy("x").agg(F.count(F.lit(1)).alias("rows")), "whiten-fit")
    size = found.groupBy(F.size("x").alias("d")).agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), "d").first()
    if size is None:
        return None, 0
    dims = size["d"]
    each = found.where(F.size("x") == dims)
    n, total = sums(each, dims)
    cov = outer_sums(each, dims, lambda x: centred(x, n, total)) / n
    values, vectors = principal((cov + cov.T) / 2, k)
    model = Whitening(n, total, values, vectors / np.sqrt(values), float(np.trace(cov)), 0.0)
    if len(values):
        # a column of ones beside the whitened values adds up their means
        m = outer_sums(each, len(values) + 1, lambda x: np.c_[model.project(x), np.ones(len(x))]) / n
        model.error = float(np.abs(m[:-1, :-1] - np.outer(m[:-1, -1], m[:-1, -1]) - np.eye(len(values))).max())
    return model, dims


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 16, scale: float = 64.0,
           shift: int = 1_000_000) -> DataFrame:
    """Every row's coordinates on the ``k`` leading components, scaled to unit variance.

    Returns a row for each input row and component: ``id_col, component`` (from 1, by falling eigenvalue), ``n``
    (distinct vectors fitted on), ``deviation`` (exact sum of ``(n * x - S)**2``; null where it passes 64 bits),
    ``whitened``, ``explained`` (share of the trace) and ``identity_error`` (one value).  Components are the
    eigenvectors of the covariance of the distinct integer vectors; those with an eigenvalue of zero (fewer
    dimensions or vectors than ``k``) are left out, so vectors that are all equal give an empty result.

    Rows whose vector is null, empty or of another length than most, or holds null or non-finite entries, are
    dropped; entries beyond 2^62 / scale count as that.  Null ids pass through; repeated rows are each returned and
    count once in the fit.  Further columns are not read; an empty table gives an empty result.  The fit runs jobs
    when this is called.
    """
    rows = levels(df, id_col, vec_col, scale, shift)
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    model, dims = fit(rows, k)
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    k = len(model.values)

    def run(batch):
        x = _matrix(batch.column(1))
        m = len(x)
        if not m:
            return
        at = pa.array(np.repeat(np.arange(m), k))
        columns = [batch.column(0).take(at), np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, model.n),
                   pa.array(model.deviations(x), pa.int64()).take(at), model.project(x).ravel(),
                   np.tile(model.values / model.trace, m), np.full(m * k, model.error)]
        yield dict(zip(names, columns))

    return map_batches(rows.where(F.size("x") == dims), run, schema)
