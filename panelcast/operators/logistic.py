"""Logistic regression by Newton's method: loss, gradient and curvature are summed over the rows, once a step.

``pyspark.ml`` minimises by L-BFGS, which takes hundreds of passes over features of very different sizes.  With a few hundred
features their curvature fits in a small matrix, so each pass sums it and the driver solves for the step; about ten passes
reach the same optimum.  Several penalties share the passes over the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.session import importable_on_workers

#: A model is done when its step would lower the loss by less than this part of it.
DONE = 1e-12
#: Halvings of a step that did not lower the loss.
HALVINGS = 30


def passed(rows: DataFrame, d: int, shift: np.ndarray, scale: np.ndarray, at: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """(loss, gradient, curvature) of each model: a column of ``at``, of which the last row is the intercept.

    ``rows`` has ``d`` features, the label and the weight; sums, not means, of the standardised features."""
    def add(batches):
        total = [[0.0, np.zeros(d + 1), np.zeros((d + 1, d + 1))] for _ in range(at.shape[1])]
        for b in batches:
            x = np.ones((b.num_rows, d + 1))
            for i in range(d):
                x[:, i] = b.column(i).to_numpy(zero_copy_only=False)
            x[:, :d] = (x[:, :d] - shift) / scale
            if np.isnan(x).any():
                raise ValueError("null or NaN in a feature")
            y, w = (b.column(d + i).to_numpy(zero_copy_only=False) for i in (0, 1))
            z = x @ at
            for t, v in zip(total, z.T):
                p = 0.5 * (1 + np.tanh(v / 2))
                t[0] += float(w @ (np.logaddexp(0, v) - y * v))
                t[1] += x.T @ (w * (p - y))
                t[2] += x.T @ (x * (w * p * (1 - p))[:, None])
        sums = [np.concatenate([[a], g, h.ravel()]).tobytes() for a, g, h in total]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums))), pa.array(sums, pa.binary())], names=["model", "sums"])

    size = 1 + (d + 1) + (d + 1) ** 2
    total = np.zeros((at.shape[1], size))
    for r in rows.mapInArrow(add, "model bigint, sums binary").collect():  # one for each of few partitions and model
        total[r["model"]] += np.frombuffer(r["sums"])
    return [(t[0], t[1 : d + 2], t[d + 2 :].reshape(d + 1, d + 1)) for t in total]


def step_of(gradient: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    """The Newton step; directions without curvature (repeated features) are left alone."""
    size = np.sqrt(np.maximum(np.diag(curvature), 1e-300))
    value, vector = np.linalg.eigh(curvature / np.outer(size, size))
    ok = value > max(value[-1], 0) * 1e-13
    return -(vector[:, ok] @ ((vector[:, ok].T @ (gradient / size)) / value[ok])) / size


def fit(df: DataFrame, features: Sequence[str], label: str, estimators: Sequence[LogisticRegression], weight_col: str | None = None) -> list[LogisticRegressionModel]:
    """The models that ``estimators`` (equal but for ``regParam`` and ``maxIter``; L2 penalty on the unscaled features) describe
    of rows with labels 0 and 1.  ``df`` is read once for the scales and once a step, so it should be a written table."""
    spark = df.sparkSession
    importable_on_workers(spark)
    spark.sparkContext.environment.setdefault("OPENBLAS_NUM_THREADS", "1")  # a task has one core
    d = len(features)
    weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    rows = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("double").alias("y"), weight.alias("w"))
    rows = rows.coalesce(4 * spark.sparkContext.defaultParallelism)  # bounds what each pass sends to the driver
    # a row of sums for each partition; columns without spread keep the coefficient 0
    first = rows.mapInArrow(_scales(d), "n double, positive double, weight double, mean binary, square binary").collect()
    n = np.array([r["n"] for r in first])
    mean, square = (np.array([np.frombuffer(r[c]) for r in first]) for c in ("mean", "square"))
    shift = n @ mean / n.sum()
    scale = np.sqrt((square.sum(axis=0) + n @ (mean - shift) ** 2) / n.sum())
    scale[scale <= 1e-14 * np.abs(shift)] = np.inf
    total, positive = sum(r["weight"] for r in first), sum(r["positive"] for r in first)
    ridge = [np.r_[np.where(np.isinf(scale), 0.0, e.getRegParam() / scale**2), 0.0] for e in estimators]
    best = [np.r_[np.zeros(d), np.log(positive / (total - positive))] for _ in estimators]
    state = [_State(b) for b in best]
    for turn in range(max(e.getMaxIter() for e in estimators) + 1):
        open_ = [i for i, s in enumerate(state) if not s.done and turn <= estimators[i].getMaxIter()]
        if not open_:
            break
        tried = [state[i].tried for i in open_]
        for i, at, (loss, gradient, curvature) in zip(open_, tried, passed(rows, d, shift, scale, np.stack(tried, axis=1))):
            state[i].take(at, loss / total + ridge[i] @ at**2 / 2, gradient / total + ridge[i] * at, curvature / total + np.diag(ridge[i]))
    out = []
    for e, s in zip(estimators, state):
        coefficients = s.best[:d] / scale
        out.append(_model(spark, e, coefficients, float(s.best[d] - coefficients @ shift)))
    return out


def _scales(d: int):
    def run(batches):
        n = positive = weight = 0.0
        mean, square = np.zeros(d), np.zeros(d)
        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(d)], axis=1)
            y, w = (b.column(d + i).to_numpy(zero_copy_only=False) for i in (0, 1))
            m, more = x.mean(axis=0), n + len(x)
            square += ((x - m) ** 2).sum(axis=0) + (m - mean) ** 2 * n * len(x) / more
            mean += (m - mean) * len(x) / more
            n, positive, weight = more, positive + float(w @ y), weight + float(w.sum())
        if n:
            yield pa.RecordBatch.from_arrays([*(pa.array([v]) for v in (n, positive, weight)), *(pa.array([v.tobytes()], pa.binary()) for v in (mean, square))],
                                             names=["n", "positive", "weight", "mean", "square"])

    return run


class _State:
    """One model on its way: the best point so far, the point to look at next."""

    def __init__(self, at: np.ndarray):
        self.best, self.loss, self.tried, self.step, self.done, self.halved = at, np.inf, at, None, False, 0

    def take(self, at, loss, gradient, curvature) -> None:
        """What was found at the point tried: go on from it, or halve the step if the loss rose."""
        if not loss <= self.loss * (1 + 1e-13):
            self.step, self.halved = self.step / 2, self.halved + 1
            self.done = self.halved > HALVINGS
        else:
            self.best, self.loss, self.step, self.halved = at, loss, step_of(gradient, curvature), 0
            self.done = -gradient @ self.step / 2 <= DONE * max(loss, 1e-300)
            if self.done:
                self.best = at + self.step
        self.tried = self.best + self.step


def _model(spark, estimator: LogisticRegression, coefficients: np.ndarray, intercept: float) -> LogisticRegressionModel:
    """The model that ``estimator`` would have made, with its settings."""
    held = spark.sparkContext._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        estimator.uid, _py2java(spark.sparkContext, Vectors.dense(coefficients)), intercept)
    return estimator._copyValues(LogisticRegressionModel(held))
