"""Model matrix, estimators, forward-chaining grid search, SMOTE and scoring (pyspark.ml).

Fitting runs on the executors; the driver only loops over parameter maps
and folds.  The training table is checkpointed into the shared checkpoint
folder before a search so every fit starts from a short lineage.
"""

from __future__ import annotations

import itertools
import threading
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.expressions import q, risk_tier
from panelcast.operators import logistic, nearest, trees
from panelcast.operators.labels import cv_blocks
from panelcast.operators.metrics import confusion

# ---- fixed values: columns that never are features, model settings, search grids --
DEFAULT_DROP = ["account_id", "month", "last_touchbase_date", "churned", "enabled_channels"]
# Logistic regression takes C (inverse L2 strength, per-sample loss summed) and is
# mapped to Spark's regParam = 1 / (C * n_rows) (mean loss), the same optimum.
LR_DEFAULTS = {"maxIter": 1000, "C": 1.0}
RF_DEFAULTS = {"numTrees": 100, "maxDepth": 20, "minInstancesPerNode": 1}
GBT_DEFAULTS = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1}
LR_GRID = {"C": [0.01, 0.1, 1.0, 10.0]}
# unlimited depth -> Spark's maximum of 30
RF_GRID = {"numTrees": [100, 200], "maxDepth": [10, 20, 30], "minSamplesSplit": [2, 5], "minInstancesPerNode": [1, 2]}
GBT_GRID = {"maxIter": [100, 200], "maxDepth": [3, 5, 7], "stepSize": [0.01, 0.1, 0.3], "subsamplingRate": [0.8, 1.0]}
# -----------------------------------------------------------------------------------

# SMOTE: rows of one partition of the smaller class.
SMOTE_PARTITION_ROWS = 2_000


def model_columns(df: DataFrame, drop_cols: Sequence[str] | None = None, label: str = "churned") -> list[str]:
    """Numeric columns left after dropping ids, raw dates, label and extras."""
    drop = set(DEFAULT_DROP) | set(drop_cols or []) | {label}
    numeric = ("int", "bigint", "double", "float", "smallint", "tinyint", "long", "integer")
    return [
        f.name
        for f in df.schema.fields
        if f.name not in drop and f.dataType.simpleString() in numeric
    ]


def model_matrix(
    df: DataFrame,
    label: str = "churned",
    drop_cols: Sequence[str] | None = None,
    ids: Sequence[str] = ("account_id", "month"),
    require_label: bool = True,
) -> DataFrame:
    """ids + scrubbed double features (NaN/inf/NULL -> 0) + label as double."""
    feats = model_columns(df, drop_cols, label)
    exprs = [q(i) for i in ids if i in df.columns]
    for f in feats:
        x = f"CAST({q(f)} AS DOUBLE)"
        # NaN is larger than infinity: one comparison leaves out null, NaN and both infinities
        exprs.append(f"CASE WHEN abs({x}) < double('inf') THEN {x} ELSE 0.0D END AS {q(f)}")
    if label in df.columns:
        exprs.append(f"CAST({q(label)} AS DOUBLE) AS {q(label)}")
    elif require_label:
        raise ValueError(f"label column {label!r} missing")
    return df.selectExpr(*exprs)


def make_estimator(
    kind: str, label: str = "churned", weight_col: str | None = None, seed: int = 42, n_rows: int | None = None, **params
):
    kind = kind.lower()
    common = {"featuresCol": "features", "labelCol": label}
    if weight_col:
        common["weightCol"] = weight_col
    if kind in ("lr", "logistic"):
        p = {**LR_DEFAULTS, **params}
        c = p.pop("C", None)
        if "regParam" not in params and c is not None:
            if not n_rows:
                raise ValueError("C needs the number of training rows (n_rows)")
            p["regParam"] = 1.0 / (float(c) * n_rows)
        est = LogisticRegression(elasticNetParam=0.0, standardization=False, **common, **p)
    elif kind in ("rf", "random_forest"):
        p = {**RF_DEFAULTS, **params}
        p["maxDepth"] = min(int(p["maxDepth"]), 30)
        est = RandomForestClassifier(seed=seed, **common, **p)
    elif kind in ("gbt", "xgb", "boosting"):
        est = GBTClassifier(seed=seed, lossType="logistic", **common, **{**GBT_DEFAULTS, **params})
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    return est


class Prepared:
    """What the fits of a tree grid on the same rows share: how many there are, cuts and binned rows, found once."""

    def __init__(self):
        self._lock, self._held = threading.Lock(), {}

    def get(self, key, make):
        with self._lock:
            if key not in self._held:
                self._held[key] = make()
            return self._held[key]


def fit(df: DataFrame, features: Sequence[str], kind: str, label: str = "churned", weight_col=None, shared: Prepared | None = None,
        **params) -> PipelineModel:
    """The fitted pipeline.  A forest on labels 0 and 1 grows its small nodes where their rows meet (``forest``), unless it
    takes weights, settings that ``forest`` does not know or a single tree.  Boosting on labels 0 and 1 takes its sums from
    blocks of binned rows (``boosting``), unless it takes weights, settings that ``boosting`` does not know or deeper trees.
    Fits of the same rows, features and label may have ``shared`` in common."""
    if kind.lower() in ("lr", "logistic"):
        return fit_logistic(df, features, [params], label, weight_col)[0]
    shared = shared or Prepared()
    counts = lambda: tuple(df.agg(F.count(F.lit(1)), F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first())
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    est = make_estimator(kind, label=label, weight_col=weight_col, **params)
    if isinstance(est, RandomForestClassifier) and weight_col is None and set(params) <= set(RF_DEFAULTS) and est.getNumTrees() > 1:
        from panelcast.operators import forest

        n, pos, neg = shared.get("counts", counts)
        if n == pos + neg and pos and neg:
            ready = shared.get("forest", lambda: forest.prepared(df, features, label, n, est.getSeed()))
            return PipelineModel([assembler, forest.fit(df, features, label, est, n, pos, ready=ready)])
    if isinstance(est, GBTClassifier) and weight_col is None and set(params) <= set(GBT_GRID):
        from panelcast.operators import boosting

        n, pos, neg = shared.get("counts", counts)
        if n == pos + neg and pos and neg and 1 <= est.getMaxDepth() <= boosting.DEEPEST:
            ready = shared.get("boosting", lambda: boosting.prepared(df, features, label, n, est.getSeed()))
            return PipelineModel([assembler, boosting.fit(df, features, label, est, n, ready)])
    return Pipeline(stages=[assembler, est]).fit(df)


def fit_logistic(df: DataFrame, features: Sequence[str], settings: Sequence[dict], label: str = "churned", weight_col=None) -> list[PipelineModel]:
    """The fitted pipelines of several settings; on labels 0 and 1 they share Newton passes (``logistic``), unless a setting is
    none of ``LR_DEFAULTS`` and ``regParam``."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    n, pos, neg = df.agg(F.count(F.lit(1)), F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first()
    ests = [make_estimator("lr", label=label, weight_col=weight_col, n_rows=n, **p) for p in settings]  # regParam = 1 / (C * n)
    if n == pos + neg and pos and neg and all(set(p) <= {*LR_DEFAULTS, "regParam"} for p in settings):
        return [PipelineModel([assembler, m]) for m in logistic.fit(df, features, label, ests, weight_col)]
    return [Pipeline(stages=[assembler, e]).fit(df) for e in ests]


def probability_of_positive(pred: DataFrame, out: str = "p1") -> DataFrame:
    return pred.select("*", vector_to_array("probability")[1].alias(out))


def score_model(
    model: PipelineModel,
    df: DataFrame,
    threshold: float | None = None,
    ids: Sequence[str] = ("account_id", "month"),
    include_risk_tiers: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """churn_risk_score, prediction (score >= threshold, or the model's own decision),
    safe_probability and risk_tier; the keys ride along (no positional concat)."""
    out = model.transform(df)
    prob = vector_to_array("probability")
    score = prob[1]
    pred = F.col("prediction").cast("int") if threshold is None else (score >= F.lit(threshold)).cast("int")
    cols = [*[i for i in ids if i in df.columns], *keep]
    cols += [score.alias("churn_risk_score"), pred.alias("prediction"), prob[0].alias("safe_probability")]
    res = out.select(*cols)
    if include_risk_tiers:
        res = res.select("*", risk_tier("churn_risk_score").alias("risk_tier"))
    return res


def feature_importance(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """(feature, importance) from a tree model; ValueError when the model has none."""
    last = model.stages[-1]
    if not hasattr(last, "featureImportances"):
        raise ValueError(f"Model {type(last).__name__} does not have feature importances")
    imp = last.featureImportances.toArray()
    return list(zip(features, [float(v) for v in imp]))


def positive_f1(pred: DataFrame, label: str = "churned", prediction: str = "prediction") -> float:
    row = confusion(pred, label, prediction).first()
    tp, fp, fn = row["tp"] or 0, row["fp"] or 0, row["fn"] or 0
    den = 2 * tp + fp + fn
    return 2 * tp / den if den else 0.0


def param_maps(grid: dict[str, list]) -> list[dict]:
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]


#: Settings that one larger fit answers as well, and what they are called where its nodes are cut.
DERIVED = {"rf": {"numTrees": "n_trees", "maxDepth": "max_depth", "minSamplesSplit": "min_split"}, "gbt": {"maxIter": "n_trees"}, "lr": {}}


def fit_groups(kind: str, maps: list[dict]) -> list[tuple[dict, list[int]]]:
    """What has to be fitted for all parameter maps: (settings of the fit, the maps that it answers).  A forest's first
    trees are a smaller forest, its trees cut at a depth or at small nodes are those grown with that bound, and the
    first rounds of boosting are a shorter boosting."""
    groups: dict[tuple, list[int]] = {}
    for i, m in enumerate(maps):
        groups.setdefault(tuple(sorted((k, v) for k, v in m.items() if k not in DERIVED[kind])), []).append(i)
    out = []
    for fixed, members in groups.items():
        largest = {k: max(maps[i][k] for i in members) for k in DERIVED[kind] if k in maps[members[0]] and k != "minSamplesSplit"}
        out.append(({**dict(fixed), **largest}, members))
    return out


def grid_search(
    df: DataFrame,
    features: Sequence[str],
    kind: str,
    grid: dict[str, list],
    label: str = "churned",
    period: str = "month",
    n_splits: int = 3,
    resample: str = "none",
    seed: int = 42,
    parallelism: int = 4,
):
    """Forward-chaining CV by period blocks (train on blocks < f, validate on f), positive-class F1, refit of the best
    map on all rows.

    Maps that differ only in the number of trees or rounds, or (forest) in depth or in the least rows of a split node,
    share one fit in each fold (``fit_groups``): the validation rows walk its trees once, and all those maps' predictions
    are taken on the way (``trees.staged_confusions``).  The fits of a fold bin its rows once.  Logistic maps of a fold are fitted in the same passes.  Resampling (SMOTE) is applied inside each training fold only, so
    synthetic rows never reach a validation fold.  Returns (model, best params, scores); the scores have ``params,
    mean_f1`` and ``n_fits``, the fits of the whole search.
    """
    from panelcast.session import materialize

    kind = {"logistic": "lr", "random_forest": "rf", "xgb": "gbt", "boosting": "gbt"}.get(kind.lower(), kind.lower())
    data = materialize(cv_blocks(df, n_splits, period), "cv-blocks")
    maps = param_maps(grid)
    groups = fit_groups(kind, maps)
    folds = {}
    for fold in range(1, n_splits + 1):  # balanced once a fold, not once a fit
        train = data.where(F.col("cv_block") < fold)
        folds[fold] = materialize(smote(train, features, label, seed=seed), "cv-train") if resample == "smote" else train

    shared = {fold: Prepared() for fold in folds}

    def evaluate(job):
        (params, members), fold = job
        valid = data.where(F.col("cv_block") == fold)
        if kind == "lr":
            models = fit_logistic(folds[fold], features, [maps[i] for i in members], label)
            return [(i, positive_f1(m.transform(valid), label)) for i, m in zip(members, models)]
        model = fit(folds[fold], features, kind, label, shared=shared[fold], **params)
        if len(members) == 1 and "minSamplesSplit" not in maps[members[0]]:
            return [(members[0], positive_f1(model.transform(valid), label))]
        settings = [{DERIVED[kind][k]: v for k, v in maps[i].items() if k in DERIVED[kind]} for i in members]
        counts = trees.staged_confusions(trees.ensemble(model), settings, valid, features, label)
        return [(i, 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0) for i, (tp, fp, fn) in zip(members, counts)]

    # independent fits run as concurrent Spark jobs (like CrossValidator's parallelism)
    n_fits = len(groups) * len(folds) + 1
    jobs = [(g, fold) for g in ([({}, list(range(len(maps))))] if kind == "lr" else groups) for fold in folds]
    scores: dict[int, list[float]] = {i: [] for i in range(len(maps))}
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for found in pool.map(evaluate, jobs):
            for i, f1 in found:
                scores[i].append(f1)
    rows = [(str(maps[i]), float(np.mean(scores[i])), n_fits) for i in range(len(maps))]
    best = maps[int(np.argmax([r[1] for r in rows]))]
    full = materialize(smote(data, features, label, seed=seed), "cv-full") if resample == "smote" else data
    model = fit(full, features, kind, label, **{k: v for k, v in best.items() if k != "minSamplesSplit"})
    if best.get("minSamplesSplit", 2) > 2:
        model = trees.TreeModel(trees.ensemble(model).pruned(min_split=best["minSamplesSplit"]), features)
    table = df.sparkSession.createDataFrame(rows, "params string, mean_f1 double, n_fits int")
    return model, best, table


def _mixed(seed: int, i: np.ndarray, j: np.ndarray, salt: int) -> np.ndarray:
    """64 pseudo-random bits for every (row, copy)."""
    with np.errstate(over="ignore"):
        x = i.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + j.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        x += np.uint64((seed * 0x165667B19E3779F9 + salt * 0x27D4EB2F165667C5) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def smote(df: DataFrame, features: Sequence[str], label: str = "churned", k: int = 5, seed: int = 42, block_rows: int = nearest.BLOCK) -> DataFrame:
    """Oversample the smaller class, whichever it is, to 1:1 with SMOTE.

    Returns the features and the label as doubles: all rows of ``df`` and one synthetic row for
    each row that the smaller class lacks.  A row's neighbours are its k nearest of all rows of
    the smaller class, exactly, found by ``nearest.nearest_rows`` (blocks of ``block_rows`` rows).
    Every row makes its even share of the synthetic rows, at a seeded place on the line to a
    seeded neighbour.  With fewer than two rows in a class, or none lacking, nothing is added.
    """
    from panelcast.session import materialize

    feats = list(features)
    original = df.select(*[F.col(f).cast("double").alias(f) for f in feats], F.col(label).cast("double").alias(label))
    counts = {int(r[0]): r[1] for r in original.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    small = 1 if counts.get(1, 0) <= counts.get(0, 0) else 0
    n, n_new = counts.get(small, 0), abs(counts.get(1, 0) - counts.get(0, 0))
    if n < 2 or n_new == 0:
        return original
    rows = original.where(F.col(label) == small).drop(label)
    parts = -(-n // SMOTE_PARTITION_ROWS)
    order = rows.select(*feats, F.xxhash64(*feats).alias("_key")).repartitionByRange(parts, "_key").sortWithinPartitions("_key").drop("_key")
    schema = T.StructType([T.StructField(f, T.DoubleType()) for f in feats])
    placed_schema = T.StructType([*schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_pos", T.LongType())])

    def number(batches):
        from pyspark import TaskContext

        part, pos = TaskContext.get().partitionId(), 0
        for pdf in batches:
            yield pdf.assign(_part=np.int32(part), _pos=np.arange(pos, pos + len(pdf)))
            pos += len(pdf)

    numbered = materialize(order.mapInPandas(number, placed_schema), "smote-rows")
    base, at = [], 0
    for r in sorted(numbered.groupBy("_part").count().collect()):
        base.append((r[0], at))
        at += r[1]
    first = F.broadcast(df.sparkSession.createDataFrame(base, "_part int, _first bigint"))
    placed = numbered.join(first, "_part").select(*feats, (F.col("_pos") + F.col("_first")).alias("_i"))

    def drawn(batches):
        for pdf in batches:
            i = pdf["_i"].to_numpy()
            share = (i + 1) * n_new // n - i * n_new // n
            row = np.repeat(np.arange(len(i)), share)
            copy = np.arange(len(row)) - np.repeat(np.cumsum(share) - share, share)
            near, size = pdf["_near"].to_numpy(), np.array([len(x) for x in pdf["_near"]], np.int64)
            which = (_mixed(seed, i[row], copy, 1) % size[row].astype(np.uint64)).astype(np.int64)
            u = (_mixed(seed, i[row], copy, 2) >> np.uint64(11)).astype(float) / float(1 << 53)
            yield pd.DataFrame({"_i": i[row], "_j": [near[r][w] for r, w in zip(row, which)], "_u": u})

    placed = materialize(placed, "smote-placed")
    near, _ = nearest.nearest_rows(placed, "_i", feats, k, block=block_rows)
    draws = near.withColumnRenamed("near", "_near").mapInPandas(drawn, "_i bigint, _j bigint, _u double")
    to = placed.select(F.col("_i").alias("_j"), *[F.col(f).alias(f"_to_{n}") for n, f in enumerate(feats)])
    lines = draws.join(placed, "_i").join(to, "_j")
    synthetic = lines.select(
        *[(F.col(f) + F.col("_u") * (F.col(f"_to_{n}") - F.col(f))).alias(f) for n, f in enumerate(feats)], F.lit(float(small)).alias(label))
    return original.unionByName(synthetic)


def train_and_compare(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    kinds: Sequence[str] = ("lr", "rf", "gbt"),
    label: str = "churned",
    params: dict[str, dict] | None = None,
    resample: str = "smote",
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit each model kind on balanced training rows (``resample="none"``: as they are), score the
    test rows, return models and the long predictions table (model_name, ids, score, prediction, label)."""
    from panelcast.session import materialize

    params = params or {}
    tr = smote(train, features, label) if resample == "smote" else train
    tr = materialize(tr, "smote-train")
    models, parts = {}, []
    for kind in kinds:
        m = fit(tr, features, kind, label, **params.get(kind, {}))
        models[kind] = m
        s = score_model(m, test, threshold=None, keep=[label]).select(F.lit(kind).alias("model_name"), "*")
        parts.append(s)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return models, out
