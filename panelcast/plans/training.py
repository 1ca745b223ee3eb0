"""Model training, evaluation, persistence and I/O queries.

Fitted models are not reproducible across engines, so most of these are
rows-only checks; the I/O round trips and the segment export have oracles.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelcast.functions.expressions import round_half_away
from panelcast.operators import drivers, explain, labels, metrics, ml, scoring, trees
from panelcast.operators.features import generate_features
from panelcast.plans.catalog import (
    EVAL_LABEL,
    TOP_N_EXPLAIN,
    TOP_N_FEATURES,
    _segments,
    features_o,
    panel_o,
    query,
    scored_narrow,
)
from panelcast.session import checkpoint_dir, materialize, scratch_root
from panelcast.sources import io

# ---- parameters of the registered training queries -----------------------------
TRAIN_MONTHS = 40
TEST_HORIZON = 12  # periods kept back at the end (churn is observable 12 months late)
# The models' own settings (``ml.LR_DEFAULTS`` and so on) unless a query says otherwise.
LR_PARAMS: dict = {}
RF_PARAMS: dict = {}
GBT_PARAMS: dict = {}
LR_SEARCH_GRID = ml.LR_GRID
# All axes of ``ml.RF_GRID`` (24 maps, 2 fits a fold) with a tenth of its trees; of ``ml.GBT_GRID`` the rounds' axis at a
# tenth, both lesser depths and the two larger rates.  The operators take the whole grids (README: what those cost).
RF_SEARCH_GRID = {**ml.RF_GRID, "numTrees": [10, 20]}
GBT_SEARCH_GRID = {"maxIter": [10, 20], "maxDepth": [3, 5], "stepSize": [0.1, 0.3]}
# ---------------------------------------------------------------------------------


def train_test(spark, d):
    """Horizon label as target (helper dropped), chronological split, model matrix;
    written once so every fit and scoring pass starts from a short lineage.  The panel is written
    first: the split's period table (counted, then joined) reads it as well as the features."""
    panel = materialize(panel_o(spark, d), "train-panel")
    f = labels.swap_label(labels.horizon_labels(generate_features(panel, check_empty=False), horizon=3), EVAL_LABEL, "churned")
    s = labels.time_split_horizon(f, TRAIN_MONTHS, horizon=TEST_HORIZON)
    mm = ml.model_matrix(s, label="churned", ids=("account_id", "month", "split"))
    return materialize(mm, "train-test")


def _features(mm):
    return [c for c in mm.columns if c not in ("account_id", "month", "split", "churned")]


def balanced_fit(mm, kind, params):
    """A model of the balanced training rows."""
    feats = _features(mm)
    train = materialize(ml.smote(mm.where(F.col("split") == "train"), feats, "churned"), "balanced-train")
    return ml.fit(train, feats, kind, "churned", **params)


def _fit_and_score(spark, d, kind, params):
    mm = train_test(spark, d)
    model = balanced_fit(mm, kind, params)
    return ml.score_model(model, mm.where(F.col("split") == "test"), threshold=None, keep=["churned"])


@query("train_lr")
def q_train_lr(spark, d):
    return _fit_and_score(spark, d, "lr", LR_PARAMS)


@query("train_rf")
def q_train_rf(spark, d):
    return _fit_and_score(spark, d, "rf", RF_PARAMS)


@query("train_gbt")
def q_train_gbt(spark, d):
    return _fit_and_score(spark, d, "gbt", GBT_PARAMS)


@query("train_lr_weighted")
def q_train_lr_weighted(spark, d):
    """Class weights n / (2 n_class) instead of resampling."""
    mm = train_test(spark, d)
    feats = _features(mm)
    train = labels.class_weights(mm.where(F.col("split") == "train"), "churned")  # from the training rows only
    model = ml.fit(train, feats, "lr", "churned", weight_col="class_weight", **LR_PARAMS)
    return ml.score_model(model, mm.where(F.col("split") == "test"), threshold=None, keep=["churned"])


@query("evaluate_fitted")
def q_evaluate_fitted(spark, d):
    """Fit LR / RF / GBT on the train months, metrics on the test months."""
    mm = train_test(spark, d)
    feats = _features(mm)
    _, pred = ml.train_and_compare(
        mm.where(F.col("split") == "train"),
        mm.where(F.col("split") == "test"),
        feats,
        kinds=("lr", "rf", "gbt"),
        label="churned",
        params={"lr": LR_PARAMS, "rf": RF_PARAMS, "gbt": GBT_PARAMS},
    )
    return metrics.classification_metrics(materialize(pred, "fitted-predictions"), "churned", group="model_name")


@query("threshold_fitted")
def q_threshold_fitted(spark, d):
    """Best-F1 threshold per fitted model (LR / RF / GBT) in one grouped job."""
    mm = train_test(spark, d)
    feats = _features(mm)
    _, pred = ml.train_and_compare(
        mm.where(F.col("split") == "train"),
        mm.where(F.col("split") == "test"),
        feats,
        kinds=("lr", "rf", "gbt"),
        label="churned",
        params={"lr": LR_PARAMS, "rf": RF_PARAMS, "gbt": GBT_PARAMS},
    )
    return metrics.optimal_threshold(materialize(pred, "fitted-predictions"), label="churned", metric="f1", group="model_name")


def _searched(spark, d, kind, grid):
    """Forward-chaining CV over period blocks of the balanced train months, positive-class F1; the best map's
    refitted model scores the test months.  One row for each map."""
    mm = train_test(spark, d)
    model, best, table = ml.grid_search(
        mm.where(F.col("split") == "train"), _features(mm), kind, grid, label="churned", n_splits=3, resample="smote")
    scored = ml.score_model(model, mm.where(F.col("split") == "test"), threshold=None, keep=["churned"])
    f1 = ml.positive_f1(scored, "churned")
    return table.select("params", "mean_f1", "n_fits", (F.col("params") == str(best)).alias("best"),
                        F.when(F.col("params") == str(best), F.lit(f1)).alias("test_f1"))


@query("grid_search_lr")
def q_grid_search(spark, d):
    return _searched(spark, d, "lr", LR_SEARCH_GRID)


@query("grid_search_rf")
def q_grid_search_rf(spark, d):
    return _searched(spark, d, "rf", RF_SEARCH_GRID)


@query("grid_search_gbt")
def q_grid_search_gbt(spark, d):
    return _searched(spark, d, "gbt", GBT_SEARCH_GRID)


@query("smote_train")
def q_smote(spark, d):
    mm = train_test(spark, d)
    return ml.smote(mm.where(F.col("split") == "train"), _features(mm), "churned", k=5, seed=42)


@query("stratified_split")
def q_stratified(spark, d):
    lab = labels.horizon_labels(panel_o(spark, d), horizon=3)
    return labels.stratified_split(lab.select("account_id", "month", EVAL_LABEL), EVAL_LABEL, 0.8, seed=42)


@query("importance_topn")
def q_importance_topn(spark, d):
    """Top features of a random forest fitted on the balanced rows, with their category."""
    mm = train_test(spark, d)
    feats = _features(mm)
    model = balanced_fit(mm, "rf", RF_PARAMS)
    imp = drivers.importance_frame(spark, *zip(*ml.feature_importance(model, feats)))
    return drivers.top_features(imp, TOP_N_FEATURES)


def _occluded(spark, d, kind, params):
    """Score change of a fitted model when each feature is set to the safe mean, top-risk test rows."""
    mm = train_test(spark, d)
    feats = _features(mm)
    model = balanced_fit(mm, kind, params)
    test = mm.where(F.col("split") == "test")
    scored = materialize(ml.score_model(model, test, threshold=None, keep=feats), "attribution-scores")
    top = scoring.top_risk(scored, TOP_N_EXPLAIN)
    stats = explain.class_stats(test, feats, "churned")
    return explain.occlusion_attribution(model, top, stats, feats)


ATTRIBUTION_TREES = {"numTrees": 20, "maxDepth": 8}


@query("occlusion_attribution")
def q_occlusion(spark, d):
    return _occluded(spark, d, "lr", LR_PARAMS)


@query("occlusion_attribution_rf")
def q_occlusion_rf(spark, d):
    """The same for a forest (smaller than the default: only its attribution is looked at)."""
    return _occluded(spark, d, "rf", ATTRIBUTION_TREES)


def _path_attribution(spark, d, kind, params):
    """The largest contributions to the margin of the top-risk test rows, by the paths through the trees of a model of
    the balanced rows."""
    mm = train_test(spark, d)
    feats = _features(mm)
    test = mm.where(F.col("split") == "test")
    split = materialize(trees.path_attribution(balanced_fit(mm, kind, params), test, feats), "path-attribution")
    return trees.top_contributions(scoring.top_risk(split, TOP_N_EXPLAIN), feats, TOP_N_FEATURES)


@query("path_attribution_rf")
def q_path_rf(spark, d):
    return _path_attribution(spark, d, "rf", RF_PARAMS)


@query("path_attribution_gbt")
def q_path_gbt(spark, d):
    return _path_attribution(spark, d, "gbt", GBT_PARAMS)


@query("tree_invariants")
def q_tree_invariants(spark, d):
    """What holds for any tree model: rows whose contributions miss the margin less the base, rows whose node-table score
    differs from the model's own, rows whose staged score differs from that of the ensemble cut to it, and split nodes
    under the bound after pruning."""
    mm = train_test(spark, d)
    feats = _features(mm)
    test = mm.where(F.col("split") == "test")
    parts = []
    for kind, params, cut in (("rf", {"numTrees": 12, "maxDepth": 8}, {"max_depth": 4, "min_split": 40, "n_trees": 5}),
                              ("gbt", {"maxIter": 8, "maxDepth": 4}, {"n_trees": 3})):
        model = ml.fit(mm.where(F.col("split") == "train"), feats, kind, "churned", **params)
        whole = trees.ensemble(model)
        small = whole.pruned(**cut)
        under = int(((small.left >= 0) & (small.rows < cut.get("min_split", 2))).sum())
        total = F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
        split = trees.path_attribution(whole, test, feats).select("account_id", "month", (total - F.col("margin") + F.col("base")).alias("miss"), "churn_risk_score")
        own = ml.score_model(model, test, threshold=None).select("account_id", "month", F.col("churn_risk_score").alias("own"))
        one = ml.score_model(trees.TreeModel(small, feats), test, threshold=None, keep=["churned"])
        f1 = ml.confusion(one, "churned", "prediction").first()
        staged = trees.staged_confusions(whole, [cut], test, feats, "churned")[0]
        parts.append(split.join(own, ["account_id", "month"]).agg(
            F.lit(kind).alias("model_name"), F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.abs("miss") > 1e-9).alias("n_not_additive"),
            F.count_if(F.abs(F.col("churn_risk_score") - F.col("own")) > 1e-9).alias("n_score_differs"),
            F.lit(int(staged != (f1["tp"] or 0, f1["fp"] or 0, f1["fn"] or 0))).cast("bigint").alias("n_staged_differs"),
            F.lit(under).cast("bigint").alias("n_split_under_bound")))
    return parts[0].unionByName(parts[1])


@query("smote_balance")
def q_smote_balance(spark, d):
    """Class counts of the training rows before and after balancing."""
    mm = train_test(spark, d)
    train = mm.where(F.col("split") == "train")
    after = ml.smote(train, _features(mm), "churned", k=5, seed=42)
    count = lambda df, stage: df.groupBy(F.col("churned").cast("int").alias("churned")).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(stage).alias("stage"), "churned", "n_rows")
    return count(train, "before").unionByName(count(after, "after"))


@query("model_invariants")
def q_model_invariants(spark, d):
    """What holds for any fitted model: rows and positives scored, scores outside [0, 1], predictions and tiers
    that do not follow from the score, and rows whose score changes when the model is saved and loaded."""
    mm = train_test(spark, d)
    feats = _features(mm)
    test = mm.where(F.col("split") == "test")
    parts = []
    for kind, params in (("lr", {"maxIter": 50}), ("rf", {"numTrees": 10, "maxDepth": 5}), ("gbt", {"maxIter": 5, "maxDepth": 3})):
        model = ml.fit(mm.where(F.col("split") == "train"), feats, kind, "churned", **params)
        path = io.save_model(model, f"{checkpoint_dir(spark).rstrip('/')}/models/{kind}-{uuid.uuid4().hex}")
        a = ml.score_model(model, test, threshold=0.5, keep=["churned"])
        b = ml.score_model(io.load_model(path), test, threshold=0.5).select("account_id", "month", F.col("churn_risk_score").alias("again"))
        tier = F.when(F.col("churn_risk_score") >= 0.7, "High Risk").when(F.col("churn_risk_score") >= 0.4, "Medium Risk").when(
            F.col("churn_risk_score") >= 0.2, "Low Risk").otherwise("Very Safe")
        parts.append(a.join(b, ["account_id", "month"]).agg(
            F.lit(kind).alias("model_name"),
            F.count(F.lit(1)).alias("n_scored"),
            F.sum("churned").cast("bigint").alias("n_positive"),
            F.count_if(~F.col("churn_risk_score").between(0, 1)).alias("n_outside"),
            F.count_if(F.col("prediction") != (F.col("churn_risk_score") >= 0.5).cast("int")).alias("n_prediction_differs"),
            F.count_if(F.col("risk_tier") != tier).alias("n_tier_differs"),
            F.count_if(F.abs(F.col("churn_risk_score") - F.col("again")) > 1e-12).alias("n_changed_by_reload"),
        ))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query("sinks_roundtrip")
def q_sinks(spark, d):
    """Predictions (alone and with the original columns), metrics and thresholds written and read back."""
    s = scored_narrow(spark, d)
    base = f"{scratch_root(spark)}/io/{uuid.uuid4().hex}"
    pred = s.select("account_id", "month", "churn_risk_score", "prediction", "risk_tier")
    count = lambda df, sink, *c: df.agg(
        F.lit(sink).alias("sink"), F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.sum(F.col(c[0]).cast("double")).alias("total"))
    out = count(spark.read.option("header", True).csv(io.save_predictions(pred, f"{base}/pred.csv")), "predictions", "prediction")
    both = spark.read.parquet(io.save_predictions(pred, f"{base}/both.parquet", original=panel_o(spark, d), fmt="parquet"))
    out = out.unionByName(count(both, "predictions_with_originals", "prediction"))
    m = metrics.classification_metrics(s, EVAL_LABEL)
    out = out.unionByName(count(spark.read.json(io.save_metrics(m, f"{base}/metrics.json")), "metrics", "tp"))
    t = metrics.optimal_threshold(s, label=EVAL_LABEL, metric="f1")
    return out.unionByName(count(spark.read.json(io.save_thresholds(t, f"{base}/thresholds.json")), "thresholds", "threshold"))


@query("input_guards")
def q_guards(spark, d):
    """The guards on good and bad inputs made from the panel: a row for each with whether it raised."""
    from panelcast.operators import guards
    from panelcast.operators.features import REQUIRED_COLUMNS, generate_features

    p = panel_o(spark, d)
    months = p.select("month").distinct().count()
    cases = [
        ("columns_present", lambda: guards.require_columns(p, REQUIRED_COLUMNS)),
        ("columns_missing", lambda: guards.require_columns(p.drop("late_payments"), REQUIRED_COLUMNS)),
        ("rows_present", lambda: guards.require_non_empty(p)),
        ("rows_missing", lambda: guards.require_non_empty(p.where("false"))),
        ("features_of_nothing", lambda: generate_features(p.where("false"))),
        ("periods_enough", lambda: labels.time_split(p, months - 2, 1, 1)),
        ("periods_short", lambda: labels.time_split(p, months, 1, 1)),
    ]

    def raised(fn):
        try:
            fn()
        except ValueError:
            return True
        return False

    return spark.createDataFrame([(name, raised(fn)) for name, fn in cases], "guard string, raised boolean")


@query("matrix_without_label")
def q_matrix_without_label(spark, d):
    """Model matrix of rows without a label (scoring input): rows, features, values that are not finite."""
    mm = ml.model_matrix(features_o(spark, d).drop("churned"), label="churned", require_label=False)
    feats = [c for c in mm.columns if c not in ("account_id", "month")]
    bad = F.size(F.filter(F.array(*feats), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return mm.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(bad).cast("bigint").alias("n_not_finite"),
                  F.lit(len(feats)).cast("bigint").alias("n_features"))


@query("model_roundtrip")
def q_model_roundtrip(spark, d):
    """Save the fitted pipeline to shared storage, load it back, score with the loaded copy."""
    mm = train_test(spark, d)
    feats = _features(mm)
    model = ml.fit(mm.where(F.col("split") == "train"), feats, "lr", "churned", **LR_PARAMS)
    path = f"{checkpoint_dir(spark).rstrip('/')}/models/lr-{uuid.uuid4().hex}"
    io.save_model(model, path)
    loaded = io.load_model(path)
    return ml.score_model(loaded, mm.where(F.col("split") == "test"), threshold=None, keep=["churned"])


@query("io_roundtrip")
def q_io_roundtrip(spark, d):
    """Panel written as csv (also with its columns in another order and one more) / json lines / parquet / json arrays and
    read back; per-format profile.  The panel is built once, not once a format."""
    p = materialize(panel_o(spark, d), "io-panel")
    base = f"{scratch_root(spark)}/io/{uuid.uuid4().hex}"
    parts = []
    for name in ("csv", "csv_shuffled", "json", "parquet", "json_array"):
        fmt = name.split("_")[0]
        path = f"{base}/{name}/panel.{fmt}"
        if name == "json_array":
            io.save_json_array(p, path)
        elif name == "csv_shuffled":
            io.save_table(p.select(F.lit("x").alias("note"), *reversed(p.columns)), path)
        else:
            io.save_table(p, path)
        back = io.load_panel(spark, path)
        parts.append(
            back.agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.countDistinct("account_id").alias("n_accounts"),
                F.sum("current_month_transactions").alias("transactions"),
                round_half_away(F.sum("current_month_revenue"), 2).alias("revenue"),
                F.sum("churned").cast("bigint").alias("churned"),
                F.max("last_touchbase_date").alias("last_touch"),
            ).select(F.lit(name).alias("format"), "*")
        )
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query("segment_export")
def q_segment_export(spark, d):
    """Driver segments exported one folder per segment, read back and counted."""
    path = f"{scratch_root(spark)}/segments/{uuid.uuid4().hex}"
    io.export_segments(_segments(spark, d), path)
    back = spark.read.option("header", True).csv(path)
    return back.groupBy("segment_name").agg(F.count(F.lit(1)).alias("n_rows"))

