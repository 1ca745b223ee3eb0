"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver tables and derives everything from them, so the
work grows with the data.  Float columns are rounded to 4 decimals at the
very end (cross-engine comparison); the operators themselves do not round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.expressions import feature_category, round_doubles
from panelcast.operators import drivers, explain, labels, metrics, quality, scoring, spine
from panelcast.operators.features import (
    change_features,
    feature_names,
    generate_features,
    recent_vs_historical,
    rolling_features,
)
from panelcast.operators.ml import model_matrix
from panelcast.session import materialize
from panelcast.sources.adapters import events_panel, orders_panel

EVAL_LABEL = "churned_next_3mo"
TOP_N_EXPLAIN = 20
TOP_N_FEATURES = 20
LOOKUP_ACCOUNT = "ACC-000010"
LOOKUP_CUSTOMER = 10
K_THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]

# A second fixed scorer, for the model-comparison queries.
ALT_INTERCEPT = -1.5
ALT_COEFFICIENTS = {
    "late_payments": 0.6,
    "total_tickets": 0.05,
    "self_service_percentage": -0.02,
    "current_month_revenue_trend_90d": -0.8,
    "number_of_channels": -0.2,
}

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        _REGISTRY[name] = lambda spark, d: round_doubles(fn(spark, d), 4)
        _REGISTRY[name].__doc__ = fn.__doc__
        return fn

    return deco


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# ---- shared building blocks ------------------------------------------------------


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def panel_o(spark, d):
    return orders_panel(table(spark, d, "orders"), table(spark, d, "lineitem"))


def panel_e(spark, d):
    return events_panel(table(spark, d, "events"))


def features_o(spark, d):
    return generate_features(panel_o(spark, d), check_empty=False)


def model_feature_names() -> list[str]:
    raw = [
        "current_month_transactions",
        "current_month_revenue",
        "total_tickets",
        "escalated_tickets",
        "late_payments",
        "self_service_percentage",
        "average_resolution_time_hours",
    ]
    return raw + feature_names()


def labelled_features(spark, d):
    """Features + 3-period horizon label, written once per query (shared by its branches)."""
    return materialize(labels.horizon_labels(features_o(spark, d), horizon=3), "labelled-features")


SCORE_DIGITS = 4  # of the registered queries' scores: cuts and ties must fall alike in both engines


def score_table(f, coefficients=scoring.FIXED_COEFFICIENTS, intercept=scoring.FIXED_INTERCEPT, digits=SCORE_DIGITS):
    return scoring.make_predictions(scoring.fixed_score(f, coefficients, intercept, digits=digits), threshold=0.5)


def scored_o(spark, d):
    """Features + fixed score + prediction at 0.5 + tier + horizon label (materialized:
    for queries whose plan reads it in several branches or runs a bucketing job)."""
    return score_table(labelled_features(spark, d))


def scored_lazy(spark, d, digits=SCORE_DIGITS):
    """Same table as ``scored_o`` but not materialized (single-branch queries)."""
    return score_table(labels.horizon_labels(features_o(spark, d), horizon=3), digits=digits)


NARROW_COLS = ["account_id", "month", "churn_risk_score", "prediction", "risk_tier", EVAL_LABEL]


def scored_narrow(spark, d):
    """Only keys, score, prediction, tier and label, written once per query: what the
    curve / threshold / metric queries read (two passes: cut points, then curves)."""
    return materialize(scored_lazy(spark, d).select(*NARROW_COLS), "scored-narrow")


def two_models(spark, d):
    """Both fixed scorers from one feature pass, long by model_name, written narrow."""
    f = labels.horizon_labels(features_o(spark, d), horizon=3)
    cols = ["account_id", "month", "churn_risk_score", "prediction", EVAL_LABEL]
    a = score_table(f).select(F.lit("linear_a").alias("model_name"), *cols)
    b = score_table(f, ALT_COEFFICIENTS, ALT_INTERCEPT).select(F.lit("linear_b").alias("model_name"), *cols)
    return materialize(a.unionByName(b), "two-models")


def stats_with_importance(stats):
    """Adds the data importance: |churned mean - safe mean| / safe std, normalised to
    sum 1.  The normalising sum is a window over the per-feature table (one row per
    feature, so bounded), keeping the stats aggregate to a single branch."""
    from pyspark.sql import Window

    eff = F.coalesce(
        F.try_divide(F.abs(F.col("churned_avg") - F.col("safe_avg")), F.col("safe_std")), F.lit(0.0)
    )
    raw = stats.select("*", eff.alias("_e"))
    total = F.sum("_e").over(Window.partitionBy())
    return raw.select(
        *stats.columns, F.coalesce(F.try_divide(F.col("_e"), total), F.lit(0.0)).alias("importance")
    )


def importance_from_stats(stats):
    return stats_with_importance(stats).select("feature", "importance")


def scored_stats(spark, d, scored=None):
    scored = scored if scored is not None else scored_o(spark, d)
    return explain.class_stats(scored, model_feature_names(), EVAL_LABEL)


def data_importance(spark, d, stats=None):
    return importance_from_stats(stats if stats is not None else scored_stats(spark, d))


# ---- A / adapters ----------------------------------------------------------------


@query("panel_orders")
def q_panel_orders(spark, d):
    """Canonical panel from orders + lineitem."""
    return panel_o(spark, d)


@query("panel_events")
def q_panel_events(spark, d):
    """Canonical daily panel from events."""
    return panel_e(spark, d)


@query("panel_profile")
def q_panel_profile(spark, d):
    return quality.panel_profile(panel_o(spark, d))


@query("dq_expectations")
def q_dq(spark, d):
    return quality.dq_expectations(features_o(spark, d))


@query("month_spine")
def q_month_spine(spark, d):
    return spine.month_spine(panel_o(spark, d))


@query("last_record")
def q_last_record(spark, d):
    return spine.last_record(panel_o(spark, d))


# ---- B / C features -------------------------------------------------------------


@query("channel_features")
def q_channel(spark, d):
    f = features_o(spark, d)
    return f.select(
        "account_id",
        "month",
        "enabled_channels",
        *[c for c in f.columns if c.startswith("has_")],
        "number_of_channels",
        "number_of_channels_avg_90d",
        "channel_trend",
        "max_channels_ever",
        "channels_dropped",
    )


@query("metadata_features")
def q_metadata(spark, d):
    f = features_o(spark, d)
    return f.select("account_id", "month", "last_touchbase_date", "days_since_last_contact", "account_age_months")


def _rolling(metric, offset):
    def fn(spark, d):
        return rolling_features(panel_o(spark, d), metric, offset)

    return fn


for _name, _metric, _off in [
    ("rolling_revenue", "current_month_revenue", 1.0),
    ("rolling_transactions", "current_month_transactions", 1.0),
    ("rolling_late", "late_payments", 0.1),
    ("rolling_escalated", "escalated_tickets", 0.1),
    ("rolling_self_service", "self_service_percentage", 1.0),
    ("rolling_resolution", "average_resolution_time_hours", 1.0),
]:
    query(_name)(_rolling(_metric, _off))


@query("change_features")
def q_change(spark, d):
    return change_features(panel_o(spark, d), ["current_month_revenue", "current_month_transactions"])


@query("recent_vs_historical")
def q_rvh(spark, d):
    return recent_vs_historical(panel_o(spark, d), ["current_month_revenue", "current_month_transactions"])


@query("full_features")
def q_full(spark, d):
    return features_o(spark, d)


@query("features_events")
def q_features_events(spark, d):
    return generate_features(panel_e(spark, d), check_empty=False)


@query("model_matrix")
def q_model_matrix(spark, d):
    return model_matrix(features_o(spark, d))


# ---- labels and splits ------------------------------------------------------------


@query("horizon_labels")
def q_horizon(spark, d):
    return labels.horizon_labels(panel_o(spark, d), horizon=3).select("account_id", "month", "churned", EVAL_LABEL)


@query("label_uplift")
def q_uplift(spark, d):
    lab = labels.horizon_labels(panel_o(spark, d), horizon=3)
    return lab.select(F.lit("all").alias("split"), "churned", EVAL_LABEL).transform(
        lambda x: labels.split_rates(x, ["churned", EVAL_LABEL])
    )


@query("split_time")
def q_split_time(spark, d):
    s = labels.time_split(panel_o(spark, d), 40, 12, 16)
    return s.select("account_id", "month", "churned", "split")


@query("split_horizon")
def q_split_horizon(spark, d):
    s = labels.time_split_horizon(panel_o(spark, d), 40, horizon=12)
    return s.select("account_id", "month", "churned", "split")


@query("split_rates")
def q_split_rates(spark, d):
    lab = labels.horizon_labels(panel_o(spark, d), horizon=3)
    s = labels.time_split(lab, 40, 12, 16)
    return labels.split_rates(s, ["churned", EVAL_LABEL])


@query("cv_folds")
def q_cv(spark, d):
    s = labels.time_split(panel_o(spark, d), 40, 12, 16).where(F.col("split") == "train")
    return labels.cv_blocks(s.drop("split"), 3).select("account_id", "month", "cv_block")


@query("class_distribution")
def q_class_dist(spark, d):
    return labels.class_distribution(labels.horizon_labels(panel_o(spark, d)), EVAL_LABEL)


@query("class_weights")
def q_class_weights(spark, d):
    lab = labels.horizon_labels(panel_o(spark, d))
    return labels.class_weights(lab, EVAL_LABEL).select("account_id", "month", EVAL_LABEL, "class_weight")


# ---- scoring --------------------------------------------------------------------


SCORE_COLS = ["account_id", "month", "churn_risk_score", "prediction", "safe_probability", "risk_tier", EVAL_LABEL]


@query("score_fixed")
def q_score(spark, d):
    return scored_lazy(spark, d).select(*SCORE_COLS)


@query("tier_distribution")
def q_tiers(spark, d):
    return scoring.tier_distribution(scored_lazy(spark, d))


@query("score_stats")
def q_score_stats(spark, d):
    return scoring.score_stats(scored_narrow(spark, d))


@query("predicted_counts")
def q_pred_counts(spark, d):
    return scoring.predicted_counts(scored_lazy(spark, d))


@query("high_risk_list")
def q_high_risk(spark, d):
    return scoring.high_risk(scored_lazy(spark, d)).select("account_id", "month", "churn_risk_score", "risk_tier")


@query("account_lookup")
def q_lookup(spark, d):
    one = orders_panel(table(spark, d, "orders"), table(spark, d, "lineitem"), customer=LOOKUP_CUSTOMER)
    scored = score_table(labels.horizon_labels(generate_features(one, check_empty=False), horizon=3))
    return scoring.account_lookup(scored, LOOKUP_ACCOUNT).select(*SCORE_COLS)


@query("tier_extract")
def q_tier_extract(spark, d):
    """All High Risk rows, highest score first (a range-partitioned sort, not a single task)."""
    return scoring.tier_extract(scored_lazy(spark, d), "High Risk").select(
        "account_id", "month", "churn_risk_score", "risk_tier"
    )


@query("top_risk")
def q_top_risk(spark, d):
    return scoring.top_risk(scored_lazy(spark, d), TOP_N_EXPLAIN).select("account_id", "month", "churn_risk_score", "risk_tier")


# ---- metrics --------------------------------------------------------------------


@query("confusion")
def q_confusion(spark, d):
    return metrics.confusion(scored_lazy(spark, d), EVAL_LABEL)


@query("classification_metrics")
def q_cls_metrics(spark, d):
    return metrics.classification_metrics(scored_narrow(spark, d), EVAL_LABEL)


@query("classification_report")
def q_cls_report(spark, d):
    return metrics.classification_report(scored_lazy(spark, d), EVAL_LABEL)


@query("roc_points")
def q_roc_points(spark, d):
    return metrics.roc_points(metrics.curve_counts(scored_narrow(spark, d), label=EVAL_LABEL))


@query("roc_auc")
def q_roc_auc(spark, d):
    return metrics.roc_auc(metrics.curve_counts(scored_narrow(spark, d), label=EVAL_LABEL))


@query("pr_points")
def q_pr_points(spark, d):
    return metrics.pr_points(metrics.curve_counts(scored_narrow(spark, d), label=EVAL_LABEL))


@query("pr_auc")
def q_pr_auc(spark, d):
    return metrics.pr_auc(metrics.curve_counts(scored_narrow(spark, d), label=EVAL_LABEL))


@query("curve_areas_unrounded")
def q_areas_unrounded(spark, d):
    """ROC and PR areas over unrounded scores (nearly as many distinct scores as rows)."""
    s = materialize(scored_lazy(spark, d, digits=None).select(*NARROW_COLS), "scored-unrounded")
    return metrics.curve_areas(metrics.curve_counts(s, label=EVAL_LABEL))


@query("pr_baseline")
def q_pr_baseline(spark, d):
    return metrics.pr_baseline(scored_lazy(spark, d), EVAL_LABEL)


def _threshold(metric):
    def fn(spark, d):
        return metrics.optimal_threshold(scored_narrow(spark, d), label=EVAL_LABEL, metric=metric, min_precision=0.3)

    return fn


for _m in ("f1", "recall", "custom"):
    query(f"threshold_{_m}")(_threshold(_m))


@query("threshold_vs_default")
def q_thr_vs_default(spark, d):
    s = scored_narrow(spark, d)
    best = metrics.optimal_threshold(s, label=EVAL_LABEL, metric="f1").select(F.lit("optimal").alias("setting"), "*")
    dflt = metrics.metrics_at_thresholds(s, [0.5], label=EVAL_LABEL).select(
        F.lit("default").alias("setting"), "threshold", "precision", "recall", "f1_score", "predicted_churn_rate"
    )
    return best.unionByName(dflt)


@query("compare_models")
def q_compare_models(spark, d):
    return metrics.optimal_threshold(two_models(spark, d), label=EVAL_LABEL, metric="f1", group="model_name")


@query("evaluate_models")
def q_evaluate_models(spark, d):
    return metrics.classification_metrics(two_models(spark, d), EVAL_LABEL, group="model_name")


# ---- drivers --------------------------------------------------------------------


@query("feature_category")
def q_feature_category(spark, d):
    imp = data_importance(spark, d)
    return imp.select("feature", "importance", feature_category("feature").alias("category"))


@query("importance_by_category")
def q_importance_by_category(spark, d):
    return drivers.importance_by_category(drivers.top_features(data_importance(spark, d), TOP_N_FEATURES))


@query("segment_cutoffs")
def q_segment_cutoffs(spark, d):
    return drivers.segment_cutoffs(scoring.high_risk(scored_o(spark, d)))


def _segments(spark, d):
    s = scored_o(spark, d)
    top = drivers.top_features(importance_from_stats(scored_stats(spark, d, s)), TOP_N_FEATURES)
    return drivers.driver_segments_from_table(s, top)


@query("driver_segments")
def q_driver_segments(spark, d):
    return _segments(spark, d)


@query("segment_summary")
def q_segment_summary(spark, d):
    return drivers.segment_summary(_segments(spark, d))


# ---- explanations ---------------------------------------------------------------


@query("class_stats")
def q_class_stats(spark, d):
    return explain.class_stats(scored_o(spark, d), model_feature_names(), EVAL_LABEL)


def _explained(spark, d, s, rows, top_n):
    stats = stats_with_importance(scored_stats(spark, d, s))
    return explain.explain_deviation(rows, stats, None, model_feature_names(), top_n=top_n)


@query("explain_zscore")
def q_explain(spark, d):
    s = scored_o(spark, d)
    return _explained(spark, d, s, scoring.top_risk(s, TOP_N_EXPLAIN), 10)


@query("top_factors")
def q_top_factors(spark, d):
    s = scored_o(spark, d)
    return _explained(spark, d, s, scoring.high_risk(s), 3)


@query("linear_attribution")
def q_linear_attr(spark, d):
    s = scored_o(spark, d)
    top = scoring.top_risk(s, TOP_N_EXPLAIN)
    return explain.linear_attribution(top, s, scoring.FIXED_COEFFICIENTS)


def queries() -> dict[str, Query]:
    from panelcast.plans import dashboard, training  # noqa: F401  (registers more queries)

    return registry()
