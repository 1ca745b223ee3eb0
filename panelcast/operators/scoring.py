"""Scores, binary predictions, risk tiers and score summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.expressions import TIER_ORDER, risk_tier, round_half_away
from panelcast.operators.metrics import exact_quantiles

# A fixed linear scorer over feature columns: logistic(intercept + sum(coef * x)).
# It stands in for a fitted model wherever results must be reproducible
# across engines (oracle checks, benchmarks); ``ml.py`` provides fitted models.
FIXED_INTERCEPT = -2.0
FIXED_COEFFICIENTS = {
    "late_payments": 0.9,
    "escalated_tickets": 0.35,
    "days_since_last_contact": 0.004,
    "self_service_percentage": -0.012,
    "current_month_transactions_trend_90d": -0.6,
    "channels_dropped": 0.25,
    "current_month_revenue_percent_change": -0.3,
}


def linear_logit(coefficients: dict[str, float], intercept: float):
    z = F.lit(intercept)
    for name, coef in coefficients.items():
        z = z + F.lit(coef) * F.col(name).cast("double")
    return z


def fixed_score(
    df: DataFrame,
    coefficients: dict[str, float] = FIXED_COEFFICIENTS,
    intercept: float = FIXED_INTERCEPT,
    out: str = "churn_risk_score",
    digits: int | None = None,
) -> DataFrame:
    """Logistic score; ``digits`` rounds it (comparison across engines), the default does not."""
    z = linear_logit(coefficients, intercept)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    if digits is not None:
        p = round_half_away(p, digits)
    return df.select("*", p.alias(out))


def make_predictions(
    scored: DataFrame,
    score: str = "churn_risk_score",
    threshold: float | None = 0.5,
    model_prediction: str | None = None,
    include_risk_tiers: bool = True,
) -> DataFrame:
    """prediction = score >= threshold (or the model's own decision when threshold is None),
    safe_probability = 1 - score, risk_tier from the fixed bounds."""
    if threshold is None:
        if not model_prediction:
            raise ValueError("threshold=None needs the model's prediction column")
        pred = F.col(model_prediction).cast("int")
    else:
        pred = (F.col(score) >= F.lit(threshold)).cast("int")
    cols = [pred.alias("prediction"), (F.lit(1.0) - F.col(score)).alias("safe_probability")]
    if include_risk_tiers:
        cols.append(risk_tier(score).alias("risk_tier"))
    keep = [c for c in scored.columns if c not in ("prediction", "safe_probability", "risk_tier")]
    return scored.select(*keep, *cols)


def tier_distribution(pred: DataFrame, tier: str = "risk_tier") -> DataFrame:
    """Counts and percent per tier in the fixed order; empty tiers kept as 0."""
    spark = pred.sparkSession
    tiers = spark.createDataFrame([(t, i) for i, t in enumerate(TIER_ORDER)], "risk_tier string, tier_order int")
    counts = pred.groupBy(F.col(tier).alias("risk_tier")).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows").alias("_n"))
    return (
        F.broadcast(tiers)
        .join(counts, on="risk_tier", how="left")
        .crossJoin(total)
        .select(
            "risk_tier",
            "tier_order",
            F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
            (F.coalesce(F.col("n_rows"), F.lit(0)) * 100.0 / F.col("_n")).alias("percent"),
        )
    )


def score_stats(pred: DataFrame, score: str = "churn_risk_score", exact_median: bool = True) -> DataFrame:
    """mean, median, max, min of the score.  The exact median is distributed
    (prefix counts over distinct values), never a single-task sort."""
    base = pred.agg(
        F.avg(score).alias("mean_score"), F.max(score).alias("max_score"), F.min(score).alias("min_score"),
        F.count(score).alias("n_scored"),
    )
    if exact_median:
        med = exact_quantiles(pred, score, [0.5]).select(F.col("value").alias("median_score"))
    else:
        med = pred.agg(F.percentile_approx(score, 0.5, 10000).cast("double").alias("median_score"))
    return base.crossJoin(med).select("n_scored", "mean_score", "median_score", "max_score", "min_score")


def predicted_counts(pred: DataFrame, prediction: str = "prediction") -> DataFrame:
    return pred.agg(
        F.sum(F.col(prediction).cast("bigint")).alias("predicted_churn"),
        F.count(F.lit(1)).alias("n_rows"),
    ).select(
        "predicted_churn",
        (F.col("n_rows") - F.col("predicted_churn")).alias("predicted_non_churn"),
        (F.col("predicted_churn") / F.col("n_rows")).alias("churn_share"),
        (1 - F.col("predicted_churn") / F.col("n_rows")).alias("non_churn_share"),
    )


def high_risk(pred: DataFrame, tiers=("High Risk", "Medium Risk"), tier: str = "risk_tier") -> DataFrame:
    return pred.where(F.col(tier).isin(*tiers))


def tier_extract(pred: DataFrame, tier_name: str, score: str = "churn_risk_score") -> DataFrame:
    """Rows of one tier ordered by score (highest first); ties by key."""
    return pred.where(F.col("risk_tier") == tier_name).orderBy(F.col(score).desc(), "account_id", "month")


def account_lookup(df: DataFrame, account: str, key: str = "account_id", check: bool = False) -> DataFrame:
    """Rows of one account.  With ``check`` a missing id raises with up to 10 sample ids."""
    out = df.where(F.col(key) == account)
    if check and out.isEmpty():
        sample = [r[0] for r in df.select(key).distinct().limit(10).collect()]
        raise ValueError(f"Account {account!r} not found. Sample ids: {sample}")
    return out


def top_risk(pred: DataFrame, n: int, score: str = "churn_risk_score", key: str = "account_id", period: str = "month") -> DataFrame:
    """Top-n rows by score (a top-k report: TakeOrderedAndProject, per-task heaps)."""
    return pred.orderBy(F.col(score).desc(), F.col(key), F.col(period)).limit(n)
