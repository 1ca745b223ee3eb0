"""Data-quality expectations and the panel profile (one pass each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.expressions import CHANNELS


def _row_rules() -> list[tuple[str, F.Column]]:
    nonneg = [
        "current_month_transactions",
        "current_month_revenue",
        "total_tickets",
        "escalated_tickets",
        "late_payments",
        "average_resolution_time_hours",
    ]
    valid = F.array(*[F.lit(c) for c in CHANNELS])
    parts = F.split(F.coalesce(F.col("enabled_channels"), F.lit("")), r"\|")
    parts = F.filter(parts, lambda p: p != "")
    rules = [(f"{c}_non_negative", F.col(c) < 0) for c in nonneg]
    rules += [
        ("churned_binary", ~F.col("churned").isin(0, 1)),
        ("self_service_in_0_100", (F.col("self_service_percentage") < 0) | (F.col("self_service_percentage") > 100)),
        ("escalated_le_total", F.col("escalated_tickets") > F.col("total_tickets")),
        ("channels_in_valid_set", F.size(F.array_except(parts, valid)) > 0),
    ]
    return rules


def dq_expectations(df: DataFrame, key: str = "account_id", period: str = "month") -> DataFrame:
    """(rule, n_violations) for row rules and per-account rules, one scan + one window.

    Account rules: one row per (account, period) -- the row-framed windows rely
    on it --, at most one churn event, no row after the churn event, tenure
    non-decreasing (when ``account_age_months`` is present).
    """
    w = Window.partitionBy(key).orderBy(period)
    w_before = w.rowsBetween(Window.unboundedPreceding, -1)
    w_acct = Window.partitionBy(key)
    n_churn = F.sum(F.col("churned")).over(w_acct)
    first_row = F.row_number().over(w) == 1
    flagged = [(name, cond) for name, cond in _row_rules()]
    per_key = F.count(F.lit(1)).over(Window.partitionBy(key, period))  # same account shuffle
    flagged += [
        ("unique_account_period", per_key > 1),
        ("one_churn_per_account", first_row & (n_churn > 1)),
        ("no_row_after_churn", F.coalesce(F.max(F.col("churned")).over(w_before), F.lit(0)) > 0),
    ]
    if "account_age_months" in df.columns:
        flagged.append(
            ("tenure_non_decreasing", F.col("account_age_months") < F.lag("account_age_months").over(w))
        )
    if any(c.startswith("has_") for c in df.columns):
        for ch in CHANNELS:
            if f"has_{ch}" in df.columns:
                flagged.append((f"has_{ch}_binary", ~F.col(f"has_{ch}").isin(0, 1)))
    marked = df.select(*[F.coalesce(cond, F.lit(False)).alias(f"_v{i}") for i, (_, cond) in enumerate(flagged)])
    counts = marked.agg(
        *[F.sum(F.col(f"_v{i}").cast("bigint")).alias(f"_v{i}") for i in range(len(flagged))]
    )
    stack = ", ".join(f"'{name}', _v{i}" for i, (name, _) in enumerate(flagged))
    return counts.selectExpr(f"stack({len(flagged)}, {stack}) AS (rule, n_violations)").select(
        "rule", F.coalesce(F.col("n_violations"), F.lit(0)).cast("bigint").alias("n_violations")
    )


def panel_profile(df: DataFrame, key: str = "account_id", label: str = "churned") -> DataFrame:
    """rows, distinct accounts, churned accounts and the account-level churn rate."""
    per_account = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.max(F.coalesce(F.col(label), F.lit(0))).alias("_churned"))
    return per_account.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(key).alias("n_accounts"),
        F.count_if((F.col("_churned") == 1) & F.col(key).isNotNull()).alias("n_churned_accounts"),
    ).select("*", (F.col("n_churned_accounts") / F.col("n_accounts")).alias("account_churn_rate"))
