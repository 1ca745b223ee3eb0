"""Column expressions (JVM-side, codegen friendly; no Python UDFs).

The fixed values below must equal the reference's for identical results.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "CHANNELS",
    "PANEL_METRICS",
    "TIER_ORDER",
    "SEGMENT_ACTIONS",
    "DEFAULT_ACTION",
    "CATEGORY_RULES",
    "risk_tier",
    "feature_category",
    "concern_label",
    "segment_action",
    "floor_days_between",
    "calendar_months_between",
    "round_doubles",
    "round_half_away",
    "q",
]

# ---- fixed values (must match the reference) ---------------------------------
# Channel names in the reference's order.
CHANNELS = ["web", "card", "agent", "ivr", "apple_pay"]

# The six panel metrics that get rolling / change features, in the reference's
# order, with the offset added to the window average in the trend denominator.
PANEL_METRICS = [
    ("current_month_revenue", 1.0),
    ("current_month_transactions", 1.0),
    ("late_payments", 0.1),
    ("escalated_tickets", 0.1),
    ("self_service_percentage", 1.0),
    ("average_resolution_time_hours", 1.0),
]

# Risk tiers: lower bound (inclusive) and name, highest first.
TIER_BOUNDS = [(0.7, "High Risk"), (0.4, "Medium Risk"), (0.2, "Low Risk")]
TIER_FALLBACK = "Very Safe"
TIER_ORDER = ["High Risk", "Medium Risk", "Low Risk", "Very Safe"]

# Feature categories: ordered substring rules, first match wins.
CATEGORY_RULES = [
    (("revenue",), "Revenue/Spending"),
    (("transaction",), "Transaction Volume"),
    (("ticket", "escalated"), "Support Quality"),
    (("channel",), "Channel Usage"),
    (("payment",), "Payment Behavior"),
    (("self_service",), "Self-Service"),
    (("resolution",), "Support Speed"),
    (("contact", "touchbase"), "Engagement"),
    (("age",), "Customer Tenure"),
]
CATEGORY_FALLBACK = "Other"

# Segment -> recommended action.
SEGMENT_ACTIONS = {
    "Support Issues": "Assign dedicated support rep, proactive check-ins, prioritize tickets",
    "Declining Engagement": "Onboarding campaign, product tutorials, feature adoption emails",
    "Payment Issues": "Flexible payment plans, financial hardship outreach, billing support",
    "Revenue Decline": "Show ROI evidence, success stories, upsell value-add features",
}
DEFAULT_ACTION = "Review and take appropriate action"

# Concern labels for z-scores: (strict lower bound, label), checked in order.
CONCERN_HIGH = [(2.0, "VERY HIGH"), (1.0, "High")]
CONCERN_LOW = [(-2.0, "VERY LOW"), (-1.0, "Low")]
CONCERN_FALLBACK = "Normal"
# -------------------------------------------------------------------------------


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def risk_tier(score: str | Column) -> Column:
    s = _c(score)
    expr = None
    for bound, name in TIER_BOUNDS:
        expr = F.when(s >= bound, name) if expr is None else expr.when(s >= bound, name)
    return expr.otherwise(TIER_FALLBACK)


def feature_category(name: str | Column) -> Column:
    n = _c(name)
    expr = None
    for needles, label in CATEGORY_RULES:
        cond = None
        for needle in needles:
            hit = n.contains(needle)
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(CATEGORY_FALLBACK)


def concern_label(z: str | Column) -> Column:
    zc = _c(z)
    expr = None
    for bound, label in CONCERN_HIGH:
        expr = F.when(zc > bound, label) if expr is None else expr.when(zc > bound, label)
    for bound, label in CONCERN_LOW:
        expr = expr.when(zc < bound, label)
    return expr.otherwise(CONCERN_FALLBACK)


def segment_action(segment: str | Column) -> Column:
    mapping = F.create_map(*[F.lit(x) for kv in SEGMENT_ACTIONS.items() for x in kv])
    return F.coalesce(F.element_at(mapping, _c(segment)), F.lit(DEFAULT_ACTION))


def floor_days_between(later_date: str | Column, earlier_ts: str | Column) -> Column:
    """floor((later - earlier) in days), like pandas ``Timedelta.days`` (may be 0 or negative)."""
    later = _c(later_date).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", _c(earlier_ts).cast("timestamp_ntz"), later)
    return F.floor(micros / F.lit(86_400_000_000)).cast("bigint")


def calendar_months_between(later: str | Column, earlier: str | Column) -> Column:
    """(y - y0) * 12 + (m - m0): calendar months, ignoring the day."""
    a, b = _c(later), _c(earlier)
    return ((F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))).cast("bigint")


def round_half_away(c: str | Column, digits: int) -> Column:
    """round(x * 10^d) / 10^d, half away from zero: the same arithmetic as
    DuckDB's ``round(double, d)``, so both engines give identical doubles."""
    scale = float(10**digits)
    return F.round(_c(c).cast("double") * F.lit(scale), 0) / F.lit(scale)


def q(name: str) -> str:
    """Back-quote a column name for SQL expression strings."""
    return "`" + name.replace("`", "``") + "`"


def round_doubles(df, digits: int = 4):
    """Round every double column (for cross-engine comparison of float results).

    Two steps, first to 10 decimals: values that sit on a half at ``digits``
    (averages of rounded scores do) but differ in the last bit between
    engines are snapped to the exact half first, so both round the same way.
    Built as SQL expression strings: one call to the JVM for any width."""
    scale = f"{float(10**digits)!r}D"
    fine = "10000000000.0D"
    exprs = []
    for field in df.schema.fields:
        n = q(field.name)
        if field.dataType.typeName() in ("double", "float"):
            snapped = f"(round(CAST({n} AS DOUBLE) * {fine}, 0) / {fine})"
            exprs.append(f"round({snapped} * {scale}, 0) / {scale} AS {n}")
        else:
            exprs.append(n)
    return df.selectExpr(*exprs)
