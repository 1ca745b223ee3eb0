"""Temporal panel features (row-framed windows per account, ordered by period).

"90d" and "180d" are frames of 3 and 6 *rows*, not calendar time: a missing
month is not a gap (use ``operators.spine.month_spine`` first to make gaps
explicit).  All window expressions share one partition/order spec, so the
whole stage plans to one exchange on the account key and one sort.

Deviations from the pandas original, kept on purpose:
* divisions by zero give NULL (then 0 after the fill) instead of +-inf;
* the previous-two-rows sum is computed per account (the original leaks the
  previous account's values into an account's first row);
* the final fill touches numeric columns only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from panelcast.functions.expressions import CHANNELS, PANEL_METRICS, q
from panelcast.operators.guards import require_columns, require_non_empty

# (name, rows, min_periods)
WINDOWS = [("90d", 3, 1), ("180d", 6, 3)]

# fixed values: columns that the features need
REQUIRED_COLUMNS = [
    "account_id",
    "month",
    "current_month_revenue",
    "current_month_transactions",
    "enabled_channels",
    "last_touchbase_date",
    "late_payments",
    "escalated_tickets",
    "self_service_percentage",
    "average_resolution_time_hours",
]

COMPARISON_METRICS = ["current_month_revenue", "current_month_transactions"]


class _Spec:
    """SQL text for window clauses over one (key, order) spec."""

    def __init__(self, key: str, order: Sequence[str]):
        self.base = f"PARTITION BY {q(key)} ORDER BY " + ", ".join(q(o) for o in order)

    def over(self, frame: str | None = None) -> str:
        return f"OVER ({self.base}{' ' + frame if frame else ''})"

    def rows(self, lo: int | None, hi: int) -> str:
        lower = "UNBOUNDED PRECEDING" if lo is None else (f"{-lo} PRECEDING" if lo < 0 else "CURRENT ROW")
        upper = "CURRENT ROW" if hi == 0 else (f"{-hi} PRECEDING" if hi < 0 else f"{hi} FOLLOWING")
        return self.over(f"ROWS BETWEEN {lower} AND {upper}")


def _dbl(x: float) -> str:
    return f"{float(x)!r}D"


def rolling_exprs(metric: str, offset: float, spec: _Spec, windows=WINDOWS) -> list[str]:
    """sum/avg/max/min (NULL until min_periods observations), trend and sample std."""
    m = q(metric)
    out = []
    for name, n_rows, min_periods in windows:
        ov = spec.rows(-(n_rows - 1), 0)
        ok = f"count({m}) {ov} >= {min_periods}"
        avg = f"(CASE WHEN {ok} THEN avg({m}) {ov} END)"
        out += [
            f"CAST(CASE WHEN {ok} THEN sum({m}) {ov} END AS DOUBLE) AS {q(f'{metric}_{name}_sum')}",
            f"CAST({avg} AS DOUBLE) AS {q(f'{metric}_{name}_avg')}",
            f"CAST(CASE WHEN {ok} THEN max({m}) {ov} END AS DOUBLE) AS {q(f'{metric}_{name}_max')}",
            f"CAST(CASE WHEN {ok} THEN min({m}) {ov} END AS DOUBLE) AS {q(f'{metric}_{name}_min')}",
            f"try_divide({m}, {avg} + {_dbl(offset)}) AS {q(f'{metric}_trend_{name}')}",
            f"CASE WHEN count({m}) {ov} >= {max(2, min_periods)} THEN stddev_samp({m}) {ov} END"
            f" AS {q(f'{metric}_volatility_{name}')}",
        ]
    return out


def percent_change_expr(metric: str, spec: _Spec) -> str:
    m = q(metric)
    prev = f"lag({m}) {spec.over()}"
    return f"try_divide({m} - {prev}, {prev})"


def feature_names(metrics=PANEL_METRICS, windows=WINDOWS) -> list[str]:
    """The 100 derived feature columns in the reference's order."""
    names = [f"has_{ch}" for ch in CHANNELS] + ["number_of_channels", "days_since_last_contact", "account_age_months"]
    for metric, _ in metrics:
        for w, _, _ in windows:
            names += [f"{metric}_{w}_{a}" for a in ("sum", "avg", "max", "min")]
            names += [f"{metric}_trend_{w}", f"{metric}_volatility_{w}"]
        names += [f"{metric}_percent_change", f"{metric}_acceleration"]
        if metric in COMPARISON_METRICS:
            names += [f"{metric}_30d", f"{metric}_recent_vs_historical"]
    names += ["number_of_channels_avg_90d", "channel_trend", "max_channels_ever", "channels_dropped"]
    return names


def channel_exprs(channels_col: str = "enabled_channels") -> list[str]:
    """has_<channel> (substring match, NULL -> 0) for every channel."""
    c = q(channels_col)
    return [f"CAST(coalesce(contains({c}, '{ch}'), false) AS INT) AS {q('has_' + ch)}" for ch in CHANNELS]


def channel_features(df: DataFrame, channels_col: str = "enabled_channels") -> DataFrame:
    flags = df.selectExpr("*", *channel_exprs(channels_col))
    total = " + ".join(q(f"has_{ch}") for ch in CHANNELS)
    return flags.selectExpr("*", f"CAST({total} AS INT) AS number_of_channels")


def generate_features(
    df: DataFrame,
    key: str = "account_id",
    period: str = "month",
    order: Sequence[str] | None = None,
    metrics=PANEL_METRICS,
    windows=WINDOWS,
    fill: bool = True,
    check_empty: bool = True,
) -> DataFrame:
    """Full feature stage: raw panel -> raw columns + 100 features.

    ``order`` adds tie-breakers after ``period`` when (key, period) is not unique.
    All expressions are Spark SQL text (one JVM call per stage, whatever the
    width); every window shares one partition/order spec.
    """
    if check_empty:
        require_non_empty(df)
    required = [key, period] + [c for c in REQUIRED_COLUMNS if c not in ("account_id", "month")]
    require_columns(df, required)
    spec = _Spec(key, [period, *(order or [])])
    raw_cols = df.columns
    p = q(period)

    # stage 1: row-local expressions
    base = channel_features(df)

    # stage 2: every window expression over the same spec (one exchange, one sort)
    first = f"min({p}) {spec.rows(None, 0)}"
    win = [
        f"CAST(floor(timestampdiff(MICROSECOND, CAST(last_touchbase_date AS TIMESTAMP_NTZ), CAST({p} AS TIMESTAMP_NTZ))"
        f" / 86400000000) AS BIGINT) AS days_since_last_contact",
        f"CAST((year({p}) - year({first})) * 12 + (month({p}) - month({first})) AS BIGINT) AS account_age_months",
    ]
    for metric, offset in metrics:
        win += rolling_exprs(metric, offset, spec, windows)
        win.append(f"{percent_change_expr(metric, spec)} AS {q(metric + '_percent_change')}")
        if metric in COMPARISON_METRICS:
            m = q(metric)
            win.append(f"{m} AS {q(metric + '_30d')}")
            win.append(
                f"try_divide({m}, sum({m}) {spec.rows(-2, -1)} + 1) AS {q(metric + '_recent_vs_historical')}"
            )
    avg3 = f"avg(number_of_channels) {spec.rows(-2, 0)}"
    max_ever = f"max(number_of_channels) {spec.rows(None, 0)}"
    win += [
        f"{avg3} AS number_of_channels_avg_90d",
        f"try_divide(number_of_channels, {avg3} + 0.01D) AS channel_trend",
        f"{max_ever} AS max_channels_ever",
        f"{max_ever} - number_of_channels AS channels_dropped",
    ]
    stage2 = base.selectExpr("*", *win)

    # stage 3: acceleration = first difference of percent change (same spec, no new exchange)
    accel = []
    for m, _ in metrics:
        pc = q(m + "_percent_change")
        accel.append(f"{pc} - lag({pc}) {spec.over()} AS {q(m + '_acceleration')}")
    stage3 = stage2.selectExpr("*", *accel)
    names = list(raw_cols) + feature_names(metrics, windows)
    if not fill:
        return stage3.selectExpr(*[q(c) for c in names])
    return fill_numeric(stage3.select(*names))


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    """fillna(0) on numeric columns (NULL and NaN); strings/timestamps untouched."""
    exprs = []
    for field in df.schema.fields:
        n, t = q(field.name), field.dataType.simpleString()
        if t in ("double", "float"):
            exprs.append(f"CAST(coalesce(nanvl({n}, {_dbl(value)}), {_dbl(value)}) AS {t}) AS {n}")
        elif t in ("tinyint", "smallint", "int", "bigint") or t.startswith("decimal"):
            exprs.append(f"CAST(coalesce({n}, {int(value)}) AS {t}) AS {n}")
        else:
            exprs.append(n)
    return df.selectExpr(*exprs)


def rolling_features(
    df: DataFrame, metric: str, offset: float = 1.0, key: str = "account_id", period: str = "month"
) -> DataFrame:
    """C1-C5 + B5 for one metric (unfilled, like the intermediate frame)."""
    spec = _Spec(key, [period])
    return df.selectExpr(q(key), q(period), q(metric), *rolling_exprs(metric, offset, spec))


def change_features(df: DataFrame, metrics, key: str = "account_id", period: str = "month") -> DataFrame:
    """C6-C7: percent change and its first difference (NULL where undefined), for one
    metric or a list of metrics, in one window stage."""
    metrics = [metrics] if isinstance(metrics, str) else list(metrics)
    spec = _Spec(key, [period])
    step = df.selectExpr(
        q(key), q(period), *[q(m) for m in metrics],
        *[f"{percent_change_expr(m, spec)} AS {q(m + '_percent_change')}" for m in metrics],
    )
    acc = [
        f"{q(m + '_percent_change')} - lag({q(m + '_percent_change')}) {spec.over()} AS {q(m + '_acceleration')}"
        for m in metrics
    ]
    return step.selectExpr("*", *acc)


def recent_vs_historical(df: DataFrame, metrics, key: str = "account_id", period: str = "month") -> DataFrame:
    """B6-B7/C8: value, and value / (sum of the previous two rows of the same account + 1)."""
    metrics = [metrics] if isinstance(metrics, str) else list(metrics)
    spec = _Spec(key, [period])
    exprs = [q(key), q(period)]
    for metric in metrics:
        m = q(metric)
        prev_two = f"sum({m}) {spec.rows(-2, -1)}"
        exprs += [
            f"{m} AS {q(metric + '_30d')}",
            f"CAST({prev_two} AS DOUBLE) AS {q(metric + '_prev_two')}",
            f"try_divide({m}, {prev_two} + 1) AS {q(metric + '_recent_vs_historical')}",
        ]
    return df.selectExpr(*exprs)
