"""DuckDB SQL oracle for every SQL-expressible registered query.

The SQL is written independently of the Spark code (window functions,
FILTER aggregates, UNPIVOT) over the driver's pre-registered views.  Double
columns are rounded to 4 decimals exactly like the Spark side
(``+ 0.0`` turns a -0.0 into 0.0).
"""

from __future__ import annotations

# ---- fixed values, written out here so that a wrong one in the package shows ------
CHANNELS = ["web", "card", "agent", "ivr", "apple_pay"]
# metric and the offset in its trend's denominator
PANEL_METRICS = [
    ("current_month_revenue", 1.0), ("current_month_transactions", 1.0), ("late_payments", 0.1),
    ("escalated_tickets", 0.1), ("self_service_percentage", 1.0), ("average_resolution_time_hours", 1.0),
]
COMPARISON_METRICS = ["current_month_revenue", "current_month_transactions"]
# window name, rows, least number of rows
WINDOWS = [("90d", 3, 1), ("180d", 6, 3)]
FIXED_INTERCEPT = -2.0
FIXED_COEFFICIENTS = {
    "late_payments": 0.9, "escalated_tickets": 0.35, "days_since_last_contact": 0.004, "self_service_percentage": -0.012,
    "current_month_transactions_trend_90d": -0.6, "channels_dropped": 0.25, "current_month_revenue_percent_change": -0.3,
}
# ------------------------------------------------------------------------------------


def feature_names() -> list[str]:
    """The derived columns in table order."""
    out = ["has_" + c for c in CHANNELS] + ["number_of_channels", "days_since_last_contact", "account_age_months"]
    for m, _ in PANEL_METRICS:
        for w in ("90d", "180d"):
            out += [f"{m}_{w}_sum", f"{m}_{w}_avg", f"{m}_{w}_max", f"{m}_{w}_min", f"{m}_trend_{w}", f"{m}_volatility_{w}"]
        out += [f"{m}_percent_change", f"{m}_acceleration"]
        if m in COMPARISON_METRICS:
            out += [f"{m}_30d", f"{m}_recent_vs_historical"]
    return out + ["number_of_channels_avg_90d", "channel_trend", "max_channels_ever", "channels_dropped"]


W = "PARTITION BY account_id ORDER BY month"
EVAL = "churned_next_3mo"
RAW_DOUBLES = ["current_month_revenue", "self_service_percentage", "average_resolution_time_hours"]
RAW_COLS = [
    "account_id", "month", "current_month_transactions", "current_month_revenue", "total_tickets",
    "escalated_tickets", "late_payments", "enabled_channels", "self_service_percentage", "last_touchbase_date",
    "average_resolution_time_hours", "churned",
]
MODEL_RAW = [
    "current_month_transactions", "current_month_revenue", "total_tickets", "escalated_tickets",
    "late_payments", "self_service_percentage", "average_resolution_time_hours",
]


def r4(expr: str) -> str:
    """Two-step rounding (10 then 4 decimals), the same arithmetic as the Spark side."""
    return f"(round(round(CAST({expr} AS DOUBLE), 10), 4) + 0.0)"


def feature_double_names() -> set[str]:
    ints = {f"has_{c}" for c in CHANNELS} | {
        "number_of_channels", "days_since_last_contact", "account_age_months", "max_channels_ever",
        "channels_dropped", "current_month_transactions_30d",
    }
    return {f for f in feature_names() if f not in ints}


DOUBLES = set(RAW_DOUBLES) | feature_double_names()


def select_rounded(cols: list[str], doubles: set[str], src: str = "") -> str:
    parts = [f"{r4(c)} AS {c}" if c in doubles else c for c in cols]
    return "SELECT " + ", ".join(parts) + (f" FROM {src}" if src else "")


# ---- panel CTEs --------------------------------------------------------------------

PANEL_O = """
per_order AS (
  SELECT l_orderkey, count(*) AS n_lines,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_returned,
         sum(CASE WHEN l_returnflag = 'R' AND l_quantity > 40 THEN 1 ELSE 0 END) AS n_escalated,
         sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS n_final,
         sum(l_quantity) AS qty
  FROM lineitem GROUP BY l_orderkey),
o_m AS (
  SELECT o.o_orderkey, 'ACC-' || repeat('0', greatest(0, 6 - length(CAST(o.o_custkey AS VARCHAR)))) || CAST(o.o_custkey AS VARCHAR) AS account_id,
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
         o.o_orderstatus, o.o_totalprice, o.o_orderdate,
         CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'web' WHEN '2' THEN 'card' WHEN '3' THEN 'agent'
              WHEN '4' THEN 'ivr' WHEN '5' THEN 'apple_pay' END AS channel,
         p.n_lines, p.n_returned, p.n_escalated, p.n_final, p.qty
  FROM orders o LEFT JOIN per_order p ON o.o_orderkey = p.l_orderkey),
monthly AS (
  SELECT account_id, month,
         CAST(count(o_orderkey) AS BIGINT) AS current_month_transactions,
         round(sum(o_totalprice), 2) AS current_month_revenue,
         CAST(coalesce(sum(n_returned), 0) AS BIGINT) AS total_tickets,
         CAST(coalesce(sum(n_escalated), 0) AS BIGINT) AS escalated_tickets,
         CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS late_payments,
         coalesce(string_agg(DISTINCT channel, '|' ORDER BY channel), '') AS enabled_channels,
         coalesce(CAST(sum(n_final) AS DOUBLE) * 100.0 / CAST(sum(n_lines) AS DOUBLE), 0.0) AS self_service_percentage,
         coalesce(sum(qty) / CAST(sum(n_lines) AS DOUBLE), 0.0) AS average_resolution_time_hours,
         max(o_orderdate) AS last_ts
  FROM o_m GROUP BY account_id, month),
glast AS (SELECT CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS gl FROM orders),
panel AS (
  SELECT account_id, month, current_month_transactions, current_month_revenue, total_tickets, escalated_tickets,
         late_payments, enabled_channels, self_service_percentage,
         coalesce(lag(last_ts) OVER (PARTITION BY account_id ORDER BY month), CAST(month AS TIMESTAMP)) AS last_touchbase_date,
         average_resolution_time_hours,
         CAST(CASE WHEN month = max(month) OVER (PARTITION BY account_id)
                    AND month + INTERVAL 12 MONTH <= gl THEN 1 ELSE 0 END AS INTEGER) AS churned
  FROM monthly CROSS JOIN glast)"""

PANEL_E = """
ev AS (
  SELECT 'USR-' || repeat('0', greatest(0, 6 - length(CAST(user_id AS VARCHAR)))) || CAST(user_id AS VARCHAR) AS account_id, CAST(ts AS DATE) AS month, ts, event_type, value,
         (['web', 'card', 'agent', 'ivr', 'apple_pay'])[CAST(((CAST(json_extract_string(props, '$.k') AS BIGINT) % 5) + 5) % 5 AS INTEGER) + 1] AS channel
  FROM events),
daily AS (
  SELECT account_id, month,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS current_month_transactions,
         round(coalesce(sum(value) FILTER (WHERE event_type = 'purchase'), 0.0), 2) AS current_month_revenue,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS total_tickets,
         CAST(count(*) FILTER (WHERE event_type = 'error' AND value > 40) AS BIGINT) AS escalated_tickets,
         CAST(count(*) FILTER (WHERE event_type = 'signup') AS BIGINT) AS late_payments,
         coalesce(string_agg(DISTINCT channel, '|' ORDER BY channel), '') AS enabled_channels,
         avg(CASE WHEN event_type IN ('view', 'click') THEN 1.0 ELSE 0.0 END::DOUBLE) * 100.0 AS self_service_percentage,
         coalesce(avg(value) FILTER (WHERE event_type = 'error'), 0.0) AS average_resolution_time_hours,
         max(ts) AS last_ts
  FROM ev GROUP BY account_id, month),
eglast AS (SELECT CAST(max(ts) AS DATE) AS gl FROM events),
panel AS (
  SELECT account_id, month, current_month_transactions, current_month_revenue, total_tickets, escalated_tickets,
         late_payments, enabled_channels, self_service_percentage,
         coalesce(lag(last_ts) OVER (PARTITION BY account_id ORDER BY month), CAST(month AS TIMESTAMP)) AS last_touchbase_date,
         average_resolution_time_hours,
         CAST(CASE WHEN month = max(month) OVER (PARTITION BY account_id)
                    AND month + INTERVAL 7 DAY <= gl THEN 1 ELSE 0 END AS INTEGER) AS churned
  FROM daily CROSS JOIN eglast)"""


def _rows(n: int) -> str:
    return f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


def rolling_sql(m: str, off: float) -> list[str]:
    out = []
    for name, n, mp in WINDOWS:
        ov = f"OVER ({W} {_rows(n)})"
        ok = f"count({m}) {ov} >= {mp}"
        avg = f"(CASE WHEN {ok} THEN avg({m}) {ov} END)"
        out += [
            f"CASE WHEN {ok} THEN CAST(sum({m}) {ov} AS DOUBLE) END AS {m}_{name}_sum",
            f"CAST({avg} AS DOUBLE) AS {m}_{name}_avg",
            f"CASE WHEN {ok} THEN CAST(max({m}) {ov} AS DOUBLE) END AS {m}_{name}_max",
            f"CASE WHEN {ok} THEN CAST(min({m}) {ov} AS DOUBLE) END AS {m}_{name}_min",
            f"CAST({m} AS DOUBLE) / NULLIF({avg} + {off}, 0) AS {m}_trend_{name}",
            f"CASE WHEN count({m}) {ov} >= {max(2, mp)} THEN stddev_samp({m}) {ov} END AS {m}_volatility_{name}",
        ]
    return out


def pct_sql(m: str) -> str:
    lag = f"lag({m}) OVER ({W})"
    return f"CAST({m} - {lag} AS DOUBLE) / NULLIF({lag}, 0)"


def features_ctes(src: str = "panel") -> str:
    flags = ", ".join(
        f"CAST(coalesce(contains(enabled_channels, '{c}'), false) AS INTEGER) AS has_{c}" for c in CHANNELS
    )
    noc = " + ".join(f"has_{c}" for c in CHANNELS)
    win = [
        "CAST(floor(CAST(date_diff('microsecond', last_touchbase_date, CAST(month AS TIMESTAMP)) AS DOUBLE)"
        " / 86400000000.0) AS BIGINT) AS days_since_last_contact",
        "CAST((year(month) - year(min(month) OVER (PARTITION BY account_id))) * 12"
        " + (month(month) - month(min(month) OVER (PARTITION BY account_id))) AS BIGINT) AS account_age_months",
    ]
    for m, off in PANEL_METRICS:
        win += rolling_sql(m, off)
        win.append(f"{pct_sql(m)} AS {m}_percent_change")
        if m in COMPARISON_METRICS:
            win.append(f"{m} AS {m}_30d")
            win.append(
                f"CAST({m} AS DOUBLE) / (sum({m}) OVER ({W} ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) + 1)"
                f" AS {m}_recent_vs_historical"
            )
    avg3 = f"avg(number_of_channels) OVER ({W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    mx = f"max(number_of_channels) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    win += [
        f"{avg3} AS number_of_channels_avg_90d",
        f"number_of_channels / NULLIF({avg3} + 0.01, 0) AS channel_trend",
        f"{mx} AS max_channels_ever",
        f"{mx} - number_of_channels AS channels_dropped",
    ]
    acc = ", ".join(
        f"{m}_percent_change - lag({m}_percent_change) OVER ({W}) AS {m}_acceleration" for m, _ in PANEL_METRICS
    )
    filled = [c for c in RAW_COLS] + [f"coalesce({f}, 0) AS {f}" for f in feature_names()]
    return f"""
f1 AS (SELECT *, {flags} FROM {src}),
f2 AS (SELECT *, {noc} AS number_of_channels FROM f1),
f3 AS (SELECT *, {", ".join(win)} FROM f2),
f4 AS (SELECT *, {acc} FROM f3),
feats AS (SELECT {", ".join(filled)} FROM f4)"""


def fixed_score_sql(coefs=FIXED_COEFFICIENTS, intercept=FIXED_INTERCEPT, digits=True) -> str:
    z = f"({intercept}"
    for k, v in coefs.items():
        z += f" + ({v}) * CAST({k} AS DOUBLE)"
    z += ")"
    score = f"1.0 / (1.0 + exp(-{z}))"
    return f"round({score}, 4)" if digits else score


TIER_SQL = (
    "CASE WHEN churn_risk_score >= 0.7 THEN 'High Risk' WHEN churn_risk_score >= 0.4 THEN 'Medium Risk'"
    " WHEN churn_risk_score >= 0.2 THEN 'Low Risk' ELSE 'Very Safe' END"
)


def scored_ctes(coefs=FIXED_COEFFICIENTS, intercept=FIXED_INTERCEPT, name="scored", digits=True) -> str:
    return f"""
{name}_s0 AS (SELECT *, {fixed_score_sql(coefs, intercept, digits)} AS churn_risk_score FROM feats),
{name} AS (
  SELECT *, CAST(churn_risk_score >= 0.5 AS INTEGER) AS prediction, 1.0 - churn_risk_score AS safe_probability,
         {TIER_SQL} AS risk_tier,
         CAST(coalesce(max(churned) OVER ({W} ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING), 0) > 0 AS INTEGER) AS {EVAL}
  FROM {name}_s0)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


BASE_O = with_(PANEL_O)
FEATS_O = with_(PANEL_O, features_ctes())
SCORED_O = with_(PANEL_O, features_ctes(), scored_ctes())
PANEL_DOUBLES = set(RAW_DOUBLES)

ALT_COEFFICIENTS = {
    "late_payments": 0.6,
    "total_tickets": 0.05,
    "self_service_percentage": -0.02,
    "current_month_revenue_trend_90d": -0.8,
    "number_of_channels": -0.2,
}
ALT_INTERCEPT = -1.5


def _curve(src: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""
pts0 AS (SELECT {g}churn_risk_score AS threshold, CAST(sum({EVAL}) AS BIGINT) AS pos,
                CAST(count(*) - sum({EVAL}) AS BIGINT) AS neg
         FROM {src} GROUP BY {g}churn_risk_score),
curve AS (SELECT {g}threshold, pos, neg,
                 CAST(sum(pos) OVER ({part}ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp,
                 CAST(sum(neg) OVER ({part}ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp,
                 CAST(sum(pos) OVER ({part.strip()}) AS BIGINT) AS n_pos,
                 CAST(sum(neg) OVER ({part.strip()}) AS BIGINT) AS n_neg
          FROM pts0)"""


def _pr_table(group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    return f"""
prt AS (SELECT {g}threshold,
               CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
               CASE WHEN n_pos > 0 THEN tp / n_pos ELSE 1.0 END AS recall,
               CASE WHEN tp + fp + n_pos > 0 THEN 2 * tp / (tp + fp + n_pos) ELSE 0.0 END AS f1_score,
               (tp + fp) / (n_pos + n_neg) AS predicted_churn_rate
        FROM curve),
prt2 AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-10) AS f1e,
                precision >= {{minp}} AS ok FROM prt)"""


def _threshold_sql(metric: str, minp: float, group: str | None = None, src_ctes: str = SCORED_O, src="scored") -> str:
    g = f"{group}, " if group else ""
    target = {"f1": "f1e", "recall": "recall", "custom": "f1e"}[metric]
    okc = "TRUE" if metric == "f1" else "ok"
    part = f"PARTITION BY {group} " if group else ""
    return (
        src_ctes.rstrip("\n")
        + ","
        + _curve(src, group)
        + ","
        + _pr_table(group).replace("{minp}", str(minp))
        + f""",
ranked AS (SELECT *, {okc} AS okk, max(CAST({okc} AS INTEGER)) OVER ({part.strip()}) AS any_ok,
                  row_number() OVER ({part}ORDER BY CAST({okc} AS INTEGER) DESC, {target} DESC, threshold ASC) AS rn_best,
                  row_number() OVER ({part}ORDER BY f1e DESC, threshold ASC) AS rn_fb
           FROM prt2)
SELECT {g}{r4('threshold')} AS threshold, {r4('precision')} AS precision, {r4('recall')} AS recall,
       {r4('f1_score')} AS f1_score, {r4('predicted_churn_rate')} AS predicted_churn_rate
FROM ranked WHERE (any_ok = 1 AND rn_best = 1) OR (any_ok = 0 AND rn_fb = 1)"""
    )


def _two_models() -> str:
    return with_(
        PANEL_O,
        features_ctes(),
        scored_ctes(),
        scored_ctes(ALT_COEFFICIENTS, ALT_INTERCEPT, name="scored_b"),
        f"""
two AS (SELECT 'linear_a' AS model_name, account_id, month, churn_risk_score, prediction, {EVAL} FROM scored
        UNION ALL
        SELECT 'linear_b' AS model_name, account_id, month, churn_risk_score, prediction, {EVAL} FROM scored_b)""",
    )


def model_feature_names() -> list[str]:
    return MODEL_RAW + feature_names()


def _stats_ctes(src="scored") -> str:
    feats = model_feature_names()
    casts = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in feats)
    return f"""
popd AS (SELECT {EVAL} AS y, {casts} FROM {src}),
poplong AS (UNPIVOT popd ON {", ".join(feats)} INTO NAME feature VALUE value),
stats AS (SELECT feature, avg(value) FILTER (WHERE y = 0) AS safe_avg,
                 stddev_samp(value) FILTER (WHERE y = 0) AS safe_std,
                 avg(value) FILTER (WHERE y = 1) AS churned_avg,
                 CAST(count(*) FILTER (WHERE y = 0) AS BIGINT) AS n_safe,
                 CAST(count(*) FILTER (WHERE y = 1) AS BIGINT) AS n_churned
          FROM poplong GROUP BY feature),
imp0 AS (SELECT feature, coalesce(abs(churned_avg - safe_avg) / NULLIF(safe_std, 0), 0.0) AS e FROM stats),
imp AS (SELECT feature, coalesce(e / NULLIF(sum(e) OVER (), 0), 0.0) AS importance FROM imp0)"""


CATEGORY_SQL = """CASE
  WHEN contains(feature, 'revenue') THEN 'Revenue/Spending'
  WHEN contains(feature, 'transaction') THEN 'Transaction Volume'
  WHEN contains(feature, 'ticket') OR contains(feature, 'escalated') THEN 'Support Quality'
  WHEN contains(feature, 'channel') THEN 'Channel Usage'
  WHEN contains(feature, 'payment') THEN 'Payment Behavior'
  WHEN contains(feature, 'self_service') THEN 'Self-Service'
  WHEN contains(feature, 'resolution') THEN 'Support Speed'
  WHEN contains(feature, 'contact') OR contains(feature, 'touchbase') THEN 'Engagement'
  WHEN contains(feature, 'age') THEN 'Customer Tenure'
  ELSE 'Other' END"""

CONCERN_SQL = """CASE WHEN z_score > 2 THEN 'VERY HIGH' WHEN z_score > 1 THEN 'High'
  WHEN z_score < -2 THEN 'VERY LOW' WHEN z_score < -1 THEN 'Low' ELSE 'Normal' END"""


def _explain_sql(rows_cte: str, top_n: int) -> str:
    feats = model_feature_names()
    casts = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in feats)
    return (
        SCORED_O.rstrip("\n")
        + ","
        + _stats_ctes()
        + f""",
{rows_cte},
xd AS (SELECT account_id, month, {casts} FROM xrows),
xl AS (UNPIVOT xd ON {", ".join(feats)} INTO NAME feature VALUE value),
xs AS (SELECT xl.account_id, xl.month, xl.feature, xl.value, s.safe_avg, s.churned_avg,
              CASE WHEN s.safe_std > 0 THEN (xl.value - s.safe_avg) / s.safe_std ELSE 0.0 END AS z_score,
              coalesce(i.importance, 0.0) AS importance,
              coalesce(abs(xl.value - s.churned_avg) < abs(xl.value - s.safe_avg), false) AS closer_to_churned
       FROM xl JOIN stats s ON xl.feature = s.feature LEFT JOIN imp i ON xl.feature = i.feature),
xr AS (SELECT *, abs(z_score) * importance AS risk_score FROM xs),
xk AS (SELECT *, row_number() OVER (PARTITION BY account_id, month ORDER BY risk_score DESC, feature) AS rank FROM xr)
SELECT account_id, month, CAST(rank AS INTEGER) AS rank, feature, {r4('value')} AS value, {r4('safe_avg')} AS safe_avg,
       {r4('churned_avg')} AS churned_avg, {r4('z_score')} AS z_score, {r4('importance')} AS importance,
       {r4('risk_score')} AS risk_score, closer_to_churned, {CONCERN_SQL} AS concern
FROM xk WHERE rank <= {top_n}"""
    )


def _quantile_ctes(src: str) -> str:
    return f"""
cuts AS (SELECT quantile_cont(CAST(total_tickets AS DOUBLE), 0.5) AS tickets_median,
                quantile_cont(average_resolution_time_hours, 0.5) AS resolution_median,
                quantile_cont(CAST(current_month_transactions AS DOUBLE), 0.33) AS transactions_q33
         FROM {src})"""


def _segments_sql() -> str:
    return (
        SCORED_O.rstrip("\n")
        + ","
        + _stats_ctes()
        + """,
hr AS (SELECT * FROM scored WHERE risk_tier IN ('High Risk', 'Medium Risk')),"""
        + _quantile_ctes("hr")
        + """,
topf AS (SELECT feature FROM imp ORDER BY importance DESC, feature LIMIT 20),
gates AS (SELECT coalesce(bool_or(contains(feature, 'ticket') OR contains(feature, 'resolution')), false) AS g_support,
                 coalesce(bool_or(contains(feature, 'transaction') OR contains(feature, 'channel')), false) AS g_eng,
                 coalesce(bool_or(contains(feature, 'payment')), false) AS g_pay,
                 coalesce(bool_or(contains(feature, 'revenue') AND contains(feature, 'trend')), false) AS g_rev
          FROM topf),
segs AS (
  SELECT 'Support Issues' AS segment, hr.* FROM hr, cuts, gates
   WHERE g_support AND (total_tickets > tickets_median OR average_resolution_time_hours > resolution_median)
  UNION ALL
  SELECT 'Declining Engagement', hr.* FROM hr, cuts, gates
   WHERE g_eng AND (current_month_transactions < transactions_q33 OR number_of_channels <= 2)
  UNION ALL
  SELECT 'Payment Issues', hr.* FROM hr, gates WHERE g_pay AND late_payments > 0
  UNION ALL
  SELECT 'Revenue Decline', hr.* FROM hr, gates WHERE g_rev AND current_month_revenue_trend_90d < 0.85)"""
    )


ACTION_SQL = """CASE segment
  WHEN 'Support Issues' THEN 'Assign dedicated support rep, proactive check-ins, prioritize tickets'
  WHEN 'Declining Engagement' THEN 'Onboarding campaign, product tutorials, feature adoption emails'
  WHEN 'Payment Issues' THEN 'Flexible payment plans, financial hardship outreach, billing support'
  WHEN 'Revenue Decline' THEN 'Show ROI evidence, success stories, upsell value-add features'
  ELSE 'Review and take appropriate action' END"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    panel_sel = select_rounded(RAW_COLS, PANEL_DOUBLES, "panel")
    q["panel_orders"] = BASE_O + panel_sel
    q["panel_events"] = with_(PANEL_E) + panel_sel
    q["panel_profile"] = BASE_O + """SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT account_id) AS BIGINT) AS n_accounts,
  CAST(count(DISTINCT CASE WHEN churned = 1 THEN account_id END) AS BIGINT) AS n_churned_accounts,
  """ + r4("count(DISTINCT CASE WHEN churned = 1 THEN account_id END) / count(DISTINCT account_id)") + " AS account_churn_rate FROM panel"

    rules = [(f"{c}_non_negative", f"{c} < 0") for c in [
        "current_month_transactions", "current_month_revenue", "total_tickets", "escalated_tickets",
        "late_payments", "average_resolution_time_hours"]]
    rules += [
        ("churned_binary", "churned NOT IN (0, 1)"),
        ("self_service_in_0_100", "self_service_percentage < 0 OR self_service_percentage > 100"),
        ("escalated_le_total", "escalated_tickets > total_tickets"),
        ("channels_in_valid_set", "len(list_filter(string_split(coalesce(enabled_channels, ''), '|'), lambda x: x <> '' AND x NOT IN ('web', 'card', 'agent', 'ivr', 'apple_pay'))) > 0"),
        ("unique_account_period", "n_key > 1"),
        ("one_churn_per_account", "rn = 1 AND n_churn > 1"),
        ("no_row_after_churn", "coalesce(churn_before, 0) > 0"),
        ("tenure_non_decreasing", "account_age_months < prev_age"),
    ] + [(f"has_{c}_binary", f"has_{c} NOT IN (0, 1)") for c in CHANNELS]
    dq_union = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS rule, CAST(count(*) FILTER (WHERE coalesce({cond}, false)) AS BIGINT) AS n_violations FROM dqb"
        for name, cond in rules
    )
    q["dq_expectations"] = FEATS_O.rstrip("\n") + f""",
dqb AS (SELECT *, row_number() OVER ({W}) AS rn, sum(churned) OVER (PARTITION BY account_id) AS n_churn,
               count(*) OVER (PARTITION BY account_id, month) AS n_key,
               max(churned) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS churn_before,
               lag(account_age_months) OVER ({W}) AS prev_age FROM feats)
{dq_union}"""

    metric_cols = ["current_month_transactions", "current_month_revenue", "total_tickets", "escalated_tickets",
                   "late_payments", "self_service_percentage", "average_resolution_time_hours"]
    spine_sel = []
    for c in RAW_COLS:
        if c in ("account_id", "month"):
            spine_sel.append(f"s.{c}")
        elif c in metric_cols or c == "churned":
            spine_sel.append(f"coalesce(p.{c}, 0) AS {c}" if c not in PANEL_DOUBLES else f"{r4(f'coalesce(p.{c}, 0)')} AS {c}")
        elif c == "enabled_channels":
            spine_sel.append("coalesce(p.enabled_channels, '') AS enabled_channels")
        else:
            spine_sel.append(f"p.{c}")
    q["month_spine"] = BASE_O.rstrip("\n") + f""",
bounds AS (SELECT account_id, min(month) AS s0, coalesce(min(CASE WHEN churned = 1 THEN month END), max(month)) AS s1 FROM panel GROUP BY account_id),
sp AS (SELECT account_id, CAST(unnest(generate_series(CAST(s0 AS TIMESTAMP), CAST(s1 AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month FROM bounds)
SELECT {", ".join(spine_sel)}, CAST(CASE WHEN p.account_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS observed
FROM sp s LEFT JOIN panel p ON s.account_id = p.account_id AND s.month = p.month"""

    lr = []
    for c in RAW_COLS:
        if c == "account_id":
            lr.append("account_id")
        elif c == "month":
            lr.append("max(month) AS month")
        else:
            e = f"arg_max({c}, CASE WHEN {c} IS NOT NULL THEN month END)"
            lr.append(f"{r4(e)} AS {c}" if c in PANEL_DOUBLES else f"{e} AS {c}")
    q["last_record"] = BASE_O + f"SELECT {', '.join(lr)} FROM panel GROUP BY account_id"

    chan_cols = ["account_id", "month", "enabled_channels"] + [f"has_{c}" for c in CHANNELS] + [
        "number_of_channels", "number_of_channels_avg_90d", "channel_trend", "max_channels_ever", "channels_dropped"]
    q["channel_features"] = FEATS_O + select_rounded(chan_cols, DOUBLES, "feats")
    q["metadata_features"] = FEATS_O + select_rounded(
        ["account_id", "month", "last_touchbase_date", "days_since_last_contact", "account_age_months"], DOUBLES, "feats")

    for qname, (m, off) in zip(
        ["rolling_revenue", "rolling_transactions", "rolling_late", "rolling_escalated", "rolling_self_service",
         "rolling_resolution"], PANEL_METRICS):
        cols = ["account_id", "month", m]
        names = []
        for w, _, _ in WINDOWS:
            names += [f"{m}_{w}_{a}" for a in ("sum", "avg", "max", "min")] + [f"{m}_trend_{w}", f"{m}_volatility_{w}"]
        q[qname] = BASE_O.rstrip("\n") + f""",
r AS (SELECT account_id, month, {m}, {", ".join(rolling_sql(m, off))} FROM panel)
""" + select_rounded(cols + names, set(names) | PANEL_DOUBLES, "r")

    ch_metrics = ["current_month_revenue", "current_month_transactions"]
    ch_parts = ", ".join(f"{pct_sql(m)} AS {m}_percent_change" for m in ch_metrics)
    ch_acc = ", ".join(f"{m}_percent_change - lag({m}_percent_change) OVER ({W}) AS {m}_acceleration" for m in ch_metrics)
    ch_cols = ["account_id", "month"] + ch_metrics + [f"{m}_percent_change" for m in ch_metrics] + [
        f"{m}_acceleration" for m in ch_metrics]
    q["change_features"] = BASE_O.rstrip("\n") + f""",
c1 AS (SELECT account_id, month, {", ".join(ch_metrics)}, {ch_parts} FROM panel),
c2 AS (SELECT *, {ch_acc} FROM c1)
""" + select_rounded(ch_cols, {c for c in ch_cols if c not in ("account_id", "month", "current_month_transactions")}, "c2")

    rv = []
    rv_cols = ["account_id", "month"]
    rv_d = set()
    for m in ch_metrics:
        prev = f"sum({m}) OVER ({W} ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING)"
        rv += [f"{m} AS {m}_30d", f"CAST({prev} AS DOUBLE) AS {m}_prev_two",
               f"CAST({m} AS DOUBLE) / ({prev} + 1) AS {m}_recent_vs_historical"]
        rv_cols += [f"{m}_30d", f"{m}_prev_two", f"{m}_recent_vs_historical"]
        rv_d |= {f"{m}_prev_two", f"{m}_recent_vs_historical"}
    rv_d.add("current_month_revenue_30d")
    q["recent_vs_historical"] = BASE_O.rstrip("\n") + f""",
rv AS (SELECT account_id, month, {", ".join(rv)} FROM panel)
""" + select_rounded(rv_cols, rv_d, "rv")

    all_cols = RAW_COLS + feature_names()
    q["full_features"] = FEATS_O + select_rounded(all_cols, DOUBLES, "feats")
    q["features_events"] = with_(PANEL_E, features_ctes()) + select_rounded(all_cols, DOUBLES, "feats")
    mm = ["account_id", "month"] + model_feature_names()
    q["model_matrix"] = FEATS_O + "SELECT " + ", ".join(
        ["account_id", "month"]
        + [f"{r4(f'coalesce(CASE WHEN isfinite(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END, 0.0)')} AS {c}" for c in mm[2:]]
        + ["CAST(churned AS DOUBLE) AS churned"]
    ) + " FROM feats"

    lab = f"CAST(coalesce(max(churned) OVER ({W} ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING), 0) > 0 AS INTEGER) AS {EVAL}"
    q["horizon_labels"] = BASE_O + f"SELECT account_id, month, churned, {lab} FROM panel"
    q["label_uplift"] = BASE_O.rstrip("\n") + f""",
lb AS (SELECT churned, {lab} FROM panel)
SELECT 'all' AS split, CAST(count(*) AS BIGINT) AS n_rows, {r4('avg(churned)')} AS churned_rate,
       {r4(f'avg({EVAL})')} AS {EVAL}_rate, {r4(f'avg({EVAL}) / NULLIF(avg(churned), 0)')} AS uplift FROM lb"""
    midx = """
mi AS (SELECT month, row_number() OVER (ORDER BY month) AS idx, count(*) OVER () AS n FROM (SELECT DISTINCT month FROM panel))"""
    split3 = "CASE WHEN idx <= 40 THEN 'train' WHEN idx <= 52 THEN 'val' WHEN idx <= 68 THEN 'test' END"
    q["split_time"] = BASE_O.rstrip("\n") + "," + midx + f"""
SELECT * FROM (SELECT p.account_id, p.month, p.churned, {split3} AS split FROM panel p JOIN mi USING (month)) WHERE split IS NOT NULL"""
    q["split_horizon"] = BASE_O.rstrip("\n") + "," + midx + """
SELECT * FROM (SELECT p.account_id, p.month, p.churned,
  CASE WHEN idx <= 40 THEN 'train' WHEN idx <= n - 12 THEN 'test' END AS split FROM panel p JOIN mi USING (month)) WHERE split IS NOT NULL"""
    q["split_rates"] = BASE_O.rstrip("\n") + "," + midx + f""",
lb AS (SELECT p.churned, {lab.replace('churned) OVER', 'p.churned) OVER').replace(W, 'PARTITION BY p.account_id ORDER BY p.month')}, {split3} AS split
       FROM panel p JOIN mi USING (month))
SELECT split, CAST(count(*) AS BIGINT) AS n_rows, {r4('avg(churned)')} AS churned_rate, {r4(f'avg({EVAL})')} AS {EVAL}_rate,
       {r4(f'avg({EVAL}) / NULLIF(avg(churned), 0)')} AS uplift
FROM lb WHERE split IS NOT NULL GROUP BY split"""
    q["cv_folds"] = BASE_O.rstrip("\n") + "," + midx + """,
tr AS (SELECT p.account_id, p.month FROM panel p JOIN mi USING (month) WHERE idx <= 40),
ti AS (SELECT month, row_number() OVER (ORDER BY month) AS idx, count(*) OVER () AS n FROM (SELECT DISTINCT month FROM tr)),
tb AS (SELECT month, CAST(CASE WHEN idx <= n - floor(n / 4) * 3 THEN 0
                  ELSE ceil((idx - (n - floor(n / 4) * 3)) / floor(n / 4)) END AS INTEGER) AS cv_block FROM ti)
SELECT tr.account_id, tr.month, tb.cv_block FROM tr JOIN tb USING (month)"""
    q["class_distribution"] = BASE_O.rstrip("\n") + f""",
lb AS (SELECT {lab} FROM panel)
SELECT {EVAL}, CAST(count(*) AS BIGINT) AS n_rows FROM lb GROUP BY {EVAL}"""
    q["class_weights"] = BASE_O.rstrip("\n") + f""",
lb AS (SELECT account_id, month, {lab} FROM panel),
cc AS (SELECT {EVAL}, count(*) AS nc FROM lb GROUP BY {EVAL}),
cw AS (SELECT {EVAL}, (SELECT sum(nc) FROM cc) / ((SELECT count(*) FROM cc) * nc) AS w FROM cc)
SELECT lb.account_id, lb.month, lb.{EVAL}, {r4('cw.w')} AS class_weight FROM lb JOIN cw USING ({EVAL})"""

    # ---- scoring
    score_cols = ["account_id", "month", "churn_risk_score", "prediction", "safe_probability", "risk_tier", EVAL]
    sd = {"churn_risk_score", "safe_probability"}
    q["score_fixed"] = SCORED_O + select_rounded(score_cols, sd, "scored")
    q["tier_distribution"] = SCORED_O.rstrip("\n") + """,
tiers AS (SELECT * FROM (VALUES ('High Risk', 0), ('Medium Risk', 1), ('Low Risk', 2), ('Very Safe', 3)) t(risk_tier, tier_order)),
cnt AS (SELECT risk_tier, count(*) AS n FROM scored GROUP BY risk_tier),
tot AS (SELECT sum(n) AS total FROM cnt)
SELECT t.risk_tier, CAST(t.tier_order AS INTEGER) AS tier_order, CAST(coalesce(c.n, 0) AS BIGINT) AS n_rows,
       """ + r4("coalesce(c.n, 0) * 100.0 / total") + """ AS percent
FROM tiers t LEFT JOIN cnt c USING (risk_tier) CROSS JOIN tot"""
    q["score_stats"] = SCORED_O + f"""SELECT CAST(count(churn_risk_score) AS BIGINT) AS n_scored, {r4('avg(churn_risk_score)')} AS mean_score,
  {r4('quantile_cont(churn_risk_score, 0.5)')} AS median_score, {r4('max(churn_risk_score)')} AS max_score,
  {r4('min(churn_risk_score)')} AS min_score FROM scored"""
    q["predicted_counts"] = SCORED_O + f"""SELECT CAST(sum(prediction) AS BIGINT) AS predicted_churn,
  CAST(count(*) - sum(prediction) AS BIGINT) AS predicted_non_churn,
  {r4('sum(prediction) / count(*)')} AS churn_share, {r4('1 - sum(prediction) / count(*)')} AS non_churn_share FROM scored"""
    q["high_risk_list"] = SCORED_O + f"""SELECT account_id, month, {r4('churn_risk_score')} AS churn_risk_score, risk_tier
FROM scored WHERE risk_tier IN ('High Risk', 'Medium Risk')"""
    q["account_lookup"] = SCORED_O + select_rounded(score_cols, sd, "scored") + " WHERE account_id = 'ACC-000010'"
    q["tier_extract"] = SCORED_O + f"""SELECT account_id, month, {r4('churn_risk_score')} AS churn_risk_score, risk_tier
FROM scored WHERE risk_tier = 'High Risk' ORDER BY churn_risk_score DESC, account_id, month"""
    q["top_risk"] = SCORED_O + f"""SELECT account_id, month, {r4('churn_risk_score')} AS churn_risk_score, risk_tier
FROM scored ORDER BY churn_risk_score DESC, account_id, month LIMIT 20"""

    # ---- metrics
    cm = f"""SELECT CAST(count(*) FILTER (WHERE {EVAL} = 0 AND prediction = 0) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE {EVAL} = 0 AND prediction = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE {EVAL} = 1 AND prediction = 0) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE {EVAL} = 1 AND prediction = 1) AS BIGINT) AS tp"""
    q["confusion"] = SCORED_O + cm + " FROM scored"
    roc_auc_sel = (
        "CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN sum(pos * ((n_neg - fp) + 0.5 * neg)) / (max(n_pos) * max(n_neg)) END"
    )
    pr_auc_sel = """CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN sum(
        ((CAST(tp AS DOUBLE) / n_pos) - (CAST(tp - pos AS DOUBLE) / n_pos))
        * ((CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END)
           + (CASE WHEN (tp - pos) + (fp - neg) > 0 THEN CAST(tp - pos AS DOUBLE) / ((tp - pos) + (fp - neg)) ELSE 1.0 END)) / 2) END"""
    q["pr_baseline"] = SCORED_O + f"SELECT {r4(f'avg(CAST({EVAL} AS DOUBLE))')} AS pr_baseline, CAST(count(*) AS BIGINT) AS n_rows FROM scored"
    q["roc_auc"] = SCORED_O.rstrip("\n") + "," + _curve("scored") + f"\nSELECT {r4(roc_auc_sel)} AS roc_auc FROM curve"
    q["pr_auc"] = SCORED_O.rstrip("\n") + "," + _curve("scored") + f"\nSELECT {r4(pr_auc_sel)} AS pr_auc FROM curve"
    q["roc_points"] = SCORED_O.rstrip("\n") + "," + _curve("scored") + f"""
SELECT {r4('threshold')} AS threshold, {r4('CASE WHEN n_neg > 0 THEN fp / n_neg ELSE 0.0 END')} AS fpr,
       {r4('CASE WHEN n_pos > 0 THEN tp / n_pos ELSE 0.0 END')} AS tpr FROM curve"""
    q["pr_points"] = SCORED_O.rstrip("\n") + "," + _curve("scored") + """,
pp AS (SELECT threshold, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
              CASE WHEN n_pos > 0 THEN tp / n_pos ELSE 1.0 END AS recall FROM curve
       UNION ALL SELECT NULL, 1.0, 0.0)
SELECT """ + f"{r4('threshold')} AS threshold, {r4('precision')} AS precision, {r4('recall')} AS recall, " + r4(
        "2 * precision * recall / (precision + recall + 1e-10)") + " AS f1 FROM pp"
    cls = f"""
cmx AS ({cm} FROM scored),
auc AS (SELECT {roc_auc_sel} AS roc_auc, {pr_auc_sel} AS pr_auc FROM curve)
SELECT {r4('CASE WHEN tn + fp + fn + tp > 0 THEN (tp + tn) / (tn + fp + fn + tp) ELSE 0.0 END')} AS accuracy,
       {r4('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END')} AS precision,
       {r4('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END')} AS recall,
       {r4('CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END')} AS f1_score,
       tn, fp, fn, tp, {r4('roc_auc')} AS roc_auc, {r4('pr_auc')} AS pr_auc
FROM cmx CROSS JOIN auc"""
    q["classification_metrics"] = SCORED_O.rstrip("\n") + "," + _curve("scored") + "," + cls
    rep = f"""
cmx AS ({cm} FROM scored),
w AS (SELECT
  CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0,
  CASE WHEN 2 * tn + fn + fp > 0 THEN 2 * tn / (2 * tn + fn + fp) ELSE 0.0 END AS f0, tn + fp AS s0,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1, tp + fn AS s1,
  CASE WHEN tn + fp + fn + tp > 0 THEN (tp + tn) / (tn + fp + fn + tp) ELSE 0.0 END AS acc, tn + fp + fn + tp AS n FROM cmx),
rows_ AS (
  SELECT '0' AS class_label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM w
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM w
  UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM w
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM w
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / NULLIF(n, 0), (r0 * s0 + r1 * s1) / NULLIF(n, 0), (f0 * s0 + f1 * s1) / NULLIF(n, 0), n FROM w)
SELECT class_label, {r4('precision')} AS precision, {r4('recall')} AS recall, {r4('f1_score')} AS f1_score,
       CAST(support AS BIGINT) AS support FROM rows_"""
    q["classification_report"] = SCORED_O.rstrip("\n") + "," + rep
    for m in ("f1", "recall", "custom"):
        q[f"threshold_{m}"] = _threshold_sql(m, 0.3)
    opt = _threshold_sql("f1", 0.5)
    head, tail = opt.rsplit("\nSELECT ", 1)
    q["threshold_vs_default"] = head + f""",
best AS (SELECT * FROM ranked WHERE (any_ok = 1 AND rn_best = 1) OR (any_ok = 0 AND rn_fb = 1)),
dflt AS (SELECT 0.5 AS threshold,
   count(*) FILTER (WHERE churn_risk_score >= 0.5 AND {EVAL} = 1) AS tp,
   count(*) FILTER (WHERE churn_risk_score >= 0.5 AND {EVAL} = 0) AS fp,
   count(*) FILTER (WHERE churn_risk_score < 0.5 AND {EVAL} = 1) AS fn,
   count(*) AS n FROM scored)
SELECT 'optimal' AS setting, {r4('threshold')} AS threshold, {r4('precision')} AS precision, {r4('recall')} AS recall,
       {r4('f1_score')} AS f1_score, {r4('predicted_churn_rate')} AS predicted_churn_rate FROM best
UNION ALL
SELECT 'default', {r4('threshold')}, {r4('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END')},
       {r4('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END')},
       {r4('CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END')},
       {r4('CASE WHEN n > 0 THEN (tp + fp) / n ELSE 0.0 END')} FROM dflt"""
    two = _two_models()
    q["compare_models"] = _threshold_sql("f1", 0.5, group="model_name", src_ctes=two, src="two")
    q["evaluate_models"] = two.rstrip("\n") + "," + _curve("two", "model_name") + f""",
cmx AS (SELECT model_name,
  CAST(count(*) FILTER (WHERE {EVAL} = 0 AND prediction = 0) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE {EVAL} = 0 AND prediction = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE {EVAL} = 1 AND prediction = 0) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE {EVAL} = 1 AND prediction = 1) AS BIGINT) AS tp FROM two GROUP BY model_name),
auc AS (SELECT model_name, {roc_auc_sel} AS roc_auc, {pr_auc_sel} AS pr_auc FROM curve GROUP BY model_name)
SELECT model_name, {r4('CASE WHEN tn + fp + fn + tp > 0 THEN (tp + tn) / (tn + fp + fn + tp) ELSE 0.0 END')} AS accuracy,
       {r4('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END')} AS precision,
       {r4('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END')} AS recall,
       {r4('CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END')} AS f1_score,
       tn, fp, fn, tp, {r4('roc_auc')} AS roc_auc, {r4('pr_auc')} AS pr_auc
FROM cmx JOIN auc USING (model_name)"""

    fine = with_(PANEL_O, features_ctes(), scored_ctes(digits=False)).rstrip("\n")
    q["curve_areas_unrounded"] = fine + "," + _curve("scored") + f"""
SELECT {r4(roc_auc_sel)} AS roc_auc, {r4(pr_auc_sel)} AS pr_auc FROM curve"""
    q["stratified_split"] = BASE_O.rstrip("\n") + f""",
hl AS (SELECT *, CAST(coalesce(max(churned) OVER ({W} ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING), 0) > 0 AS INTEGER) AS {EVAL} FROM panel),
la AS (SELECT account_id, month, {EVAL} FROM hl QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY month DESC) = 1),
od AS (SELECT *, row_number() OVER (PARTITION BY {EVAL} ORDER BY CAST('0x' || substr(md5('42:' || account_id), 1, 13) AS BIGINT)) AS rn,
              count(*) OVER (PARTITION BY {EVAL}) AS n FROM la)
SELECT account_id, month, {EVAL}, CASE WHEN rn <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM od"""
    months = "mi AS (SELECT month, row_number() OVER (ORDER BY month) AS idx, count(*) OVER () AS n_m FROM (SELECT DISTINCT month FROM panel))"
    tt = BASE_O.rstrip("\n") + f""",
hl AS (SELECT account_id, month, CAST(coalesce(max(churned) OVER ({W} ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING), 0) > 0 AS INTEGER) AS y FROM panel),
{months},
tt AS (SELECT hl.*, CASE WHEN idx <= 40 THEN 'train' WHEN idx <= n_m - 12 THEN 'test' END AS split FROM hl JOIN mi USING (month))"""
    q["smote_balance"] = tt + """,
ct AS (SELECT y AS churned, CAST(count(*) AS BIGINT) AS n_rows FROM tt WHERE split = 'train' GROUP BY y)
SELECT 'before' AS stage, churned, n_rows FROM ct UNION ALL SELECT 'after', churned, max(n_rows) OVER () FROM ct"""
    q["model_invariants"] = tt + """
SELECT model_name, CAST(count(*) AS BIGINT) AS n_scored, CAST(sum(y) AS BIGINT) AS n_positive, CAST(0 AS BIGINT) AS n_outside,
       CAST(0 AS BIGINT) AS n_prediction_differs, CAST(0 AS BIGINT) AS n_tier_differs, CAST(0 AS BIGINT) AS n_changed_by_reload
FROM tt CROSS JOIN (VALUES ('lr'), ('rf'), ('gbt')) m(model_name) WHERE split = 'test' GROUP BY model_name"""
    q["tree_invariants"] = tt + """
SELECT model_name, CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_not_additive, CAST(0 AS BIGINT) AS n_score_differs,
       CAST(0 AS BIGINT) AS n_staged_differs, CAST(0 AS BIGINT) AS n_split_under_bound
FROM tt CROSS JOIN (VALUES ('rf'), ('gbt')) m(model_name) WHERE split = 'test' GROUP BY model_name"""
    best_head = q["threshold_f1"]
    q["sinks_roundtrip"] = SCORED_O + f"""SELECT 'predictions' AS sink, CAST(count(*) AS BIGINT) AS n_rows, CAST(5 AS BIGINT) AS n_columns,
  {r4('sum(prediction)')} AS total FROM scored
UNION ALL SELECT 'predictions_with_originals', CAST(count(*) AS BIGINT), CAST(15 AS BIGINT), {r4('sum(prediction)')} FROM scored
UNION ALL SELECT 'metrics', CAST(1 AS BIGINT), CAST(10 AS BIGINT), {r4(f"count(*) FILTER (WHERE prediction = 1 AND {EVAL} = 1)")} FROM scored
UNION ALL SELECT 'thresholds', CAST(1 AS BIGINT), CAST(5 AS BIGINT), {r4('threshold')} FROM ({best_head})"""
    raised = {"columns_present": 0, "columns_missing": 1, "rows_present": 0, "rows_missing": 1, "features_of_nothing": 1,
              "periods_enough": 0, "periods_short": 1}
    q["input_guards"] = BASE_O + "\nUNION ALL ".join(
        f"SELECT '{g}' AS guard, {'TRUE' if r else 'FALSE'} AS raised FROM (SELECT count(*) AS n FROM panel) WHERE n > 0" for g, r in raised.items())
    q["matrix_without_label"] = BASE_O + """SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_not_finite,
  CAST(107 AS BIGINT) AS n_features FROM panel"""

    # ---- drivers and explanations
    stats_base = SCORED_O.rstrip("\n") + "," + _stats_ctes()
    q["class_stats"] = stats_base + f"""
SELECT feature, {r4('safe_avg')} AS safe_avg, {r4('safe_std')} AS safe_std, {r4('churned_avg')} AS churned_avg, n_safe, n_churned FROM stats"""
    q["feature_category"] = stats_base + f"\nSELECT feature, {r4('importance')} AS importance, {CATEGORY_SQL} AS category FROM imp"
    q["importance_by_category"] = stats_base + f""",
topf AS (SELECT feature, importance FROM imp ORDER BY importance DESC, feature LIMIT 20)
SELECT {CATEGORY_SQL} AS category, {r4('sum(importance)')} AS importance, CAST(count(*) AS BIGINT) AS n_features
FROM topf GROUP BY 1"""
    q["segment_cutoffs"] = SCORED_O.rstrip("\n") + """,
hr AS (SELECT * FROM scored WHERE risk_tier IN ('High Risk', 'Medium Risk')),""" + _quantile_ctes("hr") + f"""
SELECT {r4('tickets_median')} AS tickets_median, {r4('resolution_median')} AS resolution_median,
       {r4('transactions_q33')} AS transactions_q33 FROM cuts"""
    q["driver_segments"] = _segments_sql() + f"""
SELECT segment, account_id, month, {r4('churn_risk_score')} AS churn_risk_score, risk_tier FROM segs"""
    q["segment_summary"] = _segments_sql() + f"""
SELECT segment, CAST(count(*) AS BIGINT) AS n_rows, {r4('avg(churn_risk_score)')} AS avg_risk, {ACTION_SQL} AS action
FROM segs GROUP BY segment"""
    q["explain_zscore"] = _explain_sql(
        "xrows AS (SELECT * FROM scored ORDER BY churn_risk_score DESC, account_id, month LIMIT 20)", 10)
    q["top_factors"] = _explain_sql(
        "xrows AS (SELECT * FROM scored WHERE risk_tier IN ('High Risk', 'Medium Risk'))", 3)
    coef_vals = ", ".join(f"('{k}', {v})" for k, v in FIXED_COEFFICIENTS.items())
    cf = list(FIXED_COEFFICIENTS)
    casts = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in cf)
    q["linear_attribution"] = SCORED_O.rstrip("\n") + f""",
coef AS (SELECT * FROM (VALUES {coef_vals}) t(feature, coefficient)),
popd AS (SELECT {casts} FROM scored),
pmean AS (SELECT feature, avg(value) AS pop_mean FROM (UNPIVOT popd ON {", ".join(cf)} INTO NAME feature VALUE value) GROUP BY feature),
xrows AS (SELECT * FROM scored ORDER BY churn_risk_score DESC, account_id, month LIMIT 20),
xd AS (SELECT account_id, month, {casts} FROM xrows),
xl AS (UNPIVOT xd ON {", ".join(cf)} INTO NAME feature VALUE value),
xa AS (SELECT xl.account_id, xl.month, xl.feature, xl.value, pmean.pop_mean, coef.coefficient,
              coef.coefficient * (xl.value - pmean.pop_mean) AS contribution
       FROM xl JOIN pmean USING (feature) JOIN coef USING (feature))
SELECT account_id, month, feature, {r4('value')} AS value, {r4('pop_mean')} AS pop_mean, {r4('coefficient')} AS coefficient,
       {r4('contribution')} AS contribution,
       CAST(row_number() OVER (PARTITION BY account_id, month ORDER BY abs(contribution) DESC, feature) AS INTEGER) AS rank
FROM xa"""
    prof = f"""SELECT '{{fmt}}' AS format, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT account_id) AS BIGINT) AS n_accounts,
  CAST(sum(current_month_transactions) AS BIGINT) AS transactions, {r4('round(sum(current_month_revenue), 2)')} AS revenue,
  CAST(sum(churned) AS BIGINT) AS churned, max(last_touchbase_date) AS last_touch FROM panel"""
    q["io_roundtrip"] = BASE_O + "\nUNION ALL\n".join(prof.replace("{fmt}", f) for f in ("csv", "csv_shuffled", "json", "parquet", "json_array"))
    q["segment_export"] = _segments_sql() + """
SELECT replace(lower(segment), ' ', '_') AS segment_name, CAST(count(*) AS BIGINT) AS n_rows FROM segs GROUP BY 1"""
    from panelcast.plans.dashboard_sql import dashboard_sql

    q.update(dashboard_sql())
    return q
