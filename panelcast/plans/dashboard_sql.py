"""DuckDB oracle SQL for the dashboard queries."""

from __future__ import annotations


def dashboard_sql() -> dict[str, str]:
    # parameters of the registered queries, written out
    class D:
        HIST_BINS = 20
        CONTACT_COST, ACCOUNT_VALUE, SAVE_RATE = 50.0, 1000.0, 0.3
        TRAJECTORY_ROWS = 6
        AGE_BUCKET = 6
        ALERT_RISE = 0.2
        HIGH_VALUE_REVENUE = 500000.0
        REPLACED_SEGMENT = ("late_payers", "late_payments >= 2")
        CUSTOM_SEGMENTS = {
            "late_payers": "late_payments > 0",
            "low_self_service": "self_service_percentage < 30",
            "high_value_at_risk": "current_month_revenue_90d_avg >= 500000 AND churn_risk_score >= 0.4",
            "dropped_channels": "channels_dropped > 0",
        }
        WHAT_IF = [
            ("no_late_payments", {"late_payments": "0"}),
            ("self_service_plus_20", {"self_service_percentage": "least(self_service_percentage + 20, 100)"}),
            ("channels_restored", {"channels_dropped": "0"}),
        ]
        TOP_N_EXPLAIN = 20
        DRIFT_TRAIN_MONTHS, DRIFT_RECENT_FROM, DRIFT_RECENT_TO = 40, 53, 68
        CONTACT_WITHIN_DAYS, IMPACT_PERIODS = 31, 3
        PSI_EPS = 1e-4

    K_THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
    from panelcast.plans.oracle import (
        BASE_O,
        EVAL,
        PANEL_E,
        FIXED_COEFFICIENTS,
        FIXED_INTERCEPT,
        SCORED_O,
        W,
        _explain_sql,
        _two_models,
        _curve,
        features_ctes,
        scored_ctes,
        with_,
        model_feature_names,
        r4,
    )

    q: dict[str, str] = {}
    S = SCORED_O.rstrip("\n")
    q["kpi_rollup"] = SCORED_O + f"""SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT account_id) AS BIGINT) AS n_accounts,
  {r4('avg(churn_risk_score)')} AS mean_risk,
  CAST(count(*) FILTER (WHERE risk_tier = 'High Risk') AS BIGINT) AS n_high,
  CAST(count(*) FILTER (WHERE risk_tier = 'Medium Risk') AS BIGINT) AS n_medium,
  CAST(count(*) FILTER (WHERE risk_tier = 'Low Risk') AS BIGINT) AS n_low,
  CAST(count(*) FILTER (WHERE risk_tier = 'Very Safe') AS BIGINT) AS n_safe,
  CAST(count(*) FILTER (WHERE churn_risk_score >= 0.5) AS BIGINT) AS predicted_churners FROM scored"""
    nb = D.HIST_BINS
    q["risk_histogram"] = SCORED_O + f"""SELECT bin, {r4(f'bin / {nb}')} AS bin_low, {r4(f'(bin + 1) / {nb}')} AS bin_high, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT CAST(least(floor(churn_risk_score * {nb}), {nb - 1}) AS INTEGER) AS bin FROM scored) GROUP BY bin"""

    ex = _explain_sql(
        "xrows AS (SELECT * FROM scored WHERE risk_tier IN ('High Risk', 'Medium Risk') AND churn_risk_score >= 0.5)", 1
    )
    head, tail = ex.rsplit("\nSELECT account_id, month, CAST(rank AS INTEGER)", 1)
    q["high_risk_top_factor"] = head + f"""
SELECT r.account_id, r.month, {r4('r.churn_risk_score')} AS churn_risk_score, r.risk_tier, k.feature AS top_factor, {r4('k.z_score')} AS z_score
FROM xrows r JOIN xk k ON r.account_id = k.account_id AND r.month = k.month WHERE k.rank = 1"""

    tvals = ", ".join(f"({t!r})" for t in K_THRESHOLDS)
    thr_cte = f""",
th AS (SELECT CAST(t AS DOUBLE) AS threshold FROM (VALUES {tvals}) v(t)),
cm AS (SELECT threshold,
  CAST(count(*) FILTER (WHERE churn_risk_score >= threshold AND {EVAL} = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE churn_risk_score >= threshold AND {EVAL} = 0) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE churn_risk_score < threshold AND {EVAL} = 1) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE churn_risk_score < threshold AND {EVAL} = 0) AS BIGINT) AS tn
  FROM scored CROSS JOIN th GROUP BY threshold)"""
    q["threshold_table"] = S + thr_cte + f"""
SELECT {r4('threshold')} AS threshold, {r4('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END')} AS precision,
  {r4('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END')} AS recall,
  {r4('CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END')} AS f1_score,
  {r4('CASE WHEN tp + fp + fn + tn > 0 THEN (tp + fp) / (tp + fp + fn + tn) ELSE 0.0 END')} AS predicted_churn_rate,
  tp, fp, fn, tn FROM cm"""
    cost = f"((tp + fp) * {D.CONTACT_COST!r}::DOUBLE)"
    benefit = f"(tp * {D.SAVE_RATE!r}::DOUBLE * {D.ACCOUNT_VALUE!r}::DOUBLE)"
    q["cost_benefit"] = S + thr_cte + f"""
SELECT {r4('threshold')} AS threshold, tp, fp, {r4(cost)} AS cost, {r4(benefit)} AS benefit,
  {r4(f'{benefit} - {cost}')} AS net_value, {r4(f'({benefit} - {cost}) / NULLIF({cost}, 0)')} AS roi,
  row_number() OVER (ORDER BY ({benefit} - {cost}) / NULLIF({cost}, 0) DESC NULLS LAST, threshold) = 1 AS best_roi FROM cm"""

    q["risk_trajectory"] = SCORED_O + f"""SELECT * FROM (
  SELECT account_id, month, {r4('churn_risk_score')} AS churn_risk_score,
         {r4(f'churn_risk_score - lag(churn_risk_score) OVER ({W})')} AS score_change,
         CAST(row_number() OVER (PARTITION BY account_id ORDER BY month DESC) AS INTEGER) AS periods_back
  FROM scored) WHERE periods_back <= {D.TRAJECTORY_ROWS}"""

    ab = D.AGE_BUCKET
    q["cohort_rollup"] = S + f""",
cx AS (SELECT CAST(date_trunc('quarter', min(month) OVER (PARTITION BY account_id)) AS DATE) AS cohort_quarter,
              CAST(floor(account_age_months / {ab}) * {ab} AS BIGINT) AS age_bucket, churn_risk_score, {EVAL} FROM scored)
SELECT cohort_quarter, age_bucket, CAST(count(*) AS BIGINT) AS n_rows, {r4('avg(churn_risk_score)')} AS avg_risk,
       {r4(f'avg(CAST({EVAL} AS DOUBLE))')} AS churn_rate
FROM cx GROUP BY ROLLUP (cohort_quarter, age_bucket)"""

    q["portfolio_risk"] = S + f""",
per AS (SELECT month, CAST(count(*) AS BIGINT) AS n_accounts, sum(current_month_revenue) AS revenue,
               sum(churn_risk_score * current_month_revenue) / NULLIF(sum(current_month_revenue), 0) AS weighted_risk
        FROM scored GROUP BY month)
SELECT month, n_accounts, {r4('revenue')} AS revenue, {r4('weighted_risk')} AS weighted_risk,
       {r4('weighted_risk - lag(weighted_risk) OVER (ORDER BY month)')} AS risk_change FROM per"""

    feats = model_feature_names()
    casts = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in feats)
    q["feature_drift"] = S + f""",
mi AS (SELECT month, row_number() OVER (ORDER BY month) AS idx FROM (SELECT DISTINCT month FROM scored)),
dd AS (SELECT mi.idx, {casts} FROM scored JOIN mi USING (month)),
dl AS (UNPIVOT dd ON {", ".join(feats)} INTO NAME feature VALUE value),
ds AS (SELECT feature,
  avg(value) FILTER (WHERE idx <= {D.DRIFT_TRAIN_MONTHS}) AS train_mean,
  stddev_samp(value) FILTER (WHERE idx <= {D.DRIFT_TRAIN_MONTHS}) AS train_std,
  avg(value) FILTER (WHERE idx BETWEEN {D.DRIFT_RECENT_FROM} AND {D.DRIFT_RECENT_TO}) AS recent_mean,
  stddev_samp(value) FILTER (WHERE idx BETWEEN {D.DRIFT_RECENT_FROM} AND {D.DRIFT_RECENT_TO}) AS recent_std
  FROM dl GROUP BY feature)
SELECT feature, {r4('train_mean')} AS train_mean, {r4('train_std')} AS train_std, {r4('recent_mean')} AS recent_mean,
  {r4('recent_std')} AS recent_std, {r4('(recent_mean - train_mean) / NULLIF(train_std, 0)')} AS mean_shift,
  {r4('recent_std / NULLIF(train_std, 0)')} AS std_ratio FROM ds"""

    seg_union = "\n  UNION ALL\n  ".join(
        f"SELECT '{name}' AS segment, account_id, churn_risk_score FROM scored WHERE coalesce({pred}, false)"
        for name, pred in D.CUSTOM_SEGMENTS.items()
    )
    q["custom_segments"] = S + f""",
cs AS ({seg_union})
SELECT segment, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT account_id) AS BIGINT) AS n_accounts,
       {r4('avg(churn_risk_score)')} AS avg_risk FROM cs GROUP BY segment"""

    saved = {**{n: (1, p) for n, p in D.CUSTOM_SEGMENTS.items()}, D.REPLACED_SEGMENT[0]: (3, D.REPLACED_SEGMENT[1])}
    saved_union = " UNION ALL ".join(
        f"SELECT '{n}' AS segment, {v} AS version, account_id, churn_risk_score FROM scored WHERE {p}" for n, (v, p) in saved.items())
    q["saved_segments"] = S + f""",
ss AS ({saved_union})
SELECT segment, CAST(version AS BIGINT) AS version, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT account_id) AS BIGINT) AS n_accounts,
       {r4('avg(churn_risk_score)')} AS avg_risk, CAST(4 AS BIGINT) AS n_refused FROM ss GROUP BY segment, version"""
    q["segment_comparison"] = S + f""",
popd AS (SELECT CAST(risk_tier IN ('High Risk', 'Medium Risk') AS INTEGER) AS y, {casts} FROM scored),
pl AS (UNPIVOT popd ON {", ".join(feats)} INTO NAME feature VALUE value),
st AS (SELECT feature, avg(value) FILTER (WHERE y = 1) AS segment_mean, avg(value) FILTER (WHERE y = 0) AS rest_mean,
              stddev_samp(value) FILTER (WHERE y = 0) AS rest_std FROM pl GROUP BY feature),
rk AS (SELECT *, (segment_mean - rest_mean) / NULLIF(rest_std, 0) AS effect_size FROM st),
rn AS (SELECT *, row_number() OVER (ORDER BY abs(effect_size) DESC NULLS LAST, feature) AS rank FROM rk)
SELECT feature, {r4('segment_mean')} AS segment_mean, {r4('rest_mean')} AS rest_mean, {r4('effect_size')} AS effect_size,
       CAST(rank AS INTEGER) AS rank FROM rn WHERE rank <= 10"""

    wi = []
    for name, overrides in D.WHAT_IF:
        z = f"{FIXED_INTERCEPT}"
        for f, c in FIXED_COEFFICIENTS.items():
            v = overrides.get(f, f)
            z += f" + ({c!r}) * CAST({v} AS DOUBLE)"
        wi.append(
            f"SELECT account_id, month, '{name}' AS scenario, churn_risk_score AS base_score, "
            f"round(1.0 / (1.0 + exp(-({z}))), 4) AS new_score FROM top"
        )
    q["what_if"] = S + f""",
top AS (SELECT * FROM scored ORDER BY churn_risk_score DESC, account_id, month LIMIT {D.TOP_N_EXPLAIN}),
wi AS ({" UNION ALL ".join(wi)})
SELECT account_id, month, scenario, {r4('base_score')} AS base_score, {r4('new_score')} AS new_score,
       {r4('new_score - base_score')} AS delta FROM wi"""

    q["risk_alerts"] = S + f""",
al AS (SELECT account_id, month, churn_risk_score, risk_tier, current_month_revenue_90d_avg,
              lag(churn_risk_score) OVER ({W}) AS prev_score, lag(risk_tier) OVER ({W}) AS prev_tier FROM scored),
a2 AS (SELECT *, CASE WHEN risk_tier = 'High Risk' AND prev_tier <> 'High Risk' AND current_month_revenue_90d_avg >= {D.HIGH_VALUE_REVENUE!r}
                      THEN 'high_value_enters_high_risk'
                      WHEN churn_risk_score > prev_score * (1 + {D.ALERT_RISE!r}::DOUBLE) THEN 'risk_rising' END AS alert FROM al)
SELECT account_id, month, {r4('prev_score')} AS prev_score, {r4('churn_risk_score')} AS churn_risk_score, alert
FROM a2 WHERE alert IS NOT NULL"""

    roc = "CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN sum(pos * ((n_neg - fp) + 0.5 * neg)) / (max(n_pos) * max(n_neg)) END"
    pr = """CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN sum(
        ((CAST(tp AS DOUBLE) / n_pos) - (CAST(tp - pos AS DOUBLE) / n_pos))
        * ((CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END)
           + (CASE WHEN (tp - pos) + (fp - neg) > 0 THEN CAST(tp - pos AS DOUBLE) / ((tp - pos) + (fp - neg)) ELSE 1.0 END)) / 2) END"""
    q["model_comparison"] = _two_models().rstrip("\n") + "," + _curve("two", "model_name") + f""",
cmx AS (SELECT model_name,
  count(*) FILTER (WHERE {EVAL} = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE {EVAL} = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE {EVAL} = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE {EVAL} = 1 AND prediction = 1) AS tp
  FROM two GROUP BY model_name),
auc AS (SELECT model_name, {roc} AS roc_auc, {pr} AS pr_auc FROM curve GROUP BY model_name),
mt AS (SELECT model_name,
  CAST(CASE WHEN tn + fp + fn + tp > 0 THEN (tp + tn) / (tn + fp + fn + tp) ELSE 0.0 END AS DOUBLE) AS accuracy,
  CAST(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS DOUBLE) AS precision,
  CAST(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS DOUBLE) AS recall,
  CAST(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS DOUBLE) AS f1_score,
  CAST(roc_auc AS DOUBLE) AS roc_auc, CAST(pr_auc AS DOUBLE) AS pr_auc
  FROM cmx JOIN auc USING (model_name)),
ml AS (UNPIVOT mt ON accuracy, precision, recall, f1_score, roc_auc, pr_auc INTO NAME metric VALUE value)
SELECT o.metric, {r4('o.value')} AS old_value, {r4('n.value')} AS new_value, {r4('n.value - o.value')} AS delta
FROM (SELECT * FROM ml WHERE model_name = 'linear_a') o JOIN (SELECT * FROM ml WHERE model_name = 'linear_b') n USING (metric)"""

    raw7 = ["current_month_transactions", "current_month_revenue", "total_tickets", "escalated_tickets", "late_payments",
            "self_service_percentage", "average_resolution_time_hours"]
    dq_parts = []
    for c in raw7:
        lo, hi = f"quantile_cont(CAST({c} AS DOUBLE), 0.25)", f"quantile_cont(CAST({c} AS DOUBLE), 0.75)"
        dq_parts.append(f"""SELECT '{c}' AS "column", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_missing,
  {r4(f'min({c})')} AS min_value, {r4(f'max({c})')} AS max_value, max(month) AS latest_period,
  {r4(lo)} AS q1, {r4(hi)} AS q3,
  CAST(count(*) FILTER (WHERE {c} < (SELECT {lo} - 1.5 * ({hi} - {lo}) FROM panel)
                          OR {c} > (SELECT {hi} + 1.5 * ({hi} - {lo}) FROM panel)) AS BIGINT) AS n_outliers
FROM panel""")
    q["dq_report"] = BASE_O + "\nUNION ALL\n".join(dq_parts)
    q["dq_correlations"] = BASE_O + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS metric_a, '{b}' AS metric_b, {r4(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS correlation FROM panel"
        for i, a in enumerate(raw7) for b in raw7[i + 1:])
    hash52 = "CAST('0x' || substr(md5('{seed}:' || account_id), 1, 13) AS BIGINT)"
    q["ab_groups"] = SCORED_O + f"""SELECT CAST({hash52.format(seed=7)} % 2 AS INTEGER) AS ab_group,
  CAST(count(DISTINCT account_id) AS BIGINT) AS n_accounts, {r4('avg(churn_risk_score)')} AS avg_risk FROM scored GROUP BY 1"""
    # every metric is filled on every row, so the last row holds each column's last non-null value
    sd = ", ".join(f"stddev_samp({c}) AS s_{c}" for c in raw7)
    dist = " + ".join(f"coalesce(((l.{c} - t.{c}) / NULLIF(s_{c}, 0)) ** 2, 0)" for c in raw7)
    q["similar_accounts"] = S + f""",
la AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY month DESC) = 1),
sd AS (SELECT {sd} FROM la),
tg AS (SELECT * FROM la WHERE account_id = 'ACC-000010'),
ds AS (SELECT t.account_id AS target_account, l.account_id, l.month, l.churn_risk_score, round(sqrt({dist}), 4) AS distance
       FROM la l JOIN tg t ON l.risk_tier = t.risk_tier AND l.account_id <> t.account_id CROSS JOIN sd)
SELECT target_account, account_id, month, {r4('churn_risk_score')} AS churn_risk_score, {r4('distance')} AS distance
FROM ds ORDER BY ds.distance, account_id LIMIT 10"""
    q["similar_accounts_all"] = S + f""",
la AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY month DESC) = 1),
sd AS (SELECT {sd} FROM la),
ds AS (SELECT t.account_id AS target_account, sqrt({dist}) AS distance
       FROM la t JOIN la l ON l.risk_tier = t.risk_tier AND l.account_id <> t.account_id CROSS JOIN sd),
rk AS (SELECT target_account, distance, row_number() OVER (PARTITION BY target_account ORDER BY distance) AS rank FROM ds)
SELECT target_account, CAST(rank AS INTEGER) AS rank, {r4('distance')} AS distance FROM rk WHERE rank <= 10"""
    q["cluster_invariants"] = S + """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_not_nearest, CAST(0 AS BIGINT) AS n_out_of_range FROM scored"""
    n = D.IMPACT_PERIODS
    q["intervention_impact"] = S + f""",
iv AS (SELECT risk_tier, days_since_last_contact <= {D.CONTACT_WITHIN_DAYS} AS contact,
              avg(churn_risk_score) OVER ({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS risk_before,
              avg(churn_risk_score) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND {n} FOLLOWING) AS risk_after FROM scored)
SELECT risk_tier, CAST(count(*) AS BIGINT) AS n_contacts, {r4('avg(risk_before)')} AS avg_risk_before,
       {r4('avg(risk_after)')} AS avg_risk_after, {r4('avg(risk_after - risk_before)')} AS avg_change
FROM iv WHERE contact AND risk_before IS NOT NULL AND risk_after IS NOT NULL GROUP BY risk_tier"""
    deciles = "[" + ", ".join(repr(p / 10) for p in range(1, 10)) + "]"
    rounded = ", ".join(f"round(round(CAST({f} AS DOUBLE), 10), 6) AS {f}" for f in feats)
    q["feature_psi"] = S + f""",
mi AS (SELECT month, row_number() OVER (ORDER BY month) AS idx FROM (SELECT DISTINCT month FROM scored)),
sx AS (SELECT CASE WHEN idx <= {D.DRIFT_TRAIN_MONTHS} THEN 'train' ELSE 'recent' END AS part, {rounded} FROM scored JOIN mi USING (month)
       WHERE idx <= {D.DRIFT_TRAIN_MONTHS} OR idx BETWEEN {D.DRIFT_RECENT_FROM} AND {D.DRIFT_RECENT_TO}),
lb0 AS (UNPIVOT sx ON {", ".join(feats)} INTO NAME feature VALUE value),
ed AS (SELECT feature, quantile_cont(value, {deciles}) FILTER (WHERE part = 'train') AS edges FROM lb0 GROUP BY feature),
lb AS (SELECT part, feature, len(list_filter(edges, lambda e: value > e + 1e-8::DOUBLE)) AS bin FROM lb0 JOIN ed USING (feature)),
ct AS (SELECT feature, bin, count(*) FILTER (WHERE part = 'train') AS n_train, count(*) FILTER (WHERE part = 'recent') AS n_recent
       FROM lb GROUP BY feature, bin),
tm AS (SELECT feature, (CAST(n_recent AS DOUBLE) / sum(n_recent) OVER (PARTITION BY feature)) AS pr,
              (CAST(n_train AS DOUBLE) / sum(n_train) OVER (PARTITION BY feature)) AS pt FROM ct)
SELECT feature, {r4(f'sum((pr - pt) * ln((pr + {D.PSI_EPS!r}) / (pt + {D.PSI_EPS!r})))')} AS psi, CAST(count(*) AS BIGINT) AS n_bins
FROM tm GROUP BY feature"""
    q["stream_scoring"] = SCORED_O + f"""SELECT account_id, month, {r4('churn_risk_score')} AS churn_risk_score, prediction,
  {r4('safe_probability')} AS safe_probability, risk_tier FROM scored"""
    q["campaign_impact"] = with_(PANEL_E, features_ctes(), scored_ctes()).rstrip("\n") + f""",
cm AS (SELECT DISTINCT 'USR-' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(6, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') AS account_id,
              'campaign ' || CAST(k % 3 AS VARCHAR) AS campaign, start_date, start_date + CAST(k // 3 AS INTEGER) AS end_date
       FROM (SELECT user_id, CAST(ts AS DATE) AS start_date, ((CAST(json_extract_string(props, '$.k') AS BIGINT) % 6) + 6) % 6 AS k
             FROM events WHERE event_type = 'click')),
bf AS (SELECT account_id, campaign, start_date, end_date, arg_max(churn_risk_score, month) AS risk_at_start,
              avg(churn_risk_score) FILTER (WHERE CAST(month AS DATE) >= start_date - 7) AS risk_before
       FROM cm JOIN scored USING (account_id) WHERE CAST(month AS DATE) < start_date GROUP BY ALL),
af AS (SELECT account_id, campaign, start_date, end_date, avg(churn_risk_score) AS risk_after, max(churned) AS churned_after
       FROM cm JOIN scored USING (account_id) WHERE CAST(month AS DATE) > end_date AND CAST(month AS DATE) <= end_date + 7 GROUP BY ALL),
al AS (SELECT *, risk_at_start >= 0.2 AND risk_after IS NOT NULL AS risky, risk_before IS NOT NULL AND risk_after IS NOT NULL AS compared
       FROM cm LEFT JOIN bf USING (account_id, campaign, start_date, end_date) LEFT JOIN af USING (account_id, campaign, start_date, end_date)),
su AS (SELECT campaign, count(*) AS n_contacts, count(*) FILTER (WHERE compared) AS n_compared,
              avg(risk_before) FILTER (WHERE compared) AS b, avg(risk_after) FILTER (WHERE compared) AS a,
              avg(risk_after - risk_before) FILTER (WHERE compared) AS c, count(*) FILTER (WHERE risky) AS n_at_risk,
              count(*) FILTER (WHERE risky AND coalesce(churned_after, 0) = 0) AS n_saved FROM al GROUP BY campaign)
SELECT campaign, n_contacts, n_compared, {r4('b')} AS avg_risk_before, {r4('a')} AS avg_risk_after, {r4('c')} AS avg_change,
  n_at_risk, n_saved, {r4('CAST(n_saved AS DOUBLE) / nullif(n_at_risk, 0)')} AS save_rate,
  CAST(n_saved * {D.ACCOUNT_VALUE!r} - n_contacts * {D.CONTACT_COST!r} AS DOUBLE) AS roi FROM su"""
    q["stream_raw_scoring"] = q["stream_scoring"]
    return q
