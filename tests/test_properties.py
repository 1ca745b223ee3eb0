"""Property-based checks against brute force (small random inputs with ties)."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import panel_rows
from panelcast.operators import metrics
from panelcast.operators.features import generate_features

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def brute_curves(y, p):
    y, p = np.asarray(y), np.asarray(p)
    P, N = y.sum(), (1 - y).sum()
    out = {}
    for t in sorted(set(p.tolist())):
        pred = p >= t
        tp, fp = int((pred & (y == 1)).sum()), int((pred & (y == 0)).sum())
        out[t] = (tp, fp)
    auc = None
    if P and N:
        s = 0.0
        for a in p[y == 1]:
            s += (p[y == 0] < a).sum() + 0.5 * (p[y == 0] == a).sum()
        auc = s / (P * N)
    # trapezoid PR AUC over points sorted by threshold + end point (1, 0)
    pts = [(out[t][0] / P if P else 1.0, out[t][0] / (out[t][0] + out[t][1])) for t in sorted(out)] + [(0.0, 1.0)]
    pr = sum((r0 - r1) * (p0 + p1) / 2 for (r0, p0), (r1, p1) in zip(pts[:-1], pts[1:])) if P and N else None
    return out, auc, pr


@SETTINGS
@given(
    st.lists(st.tuples(st.integers(0, 1), st.integers(0, 12)), min_size=2, max_size=60),
    st.sampled_from([1, 2, 5, 64]),
)
def test_curves_match_brute_force(spark, rows, n_buckets):
    y = [a for a, _ in rows]
    p = [b / 12 for _, b in rows]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(y, p))], "id int, churned int, churn_risk_score double")
    counts = metrics.curve_counts(df, n_buckets=n_buckets)
    got = {r.threshold: (r.tp, r.fp) for r in counts.collect()}
    want, auc, pr = brute_curves(y, p)
    assert got == want
    got_auc = metrics.roc_auc(counts).first().roc_auc
    got_pr = metrics.pr_auc(counts).first().pr_auc
    if auc is None:
        assert got_auc is None and got_pr is None
    else:
        assert got_auc == pytest.approx(auc) and got_pr == pytest.approx(pr)


@SETTINGS
@given(st.lists(st.integers(0, 6), min_size=1, max_size=40), st.sampled_from([0.1, 0.33, 0.5, 0.9]))
def test_exact_quantile_matches_pandas(spark, values, q):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    want = float(pd.Series(values, dtype=float).quantile(q))
    for n_buckets in (1, 3):
        got = metrics.exact_quantiles(df, "v", [q], n_buckets=n_buckets).first().value
        assert got == pytest.approx(want)


def pandas_rolling(pdf):
    """Independent pandas rendition of the documented per-account semantics."""
    out = []
    for _, g in pdf.sort_values(["account_id", "month"]).groupby("account_id", sort=True):
        x = g["current_month_revenue"]
        r6 = x.rolling(6, min_periods=3)
        r3 = x.rolling(3, min_periods=1)
        prev = x.shift(1)
        pc = (x - prev) / prev.where(prev != 0)
        out.append(pd.DataFrame({
            "sum6": r6.sum(), "avg3": r3.mean(), "std3": x.rolling(3, min_periods=2).std(),
            "trend3": x / (r3.mean() + 1.0), "pc": pc, "acc": pc - pc.shift(1),
            "rvh": x / (x.shift(1).rolling(2, min_periods=1).sum() + 1),
        }))
    return pd.concat(out).fillna(0.0).reset_index(drop=True)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 5)), min_size=1, max_size=30))
def test_rolling_features_match_pandas(spark, rows):
    seen = {}
    data = []
    for acc, v in rows:
        k = seen.get(acc, 0)
        seen[acc] = k + 1
        data.append({"account_id": acc, "month": dt.date(2020 + k // 12, k % 12 + 1, 1), "current_month_revenue": float(v)})
    f = generate_features(panel_rows(spark, data)).orderBy("account_id", "month").toPandas()
    want = pandas_rolling(pd.DataFrame(data))
    pairs = {
        "sum6": "current_month_revenue_180d_sum", "avg3": "current_month_revenue_90d_avg",
        "std3": "current_month_revenue_volatility_90d", "trend3": "current_month_revenue_trend_90d",
        "pc": "current_month_revenue_percent_change", "acc": "current_month_revenue_acceleration",
        "rvh": "current_month_revenue_recent_vs_historical",
    }
    for k, c in pairs.items():
        np.testing.assert_allclose(f[c].to_numpy(), want[k].to_numpy(), atol=1e-9, err_msg=c)
