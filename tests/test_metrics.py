import pytest

from panelcast.functions.expressions import feature_category, risk_tier
from panelcast.operators import metrics


def scored(spark, y, p):
    return spark.createDataFrame([(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))], "id int, churned int, churn_risk_score double")


def test_eight_row_metrics(spark):
    y = [0, 0, 1, 1, 0, 1, 1, 0]
    p = [0.1, 0.2, 0.8, 0.4, 0.3, 0.9, 0.7, 0.2]
    df = scored(spark, y, p).selectExpr("*", "CAST(churn_risk_score >= 0.5 AS INT) AS prediction")
    m = metrics.classification_metrics(df, "churned").first()
    assert (m.tn, m.fp, m.fn, m.tp) == (4, 0, 1, 3)
    assert m.accuracy == pytest.approx(0.875)
    assert m.precision == pytest.approx(1.0) and m.recall == pytest.approx(0.75)
    assert m.f1_score == pytest.approx(6 / 7)
    assert m.roc_auc == pytest.approx(1.0) and m.pr_auc == pytest.approx(1.0)
    t = metrics.optimal_threshold(df, metric="f1").first()
    assert t.threshold == pytest.approx(0.4)


def test_single_class_confusion_is_safe(spark):
    df = scored(spark, [0, 0, 0], [0.1, 0.2, 0.3]).selectExpr("*", "0 AS prediction")
    m = metrics.classification_metrics(df, "churned").first()
    assert (m.tn, m.fp, m.fn, m.tp) == (3, 0, 0, 0)
    assert m.roc_auc is None


Y10 = [0, 0, 1, 0, 1, 1, 0, 1, 0, 1]
P10 = [0.05, 0.2, 0.2, 0.35, 0.4, 0.55, 0.6, 0.7, 0.8, 0.9]


@pytest.mark.parametrize("n_buckets", [1, 3, 512])
def test_threshold_table(spark, n_buckets):
    counts = metrics.curve_counts(scored(spark, Y10, P10), n_buckets=n_buckets)
    pts = {r.threshold: r for r in metrics.pr_points(counts).collect()}
    expect = {
        0.05: (0.5, 1.0), 0.2: (0.5556, 1.0), 0.35: (0.5714, 0.8), 0.4: (0.6667, 0.8), 0.55: (0.6, 0.6),
        0.6: (0.5, 0.4), 0.7: (0.6667, 0.4), 0.8: (0.5, 0.2), 0.9: (1.0, 0.2), None: (1.0, 0.0),
    }
    assert set(pts) == set(expect)
    for t, (prec, rec) in expect.items():
        assert pts[t].precision == pytest.approx(prec, abs=1e-4) and pts[t].recall == pytest.approx(rec)
    assert metrics.roc_auc(counts).first().roc_auc == pytest.approx(0.66)
    assert metrics.pr_auc(counts).first().pr_auc == pytest.approx(0.6660, abs=1e-4)


def test_threshold_search_modes(spark):
    df = scored(spark, Y10, P10)
    assert metrics.optimal_threshold(df, metric="f1").first().threshold == pytest.approx(0.4)
    assert metrics.optimal_threshold(df, metric="recall", min_precision=0.7).first().threshold == pytest.approx(0.9)
    assert metrics.optimal_threshold(df, metric="custom", min_precision=0.7).first().threshold == pytest.approx(0.9)
    best = metrics.optimal_threshold(df, metric="f1").first()
    assert (best.precision, best.recall) == (pytest.approx(2 / 3), pytest.approx(0.8))


def test_tiers_and_categories(spark):
    df = spark.createDataFrame([(0.7,), (0.6999,), (0.4,), (0.2,), (0.1999,)], "s double")
    assert [r[0] for r in df.select(risk_tier("s")).collect()] == [
        "High Risk", "Medium Risk", "Medium Risk", "Low Risk", "Very Safe"]
    names = ["current_month_revenue_90d_sum", "total_tickets", "has_agent", "has_web",
             "average_resolution_time_hours", "days_since_last_contact"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "f string").select(feature_category("f")).collect()]
    assert got == ["Revenue/Spending", "Support Quality", "Customer Tenure", "Other", "Support Speed", "Engagement"]


@pytest.mark.parametrize("n_buckets", [1, 2, 512])
def test_exact_quantiles(spark, n_buckets):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    got = {r.q: r.value for r in metrics.exact_quantiles(df, "v", [0.33, 0.5], n_buckets=n_buckets).collect()}
    assert got[0.33] == pytest.approx(1.99) and got[0.5] == pytest.approx(2.5)
