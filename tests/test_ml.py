import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from panelcast.operators import ml
from panelcast.plans.training import _features, train_test


def brute_nearest(x, k):
    d = ((x[:, None, :] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    return np.argsort(d, axis=1, kind="stable")[:, : min(k, len(x) - 1)]


@pytest.fixture(scope="module")
def matrix(spark):
    return train_test(spark, SF0001)


def test_model_matrix_is_clean(spark, matrix):
    feats = _features(matrix)
    assert len(feats) == 107
    bad = matrix.where(" OR ".join(f"isnan({c}) OR {c} IS NULL" for c in feats))
    assert bad.count() == 0


@pytest.mark.parametrize("flip", [False, True])
def test_smote_balances_the_smaller_class(spark, matrix, flip):
    """Either class can be the smaller one, and the result keeps every original row."""
    train = matrix.where(F.col("split") == "train")
    if flip:
        train = train.withColumn("churned", 1 - F.col("churned"))
    feats = _features(matrix)
    res = ml.smote(train, feats, "churned", k=5, seed=42, block_rows=16)
    before = {r[0]: r[1] for r in train.groupBy("churned").count().collect()}
    counts = {r[0]: r[1] for r in res.groupBy("churned").count().collect()}
    assert counts[0.0] == counts[1.0] == max(before.values())
    assert res.columns == [*feats, "churned"]
    # deterministic for a fixed seed
    again = ml.smote(train, feats, "churned", k=5, seed=42, block_rows=16)
    assert res.agg(F.sum(feats[0])).first()[0] == pytest.approx(again.agg(F.sum(feats[0])).first()[0])


def test_smote_rows_lie_between_neighbours(spark):
    rows = [(float(i), float(i % 7), 1.0) for i in range(30)] + [(float(-i), 1.0, 0.0) for i in range(101)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    new = ml.smote(df, ["a", "b"], "y", k=3, seed=1).where("y = 1").subtract(df.where("y = 1")).collect()
    real = np.array([r[:2] for r in rows[:30]])
    near = brute_nearest(real, 3)
    for r in new:
        p = np.array([r.a, r.b])
        on_line = [
            abs(np.linalg.det([real[j] - real[i], p - real[i]])) < 1e-6 and -1e-9 <= (p - real[i]) @ (real[j] - real[i]) <= ((real[j] - real[i]) ** 2).sum() + 1e-9
            for i in range(30) for j in near[i]
        ]
        assert any(on_line)
    assert ml.smote(df, ["a", "b"], "y", k=3, seed=1).where("y = 1").count() == 101


def test_smote_draws_lines_to_nearest_rows_above_a_block(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2500, 6))
    names = [f"f{i}" for i in range(6)]
    rows = [(*map(float, r), 1.0) for r in x] + [(0.0,) * 6 + (0.0,)] * 4000
    df = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in names) + ", y double")
    res = np.array(ml.smote(df, names, "y", k=2).where("y = 1").select(*names).collect())
    old = {tuple(r) for r in x}
    new = np.array([r for r in res if tuple(r) not in old])
    near = brute_nearest(x, 2)
    a, b = np.repeat(x, 2, axis=0), x[near].reshape(-1, 6)
    side = b - a
    for p in new[::5]:
        u = np.clip(((p - a) * side).sum(axis=1) / (side**2).sum(axis=1), 0, 1)
        assert np.abs(a + u[:, None] * side - p).max(axis=1).min() < 1e-9
    assert len(res) == 4000 and len(new) == 1500


def test_smote_nothing_to_add_keeps_rows_and_schema(spark, matrix):
    feats = _features(matrix)
    one = matrix.where(F.col("split") == "train").where("churned = 0")
    same = ml.smote(one, feats, "churned")
    assert same.count() == one.count() and same.columns == [*feats, "churned"]


def test_fit_score_and_reload(spark, matrix, tmp_path):
    from panelcast.sources import io

    feats = _features(matrix)
    train, test = matrix.where("split = 'train'"), matrix.where("split = 'test'")
    model = ml.fit(train, feats, "lr", "churned", maxIter=50, regParam=0.01)
    a = ml.score_model(model, test, threshold=0.3).orderBy("account_id", "month")
    path = str(tmp_path / "lr-model")
    io.save_model(model, path)
    b = ml.score_model(io.load_model(path), test, threshold=0.3).orderBy("account_id", "month")
    ra, rb = a.collect(), b.collect()
    assert len(ra) == len(rb) > 0
    assert all(x.churn_risk_score == pytest.approx(y.churn_risk_score) for x, y in zip(ra, rb))
    assert {r.risk_tier for r in ra} <= {"High Risk", "Medium Risk", "Low Risk", "Very Safe"}
    assert all(abs(r.churn_risk_score + r.safe_probability - 1) < 1e-9 for r in ra)


def test_tree_importance(spark, matrix):
    feats = _features(matrix)
    model = ml.fit(matrix.where("split = 'train'"), feats, "rf", "churned", numTrees=10, maxDepth=4)
    imp = ml.feature_importance(model, feats)
    assert len(imp) == 107 and sum(v for _, v in imp) == pytest.approx(1.0)
    lr = ml.fit(matrix.where("split = 'train'"), feats, "lr", "churned", maxIter=10)
    with pytest.raises(ValueError):
        ml.feature_importance(lr, feats)


def test_lr_c_maps_to_reg_param():
    from panelcast.operators.ml import make_estimator

    est = make_estimator("lr", n_rows=200, C=0.5)
    assert est.getRegParam() == pytest.approx(1.0 / (0.5 * 200))
    assert make_estimator("lr", regParam=0.3).getRegParam() == pytest.approx(0.3)
    with pytest.raises(ValueError):
        make_estimator("lr", C=1.0)
    assert len(ml.param_maps(ml.RF_GRID)) == 24 and len(ml.param_maps(ml.GBT_GRID)) == 36


def test_maps_that_share_a_fit():
    rf = ml.fit_groups("rf", ml.param_maps(ml.RF_GRID))
    assert [(p, len(m)) for p, m in rf] == [({"minInstancesPerNode": n, "numTrees": 200, "maxDepth": 30}, 12) for n in (1, 2)]
    gbt = ml.fit_groups("gbt", ml.param_maps(ml.GBT_GRID))
    assert len(gbt) == 18 and all(p["maxIter"] == 200 and len(m) == 2 for p, m in gbt)
    assert len(ml.fit_groups("lr", ml.param_maps(ml.LR_GRID))) == 4


def test_staged_search_scores_like_separate_fits(spark, matrix):
    """Fewer boosting rounds taken from one ensemble are what a fit of so many rounds gives."""
    feats = _features(matrix)
    train = matrix.where("split = 'train'")
    grid = {"maxIter": [2, 4], "maxDepth": [2]}
    _, best, table = ml.grid_search(train, feats, "gbt", grid, n_splits=2)
    rows = {r.params: r for r in table.collect()}
    assert len(rows) == 2 and {r.n_fits for r in rows.values()} == {3} and str(best) in rows
    alone = {}
    for n in (2, 4):
        alone[n] = ml.grid_search(train, feats, "gbt", {"maxIter": [n], "maxDepth": [2]}, n_splits=2)[2].first().mean_f1
    assert [rows[str({"maxIter": n, "maxDepth": 2})].mean_f1 for n in (2, 4)] == pytest.approx([alone[2], alone[4]])
    model, best, table = ml.grid_search(train, feats, "rf", {"numTrees": [3], "maxDepth": [3], "minSamplesSplit": [2000]}, n_splits=2)
    assert set(ml.score_model(model, train).columns) == {"account_id", "month", "churn_risk_score", "prediction", "safe_probability", "risk_tier"}
