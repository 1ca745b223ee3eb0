import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler

from panelcast.operators import logistic, ml


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 6)) * [30.0, 1.0, 0.1, 5.0, 1.0, 1.0] + [40.0, 0, 0, 7, 0, 0]
    x[:, 4] = x[:, 0]  # the same feature again
    x[:, 5] = 2.5  # without spread
    z = (x[:, 0] - 40) / 30 - 2 * x[:, 1] + 4 * x[:, 2]
    y = (rng.random(1500) < 1 / (1 + np.exp(-z))).astype(float)
    w = rng.random(1500) + 0.5
    names = [f"f{i}" for i in range(6)]
    df = spark.createDataFrame([(*map(float, r), float(a), float(b)) for r, a, b in zip(x, y, w)], ", ".join(f"{f} double" for f in names) + ", y double, w double")
    return df.repartition(5).cache(), names, x, y, w


def objective(model, x, y, w, reg):
    b = model.coefficients.toArray()
    z = x @ b + model.intercept
    return (w @ (np.logaddexp(0, z) - y * z)) / w.sum() + reg * (b @ b) / 2


@pytest.mark.parametrize("weighted", [False, True])
def test_the_optimum_of_spark(spark, table, weighted):
    df, names, x, y, w = table
    model = ml.fit(df, names, "lr", "y", weight_col="w" if weighted else None, regParam=0.01).stages[-1]
    assert isinstance(model, LogisticRegressionModel)
    est = LogisticRegression(featuresCol="features", labelCol="y", elasticNetParam=0.0, standardization=False, regParam=0.01, maxIter=300, tol=1e-12)
    if weighted:
        est.setWeightCol("w")
    own = est.fit(VectorAssembler(inputCols=names, outputCol="features").transform(df))
    u = w if weighted else np.ones(len(y))
    assert objective(model, x, y, u, 0.01) <= objective(own, x, y, u, 0.01) + 1e-10
    p, q = (1 / (1 + np.exp(-(x @ m.coefficients.toArray() + m.intercept))) for m in (model, own))
    assert np.abs(p - q).max() < 1e-3
    assert model.coefficients[5] == 0 and model.coefficients[0] == pytest.approx(model.coefficients[4], rel=1e-6)


def test_few_passes_shared_by_all_penalties(spark, table, monkeypatch):
    df, names, x, y, w = table
    seen, passed = [], logistic.passed
    monkeypatch.setattr(logistic, "passed", lambda *a: seen.append(a[-1].shape[1]) or passed(*a))
    models = ml.fit_logistic(df, names, [{"C": c} for c in (0.01, 0.1, 1.0, 10.0)], "y")
    assert len(seen) <= 15 and seen[0] == 4
    for m, c in zip(models, (0.01, 0.1, 1.0, 10.0)):
        alone = ml.fit(df, names, "lr", "y", C=c).stages[-1]
        assert np.allclose(m.stages[-1].coefficients.toArray(), alone.coefficients.toArray(), rtol=1e-6)
        assert m.stages[-1].getRegParam() == 1 / (c * 1500)


def test_steps_that_overshoot_are_halved(spark):
    """Far points beside a small bulk: the full step from the start raises the loss."""
    x = np.r_[np.linspace(-1, 1, 200), [3000.0, -3000.0, 5000.0]]
    y = np.r_[(np.linspace(-1, 1, 200) > 0).astype(float), [1.0, 0.0, 1.0]]
    y[::7] = 1 - y[::7]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "a double, y double")
    m = ml.fit(df, ["a"], "lr", "y", regParam=1e-6).stages[-1]
    p = 1 / (1 + np.exp(-(x * m.coefficients[0] + m.intercept)))
    assert abs(((p - y) * x).mean() + 1e-6 * m.coefficients[0]) < 1e-6 and abs((p - y).mean()) < 1e-8


def test_one_class_and_gaps(spark, table):
    df, names, *_ = table
    assert ml.fit(df.where("y = 1"), names, "lr", "y").stages[-1].intercept == float("inf")
    with pytest.raises(Exception):
        ml.fit(df.selectExpr("CASE WHEN f0 > 40 THEN f0 END AS f0", "y"), ["f0"], "lr", "y")


def test_saved_and_loaded_with_its_settings(spark, table, tmp_path):
    df, names, x, y, w = table
    model = ml.fit(df, names, "lr", "y", weight_col="w", C=0.5, maxIter=40)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = type(model).load(str(tmp_path / "m")).stages[-1]
    own = model.stages[-1]
    assert again.coefficients == own.coefficients and again.intercept == own.intercept
    assert (again.getMaxIter(), again.getLabelCol(), again.getWeightCol(), again.getRegParam()) == (40, "y", "w", 1 / (0.5 * 1500))
    assert again.numClasses == 2 and own.transform(VectorAssembler(inputCols=names, outputCol="features").transform(df)).count() == 1500
