import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from panelcast.operators import boosting, ml, trees

NAMES = [f"f{i}" for i in range(6)]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 25, size=(3000, 6)).astype(float)  # few values: all cuts are the same, whoever samples
    x[:, 5] = 1.0  # asks nothing
    y = (x[:, 0] * x[:, 1] + 9 * x[:, 2] + rng.normal(scale=40, size=3000) > 250).astype(float)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], ", ".join(f"{f} double" for f in NAMES) + ", y double")
    return df.repartition(5).cache(), x, y


def sparks_own(df, **params):
    return Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="features"), ml.make_estimator("gbt", label="y", **params)]).fit(df)


def scores(model, df):
    return np.array([r[0] for r in model.transform(df).orderBy(*NAMES, "y").select(vector_to_array("probability")[1]).collect()])


def test_the_trees_of_sparks_own(spark, table):
    """Also over the round after which the kept margins move on."""
    df, *_ = table
    params = {"maxIter": boosting.HELD + 2, "maxDepth": 3, "stepSize": 0.3}
    own, other = ml.fit(df, NAMES, "gbt", "y", **params), sparks_own(df, **params)
    assert isinstance(own, PipelineModel) and isinstance(own.stages[-1], GBTClassificationModel)
    a, b = trees.ensemble(own), trees.ensemble(other)
    assert a.weight.tolist() == b.weight.tolist() and len(a.left) == len(b.left) and sorted(a.rows) == sorted(b.rows)
    assert np.abs(scores(own, df) - scores(other, df)).max() < 1e-6
    assert own.stages[-1].getMaxIter() == params["maxIter"] and own.stages[-1].getNumTrees == params["maxIter"]
    p, q = (np.array([v for _, v in ml.feature_importance(m, NAMES)]) for m in (own, other))
    assert np.abs(p - q).max() < 1e-6


def test_partitions_do_not_matter(spark, table):
    df, *_ = table
    a, b = (scores(ml.fit(d, NAMES, "gbt", "y", maxIter=3, maxDepth=4), df) for d in (df, df.repartition(1)))
    assert (a == b).all()


def test_drawn_rows_and_deep_trees(spark, table):
    df, x, y = table
    model = ml.fit(df, NAMES, "gbt", "y", maxIter=3, maxDepth=6, subsamplingRate=0.5)
    t = trees.ensemble(model)
    assert all(1350 < n < 1650 for n in t.rows[t.root]) and sum(1 for _ in t.levels()) <= 7
    inner = t.left >= 0
    assert (t.rows[t.left[inner]] + t.rows[t.right[inner]] == t.rows[inner]).all()
    assert ((t.margins(x) > 0) == y).mean() > 0.85


def test_one_split_against_brute_force():
    rng = np.random.default_rng(2)
    x, g = rng.integers(0, 6, (3, 80)).astype(np.uint8), rng.normal(size=80)
    slot = np.where(np.arange(80) % 4 == 0, -1, 0)
    f, cut, gain, n, p, all_n, all_p = boosting.chosen(boosting.sums(x, np.rint(g * boosting.SCALE), slot, 1))
    x, g = x[:, slot == 0], g[slot == 0]
    want = {(i, c): g.var() - sum(m.mean() * g[m].var() for m in (x[i] <= c, x[i] > c)) for i in range(3) for c in range(5)
            if 0 < (x[i] <= c).sum() < len(g)}
    assert gain[0] == pytest.approx(max(want.values())) and want[f[0], cut[0]] == pytest.approx(gain[0])
    left = x[f[0]] <= cut[0]
    assert (n[0], all_n[0]) == (left.sum(), 60) and p[0] == pytest.approx(g[left].sum()) and all_p[0] == pytest.approx(g.sum())


def test_cuts_left_over_go_above_a_frequent_value():
    x = np.r_[np.zeros(900), np.arange(1, 101)][:, None]
    (cuts,) = boosting.cuts_of(x, 32)
    assert len(cuts) > 20 and cuts[0] == 0.5
    assert len(boosting.cuts_of(np.arange(1000.0)[:, None], 32)[0]) == 31 and len(boosting.cuts_of(np.ones((9, 1)))[0]) == 0


def test_only_the_smaller_of_two_siblings_is_summed(spark, table, monkeypatch):
    """The cost that made boosting fail: at every level all rows, for every feature."""
    df, x, y = table
    summed, was = [], boosting.level_sums
    monkeypatch.setattr(boosting, "level_sums", lambda *a: summed.append((out := was(*a))[0, :, 0].sum()) or out)
    model = ml.fit(df, NAMES, "gbt", "y", maxIter=2, maxDepth=4)
    assert len(summed) == 8 and model.stages[-1].getNumTrees == 2
    assert all(n == len(y) for n in summed[::4]) and all(n <= len(y) / 2 for i, n in enumerate(summed) if i % 4)


def test_odd_labels_and_weights_go_to_spark(spark, table, monkeypatch):
    df, *_ = table
    monkeypatch.setattr(boosting, "fit", lambda *a: pytest.fail("not for these"))
    small = df.limit(200)
    ml.fit(small.selectExpr("*", "1.0D AS w"), NAMES, "gbt", "y", weight_col="w", maxIter=1, maxDepth=2)
    ml.fit(small, NAMES, "gbt", "y", maxIter=1, maxDepth=2, minInstancesPerNode=3)


def test_the_cuts_of_sparks_own(spark):
    """Up to ``CUT_ROWS`` rows all of them place the cuts, in both: many values, some of them frequent."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(4000, 6)).round(3)
    x[rng.random((4000, 6)) < [0, 0.2, 0.5, 0.8, 0.97, 0.3]] = 0.0
    x[:, 5] = np.where(x[:, 5] == 0, 2.5, x[:, 5])
    y = (x[:, 0] + x[:, 1] * x[:, 2] + x[:, 3] + x[:, 5] + rng.normal(scale=0.5, size=4000) > 0.8).astype(float)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], ", ".join(f"{f} double" for f in NAMES) + ", y double").cache()
    params = {"maxIter": 4, "maxDepth": 5}
    own, other = trees.ensemble(ml.fit(df, NAMES, "gbt", "y", **params)), trees.ensemble(sparks_own(df, **params))
    assert np.abs(own.probability(own.margins(x)) - other.probability(other.margins(x))).max() < 1e-6
    assert len(own.left) == len(other.left) > 150


def test_leaves_found_by_asking_all_cuts_at_once():
    rng = np.random.default_rng(8)
    x, g = rng.integers(0, 32, (4, 700)).astype(np.uint8), rng.normal(size=700).round(3) * boosting.SCALE
    slots = lambda t, wanted: np.where(np.isin(at := t.walk(x.T, np.zeros(700, np.int64)), wanted), np.searchsorted(wanted, at), -1)

    def summed(t, wanted):
        order = np.argsort(wanted)
        slot = slots(t, wanted[order])
        ok = slot >= 0
        return boosting.sums(x[:, ok], np.rint(g[ok]), order[slot[ok]], len(wanted)).astype(np.int64)

    for depth in (0, 1, 6):
        t = boosting.grow(summed, depth)
        assert t.depth.max() == depth and np.array_equal(boosting.walked(t, x), t.walk(x.T, np.zeros(700, np.int64)))


@pytest.mark.parametrize("kind, grid, module", [("gbt", {"maxIter": [1], "maxDepth": [1, 2], "stepSize": [0.1, 0.3]}, "boosting"),
                                                ("rf", {"numTrees": [2], "maxDepth": [2], "minInstancesPerNode": [1, 2, 3]}, "forest")])
def test_the_fits_of_a_fold_bin_its_rows_once(spark, monkeypatch, kind, grid, module):
    from panelcast.operators import forest

    made, module = [], {"boosting": boosting, "forest": forest}[module]
    real = module.prepared
    monkeypatch.setattr(module, "prepared", lambda *a: made.append(1) or real(*a))
    rng = np.random.default_rng(9)
    x = rng.normal(size=(240, 2))
    rows = [(f"2024-{1 + i % 4:02d}-01", float(a), float(b), float(a + b > 0)) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "month string, a double, b double, churned double").selectExpr("CAST(month AS DATE) AS month", "a", "b", "churned")
    *_, table = ml.grid_search(df, ["a", "b"], kind, grid, n_splits=2)
    n = len(ml.param_maps(grid))
    assert {r.n_fits for r in table.collect()} == {2 * n + 1} and len(made) == 2 + 1  # one for each fold, one for the best map
