import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from panelcast.operators import ml, trees
from panelcast.plans.training import _features, train_test


@pytest.fixture(scope="module")
def fitted(spark):
    mm = train_test(spark, SF0001)
    feats = _features(mm)
    train = mm.where("split = 'train'")
    return mm, feats, {"rf": ml.fit(train, feats, "rf", numTrees=7, maxDepth=9), "gbt": ml.fit(train, feats, "gbt", maxIter=6, maxDepth=4)}


@pytest.mark.parametrize("kind", ["rf", "gbt"])
def test_contributions_add_up_and_scores_are_the_models(spark, fitted, kind):
    mm, feats, models = fitted
    test = mm.where("split = 'test'")
    got = {(r.account_id, r.month): r for r in trees.path_attribution(models[kind], test, feats).collect()}
    own = ml.score_model(models[kind], test).collect()
    assert len(got) == len(own) > 0
    for r in own:
        a = got[r.account_id, r.month]
        assert sum(a.contributions) == pytest.approx(a.margin - a.base, abs=1e-9)
        assert a.churn_risk_score == pytest.approx(r.churn_risk_score, abs=1e-9)
    assert np.abs([sum(map(abs, r.contributions)) for r in got.values()]).max() > 0


def test_contributions_by_hand():
    # root asks feature 0, its right child asks feature 1
    e = trees.Ensemble(False, np.array([0]), np.array([1.0]), np.array([1, -1, 3, -1, -1]), np.array([2, -1, 4, -1, -1]),
                       np.array([0, 0, 1, 0, 0]), np.array([5.0, 0, 2.0, 0, 0]), np.array([0.5, 0.2, 0.8, 0.6, 1.0]), np.array([10, 5, 5, 2, 3]))
    x = np.array([[4.0, 9.0], [6.0, 1.0], [6.0, 3.0]])
    assert e.margins(x).tolist() == [0.2, 0.6, 1.0]
    assert np.allclose(e.contributions(x), [[-0.3, 0], [0.3, -0.2], [0.3, 0.2]])
    cut = e.pruned(min_split=6)
    assert cut.margins(x).tolist() == [0.2, 0.8, 0.8] and e.pruned(max_depth=0).margins(x).tolist() == [0.5] * 3
    both = trees.Staged(e, [{}, {"min_split": 6}, {"max_depth": 0}, {"max_depth": 1, "min_split": 6}])(x)
    assert both.tolist() == [[0.2, 0.6, 1.0], [0.2, 0.8, 0.8], [0.5] * 3, [0.2, 0.8, 0.8]]


def test_no_split_node_under_the_bound_and_staged_equals_pruned(spark, fitted):
    mm, feats, models = fitted
    e = trees.ensemble(models["rf"])
    x = np.array(mm.where("split = 'test'").select(*feats).limit(300).collect())
    settings = [{"n_trees": n, "max_depth": d, "min_split": m} for n in (1, 4, 7) for d in (2, 5, 30) for m in (2, 5, 60)]
    for s, p in zip(settings, trees.Staged(e, settings)(x)):
        cut = e.pruned(**s)
        seen = np.concatenate(list(cut.levels()))
        inner = seen[cut.left[seen] >= 0]
        assert (cut.rows[inner] >= s["min_split"]).all() and sum(1 for _ in cut.levels()) <= s["max_depth"] + 1
        assert np.allclose(p, cut.probability(cut.margins(x)))
    with pytest.raises(ValueError):
        trees.ensemble(models["gbt"]).pruned(max_depth=2)


def test_fewer_rounds_are_a_shorter_fit(spark, fitted):
    mm, feats, models = fitted
    short = trees.ensemble(ml.fit(mm.where("split = 'train'"), feats, "gbt", maxIter=3, maxDepth=4))
    cut = trees.ensemble(models["gbt"]).pruned(n_trees=3)
    x = np.array(mm.select(*feats).limit(300).collect())
    assert np.allclose(short.margins(x), cut.margins(x))


def test_top_contributions_and_empty_rows(spark, fitted):
    mm, feats, models = fitted
    out = trees.path_attribution(models["rf"], mm.limit(3), feats)
    top = trees.top_contributions(out, feats, 4).collect()
    assert len(top) == 12 and all(abs(a.contribution) >= abs(b.contribution) for a, b in zip(top, top[1:]) if b.rank > 1)
    assert trees.path_attribution(models["rf"], mm.where("false"), feats).count() == 0
    with pytest.raises(ValueError):
        trees.node_table(ml.fit(mm.where(F.col("split") == "train"), feats, "lr", maxIter=3))
