import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel

from panelcast.operators import forest, ml, trees


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 9)).round(2)
    x[:, 8] = 1.0  # asks nothing
    y = (x[:, 0] * x[:, 1] + 0.5 * x[:, 2] + rng.normal(scale=0.3, size=3000) > 0).astype(float)
    names = [f"f{i}" for i in range(9)]
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], ", ".join(f"{f} double" for f in names) + ", y double").repartition(5).cache(), names, x, y


def grown(table, **params):
    df, names, x, y = table
    local = params.pop("local_rows", None)
    est = ml.make_estimator("rf", label="y", **params)
    return forest.fit(df, names, "y", est, len(y), int(y.sum()), local)


@pytest.mark.parametrize("local", [None, 200, 1])
def test_same_rules_wherever_nodes_are_split(spark, table, local):
    """All nodes in one task, some, or none but by sums over partitions."""
    df, names, x, y = table
    model = grown(table, numTrees=6, maxDepth=7, minInstancesPerNode=3, local_rows=local)
    assert isinstance(model, RandomForestClassificationModel) and model.getNumTrees == 6 and model.numFeatures == 9 and model.numClasses == 2
    from pyspark.ml import PipelineModel

    t = trees.ensemble(PipelineModel([model]))
    assert sum(1 for _ in t.levels()) <= 8
    inner = t.left >= 0
    assert inner.sum() > 60 and (t.rows >= 3).all() and not (t.feature[inner] == 8).any()
    kids = t.rows[t.left[inner]] + t.rows[t.right[inner]]
    assert (kids == t.rows[inner]).all()
    positives = t.value * t.rows
    assert np.allclose(positives[t.left[inner]] + positives[t.right[inner]], positives[inner])
    assert not (t.value[~inner][:, None] > 1).any()
    # every node holds the rows of its tree's bag that its cuts leave
    rows = forest.binned(df, names, "y", forest.cuts_of(x)).orderBy("row").collect()
    order = np.array([r.row for r in rows])
    placed = np.array(df.select(*names, "y").collect())
    assert len(placed) == len(order)
    for tree in range(6):
        w = forest.bag(42, order, tree)
        assert t.rows[t.root[tree]] == w.sum()
    assert ((t.margins(x) > 0.5) == y).mean() > 0.85


def test_as_good_as_sparks_own(spark, table):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import VectorAssembler

    df, names, x, y = table
    train, test = df.randomSplit([0.7, 0.3], 1)
    train = train.cache()
    params = {"numTrees": 30, "maxDepth": 12}
    own = ml.fit(train, names, "rf", "y", **params)
    spark_model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), ml.make_estimator("rf", label="y", **params)]).fit(train)
    f1 = [ml.positive_f1(m.transform(test), "y") for m in (own, spark_model)]
    assert abs(f1[0] - f1[1]) < 0.04 and f1[0] > 0.8
    a, b = (np.array([v for _, v in ml.feature_importance(m, names)]) for m in (own, spark_model))
    assert a.sum() == pytest.approx(1) and np.abs(a - b).max() < 0.05
    assert isinstance(own, PipelineModel)


def test_one_split_against_brute_force():
    rng = np.random.default_rng(2)
    x, y, w = rng.integers(0, 6, (80, 3)).astype(np.uint8), rng.integers(0, 2, 80), rng.integers(0, 3, 80)
    drawn = np.array([[0, 1, 2]])
    f, cut, gain, n, p, all_n, all_p = forest.chosen(forest.sums(x, y, w, np.zeros(80, np.int64), drawn), drawn, 4)

    def gini(m):
        q = (w * y)[m].sum() / max(1, w[m].sum())
        return w[m].sum() / w.sum() * 2 * q * (1 - q)

    every = np.ones(80, bool)
    want = {(i, c): gini(every) - gini(x[:, i] <= c) - gini(x[:, i] > c) for i in range(3) for c in range(5)
            if min(w[x[:, i] <= c].sum(), w[x[:, i] > c].sum()) >= 4}
    assert gain[0] == pytest.approx(max(want.values())) and want[f[0], cut[0]] == pytest.approx(gain[0])
    assert (all_n[0], all_p[0]) == (w.sum(), (w * y).sum())
    assert n[0] == w[x[:, f[0]] <= cut[0]].sum() and p[0] == (w * y)[x[:, f[0]] <= cut[0]].sum()


def test_no_statistics_of_small_nodes_from_every_partition(spark, table, monkeypatch):
    """The cost that made deep forests fail: a job for each level or group of nodes.  Small nodes take one job."""
    calls = []
    monkeypatch.setattr(forest, "_split_level", lambda *a: calls.append(a))
    model = grown(table, numTrees=3, maxDepth=20)
    assert not calls and max(t.depth for t in model.trees) > 8


def test_odd_labels_and_weights_go_to_spark(spark, table, monkeypatch):
    df, names, *_ = table
    monkeypatch.setattr(forest, "fit", lambda *a: pytest.fail("not for these"))
    small = df.limit(200)
    ml.fit(small.where("y = 1"), names, "rf", "y", numTrees=2, maxDepth=2)
    ml.fit(small.selectExpr("*", "1.0D AS w"), names, "rf", "y", weight_col="w", numTrees=2, maxDepth=2)
    ml.fit(small, names, "rf", "y", numTrees=1, maxDepth=2)


def test_own_arrays_are_those_of_the_saved_model(spark, table):
    """The nodes reach the attribution without Spark's model, which is loaded when asked for and has the same nodes."""
    from pyspark.ml import PipelineModel

    model = grown(table, numTrees=4, maxDepth=6, local_rows=500)
    pipe = PipelineModel([model])
    own = trees.ensemble(pipe)
    assert model._loaded is None
    read = trees.ensemble(PipelineModel([RandomForestClassificationModel._from_java(model._java_obj)]))
    assert model._loaded is not None and model.getNumTrees == 4 and model.getMaxDepth() == 6
    a, b = (np.concatenate(list(e.levels())) for e in (own, read))  # numbered in another order
    for c in ("feature", "cut", "value", "rows"):
        assert np.array_equal(getattr(own, c)[a], getattr(read, c)[b]), c
    assert np.array_equal(own.left[a] < 0, read.left[b] < 0) and np.array_equal(own.weight, read.weight)


def test_rows_of_a_few_trees_are_on_their_way_at_once(spark, table, monkeypatch):
    """All trees' rows in one shuffle filled the disks; now they go in turns, whose files go with them, with the same trees."""
    calls, real = [], forest._subtrees

    def seen(rows, top, small, sent, *a):
        calls.append(list(sent))
        return real(rows, top, small, sent, *a)

    monkeypatch.setattr(forest, "_subtrees", seen)
    whole = grown(table, numTrees=7, maxDepth=5).ensemble()
    monkeypatch.setattr(forest, "SENT_TREES", 3)
    monkeypatch.setattr(forest, "SENT_ROWS", 0)
    parts = grown(table, numTrees=7, maxDepth=5).ensemble()
    assert calls == [list(range(7)), [0, 1, 2], [3, 4, 5], [6]]
    assert np.array_equal(whole.cut, parts.cut) and np.array_equal(whole.left, parts.left) and np.array_equal(whole.rows, parts.rows)
