"""Node tables of fitted tree ensembles: additive attribution, staged scores and pruning.

A fitted forest or boosted ensemble becomes one table of nodes (tree, feature, cut, value,
rows).  From it a batch of rows walks all trees at once:

* a row's margin splits over the features on its paths: every step from a node to its child
  adds the change of the node value to the feature that the node asks, so the contributions
  and the base (the weighted root values) add up to the margin;
* margins after fewer trees, with a smaller depth, or without the splits of nodes with too few
  rows all come from the same walk, because nodes are grown from the top and cutting a grown
  tree gives the tree that the smaller setting grows.

The table goes to every task, so its size is checked (``MAX_NODES``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.operators import forest
from panelcast.session import importable_on_workers, scratch_path

#: About 40 bytes each in every task.
MAX_NODES = 5_000_000


@dataclass
class Ensemble:
    """Nodes of all trees, a parent before its children.  ``left`` and ``right`` are node numbers, -1 in leaves; ``value``
    is the share of positives (forest) or the mean response (boosting), ``rows`` the training rows, ``root`` the
    first node and ``weight`` the weight of each tree."""

    boosted: bool
    root: np.ndarray
    weight: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    rows: np.ndarray

    @property
    def base(self) -> float:
        return float(self.weight @ self.value[self.root])

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-2 * margin)) if self.boosted else margin

    def levels(self):
        """Node numbers of each depth, roots first."""
        at = self.root
        while len(at):
            yield at
            inner = at[self.left[at] >= 0]
            at = np.r_[self.left[inner], self.right[inner]]

    def pruned(self, max_depth: int | None = None, min_split: int = 2, n_trees: int | None = None) -> Ensemble:
        """The ensemble grown to ``max_depth``, splitting no node of fewer than ``min_split`` rows, with the first trees
        only: nodes that may not be split become leaves.  Boosted trees depend on all leaves of those before them, so only
        their number can be cut."""
        root = self.root if n_trees is None else self.root[:n_trees]
        weight = self.weight[: len(root)]
        if not self.boosted:
            weight = np.full(len(root), 1 / len(root))
        elif max_depth is not None or min_split > 2:
            raise ValueError("only the number of boosted trees can be cut")
        stop = self.rows < min_split
        for depth, at in enumerate(self.levels()):
            if depth == max_depth:
                stop[at] = True
        return replace(self, root=root, weight=weight, left=np.where(stop, -1, self.left), right=np.where(stop, -1, self.right))

    def leaves(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The leaf of each row in a tree."""
        at = np.full(len(x), self.root[tree])
        go = np.arange(len(x))
        while True:
            go = go[self.left[at[go]] >= 0]
            if not len(go):
                return at
            n = at[go]
            at[go] = np.where(x[go, self.feature[n]] <= self.cut[n], self.left[n], self.right[n])

    def margins(self, x: np.ndarray) -> np.ndarray:
        return sum((w * self.value[self.leaves(x, t)] for t, w in enumerate(self.weight)), np.zeros(len(x)))

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """Rows by features: what each feature on a row's paths adds to its margin."""
        out = np.zeros(x.shape)
        for root, w in zip(self.root, self.weight):
            at, go = np.full(len(x), root), np.arange(len(x))
            while True:
                go = go[self.left[at[go]] >= 0]
                if not len(go):
                    break
                n = at[go]
                f = self.feature[n]
                child = np.where(x[go, f] <= self.cut[n], self.left[n], self.right[n])
                out[go, f] += w * (self.value[child] - self.value[n])
                at[go] = child
        return out


class Staged:
    """Probabilities under several settings (``max_depth``, ``min_split``, ``n_trees``) from one walk of the whole ensemble."""

    def __init__(self, ensemble: Ensemble, settings: Sequence[dict]):
        self.whole, self.settings = ensemble, list(settings)
        shapes = {(s.get("max_depth"), s.get("min_split", 2)) for s in settings}
        self.values = {shape: self._seen_from(ensemble.pruned(*shape) if shape != (None, 2) else ensemble) for shape in shapes}

    def _seen_from(self, cut: Ensemble) -> np.ndarray:
        """For every node of the whole ensemble the value at which the cut one stops on the way to it."""
        out = self.whole.value.copy()
        for at in self.whole.levels():
            inner = at[self.whole.left[at] >= 0]
            above = inner[(cut.left[inner] < 0)]
            for child in (self.whole.left[above], self.whole.right[above]):
                out[child] = out[above]
                cut.left[child] = -1  # below a stop all is stopped
        return out

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Settings by rows."""
        shapes = list(self.values)
        sums = {s: np.zeros(len(x)) for s in shapes}
        out = np.empty((len(self.settings), len(x)))
        total = len(self.whole.root)
        for t in range(total):
            leaf = self.whole.leaves(x, t)
            for s in shapes:
                sums[s] += self.values[s][leaf] * (self.whole.weight[t] if self.whole.boosted else 1.0)
            for i, setting in enumerate(self.settings):
                if t + 1 == min(setting.get("n_trees") or total, total):
                    m = sums[setting.get("max_depth"), setting.get("min_split", 2)]
                    out[i] = self.whole.probability(m if self.whole.boosted else m / (t + 1))
        return out


def node_table(model: PipelineModel) -> DataFrame:
    """``tree, node, left, right, feature, cut, value, rows`` of the pipeline's last stage, a fitted tree ensemble.  The
    stage is written to the shared scratch folder in Spark's own model format and read back as a table."""
    last = model.stages[-1]
    if not hasattr(last, "treeWeights"):
        raise ValueError(f"{type(last).__name__} is not a tree ensemble")
    spark = SparkSession.builder.getOrCreate()
    path = scratch_path(spark, f"trees-{uuid.uuid4().hex[:8]}")
    last.write().overwrite().save(path)
    raw = spark.read.parquet(f"{path}/data")
    n = F.col("nodeData")
    stats = n["impurityStats"]
    share = F.when(F.aggregate(stats, F.lit(0.0), lambda a, b: a + b) > 0, F.get(stats, F.lit(1)) / F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)).otherwise(0.0)
    boosted = type(last).__name__.startswith("GBT")
    return raw.select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("cut"),
        (n["prediction"] if boosted else share).alias("value"), n["rawCount"].alias("rows"),
        (n["split"]["numCategories"] > -1).alias("categorical"))


def ensemble(model: PipelineModel) -> Ensemble:
    """The node table as arrays; ValueError for one that is too large for every task, or that splits on categories.  A
    forest that still has its own arrays (``forest.Forest``) gives those."""
    if isinstance(model.stages[-1], forest.Forest):
        grown = model.stages[-1].ensemble()
        if len(grown.left) > MAX_NODES:
            raise ValueError(f"more than {MAX_NODES} nodes")
        return grown
    table = node_table(model)
    if table.count() > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes")
    t = table.toPandas().sort_values(["tree", "node"])
    inner = (t["left"] >= 0).to_numpy()
    if t.loc[inner, "categorical"].any():
        raise ValueError("splits on categories are not supported")
    root = np.flatnonzero((t["node"] == 0).to_numpy())
    first = np.repeat(root, np.diff(np.r_[root, len(t)]))
    last = model.stages[-1]
    boosted = type(last).__name__.startswith("GBT")
    weight = np.array(last.treeWeights, float)
    if not boosted:
        weight = np.full(len(root), 1 / len(root))
    side = lambda c: np.where(inner, t[c].to_numpy() + first, -1).astype(np.int64)
    return Ensemble(boosted, root, weight, side("left"), side("right"), np.where(inner, t["feature"], 0).astype(np.int64),
                    np.where(inner, t["cut"], 0.0).astype(float), t["value"].to_numpy(float), t["rows"].to_numpy(np.int64))


def _matrix(batch: pa.RecordBatch, at: Sequence[int]) -> np.ndarray:
    return np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in at], axis=1) if batch.num_rows else np.zeros((0, len(at)))


def _walked(rows: DataFrame, features: Sequence[str], keep: Sequence[str], fields: Sequence[T.StructField], fn) -> DataFrame:
    """``keep`` and the arrays that ``fn`` makes of the feature matrix of each batch."""
    importable_on_workers(rows.sparkSession)
    features, keep = list(features), list(keep)
    src = rows.select(*keep, *[F.col(f).cast("double").alias(f"__x{i}") for i, f in enumerate(features)])
    schema = T.StructType([*[rows.schema[c] for c in keep], *fields])
    at = range(len(keep), len(keep) + len(features))

    def run(batches):
        for b in batches:
            made = fn(_matrix(b, at))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *[pa.array(m) for m in made]], names=schema.names)

    return src.mapInArrow(run, schema)


def path_attribution(model: PipelineModel | Ensemble, rows: DataFrame, features: Sequence[str], ids: Sequence[str] = ("account_id", "month")) -> DataFrame:
    """``ids, base, margin, churn_risk_score, contributions``: a row's margin (a forest's share of positives, a boosted
    ensemble's half log-odds) as the base and one contribution for each feature, in the order of ``features``.  The
    contributions add up to ``margin - base``.  Nulls count as not a number, which goes right at every cut."""
    e = model if isinstance(model, Ensemble) else ensemble(model)

    def fn(x):
        m = e.margins(x)
        return np.full(len(x), e.base), m, e.probability(m), list(e.contributions(x))

    double = lambda n: T.StructField(n, T.DoubleType())
    return _walked(rows, features, ids, [double("base"), double("margin"), double("churn_risk_score"), T.StructField("contributions", T.ArrayType(T.DoubleType()))], fn)


def top_contributions(attributed: DataFrame, features: Sequence[str], top_n: int, ids: Sequence[str] = ("account_id", "month")) -> DataFrame:
    """The ``top_n`` largest contributions of every row (by size, ties by name): ``ids, base, margin, rank, feature, contribution``."""
    names = F.array(*[F.lit(f) for f in features])
    pairs = F.arrays_zip(names.alias("feature"), F.col("contributions").alias("contribution"))
    ordered = F.array_sort(F.transform(pairs, lambda p: F.struct((-F.abs(p["contribution"])).alias("size"), p["feature"].alias("feature"), p["contribution"].alias("contribution"))))
    out = attributed.select(*ids, "base", "margin", F.posexplode(F.slice(ordered, 1, top_n)).alias("at", "p"))
    return out.select(*ids, "base", "margin", (F.col("at") + 1).alias("rank"), F.col("p.feature").alias("feature"), F.col("p.contribution").alias("contribution"))


def staged_confusions(whole: Ensemble, settings: Sequence[dict], rows: DataFrame, features: Sequence[str], label: str) -> list[tuple[int, int, int]]:
    """(true positives, false positives, false negatives) of each setting (``Staged``) at 0.5, all in one pass over ``rows``."""
    staged = Staged(whole, settings)
    scored = _walked(rows, features, [label], [T.StructField("p", T.ArrayType(T.DoubleType()))], lambda x: (list(staged(x).T),))
    sums = [F.count_if(c).alias(f"{k}{i}") for i in range(len(settings)) for k, c in (
        ("tp", (F.col("p")[i] > 0.5) & (F.col(label) == 1)), ("fp", (F.col("p")[i] > 0.5) & (F.col(label) != 1)),
        ("fn", (F.col("p")[i] <= 0.5) & (F.col(label) == 1)))]
    r = scored.agg(*sums).first()
    return [(r[f"tp{i}"], r[f"fp{i}"], r[f"fn{i}"]) for i in range(len(settings))]


class TreeModel:
    """A (pruned) ensemble that scores like a fitted pipeline."""

    def __init__(self, nodes: Ensemble, features: Sequence[str]):
        self.nodes, self.features = nodes, list(features)

    def transform(self, df: DataFrame) -> DataFrame:
        e = self.nodes
        p = _walked(df, self.features, df.columns, [T.StructField("__p1", T.DoubleType())], lambda x: (e.probability(e.margins(x)),))
        return p.select(*df.columns, array_to_vector(F.array(1 - F.col("__p1"), F.col("__p1"))).alias("probability"),
                        (F.col("__p1") > 0.5).cast("double").alias("prediction"))
