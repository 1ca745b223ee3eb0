"""Random forests of deep trees: big nodes split from sums over all partitions, small nodes grown where their rows meet.

``pyspark.ml`` splits every node from statistics of every partition (32 bins x drawn features x classes), however few rows
the node has, so its work for deep trees goes with nodes x partitions.  Here only nodes of more than ``local_rows`` rows are
split so, a level at a time.  The rows of each smaller node meet once, packed, in the task that its node is dealt to, and its
subtree grows there, from the same bins and by the same rules.  A few trees at a time send their rows, and those shuffle files
go before the next trees' rows are sent, so the disk holds the table some times, not once for every tree.

The model is that of ``RandomForestClassifier``: trees on Poisson(1) bags, cuts of at most ``BINS`` bins from a sample of
rows, ``ceil(sqrt(features))`` features drawn for each node, gini gain, ``maxDepth`` and ``minInstancesPerNode``, sibling
leaves of equal prediction merged.  Its nodes stay arrays; Spark's own model is saved and loaded from them (``Forest``) only
when something asks for it.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import importable_on_workers, materialize, scratch_path

#: Bins of a feature, and rows of the sample that places their cuts (both as in ``RandomForestClassifier``).
BINS, CUT_ROWS = 32, 10_000
#: Rows up to which a node's subtree grows in one task (a byte a row and feature), and rows of one such task's partition.
LOCAL_ROWS, TASK_ROWS = 200_000, 2_000_000
#: Trees whose rows are on their way at once, or as many more as have so many rows.
SENT_TREES, SENT_ROWS = 10, 20_000_000
#: Rows whose places in all trees are found at once; nodes whose bins are summed at once.
STEP_ROWS, STEP_NODES = 1 << 18, 1 << 10
#: Rows and positives are summed as one number, positives in steps of this (fewer rows in any sum).
_BOTH = float(1 << 26)
#: Types in which the arrays of a subtree travel.
_PACKED = {"left": np.int32, "feature": np.int32, "cut": np.uint8, "n": np.int32, "p": np.int32, "gain": np.float64}
#: Cumulated Poisson(1) probabilities.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def cuts_of(sample: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Cuts of each column: between all its values, or where a ``bins``-th of the rows more lies below."""
    out = []
    for x in sample.T:
        values, n = np.unique(x, return_counts=True)
        middle = (values[:-1] + values[1:]) / 2
        if len(middle) >= bins:
            want = np.arange(1, bins) * len(x) / bins
            middle = middle[np.unique(np.minimum(np.searchsorted(np.cumsum(n), want), len(middle) - 1))]
        out.append(middle)
    return out


def binned(df: DataFrame, features: Sequence[str], label: str, cuts: list[np.ndarray]) -> DataFrame:
    """``row, x, y``: a number of each row, one byte a feature and the label, written once."""
    src = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("double").alias("y"))

    def run(batches):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        for b in batches:
            x = np.empty((b.num_rows, len(cuts)), np.uint8)
            for i, c in enumerate(cuts):
                v = b.column(i).to_numpy(zero_copy_only=False).astype(float)
                if np.isnan(v).any():
                    raise ValueError(f"null or NaN in {features[i]}")
                x[:, i] = np.searchsorted(c, v)
            at = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(first, first + len(x))), pa.Array.from_buffers(pa.binary(), len(x), [None, at.buffers()[1], pa.py_buffer(x)]),
                 pa.array(b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int8))], names=["row", "x", "y"])
            first += len(x)

    even = 2 * df.sparkSession.sparkContext.defaultParallelism  # every level waits for the longest task
    return materialize(src.mapInArrow(run, "row bigint, x binary, y tinyint").repartition(even, "row"), "forest-rows")


def sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, slot: np.ndarray, drawn: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """(rows and positives) x nodes x drawn features x bins; ``slot`` is the node of each row, or of each of ``rows``."""
    k = drawn.shape[1]
    rows = np.arange(len(x)) if rows is None else rows
    cell = x.ravel().take(rows[:, None] * x.shape[1] + drawn[slot]) + (np.arange(len(drawn) * k) * BINS).reshape(-1, k)[slot]
    both = np.bincount(cell.ravel(), np.repeat(w[rows] * (1 + _BOTH * y[rows]), k), len(drawn) * k * BINS)
    positives = np.floor(both / _BOTH)
    return np.stack([both - _BOTH * positives, positives]).reshape(2, len(drawn), k, BINS)


def chosen(found: np.ndarray, drawn: np.ndarray, least: int):
    """The best cut of each node: (feature, bin up to which rows go left, gain, rows and positives on the left, of all)."""
    n, p = np.cumsum(found, axis=3)
    all_n, all_p = n[:, :1, -1:], p[:, :1, -1:]
    n, p = n[..., :-1], p[..., :-1]

    def gini(n, p):
        return 2 * p * (n - p) / np.maximum(n, 1)

    gain = (gini(all_n, all_p) - gini(n, p) - gini(all_n - n, all_p - p)) / np.maximum(all_n, 1)
    gain[(n < least) | (all_n - n < least)] = -1
    flat = gain.reshape(len(drawn), -1)
    best, at = flat.argmax(axis=1), np.arange(len(drawn))
    f, cut = np.divmod(best, BINS - 1)
    return drawn[at, f], cut, flat[at, best], n[at, f, cut], p[at, f, cut], all_n[:, 0, 0], all_p[:, 0, 0]


class Nodes:
    """Growing arrays of nodes; ``left`` is -1 in leaves, the right child follows the left one."""

    def __init__(self, n, p, depth: int = 0):
        self.n, self.p = np.atleast_1d(n).astype(float), np.atleast_1d(p).astype(float)
        size = len(self.n)
        self.left, self.feature, self.cut = (np.full(size, v, np.int64) for v in (-1, 0, 0))
        self.gain, self.depth = np.zeros(size), np.full(size, depth)

    def impure(self, at: np.ndarray, least: int, deepest: int) -> np.ndarray:
        """Those of ``at`` that may be split."""
        n, p = self.n[at], self.p[at]
        return at[(p > 0) & (p < n) & (n >= 2 * least) & (self.depth[at] < deepest)]

    def split(self, at: np.ndarray, feature, cut, gain, n, p, all_n, all_p) -> np.ndarray:
        """Split nodes where it gains; their children."""
        self.n[at], self.p[at] = all_n, all_p
        ok = gain > 1e-12
        at, feature, cut, gain, n, p = (v[ok] for v in (at, feature, cut, gain, n, p))
        first = len(self.n) + 2 * np.arange(len(at))
        self.left[at], self.feature[at], self.cut[at], self.gain[at] = first, feature, cut, gain
        sides = lambda a, b: np.stack([a, b], axis=1).ravel()
        more = Nodes(sides(n, self.n[at] - n), sides(p, self.p[at] - p))
        more.depth = np.repeat(self.depth[at] + 1, 2)
        for c in vars(self):
            setattr(self, c, np.r_[getattr(self, c), getattr(more, c)])
        return sides(first, first + 1)

    def walk(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The leaf of each row, from the node it is at."""
        at, go = at.copy(), np.arange(len(x))
        while len(go := go[self.left[at[go]] >= 0]):
            k = at[go]
            at[go] = self.left[k] + (x[go, self.feature[k]] > self.cut[k])
        return at


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, deepest: int, least: int, k: int, rng: np.random.Generator) -> Nodes:
    """The tree below a node of these rows."""
    t = Nodes(w.sum(), (w * y).sum(), depth)
    level, node, rows = np.zeros(1, np.int64), np.zeros(len(x), np.int64), np.arange(len(x))
    while len(active := t.impure(level, least, deepest)):
        slot_of = np.full(len(t.n), -1)
        slot_of[active] = np.arange(len(active))
        rows = rows[slot_of[node[rows]] >= 0]
        rows = rows[np.argsort(slot_of[node[rows]], kind="stable")]
        slot = slot_of[node[rows]]
        drawn = rng.random((len(active), x.shape[1])).argpartition(k - 1, axis=1)[:, :k]
        parts = []
        for a in range(0, len(active), STEP_NODES):
            d = drawn[a : a + STEP_NODES]
            i, j = np.searchsorted(slot, [a, a + len(d)])
            parts.append(chosen(sums(x, y, w, slot[i:j] - a, d, rows[i:j]), d, least))
        level = t.split(active, *map(np.concatenate, zip(*parts)))
        k_at = node[rows]
        rows, k_at = rows[t.left[k_at] >= 0], k_at[t.left[k_at] >= 0]
        node[rows] = t.left[k_at] + (x[rows, t.feature[k_at]] > t.cut[k_at])
    return t


def bag(seed: int, row: np.ndarray, tree: int) -> np.ndarray:
    """How often a tree's bag holds each row."""
    from panelcast.operators.ml import _mixed

    u = (_mixed(seed, row, np.full(1, tree), 3) >> np.uint64(11)).astype(float) / float(1 << 53)
    return np.searchsorted(_POISSON, u, "right")


def _steps(batches) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row numbers, bins, labels) of up to ``STEP_ROWS`` rows, and of those of one batch at least."""
    held: list[pa.RecordBatch] = []

    def read():
        x = []
        for b in held:
            c = b.column(1)
            at = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]
            x.append(np.frombuffer(c.buffers()[2], np.uint8)[at[0] : at[-1]].reshape(len(c), -1))
        col = lambda i: np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held])
        return col(0), np.concatenate(x), col(2).astype(np.int64)

    for b in batches:
        if held and sum(h.num_rows for h in held) + b.num_rows > STEP_ROWS:
            yield read()
            held.clear()
        if b.num_rows:
            held.append(b)
    if held:
        yield read()


def _placed(batches, top: Nodes, wanted: np.ndarray, trees: Sequence[int], seed: int):
    """(tree, bins, labels, weights, nodes) of the rows of each tree's bag that stand at ``wanted`` nodes."""
    is_wanted = np.zeros(len(top.n), bool)
    is_wanted[wanted] = True
    for row, x, y in _steps(batches):
        for t in trees:
            w = bag(seed, row, t)
            r = np.flatnonzero(w)
            at = top.walk(x[r], np.full(len(r), t))
            r, at = r[is_wanted[at]], at[is_wanted[at]]
            if len(r):
                yield t, x[r], y[r], w[r], at


def _tree_of(top: Nodes, trees: int) -> np.ndarray:
    tree = np.r_[np.arange(trees), np.zeros(len(top.n) - trees, np.int64)]
    for i in np.flatnonzero(top.left >= 0):  # parents come before their children
        tree[top.left[i] : top.left[i] + 2] = tree[i]
    return tree


def _split_level(rows: DataFrame, top: Nodes, big: np.ndarray, trees: int, k: int, features: int, least: int, seed: int) -> None:
    """Split the nodes ``big`` from sums over all partitions."""
    drawn = np.random.default_rng([seed, len(top.n)]).random((len(big), features)).argpartition(k - 1, axis=1)[:, :k]
    tree = _tree_of(top, trees)[big]
    order = np.argsort(tree, kind="stable")
    big, drawn, tree = big[order], drawn[order], tree[order]
    first = np.searchsorted(tree, np.arange(trees + 1))
    slot_of = np.full(len(top.n), -1)
    slot_of[big] = np.arange(len(big))

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for t, x, y, w, at in _placed(batches, top, big, range(trees), seed):
            s = sums(x, y, w, slot_of[at] - first[t], drawn[first[t] : first[t + 1]])
            total[t] = total[t] + s if t in total else s
        for t, s in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([t]), pa.array([s.astype(np.int64).tobytes()], pa.binary())], names=["tree", "sums"])

    def best(key, pdf):
        t = key[0]
        d = drawn[first[t] : first[t + 1]]
        total = sum(np.frombuffer(s, np.int64) for s in pdf["sums"]).reshape(2, len(d), k, BINS).astype(float)
        return pd.DataFrame(dict(zip(("slot", *cols), (np.arange(first[t], first[t + 1]), *chosen(total, d, least)))))

    cols = ("f", "cut", "gain", "n", "p", "all_n", "all_p")
    schema = "slot bigint, f bigint, cut bigint, gain double, n double, p double, all_n double, all_p double"
    found = rows.mapInArrow(add, "tree bigint, sums binary").groupBy("tree").applyInPandas(best, schema)
    got = found.toPandas().sort_values("slot")
    top.split(big[got["slot"].to_numpy()], *(got[c].to_numpy() for c in cols))


def _dealt(rows: np.ndarray, tasks: int) -> np.ndarray:
    """A task for each node of so many rows, about the same number of rows for each task."""
    out, load = np.zeros(len(rows), np.int64), [(0.0, i) for i in range(tasks)]
    for i in np.argsort(-rows, kind="stable"):
        least, task = load[0]
        out[i] = task
        heapq.heapreplace(load, (least + rows[i], task))
    return out


def _subtrees(rows: DataFrame, top: Nodes, small: np.ndarray, trees: Sequence[int], k: int, features: int, deepest: int, least: int, seed: int,
              tasks: int) -> DataFrame:
    """The trees below the nodes ``small`` of some trees, each grown where its rows meet: a row of packed arrays for each."""
    task_of = np.zeros(len(top.n), np.int64)
    task_of[small] = _dealt(top.n[small], tasks)

    def send(batches):
        codec = pa.Codec("zstd", compression_level=1)
        for t, x, y, w, at in _placed(batches, top, small, trees, seed):
            order = np.argsort(at, kind="stable")
            at = at[order]
            held = np.concatenate([x[order], (2 * w[order] + y[order]).astype(np.uint8)[:, None]], axis=1)
            nodes, first = np.unique(at, return_index=True)
            cut = [*first, len(at)]
            pieces = [codec.compress(held[i:j].T.tobytes(), asbytes=True) for i, j in zip(cut, cut[1:])]  # by feature: packs better
            yield pa.RecordBatch.from_arrays([pa.array(task_of[nodes]), pa.array(nodes), pa.array(np.diff(cut)), pa.array(pieces, pa.binary())],
                                             names=["task", "node", "n", "held"])

    depth = top.depth

    def below(batches):
        codec, found = pa.Codec("zstd"), {}
        for b in batches:
            for node, n, held in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                found.setdefault(node, []).append((n, held))
        for node in sorted(found):
            held = np.concatenate([np.frombuffer(codec.decompress(h, n * (features + 1)), np.uint8).reshape(features + 1, n).T for n, h in found.pop(node)])
            x, y, w = np.ascontiguousarray(held[:, :-1]), (held[:, -1] & 1).astype(np.int64), (held[:, -1] >> 1).astype(np.int64)
            t = grow(x, y, w, int(depth[node]), deepest, least, k, np.random.default_rng([seed, node]))
            yield pa.RecordBatch.from_arrays([pa.array([node]), *(pa.array([getattr(t, c).astype(d).tobytes()], pa.binary()) for c, d in _PACKED.items())],
                                             names=["node", *_PACKED])

    sent = rows.mapInArrow(send, "task bigint, node bigint, n bigint, held binary").repartitionById(tasks, F.col("task").cast("int"))
    return sent.mapInArrow(below, f"node bigint, {', '.join(f'{c} binary' for c in _PACKED)}")


def grown(rows: DataFrame, n: int, positives: int, features: int, trees: int, deepest: int, least: int, seed: int, local_rows: int | None = None) -> Nodes:
    """All trees; the first ``trees`` nodes are their roots."""
    local_rows = local_rows or LOCAL_ROWS
    k = math.ceil(math.sqrt(features))
    top = Nodes(np.full(trees, n), np.full(trees, positives))  # their bags' own sums are not known yet
    while True:
        leaves = top.impure(np.flatnonzero(top.left < 0), least, deepest)
        big = leaves[(top.n[leaves] > local_rows) & (top.gain[leaves] >= 0)]
        if not len(big):
            break
        was = len(top.left)
        _split_level(rows, top, big, trees, k, features, least, seed)
        top.gain[big[top.left[big] < 0]] = -1  # tried: no cut gains
        if was == len(top.left):
            break
    small = leaves[(top.n[leaves] <= local_rows) & (top.gain[leaves] >= 0)]
    if not len(small):
        return top
    parts = {c: [getattr(top, c).copy()] for c in _PACKED}  # later trees still walk the top
    at, of = len(top.n), _tree_of(top, trees)[small]
    step = max(SENT_TREES, SENT_ROWS // max(1, n))
    for first in range(0, trees, step):
        some = small[(of >= first) & (of < first + step)]
        if not len(some):
            continue
        tasks = min(len(some), max(4 * rows.sparkSession.sparkContext.defaultParallelism, int(top.n[some].sum()) // TASK_ROWS))
        sent = range(first, min(first + step, trees))
        below = materialize(_subtrees(rows, top, some, sent, k, features, deepest, least, seed, tasks), "forest-subtrees")
        for r in below.toPandas().sort_values("node").itertuples(index=False):
            t = {c: np.frombuffer(getattr(r, c), d) for c, d in _PACKED.items()}
            t["left"] = np.where(t["left"] >= 0, t["left"].astype(np.int64) + at - 1, -1)
            for c in parts:
                parts[c][0][r.node] = t[c][0]
                parts[c].append(t[c][1:])
            at += len(t["left"]) - 1
    for c, v in parts.items():
        setattr(top, c, np.concatenate(v))
    return top


def merged(t: Nodes, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge sibling leaves of equal prediction, from the deepest; (tree, node) of those left, parents first."""
    levels, at, tree = [], np.arange(trees), np.arange(trees)
    while len(at):
        levels.append((tree, at))
        inner = t.left[at] >= 0
        first = t.left[at[inner]]
        at, tree = np.stack([first, first + 1], axis=1).ravel(), np.repeat(tree[inner], 2)
    says = 2 * t.p > t.n
    for _, at in reversed(levels):
        at = at[t.left[at] >= 0]
        a = t.left[at]
        t.left[at[(t.left[a] < 0) & (t.left[a + 1] < 0) & (says[a] == says[a + 1])]] = -1
    kept, at, tree = [], np.arange(trees), np.arange(trees)
    while len(at):
        kept.append((tree, at))
        inner = t.left[at] >= 0
        first = t.left[at[inner]]
        at, tree = np.stack([first, first + 1], axis=1).ravel(), np.repeat(tree[inner], 2)
    tree, at = (np.concatenate(v) for v in zip(*kept))
    order = np.argsort(tree, kind="stable")
    return tree[order], at[order]


def cut_table(cuts: list[np.ndarray]) -> np.ndarray:
    table = np.full((len(cuts), BINS), np.inf)
    for i, c in enumerate(cuts):
        table[i, : len(c)] = c
    return table


def node_rows(t: Nodes, trees: int, cuts: list[np.ndarray]) -> pa.Table:
    """The trees in the columns of Spark's saved ensembles."""
    tree, at = merged(t, trees)
    of = np.zeros(len(t.n), np.int64)
    of[at] = np.arange(len(at)) - np.searchsorted(tree, tree)
    left, n, p = t.left[at], t.n[at], t.p[at]
    inner = left >= 0
    table = cut_table(cuts)
    f, q = t.feature[at], p / np.maximum(n, 1)
    arrays = lambda v, step: pa.ListArray.from_arrays(pa.array(step), pa.array(v))
    split = pa.StructArray.from_arrays(
        [pa.array(np.where(inner, f, -1).astype(np.int32)),
         arrays(table[f, t.cut[at]][inner], np.r_[0, np.cumsum(inner)].astype(np.int32)), pa.array(np.full(len(at), -1, np.int32))],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    child = lambda d: pa.array(np.where(inner, of[left + d], -1).astype(np.int32))
    node = pa.StructArray.from_arrays(
        [pa.array(of[at].astype(np.int32)), pa.array((2 * p > n).astype(float)), pa.array(2 * q * (1 - q)),
         arrays(np.stack([n - p, p], axis=1).ravel(), np.arange(0, 2 * len(at) + 1, 2, dtype=np.int32)), pa.array(n.astype(np.int64)),
         pa.array(np.where(inner, t.gain[at], -1.0)), child(0), child(1), split],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.table({"treeID": pa.array(tree.astype(np.int32)), "nodeData": node})


class Forest(RandomForestClassificationModel):
    """A grown forest.  ``ensemble`` gives its nodes as they are; Spark's own model, many times as large in the driver's memory, is
    saved and loaded from them when it is first asked for."""

    def __init__(self, spark: SparkSession, estimator: RandomForestClassifier, nodes: Nodes, cuts: list[np.ndarray], label: str):
        super().__init__()
        self._spark, self._estimator, self._nodes, self._cuts, self._label, self._loaded = spark, estimator, nodes, cuts, label, None
        self._params = sorted((v for v in vars(self).values() if isinstance(v, Param)), key=lambda v: v.name)  # else all attributes are asked
        self._resetUid(estimator.uid)
        estimator._copyValues(self)

    @property
    def _java_obj(self):
        if self._held is not None or "_label" not in vars(self):
            return self._held
        if self._loaded is None:
            # Spark's own settings and metadata come from a fit of two rows; its nodes are replaced by those grown
            two = self._spark.createDataFrame([(Vectors.dense([float(y)] * len(self._cuts)), float(y)) for y in (0, 1)], ["features", self._label])
            path = scratch_path(self._spark, "forest")
            self._estimator.fit(two).write().overwrite().save(path)
            schema = self._spark.read.parquet(f"{path}/data").schema
            nodes = node_rows(self._nodes, self._estimator.getNumTrees(), self._cuts)
            self._spark.createDataFrame(nodes, schema).write.mode("overwrite").parquet(f"{path}/data")
            self._loaded = RandomForestClassificationModel.load(path)
        return self._loaded._java_obj

    @_java_obj.setter
    def _java_obj(self, value):
        self._held = value

    def __del__(self):
        if vars(self).get("_held") is not None:
            super().__del__()

    def ensemble(self):
        """The nodes as a ``trees.Ensemble``."""
        from panelcast.operators.trees import Ensemble

        t, trees = self._nodes, self._estimator.getNumTrees()
        tree, at = merged(t, trees)
        of = np.zeros(len(t.n), np.int64)
        of[at] = np.arange(len(at))
        inner, root = t.left[at] >= 0, np.searchsorted(tree, np.arange(trees))
        table = cut_table(self._cuts)
        feature = np.where(inner, t.feature[at], 0)
        side = lambda d: np.where(inner, of[t.left[at] + d], -1)
        return Ensemble(False, root, np.full(trees, 1 / trees), side(0), side(1), feature, np.where(inner, table[feature, t.cut[at]], 0.0),
                        t.p[at] / np.maximum(t.n[at], 1), t.n[at].astype(np.int64))


def prepared(df: DataFrame, features: Sequence[str], label: str, n: int, seed: int) -> tuple[list[np.ndarray], DataFrame]:
    """The cuts and the written bins, the same for every fit of these rows with this seed."""
    cols = [F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]
    share = min(1.0, CUT_ROWS / n)
    cuts = cuts_of((df if share == 1 else df.sample(share, seed)).select(*cols).toPandas().to_numpy(float))
    return cuts, binned(df, features, label, cuts)


def fit(df: DataFrame, features: Sequence[str], label: str, estimator: RandomForestClassifier, n: int, positives: int,
        local_rows: int | None = None, ready: tuple | None = None) -> Forest:
    """The forest that ``estimator`` describes of ``n`` rows with labels 0 and 1, ``positives`` of them 1; ``ready`` is what
    ``prepared`` gave of them."""
    spark = df.sparkSession
    importable_on_workers(spark)
    features, trees, seed = list(features), estimator.getNumTrees(), estimator.getSeed()
    cuts, rows = ready or prepared(df, features, label, n, seed)
    t = grown(rows, n, positives, len(features), trees, estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), seed, local_rows)
    return Forest(spark, estimator, t, cuts, label)
