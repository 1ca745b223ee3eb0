"""Gradient boosting of shallow trees: sums by node, feature and bin, exact in whole numbers, from blocks of binned rows.

``GBTClassifier`` updates three statistics row by row for all features at every level of every round.  Here rows lie in blocks, a
byte a row and feature, and a level is a pass of ``bincount`` over them.  Only the smaller child of every split is summed; its
sibling is what is left of the parent.  Residuals are rounded to multiples of ``1 / SCALE``, so sums do not depend on the
partitions.  Blocks are kept on the executors with each row's margin, which moves on every ``HELD`` rounds.

The model is that of ``GBTClassifier``: logistic loss on labels -1 and 1, the first tree of weight 1, the others of
``stepSize``, cuts of at most ``BINS`` bins from a sample of rows, the gain in variance, ``maxDepth`` and ``subsamplingRate``.  It
is saved in Spark's model format and loaded as a ``GBTClassificationModel``; sums of squares and impurities of nodes are not kept
(not a number there).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.forest import BINS, CUT_ROWS, Nodes
from panelcast.session import importable_on_workers, materialize, scratch_path

#: Parts of a residual's unit that sums are taken in.
SCALE = float(1 << 30)
#: Rows of a block at most, and of a partition.
BLOCK_ROWS, TASK_ROWS = 1 << 14, 500_000
#: Rounds after which the margins kept with the rows move on.
HELD = 5
#: Bytes of sums up to which all partitions' sums go to the driver.
DIRECT_BYTES = 32 << 20
#: Deepest trees: every node's sums are at the driver for its level.
DEEPEST = 10


def _block(first: int, x: np.ndarray, y: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([first]), *(pa.array([v.tobytes()], pa.binary()) for v in (x, y, f))], names=["first", "x", "y", "f"])


def _opened(row, n_features: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(number of the first row, bins by feature and row, labels -1 and 1, margins) of a block."""
    return row[0], np.frombuffer(row[1], np.uint8).reshape(n_features, -1), np.frombuffer(row[2], np.int8), np.frombuffer(row[3], np.float64)


def cuts_of(sample: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Cuts of each column, where ``GBTClassifier`` puts them: between all its values, or a ``bins``-th of the rows apart.  Cuts that
    a frequent value leaves over go between the values above it."""
    out = []
    for x in sample.T:
        v, n = np.unique(x, return_counts=True)
        middle = (v[:-1] + v[1:]) / 2
        if len(middle) >= bins:
            below, stride, at = np.cumsum(n).tolist(), len(x) / bins, []
            target = stride
            for i in range(len(middle)):
                if abs(below[i] - target) < abs(below[i + 1] - target):
                    at.append(i)
                    target += stride
            middle = middle[at[: bins - 1]]
        out.append(middle)
    return out


def blocks(df: DataFrame, features: Sequence[str], label: str, cuts: list[np.ndarray], n: int) -> DataFrame:
    """``first, x, y, f``: blocks of rows with their bins, labels -1 and 1 and margins of 0, written once."""
    parts = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
    size = int(min(BLOCK_ROWS, max(256, n // (8 * parts))))
    src = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("double").alias("y"))
    names = list(features)

    def run(batches):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        held, rows = [], 0

        def out():
            nonlocal first
            x, y = (np.concatenate(v, axis=-1) for v in zip(*held))
            for i in range(0, len(y), size):
                yield _block(first + i, np.ascontiguousarray(x[:, i : i + size]), y[i : i + size], np.zeros(len(y[i : i + size])))
            first += len(y)

        for b in batches:
            x = np.empty((len(cuts), b.num_rows), np.uint8)
            for i, c in enumerate(cuts):
                v = b.column(i).to_numpy(zero_copy_only=False).astype(float)
                if np.isnan(v).any():
                    raise ValueError(f"null or NaN in {names[i]}")
                x[i] = np.searchsorted(c, v)
            held.append((x, (2 * b.column(b.num_columns - 1).to_numpy(zero_copy_only=False) - 1).astype(np.int8)))
            rows += b.num_rows
            if rows >= size:
                yield from out()
                held, rows = [], 0
        if rows:
            yield from out()

    return materialize(src.mapInArrow(run, "first bigint, x binary, y binary, f binary").repartition(parts), "boosting-rows")


def residuals(y: np.ndarray, f: np.ndarray, first_tree: bool) -> np.ndarray:
    """What the next tree is fitted to, in whole parts of ``1 / SCALE``: the labels, then the negative gradients of the loss."""
    with np.errstate(over="ignore"):  # exp of a large margin: infinity, so a residual of 0
        return np.rint((y if first_tree else 4 * y / (1 + np.exp(2 * y * f))) * SCALE)


def values(t: Nodes) -> np.ndarray:
    return t.p / np.maximum(t.n, 1)


def walked(t: Nodes, x: np.ndarray) -> np.ndarray:
    """The leaf of each row.  Every cut is asked of all rows at once, which is quicker than picking those that reach it."""
    rows, inner = x.shape[1], np.flatnonzero(t.left >= 0)
    right = np.zeros((len(inner) + 1, rows), bool)  # nothing goes right in leaves, the last line
    for i, k in enumerate(inner):
        np.greater(x[t.feature[k]], int(t.cut[k]), out=right[i])
    line, child = np.full(len(t.n), len(inner) * rows), np.arange(len(t.n))
    line[inner], child[inner] = np.arange(len(inner)) * rows, t.left[inner]
    at, of, right = np.zeros(rows, np.int64), np.arange(rows), right.ravel()
    for _ in range(int(t.depth.max())):
        at = child.take(at) + right.take(line.take(at) + of)
    return at


def moved(x: np.ndarray, f: np.ndarray, trees: Sequence[tuple[Nodes, float]]) -> np.ndarray:
    """The margins after some more trees."""
    for t, weight in trees:
        f = f + weight * values(t)[walked(t, x)]
    return f


def sums(x: np.ndarray, g: np.ndarray, slot: np.ndarray, slots: int) -> np.ndarray:
    """(rows and residuals) x nodes x features x bins; ``slot`` is the node of each row, -1 outside them."""
    rows = np.flatnonzero(slot >= 0)
    if len(rows) < len(slot):
        x, g, slot = np.take(x, rows, axis=1), g[rows], slot[rows]
    at, size = slot * BINS, slots * BINS
    out = np.empty((2, len(x), size))
    for j, bins in enumerate(x):
        cell = at + bins
        out[0, j] = np.bincount(cell, minlength=size)
        out[1, j] = np.bincount(cell, g, size)
    return out.reshape(2, len(x), slots, BINS).swapaxes(1, 2)


def level_sums(rows: RDD, features: int, before: Sequence[tuple[Nodes, float]], tree: Nodes, wanted: np.ndarray, first_tree: bool, drawn) -> np.ndarray:
    """The sums of the nodes ``wanted`` over all rows."""
    slot_of = np.full(len(tree.n), -1)
    slot_of[wanted] = np.arange(len(wanted))

    def add(held):
        total = np.zeros((2, len(wanted), features, BINS), np.int64)
        for first, x, y, f in held:
            slot = slot_of[walked(tree, x)]
            if drawn is not None:
                slot = np.where(drawn(first, len(y)), slot, -1)
            here = np.flatnonzero(slot >= 0)
            if len(here) < len(slot):  # margins are moved and residuals taken for these rows only
                x, y, f, slot = np.take(x, here, axis=1), y[here], f[here], slot[here]
            total += sums(x, residuals(y, moved(x, f, before), first_tree), slot, len(wanted)).astype(np.int64)
        yield total

    found = rows.mapPartitions(add)
    # a few small arrays go to the driver as they are: adding them up in further stages takes longer
    return found.reduce(np.add) if rows.getNumPartitions() * 2 * len(wanted) * features * BINS * 8 <= DIRECT_BYTES else found.treeReduce(np.add)


def chosen(found: np.ndarray):
    """The best cut of each node: (feature, bin up to which rows go left, gain, rows and residuals on the left, of all)."""
    n, p = np.cumsum(found[0], axis=2), np.cumsum(found[1], axis=2) / SCALE
    all_n, all_p = n[:, :1, -1:], p[:, :1, -1:]
    n, p = n[..., :-1], p[..., :-1]
    part = lambda n, p: p * p / np.maximum(n, 1)
    gain = (part(n, p) + part(all_n - n, all_p - p) - part(all_n, all_p)) / np.maximum(all_n, 1)
    gain[(n < 1) | (all_n - n < 1)] = -1
    flat = gain.reshape(len(gain), -1)
    best, at = flat.argmax(axis=1), np.arange(len(flat))
    f, cut = np.divmod(best, BINS - 1)
    return f, cut, flat[at, best], n[at, f, cut], p[at, f, cut], all_n[:, 0, 0], all_p[:, 0, 0]


def grow(summed, deepest: int) -> Nodes:
    """A tree from ``summed(tree, nodes)``, the sums of some of its nodes."""
    t, active, held = Nodes(0, 0), np.zeros(1, np.int64), None
    for depth in range(deepest):
        if depth == 0:
            found = summed(t, active)
        else:
            # of two siblings the one of fewer rows is summed, the other is what is left of their parent
            pairs = children.reshape(-1, 2)
            small = np.where(t.n[pairs[:, 0]] <= t.n[pairs[:, 1]], 0, 1)
            at = np.arange(len(pairs))
            one = summed(t, pairs[at, small])
            found = np.empty((2, len(pairs), 2, *one.shape[2:]), np.int64)
            found[:, at, small] = one
            found[:, at, 1 - small] = held - one
            found = found.reshape(2, -1, *one.shape[2:])
            may = t.n[children] > 1
            active, found = children[may], found[:, may]
        if not len(active):
            break
        children = t.split(active, *chosen(found))
        held = found[:, t.left[active] >= 0]
        if not len(children):
            break
    return t


def _drawn(seed: int, tree: int, rate: float, first: int, n: int) -> np.ndarray:
    """Which of ``n`` rows from number ``first`` on a tree is fitted to."""
    from panelcast.operators.ml import _mixed

    u = (_mixed(seed, np.arange(first, first + n), np.full(1, tree), 4) >> np.uint64(11)).astype(float) / float(1 << 53)
    return u < rate


def boosted(rows: DataFrame, features: int, rounds: int, deepest: int, step: float, rate: float, seed: int) -> list[Nodes]:
    """The trees of all rounds.  Blocks are kept as the workers' own arrays: a pass converts nothing."""
    out: list[Nodes] = []
    kept = rows.rdd.map(partial(_opened, n_features=features)).persist(StorageLevel.MEMORY_AND_DISK)
    before: list[tuple[Nodes, float]] = []
    try:
        for k in range(rounds):
            drawn = partial(_drawn, seed, k, rate) if rate < 1 else None
            t = grow(lambda t, nodes: level_sums(kept, features, before, t, nodes, k == 0, drawn), deepest)  # noqa: B023
            out.append(t)
            before.append((t, step if k else 1.0))
            if len(before) == HELD and k + 1 < rounds:
                was, kept = kept, kept.map(partial(_moved_block, before)).persist(StorageLevel.MEMORY_AND_DISK)
                kept.count()
                was.unpersist()
                before = []
    finally:
        kept.unpersist()
    return out


def _moved_block(before: Sequence[tuple[Nodes, float]], block: tuple) -> tuple:
    first, x, y, f = block
    return first, x, y, moved(x, f, before)


def node_rows(grown: Sequence[Nodes], cuts: list[np.ndarray]) -> pa.Table:
    """The trees in the columns of Spark's saved ensembles."""
    size = [len(t.n) for t in grown]
    col = lambda c: np.concatenate([getattr(t, c) for t in grown])
    left, n, p, f, cut, gain = (col(c) for c in ("left", "n", "p", "feature", "cut", "gain"))
    inner, total = left >= 0, len(left)
    table = np.full((len(cuts), BINS), np.inf)
    for i, c in enumerate(cuts):
        table[i, : len(c)] = c
    unknown = np.full(total, np.nan)
    arrays = lambda v, step: pa.ListArray.from_arrays(pa.array(step.astype(np.int32)), pa.array(v))
    split = pa.StructArray.from_arrays(
        [pa.array(np.where(inner, f, -1).astype(np.int32)), arrays(table[f, cut][inner], np.r_[0, np.cumsum(inner)]), pa.array(np.full(total, -1, np.int32))],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    child = lambda d: pa.array(np.where(inner, left + d, -1).astype(np.int32))
    node = pa.StructArray.from_arrays(
        [pa.array(np.concatenate([np.arange(s) for s in size]).astype(np.int32)), pa.array(p / np.maximum(n, 1)), pa.array(unknown),
         arrays(np.stack([n, p, unknown], axis=1).ravel(), np.arange(0, 3 * total + 1, 3)), pa.array(n.astype(np.int64)),
         pa.array(np.where(inner, gain, -1.0)), child(0), child(1), split],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.table({"treeID": pa.array(np.repeat(np.arange(len(grown)), size).astype(np.int32)), "nodeData": node})


def prepared(df: DataFrame, features: Sequence[str], label: str, n: int, seed: int) -> tuple[list[np.ndarray], DataFrame]:
    """The cuts and the written blocks, the same for every fit of these rows with this seed."""
    share = min(1.0, CUT_ROWS / n)
    sample = df if share == 1 else df.sample(share, seed)
    cuts = cuts_of(sample.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]).toPandas().to_numpy(float), min(BINS, n))
    return cuts, blocks(df, features, label, cuts, n)


def fit(df: DataFrame, features: Sequence[str], label: str, estimator: GBTClassifier, n: int, ready: tuple | None = None) -> GBTClassificationModel:
    """The boosted trees that ``estimator`` describes of ``n`` rows with labels 0 and 1; ``ready`` is what ``prepared`` gave of them."""
    spark = df.sparkSession
    importable_on_workers(spark)
    features, rounds, seed = list(features), estimator.getMaxIter(), estimator.getSeed()
    cuts, rows = ready or prepared(df, features, label, n, seed)
    grown = boosted(rows, len(features), rounds, estimator.getMaxDepth(), estimator.getStepSize(), estimator.getSubsamplingRate(), seed)
    # Spark's own settings and metadata come from a fit of two rows and at most two rounds; its nodes are replaced by those grown
    two = spark.createDataFrame([(Vectors.dense([float(y)] * len(features)), float(y)) for y in (0, 1)], ["features", label])
    path = scratch_path(spark, "boosting")
    estimator.copy({estimator.maxIter: min(rounds, 2)}).fit(two).write().overwrite().save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    spark.createDataFrame(node_rows(grown, cuts), schema).write.mode("overwrite").parquet(f"{path}/data")
    trees = spark.read.parquet(f"{path}/treesMetadata")
    of = sorted(trees.collect())
    of += [(i, *of[-1][1:]) for i in range(len(of), rounds)]
    spark.createDataFrame([tuple(r) for r in of], trees.schema).write.mode("overwrite").parquet(f"{path}/treesMetadata")
    about = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    about["numTrees"] = about["paramMap"]["maxIter"] = rounds
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    return GBTClassificationModel.load(path)
