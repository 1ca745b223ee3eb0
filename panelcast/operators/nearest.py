"""Exact nearest neighbours of every row by a pivot table, without comparing all pairs.

Every row goes to the cell of its nearest pivot.  Cells are range-partitioned by the distance
to their pivot, and the rows of a cell in a partition, a ring around a pivot with a known smallest
and largest distance, are cut at medians into blocks, so no cell, however large, lies in one task.
Inside its block a row finds a first k-th distance; by the triangle inequality a block can only
hold a nearer row if its ring, its side of the plane between the two pivots, and its box on the few
axes of the largest spread come within that distance.  Rows meet only such blocks (one shuffle by
block a round): first the few that promise most, then, with the distance those give, all that are
left.  A row takes its k-th distance along, and only what is not farther is written.

Equal rows are searched once, with the smallest of their numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.session import importable_on_workers, materialize

#: Pivots, rows they are chosen from, least rows of a block, blocks at most (their bounds are sent to every task).
PIVOTS, SAMPLE, BLOCK, BLOCKS = 48, 4096, 1024, 1 << 16
#: Blocks besides its own that a row meets in the first round.
FIRST = 4
#: Axes of the blocks' boxes.
AXES = 8
#: Share of a distance that rounding may hide.
SLACK = 1e-9
ROWS_PER_STEP = 256


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of a sample far from one another: each next one is the farthest from those before."""
    at = [int(((sample - sample.mean(axis=0)) ** 2).sum(axis=1).argmax())]
    gap = ((sample - sample[at[0]]) ** 2).sum(axis=1)
    while len(at) < count and gap.max() > 0:
        at.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[at[-1]]) ** 2).sum(axis=1))
    return sample[at]


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``x`` to all rows of ``y``; those of a pair never depend on other rows."""
    out = np.empty((len(x), len(y)))
    for i in range(0, len(x), 64):
        out[i : i + 64] = np.sqrt(((x[i : i + 64, None, :] - y[None, :, :]) ** 2).sum(axis=2))
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def nearest_among(x, i, y, j, k, reach=None):
    """(number in ``i``, number in ``j``, distance) of the at most ``k`` rows of ``y`` nearest to each row of ``x`` but itself,
    ties to the smaller number, none farther than the row's ``reach``.  A cheap matrix product finds the candidates, their
    distances are taken anew."""
    out = []
    middle = y.mean(axis=0)
    yc = y - middle
    sq = (yc * yc).sum(axis=1)
    for s in range(0, len(x), ROWS_PER_STEP):
        q, n = x[s : s + ROWS_PER_STEP], i[s : s + ROWS_PER_STEP]
        qc = q - middle
        rough = sq + (qc * qc).sum(axis=1)[:, None] - 2.0 * qc @ yc.T
        rough[j[None, :] == n[:, None]] = np.inf
        most = min(k, len(y))
        kth = np.partition(rough, most - 1, axis=1)[:, most - 1]
        # everything that rounding could bring into the first k
        room = 1e-7 * (np.where(np.isfinite(kth), kth, 0) + sq.max() + (qc * qc).sum(axis=1))
        r, c = np.nonzero((rough <= (kth + room)[:, None]) & np.isfinite(rough))
        d = np.sqrt(((q[r] - y[c]) ** 2).sum(axis=1))
        order = np.lexsort((j[c], d, r))
        r, c, d = r[order], c[order], d[order]
        begin = np.searchsorted(r, np.arange(len(q)))
        keep = np.arange(len(r)) - begin[r] < k
        if reach is not None:
            keep &= d <= reach[s + r]
        out.append((n[r[keep]], j[c[keep]], d[keep]))
    return tuple(np.concatenate(p) for p in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


class Bounds:
    """Pivots and the blocks' bounds: for a row the least distance at which each block can hold a row."""

    def __init__(self, pivots, cell, low, high, boxes=()):
        self.pivots, self.cell, self.low, self.high = pivots, cell, low, high
        self.boxes = list(boxes)  # (axis, its least value in each block, its largest)
        self.between = distances(pivots, pivots)

    def least(self, x: np.ndarray) -> np.ndarray:
        d = distances(x, self.pivots)
        own = d.argmin(axis=1)
        near = d.min(axis=1)
        gap = self.between[own]
        # a row nearer to pivot p than to the own one lies behind the plane between the two
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(gap > 0, (d * d - (near * near)[:, None]) / (2 * gap), 0.0)
        away = d[:, self.cell]
        least = np.maximum(np.maximum(away - self.high, self.low - away), plane[:, self.cell])
        box = np.zeros(least.shape)
        for axis, low, high in self.boxes:
            v = x[:, axis, None]
            gap = np.maximum(np.maximum(low - v, v - high), 0.0)
            box += gap * gap
        return np.maximum(least, np.sqrt(box))


_FOUND = "i bigint, j bigint, d double, compared bigint"


def _found(i, j, d, compared):
    extra = np.zeros(len(i), np.int64)
    if len(extra):
        extra[0] = compared  # the comparisons behind these rows, counted once
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(i, np.int64)), pa.array(np.asarray(j, np.int64)), pa.array(np.asarray(d, float)), pa.array(extra)],
                                      names=["i", "j", "d", "compared"])


def _halves(x: np.ndarray, parts: int) -> list[np.ndarray]:
    """Row numbers in ``parts`` equal parts, cut again and again across the axis of the largest range."""
    out, todo = [], [(np.arange(len(x)), parts)]
    while todo:
        at, n = todo.pop()
        if n == 1:
            out.append(at)
            continue
        axis = np.ptp(x[at], axis=0).argmax()
        at = at[np.argsort(x[at, axis], kind="stable")]
        left = len(at) * (n // 2) // n
        todo += [(at[:left], n // 2), (at[left:], n - n // 2)]
    return out


def _blocked(points: DataFrame, pivots: np.ndarray, size: int, n: int, axes: Sequence[int]) -> DataFrame:
    """``id, x, cell, away, block``: rows of a cell whose distances to its pivot are alike, cut into blocks."""

    def placed(batches):
        for b in batches:
            x = _vectors(b.column(1))
            if len(x):
                d = distances(x, pivots)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(d.argmin(axis=1).astype(np.int32)), pa.array(d.min(axis=1))],
                                                 names=["id", "x", "cell", "away"])

    def cut(batches):
        from pyspark import TaskContext

        part, at, cell, held = TaskContext.get().partitionId(), -1, None, []

        def out():
            nonlocal at
            rows = pa.concat_batches(held)
            held.clear()
            for r in _halves(_vectors(rows.column(1))[:, axes], -(-rows.num_rows // size)):
                at += 1
                yield pa.RecordBatch.from_arrays([*rows.take(pa.array(r)).columns, pa.array(np.full(len(r), part * (1 << 32) + at))],
                                                 names=["id", "x", "cell", "away", "block"])

        for b in batches:
            cells = b.column(2).to_numpy()
            first = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1).tolist(), len(cells)]
            for i, j in zip(first, first[1:]):
                if i == j:
                    continue
                if held and (cells[i] != cell or sum(h.num_rows for h in held) >= 32 * size):
                    yield from out()
                cell = cells[i]
                held.append(b.slice(i, j - i))
        if held:
            yield from out()

    cells = points.mapInArrow(placed, "id bigint, x array<double>, cell int, away double")
    ranged = cells.repartitionByRange(max(1, -(-n // (16 * size))), "cell", "away").sortWithinPartitions("cell", "away", "id")
    return ranged.mapInArrow(cut, "id bigint, x array<double>, cell int, away double, block bigint")


def _meet(blocks: DataFrame, queries: DataFrame | None, k: int) -> DataFrame:
    """Rows against their block's rows: ``queries`` (``id, x, block, reach``: nothing farther is wanted), or without them every
    row against its own block."""
    rows = blocks.select("block", F.lit(0).alias("asks"), "id", "x", F.lit(None).cast("double").alias("reach"))
    if queries is not None:
        rows = rows.unionByName(queries.select("block", F.lit(1).alias("asks"), "id", "x", "reach"))
    alone = queries is None

    def run(batches):
        block, ids, xs, home, uncounted = None, [], [], None, 0

        def settled():
            return np.concatenate(ids), np.concatenate(xs)

        def own():
            i, x = settled()
            if len(i) > 1:
                yield _found(*nearest_among(x, i, x, i, k), len(i) * len(i))

        for b in batches:
            at, asks, num, x = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(), _vectors(b.column(3))
            reach = b.column(4).to_numpy(zero_copy_only=False).astype(float)
            cut = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (asks[1:] != asks[:-1])]) if len(at) else []
            for s, t in zip(cut, [*cut[1:], len(at)]):
                if at[s] != block:
                    if alone and ids:
                        yield from own()
                    block, ids, xs, home = at[s], [], [], None
                if not asks[s]:
                    ids.append(num[s:t]), xs.append(x[s:t])
                elif ids:
                    home = home or settled()
                    near = nearest_among(x[s:t], num[s:t], home[1], home[0], k, np.where(np.isnan(reach[s:t]), np.inf, reach[s:t]))
                    uncounted += (t - s) * len(home[0])
                    if len(near[0]):
                        yield _found(*near, uncounted)
                        uncounted = 0
        if alone and ids:
            yield from own()
        if uncounted:  # nothing near enough: a row for the comparisons alone
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([None], pa.float64()), pa.array([uncounted])],
                                             names=["i", "j", "d", "compared"])

    # home rows first; a block's rows are few, its askers stream
    return rows.repartition("block").sortWithinPartitions("block", "asks").mapInArrow(run, _FOUND)


def _reach(found: DataFrame, k: int) -> DataFrame:
    """``id, reach``: the k-th distance so far of every row that has k."""
    return found.where("i IS NOT NULL").groupBy(F.col("i").alias("id")).agg(F.slice(F.array_sort(F.collect_list("d")), 1, k).alias("d")).select(
        "id", F.when(F.size("d") == k, F.element_at("d", -1)).alias("reach"))


def nearest_rows(df: DataFrame, id_col: str, features: Sequence[str], k: int, pivots: int = PIVOTS, block: int = BLOCK) -> tuple[DataFrame, int]:
    """``id_col, near``: the numbers of the ``k`` nearest other rows of every row (Euclidean, ties to the smaller number),
    nearest first, exactly; and the distances computed for it.

    ``id_col`` holds distinct non-null longs and ``features`` finite doubles.  Rows without another row are left out.  Jobs run when this is called;
    every step's rows are written to the shared scratch folder.  The pivots are chosen from a bounded sample, which
    only the amount of work depends on; the blocks' bounds (at most ``BLOCKS`` and one a cell and partition) go to the tasks.
    """
    spark = df.sparkSession
    importable_on_workers(spark)
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.array(*[F.col(f).cast("double") + 0.0 for f in features]).alias("x"))
    # of equal rows the k + 1 smallest numbers are enough for any result; they are merged before the shuffle as well
    few = F.slice(F.array_sort(F.collect_list("id")), 1, k + 1)
    small = rows.groupBy("x", F.pmod(F.xxhash64("id"), F.lit(64)).alias("s")).agg(few.alias("ids"))
    points = materialize(small.groupBy("x").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))
                         .select(F.element_at("ids", 1).alias("id"), "x", "ids"), "nearest-points")
    n = points.count()
    pairs, compared, size = None, 0, max(block, -(-n // BLOCKS))
    if 1 < n <= size:  # one block holds all rows
        found = materialize(_meet(points.withColumn("block", F.lit(0).cast("bigint")), None, k), "nearest-found")
    elif n > size:
        sample = np.array([r[0] for r in points.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("x").collect()], float)
        chosen = choose_pivots(sample, pivots)
        axes = np.sort(np.argsort(-sample.var(axis=0), kind="stable")[:AXES])
        blocks = materialize(_blocked(points.select("id", "x"), chosen, size, n, axes), "nearest-blocks")
        box = [f(F.element_at("x", int(a) + 1)).alias(f"{c}{a}") for a in axes for c, f in (("low", F.min), ("high", F.max))]
        edge = blocks.groupBy("block").agg(F.first("cell").alias("cell"), F.min("away").alias("low"), F.max("away").alias("high"), *box).toPandas()
        bounds = Bounds(chosen, edge["cell"].to_numpy(), edge["low"].to_numpy(), edge["high"].to_numpy(),
                        [(a, edge[f"low{a}"].to_numpy(), edge[f"high{a}"].to_numpy()) for a in axes])
        shared = spark.sparkContext.broadcast((bounds, edge["block"].to_numpy()))
        found = materialize(_meet(blocks, None, k), "nearest-found")
        for first_round in (True, False):

            def targets(batches, first_round=first_round):
                limits, names = shared.value
                for b in batches:
                    x, reach, own = _vectors(b.column(1)), b.column(3).to_numpy(zero_copy_only=False), b.column(2).to_numpy()
                    reach0 = b.column(4).to_numpy(zero_copy_only=False)
                    for s in range(0, len(x), ROWS_PER_STEP):
                        least = limits.least(x[s : s + ROWS_PER_STEP])
                        least[names[None, :] == own[s : s + ROWS_PER_STEP, None]] = np.inf
                        r0 = np.where(np.isnan(reach0[s : s + ROWS_PER_STEP]), np.inf, reach0[s : s + ROWS_PER_STEP])[:, None]
                        now = np.where(np.isnan(reach[s : s + ROWS_PER_STEP]), np.inf, reach[s : s + ROWS_PER_STEP])[:, None]
                        open_ = (least * (1 - SLACK) <= r0) & np.isfinite(least)
                        # the first round's blocks: the most promising ones under the first reach, the same in both rounds
                        promise, few = np.where(open_, least, np.inf), min(FIRST, least.shape[1])
                        early = np.zeros(open_.shape, bool)
                        np.put_along_axis(early, np.argpartition(promise, few - 1, axis=1)[:, :few], True, axis=1)
                        q, c = np.nonzero(open_ & (early == first_round) & (least * (1 - SLACK) <= now))
                        for a in range(0, len(q), 4096):
                            at = pa.array(q[a : a + 4096] + s)
                            yield pa.RecordBatch.from_arrays([pa.array(names[c[a : a + 4096]]), *(b.column(i).take(at) for i in (0, 1, 3))],
                                                             names=["block", "id", "x", "reach"])

            if first_round:
                first = materialize(_reach(found, k), "nearest-reach")
                asked = blocks.join(first.withColumn("reach0", F.col("reach")), "id", "left")
            elif len(edge) <= FIRST + 1:
                break
            else:
                asked = blocks.join(_reach(found, k), "id", "left").join(first.withColumnRenamed("reach", "reach0"), "id", "left")
            asks = asked.select("id", "x", "block", "reach", "reach0").mapInArrow(targets, "block bigint, id bigint, x array<double>, reach double")
            found = found.unionByName(materialize(_meet(blocks, asks, k), "nearest-found"))
    if n > 1:
        compared = found.agg(F.sum("compared")).first()[0] or 0
        nearest = found.where("i IS NOT NULL").groupBy("i").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "j"))), 1, k).alias("near"))
        pairs = nearest.select(F.col("i").alias("id"), F.explode("near").alias("p")).select("id", F.col("p.d").alias("d"), F.col("p.j").alias("j"))
        pairs = pairs.join(points.select(F.col("id").alias("j"), "ids"), "j").select("id", "d", F.explode("ids").alias("near"))
    own = points.select("id", F.lit(0.0).alias("d"), F.explode("ids").alias("near"))
    both = own if pairs is None else own.unionByName(pairs)
    # every distinct row's list of k + 1, from which each of its copies leaves itself out
    lists = both.groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "near"))), 1, k + 1).alias("near")).select(
        "id", F.expr("transform(near, p -> p.near)").alias("near"))
    per_x = points.select("id", "x").join(lists, "id").select("x", "near")
    out = rows.join(per_x, "x").select(F.col("id").alias(id_col), F.slice(F.filter("near", lambda v: v != F.col("id")), 1, k).alias("near"))
    return out.where(F.size("near") > 0), int(compared)
