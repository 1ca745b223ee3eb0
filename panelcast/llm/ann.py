"""Approximate nearest neighbours with shifted space-filling curves.

Vectors are projected to a few dimensions, shifted and laid on a Hilbert curve; several
curves with their own random projection and shift give several orders.  In each order
Spark range-partitions and sorts all vectors, and every vector gets its place.  A query's
window are the vectors at most ``window`` places before and behind it; windows lie over
blocks of consecutive places, so a query goes to the few blocks that its window touches,
meets them there, and the nearest of all blocks and curves are merged and ranked by the
exact distance.

Equal vectors are indexed once, with the smallest of their ids (as many as a result can
show), so any number of copies of a vector takes one place.

On vectors without any structure (all pairs about equally far), neighbours in the curve
are hardly nearer than others, and only windows in proportion to the number of vectors
keep the recall; ``window`` is therefore a share of all vectors.  ``recall`` measures it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import bounded_batches, looked_up, map_batches, pack_scratch

#: Curves, projected dimensions, bits a dimension; share of all vectors before and behind a query; rows of a block.
CURVES, DIMS, BITS, WINDOW, BLOCK = 20, 12, 4, 0.04, 2048
#: Places before and behind a query that are always looked at.
LEAST = 64
#: Vectors that the projections' ranges are fitted on.
SAMPLE = 4096


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer cells (rows; ``bits`` bits in each column), by exchanging and
    inverting the lower bits of each axis from the top bit down, then Gray decoding."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            on = (x[i] >> b) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


@dataclass
class Curves:
    """Projections of all curves: cells are ``(x - mean) @ axes * scale + shift``."""

    axes: list[np.ndarray]
    scale: list[np.ndarray]
    shift: list[np.ndarray]
    bits: int

    def keys(self, x: np.ndarray, curve: int) -> np.ndarray:
        top = (1 << self.bits) - 1
        y = x @ self.axes[curve] * self.scale[curve] + self.shift[curve]
        return hilbert_keys(np.clip(np.floor(y), 0, top), self.bits)


def fit_curves(sample: np.ndarray, curves: int = CURVES, dims: int = DIMS, bits: int = BITS, seed: int = 7) -> Curves:
    """Random orthonormal projections, stretched over the sample's range and shifted by up to a third of the cube."""
    rng = np.random.default_rng(seed)
    d = sample.shape[1]
    dims = min(dims, d, 62 // bits)
    axes, scales, shifts = [], [], []
    for _ in range(curves):
        a = np.linalg.qr(rng.normal(size=(d, d)))[0][:, :dims]
        y = sample @ a
        low, high = y.min(axis=0), y.max(axis=0)
        scale = (1 << bits) / np.maximum(high - low, 1e-12) / 1.5
        axes.append(a), scales.append(scale), shifts.append(rng.random(dims) / 3 * (1 << bits) - low * scale)
    return Curves(axes, scales, shifts, bits)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` (doubles) of the rows that take part: an id, and a vector that is neither null nor empty nor zero,
    has only finite components, and has the length that most such vectors have."""
    v = F.col(vec_col).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), v.alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", finite) & F.exists("vec", lambda x: x != 0.0))
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (size["n"] if size else 0))


def neighbours(df: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", curves: int = CURVES,
               dims: int = DIMS, bits: int = BITS, window: float = WINDOW, block: int = BLOCK) -> DataFrame:
    """The ``k`` nearest found of every row for which ``is_query`` (a column expression over ``id_col``) holds,
    by Euclidean distance among all other rows.

    Returns ``query_id, rank`` (from 1), ``vec_id, score`` (the distance in double precision), nearest first,
    ties to the smaller id; fewer rows where there are fewer candidates.  Rows with a null id, or a vector that
    is null, empty, zero, of another length than most, or with null or non-finite components take no part.  A
    row with the query's own id is never its neighbour; a repeated id counts once, at its nearest vector.
    Further columns are not read; an empty table gives an empty result.
    """
    spark = df.sparkSession
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    rows = usable(df.withColumn(id_col, F.col(id_col).cast("bigint")), id_col, vec_col).withColumn("vk", F.md5(F.col("vec").cast("string")))
    asked = rows.withColumnRenamed("id", id_col).where(is_query).select(F.col(id_col).alias("query_id"), "vk").distinct()
    # the k + 1 smallest ids of each distinct vector; Spark limits each group before it shuffles
    nth = F.row_number().over(Window.partitionBy("vk").orderBy("id"))
    few = rows.withColumn("_nth", nth).where(F.col("_nth") <= k + 1)
    points = few.groupBy("vk").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec"))
    q = asked.groupBy("vk").agg(F.count(F.lit(1)).alias("rows"))
    points = pack_scratch(points.join(q, "vk", "left").select("vk", "ids", "vec", F.col("rows").isNotNull().alias("asked")), "ann-points")
    n = points.count()
    if n == 0:
        return spark.createDataFrame([], empty)
    sample = np.array([r[0] for r in points.orderBy("vk").limit(SAMPLE).select("vec").collect()])
    model = spark.sparkContext.broadcast(fit_curves(sample, curves, dims, bits))
    placed, base = _places(points, model, curves)
    reach = max(LEAST, int(np.ceil(window * n)) + k)
    found = _windows(placed, base, min(block, reach), reach, k)
    nearest = F.row_number().over(Window.partitionBy("vk").orderBy("score", "id"))
    best = (found.groupBy("vk", "id").agg(F.min("score").alias("score")).withColumn("_nth", nearest).where(F.col("_nth") <= k + 1)
            .groupBy("vk").agg(F.array_sort(F.collect_list(F.struct("score", "id"))).alias("near")))
    lists = pack_scratch(best.join(q, "vk"), "ann-found")
    each = looked_up(asked, lists, "vk", "rows", "inner")
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    return each.select("query_id", F.posexplode(others).alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))


def _places(points: DataFrame, model, curves: int):
    """All curves' orders, written once: ``curve, part, pos, vk, ids, vec, asked``, and the place in its curve at
    which each partition of the order begins."""
    from pyspark import TaskContext

    def keyed(batch):
        x = np.array(batch.column(2).to_pylist())
        for c in range(curves):
            yield {"curve": np.full(len(x), c, np.int32), "key": model.value.keys(x, c), "vk": batch.column(0), "ids": batch.column(1),
                   "vec": pa.array([v.tobytes() for v in x], pa.binary()), "asked": batch.column(3)}

    rows = map_batches(points, keyed, "curve int, key bigint, vk string, ids array<bigint>, vec binary, asked boolean")
    order = rows.repartitionByRange("curve", "key", "vk").sortWithinPartitions("curve", "key", "vk").drop("key")

    def number(batches):
        part, pos = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(np.arange(pos, pos + b.num_rows))],
                names=[*b.schema.names, "part", "pos"])
            pos += b.num_rows

    bounded_batches(points.sparkSession)
    placed = pack_scratch(order.mapInArrow(number, "curve int, vk string, ids array<bigint>, vec binary, asked boolean, part int, pos bigint"), "ann-order")
    # a row for each partition and curve in it
    counts = sorted((r["curve"], r["part"], r["low"], r["n"]) for r in placed.groupBy("curve", "part").agg(
        F.min("pos").alias("low"), F.count(F.lit(1)).alias("n")).collect())
    base, at, last = {}, 0, None
    for curve, part, low, n in counts:
        at = 0 if curve != last else at
        base[curve, part], at, last = at - low, at + n, curve
    return placed, points.sparkSession.sparkContext.broadcast(base)


def _windows(placed: DataFrame, base, block: int, reach: int, k: int) -> DataFrame:
    """The ``k + 1`` nearest (``vk, id, score``) of each query in each block that its window touches."""

    def with_place(batch):
        curve, part = batch.column(0).to_pylist(), batch.column(5).to_pylist()
        place = np.array([base.value[c, p] for c, p in zip(curve, part)], np.int64) + batch.column(6).to_numpy()
        yield {"curve": batch.column(0), "place": place, "vk": batch.column(1), "ids": batch.column(2), "vec": batch.column(3), "asked": batch.column(4)}

    rows = map_batches(placed, with_place, "curve int, place bigint, vk string, ids array<bigint>, vec binary, asked boolean")
    targets = rows.select("*", F.floor(F.col("place") / block).alias("block"), F.lit(True).alias("target"))
    asked = rows.where("asked").select(
        "*", F.explode(F.sequence(F.floor(F.greatest(F.col("place") - reach, F.lit(0)) / block), F.floor((F.col("place") + reach) / block))).alias("block"),
        F.lit(False).alias("target")).withColumn("ids", F.lit(None).cast("array<bigint>"))
    cols = ["curve", "block", "target", "place", "vk", "ids", "vec"]
    dealt = asked.select(cols).unionByName(targets.select(cols)).repartition(F.col("curve"), F.col("block")).sortWithinPartitions("curve", "block", "target")

    def run(batches):
        key, queries, best = None, [], {}
        for b in batches:
            curve, blk, target = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cut = np.flatnonzero(np.r_[True, (curve[1:] != curve[:-1]) | (blk[1:] != blk[:-1]) | (target[1:] != target[:-1])])
            for i, j in zip(cut, np.r_[cut[1:], len(curve)]):
                if (curve[i], blk[i]) != key:
                    yield from emit(queries, best)
                    key, queries, best = (curve[i], blk[i]), [], {}
                part = b.slice(i, j - i)
                place = part.column(3).to_numpy()
                vecs = np.array([np.frombuffer(v) for v in part.column(6).to_pylist()])
                if not target[i]:
                    queries += list(zip(place.tolist(), part.column(4).to_pylist(), vecs))
                    continue
                ids = part.column(5).to_pylist()
                for at, vk, v in queries:
                    near = np.flatnonzero(np.abs(place - at) <= reach)
                    if not len(near):
                        continue
                    dist = np.sqrt(np.square(vecs[near] - v).sum(axis=1))
                    top = near[dist <= np.partition(dist, k)[k]] if len(near) > k + 1 else near
                    d = dict(zip(near.tolist(), dist.tolist()))
                    new = [(d[t], x) for t in top.tolist() for x in ids[t]]
                    best[vk] = sorted(best.get(vk, []) + new)[: k + 1]
        yield from emit(queries, best)

    def emit(queries, best):
        rows = [(vk, x, s) for vk, found in best.items() for s, x in found]
        for i in range(0, len(rows), 50_000):
            part = rows[i : i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.string()), pa.array([r[1] for r in part], pa.int64()), pa.array([r[2] for r in part], pa.float64())],
                names=["vk", "id", "score"])

    return dealt.mapInArrow(run, "vk string, id bigint, score double")


def brute_force(df: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", most_queries: int = 2000) -> DataFrame:
    """The exact answer for up to ``most_queries`` queries (the smallest ids): they are sent to all rows, which keep the
    nearest of each batch.  For measuring the recall."""
    spark = df.sparkSession
    rows = usable(df.withColumn(id_col, F.col(id_col).cast("bigint")), id_col, vec_col)
    q = rows.withColumnRenamed("id", id_col).where(is_query).orderBy(id_col).limit(most_queries).collect()
    shared = spark.sparkContext.broadcast(([r[id_col] for r in q], np.array([r["vec"] for r in q])))

    def run(batch):
        ids, x = batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist())
        for qid, v in zip(*shared.value):
            d = np.sqrt(np.square(x - v).sum(axis=1))
            use = np.lexsort((ids, d))
            use = use[ids[use] != qid][:k]
            yield {"query_id": [qid] * len(use), "vec_id": ids[use], "score": d[use]}

    found = map_batches(rows.select("id", "vec"), run, "query_id bigint, vec_id bigint, score double").groupBy("query_id", "vec_id").agg(
        F.min("score").alias("score"))
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", nth).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact answer's rows that were found (an equally near neighbour counts as well)."""
    worst = exact.groupBy("query_id").agg(F.max("score").alias("_far"), F.count(F.lit(1)).alias("_n"))
    hits = found.join(worst, "query_id").where(F.col("score") <= F.col("_far")).count()
    return hits / max(1, exact.count())
