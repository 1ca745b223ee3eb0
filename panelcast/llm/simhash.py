"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints: majority bits over the XXH64 hashes of word shingles, one pass over the
texts.  Equal fingerprints collapse first, so copies never meet each other in a join.

Links between distinct fingerprints: in Gray order, all fingerprints with the same top
bits are neighbours, and those top bits are a pattern shared by the whole run.  The index
factors such shared patterns into nodes: a search adds up the differing bits on its way
down and leaves out every node at which the sum passes the maximum.  The upper levels are
Spark rows (a fingerprint goes to the nodes it can still match in), the lower levels are
built inside a task by ``GrayIndex``.  A node with too many rows is not searched as it is:
its rows go down another level, until nodes are small; a full-depth node holds one
fingerprint and only those within the maximum distance of it.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import connected_components, delete_path, looked_up, map_batches, pack_scratch, scratch_path

#: Rows of a node above which it is split into the next level.
NODE_ROWS = 1 << 15
LEVEL_BITS = 10
BLOCK = 64


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42, step: int = 1 << 16) -> bytes:
    """64-bit SimHash of a text, big-endian: ASCII letters lower-cased, words split at ASCII
    white space, a bit set if set in over half of all shingle hashes (repeats included)."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return b"\0" * 8
    if len(words) < shingle:
        return _majority([xxhash.xxh64_digest(b" ".join(words), seed)])
    digest, join = xxhash.xxh64_digest, b" ".join
    total, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for i in range(0, n, step):
        part = words[i : min(i + step, n) + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle)))
        total += _bit_sums([digest(join(g), seed) for g in grams])
    return np.packbits(2 * total > n).tobytes()


def _bit_sums(digests: list[bytes]) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1)
    return np.add.reduce(bits, axis=0, dtype=np.int64)


def _majority(digests: list[bytes]) -> bytes:
    return np.packbits(2 * _bit_sums(digests) > len(digests)).tobytes()


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id_col``, ``content`` (hash of the text) and ``fp`` (the fingerprint as a signed long)."""

    def run(batch):
        fps = b"".join(fingerprint(t, shingle) for t in batch.column(2).to_pylist())
        yield {id_col: batch.column(0), "content": batch.column(1), "fp": np.frombuffer(fps, ">i8").astype(np.int64)}

    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(id_col, F.xxhash64(text_col).alias("content"), text_col)
    return map_batches(src, run, f"`{id_col}` {kind}, content bigint, fp bigint")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each 64-bit word in Gray order."""
    r = fp.astype(np.uint64)
    for s in (1, 2, 4, 8, 16, 32):
        r = r ^ (r >> np.uint64(s))
    return r


class GrayIndex:
    """Fingerprints in Gray order under two levels of nodes with shared masked bits."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps[np.argsort(gray_rank(fps))]
        self.low = self._nodes(self.fps, BLOCK)
        upper = self._nodes(self.fps, BLOCK * BLOCK)
        # bits that a block shares beyond those its upper node shares already
        owner = np.arange(len(self.low[0])) // BLOCK
        self.low = (self.low[0] & ~upper[0][owner], self.low[1])
        self.upper = upper

    @staticmethod
    def _nodes(fps, size):
        """Mask of the bits shared inside each run of ``size`` fingerprints, and their pattern."""
        at = np.arange(0, len(fps), size)
        both, any_ = np.bitwise_and.reduceat(fps, at), np.bitwise_or.reduceat(fps, at)
        return ~(both ^ any_), both

    def search(self, queries: np.ndarray, most: int, step: int = 1 << 12):
        """Pairs (query, place in ``fps``) at ``most`` differing bits."""
        out_q, out_p = [], []
        for i in range(0, len(queries), step):
            q = queries[i : i + step]
            qi, ui, acc = np.arange(len(q)), np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
            for u in range(len(self.upper[0])):
                acc = np.bitwise_count((q ^ self.upper[1][u]) & self.upper[0][u])
                qi = np.flatnonzero(acc <= most)
                if not len(qi):
                    continue
                b0, b1 = u * BLOCK, min((u + 1) * BLOCK, len(self.low[0]))
                more = np.bitwise_count((q[qi, None] ^ self.low[1][None, b0:b1]) & self.low[0][None, b0:b1])
                x, b = np.nonzero(acc[qi, None] + more <= most)
                if not len(x):
                    continue
                b += b0
                size = np.minimum((b + 1) * BLOCK, len(self.fps)) - b * BLOCK
                for c in range(0, len(x), 1 << 14):  # a bounded number of leaf comparisons at a time
                    n = size[c : c + (1 << 14)]
                    p = np.repeat(b[c : c + (1 << 14)] * BLOCK - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    w = np.repeat(qi[x[c : c + (1 << 14)]], n)
                    hit = np.bitwise_count(q[w] ^ self.fps[p]) <= most
                    out_q.append(w[hit] + i)
                    out_p.append(p[hit])
        if not out_q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(out_q), np.concatenate(out_p)


def forest(a: np.ndarray, b: np.ndarray):
    """Links (values) reduced to one edge from each value to the smallest one that it is joined with."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def _masks(bits: int, most: int) -> list[int]:
    return [sum(1 << k for k in c) for n in range(most + 1) for c in combinations(range(bits), n)]


def _descend(rows: DataFrame, depth: int, to: int, most: int) -> DataFrame:
    """The rows (``fp, home, acc``) in the nodes of the next level at which their sum stays within ``most``.
    ``home`` marks a fingerprint in its own node; of two sibling nodes only the larger one is probed by the other's."""
    bits = to - depth
    own = F.shiftrightunsigned("fp", 64 - to) if to < 64 else F.col("fp")
    shift = F.explode(F.array(*[F.lit(m).cast("bigint") for m in _masks(bits, most)]))
    r = rows.select("*", shift.alias("_mask"))
    if depth:
        # a probe of an upper level keeps that level's path; the new bits are its own, shifted by the mask
        low = (1 << bits) - 1
        prefix = F.shiftleft("node", bits).bitwiseOR(own.bitwiseAND(F.lit(low).cast("bigint")))
    else:
        prefix = own
    r = r.withColumn("_node", prefix.bitwiseXOR(F.col("_mask"))).withColumn("_acc", F.col("acc") + F.bit_count("_mask"))
    larger = (F.col("_node") > prefix) if to < 64 else (F.col("_node").bitwiseXOR(F.lit(-(1 << 63)).cast("bigint")) > prefix.bitwiseXOR(F.lit(-(1 << 63)).cast("bigint")))
    keep = (F.col("_acc") <= most) & (~F.col("home") | (F.col("_mask") == 0) | larger)
    return r.where(keep).select("fp", (F.col("home") & (F.col("_mask") == 0)).alias("home"),
                                F.col("_acc").cast("int").alias("acc"), F.col("_node").alias("node"))


def _search_nodes(rows: DataFrame, most: int) -> DataFrame:
    """Edges (a forest for each node and batch) of all rows grouped by node, streamed in node order, homes first."""
    schema = "a bigint, b bigint"

    def run(batches):
        index = node = None
        held: list[np.ndarray] = []

        def emit(queries, index):
            q, p = index.search(queries, most)
            a, b = queries[q], index.fps[p]
            keep = a != b
            a, b = forest(a[keep].astype(np.int64), b[keep].astype(np.int64)) if keep.any() else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            fp = batch.column(0).to_numpy().astype(np.uint64)
            home = batch.column(1).to_numpy(zero_copy_only=False)
            nodes = batch.column(2).to_numpy()
            cut = np.flatnonzero(np.r_[True, (nodes[1:] != nodes[:-1]) | (home[1:] != home[:-1])])
            for s, t in zip(cut, np.r_[cut[1:], len(nodes)]):
                if nodes[s] != node:
                    if held and index is None and sum(map(len, held)) > 1:
                        h = np.concatenate(held)
                        yield emit(h, GrayIndex(h))
                    node, index, held = nodes[s], None, []
                if home[s]:
                    held.append(fp[s:t])
                elif held:
                    if index is None:
                        h = np.concatenate(held)
                        index = GrayIndex(h)
                        if len(h) > 1:
                            yield emit(h, index)
                    yield emit(fp[s:t], index)
        if held and index is None and sum(map(len, held)) > 1:
            h = np.concatenate(held)
            yield emit(h, GrayIndex(h))

    spread = rows.select("fp", "home", "node").repartition(F.col("node")).sortWithinPartitions("node", F.desc("home"))
    return spread.mapInArrow(run, schema)


def links(fps: DataFrame, most: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """Edges between distinct fingerprints (``fp``) that join exactly those classes which links
    at ``most`` differing bits join."""
    spark = fps.sparkSession
    n = fps.count()
    depth = max(6, min(16, int(np.ceil(np.log2(max(n, 2) / 64)))))
    start = fps.select("fp", F.lit(True).alias("home"), F.lit(0).alias("acc"))
    rows, parts, to = _descend(start, 0, depth, most), [], depth
    while True:
        size = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("live"))
        big = size.where(F.col("live") & (F.col("n") > node_rows)).select("node")
        held = scratch_path(spark, "simhash-big")
        big.write.parquet(held)
        big = spark.read.schema("node bigint").parquet(held)
        if to >= 64 or big.isEmpty():
            parts.append(_search_nodes(rows, most))
            break
        parts.append(_search_nodes(rows.join(big, "node", "left_anti"), most))
        depth, to = to, min(64, to + LEVEL_BITS)
        deeper = _descend(rows.join(big, "node", "left_semi"), depth, to, most)
        live = deeper.where("home").select("node").distinct()
        rows = pack_scratch(deeper.join(live, "node", "left_semi"), "simhash-level")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most: int = 2,
               node_rows: int = NODE_ROWS) -> DataFrame:
    """``id_col, content, fp, root`` for each row: documents whose fingerprints link, directly
    or through others, share ``root`` (a fingerprint)."""
    spark = df.sparkSession
    docs = pack_scratch(fingerprints(df, id_col, text_col, shingle), "simhash-docs")
    distinct = pack_scratch(docs.groupBy("fp").agg(F.count(F.lit(1)).alias("n")), "simhash-fps")
    edges = links(distinct.select("fp"), most, node_rows)
    cc = connected_components(edges, "a", "b", "simhash-edges").withColumnRenamed("node", "fp")
    roots = distinct.join(cc, "fp", "left").select("fp", "n", F.coalesce("root", "fp").alias("root"))
    return looked_up(docs, pack_scratch(roots, "simhash-roots"), "fp", "n", "inner")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most: int = 2,
                   node_rows: int = NODE_ROWS) -> DataFrame:
    """Near-duplicate classes of whole texts by SimHash; one output row for each input row.

    Returns ``id_col, fingerprint`` (16 lower-case hex digits) and ``component_id``, the
    smallest id reachable over links of at most ``most`` differing bits, the row's own
    included.  A null or blank text has fingerprint zero and links like any other.  Null
    ids pass through; a class with only null ids has a null component.  Repeated rows share
    a class.  Further columns are not read; an empty table gives an empty result.
    """
    rows = components(df, id_col, text_col, shingle, most, node_rows)
    low = pack_scratch(rows.groupBy("root").agg(F.min(id_col).alias("component_id"), F.count(F.lit(1)).alias("n")), "simhash-low")
    out = looked_up(rows, low, "root", "n", "inner")
    return out.select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most: int = 2) -> DataFrame:
    """The documents (all columns) without near-duplicates: of each class the row with the
    smallest id stays (a null id counts as smallest; of equal ids the smaller content hash;
    of identical rows one).  Null and blank texts have fingerprint zero and are copies of one another.
    An empty table stays empty; column names beginning with ``__simhash_`` are the operator's own and refused."""
    if own := [c for c in df.columns if c.startswith("__simhash_")]:
        raise ValueError(f"reserved column names: {', '.join(own)}")
    rows = components(df, id_col, text_col, shingle, most)
    best = rows.groupBy("root").agg(F.min(F.struct(id_col, "content")).alias("k"))
    keep = best.select(F.col("k")[id_col].alias("__simhash_keep_id"), F.col("k.content").alias("__simhash_keep_content"))
    docs = df.withColumn("__simhash_content", F.xxhash64(text_col))
    on = docs[id_col].eqNullSafe(keep["__simhash_keep_id"]) & (docs["__simhash_content"] == keep["__simhash_keep_content"])
    from pyspark.sql import Window

    w = Window.partitionBy("__simhash_keep_id", "__simhash_keep_content").orderBy("__simhash_keep_id")
    out = docs.join(keep, on, "inner").withColumn("__simhash_nth", F.row_number().over(w)).where("__simhash_nth = 1")
    return out.select(*[docs[c] for c in df.columns])
