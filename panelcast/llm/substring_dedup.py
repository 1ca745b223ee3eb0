"""Repeated word windows by super-k-mer partitioning.

A window is ``window`` consecutive words of one document.  Its minimiser is the smallest hash
of its runs of ``MINIMISER`` words; neighbouring windows mostly share it, so a stretch of
windows with one bucket travels there as one packed string of words, not window by window.
In the bucket the windows are sorted (by hash, equal hashes word by word), and every window
that also starts in a document with a smaller id is marked; marked stretches go back to their
documents.

Skew.  A first pass counts the windows of every bucket.  Windows of a bucket that is too large
are dealt singly by their own hash to as many smaller buckets as it needs.  Before anything
travels, each step of a task compares its own windows: of equal ones only those of the smallest
id travel, and of those only the first in each document; all others are decided or refer to it.
A window that a third of all documents share therefore reaches its bucket once a step.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import bounded_batches, in_steps, map_batches
from panelcast.llm.words import byte_classes, hashes, mixed, words_of

CLASSES = byte_classes(b" \t\n\x0b\x0c\r")
LINES = byte_classes(b" ", b"\n")
#: Words of a minimiser; windows meant for one bucket, and the multiple of it from which a bucket is split.
MINIMISER, BUCKET, HOT = 2, 1 << 19, 4
#: At most so many buckets are counted (8 bytes each on the driver).
MOST_BUCKETS = 1 << 20
#: Bytes of text that a task works on at a time.
STEP = 6 << 20
#: Stands for a null id: larger than all others.
NO_ID = np.iinfo(np.int64).max


def window_hashes(h: np.ndarray, window: int) -> np.ndarray:
    """A hash for the window at each word, from the words' hashes."""
    out = np.zeros(max(0, len(h) - window + 1), np.uint64)
    for j in range(window):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + len(out)]
    return mixed(out)


def minimisers(h: np.ndarray, window: int, size: int = MINIMISER) -> np.ndarray:
    """For the window at each word the smallest hash of its runs of ``size`` words."""
    size = min(size, window)
    low = window_hashes(h, size)
    have, want = 1, window - size + 1
    while have < want:
        step = min(have, want - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    return low


def equal_windows(code: np.ndarray, starts: np.ndarray, keys: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows (places in ``starts``) that have an equal among them, equal ones side by side in their given order, and
    where each group begins.  ``keys`` are hashes; windows with equal hashes are compared word by word."""
    order = np.argsort(keys, kind="stable")
    twin = keys[order][1:] == keys[order][:-1]
    many = order[np.r_[twin, False] | np.r_[False, twin]] if len(order) else order
    if not len(many):
        return many, many
    key = keys[many]

    def alike(rows):
        at, k = starts[rows], keys[rows]
        same = k[1:] == k[:-1]
        for j in range(window):
            c = code[at + j]
            same &= c[1:] == c[:-1]
        return same

    same = alike(many)
    if (~same & (key[1:] == key[:-1])).any():  # different windows under one hash: sort by their words too
        at = starts[many]
        many = many[np.lexsort([np.arange(len(many)), *(code[at + j] for j in range(window)), key])]
        same = alike(many)
    return many, np.flatnonzero(np.r_[True, ~same])


def runs(*breaks: np.ndarray) -> np.ndarray:
    """Begins of the stretches of rows in which no column (given as its difference to the expected next value) changes."""
    cut = np.ones(len(breaks[0]) + 1, bool)
    cut[1:] = breaks[0]
    for b in breaks[1:]:
        cut[1:] |= b
    return np.flatnonzero(cut)


class Windows:
    """The windows of a step of texts: ``at`` (first words), their bucket numbers before and after splitting."""

    def __init__(self, batch: pa.RecordBatch, window: int, bits: int):
        self.words = words_of(batch.column(2), CLASSES)
        owner = self.words.owner
        self.at = np.flatnonzero(owner[: max(0, len(owner) - window + 1)] == owner[window - 1 :])
        h = mixed(hashes(self.words.vocab))[self.words.code]
        self.key = window_hashes(h, window)[self.at]
        self.bucket = (mixed(minimisers(h, window)[self.at]) >> np.uint64(64 - bits)).astype(np.int64)


def _texts(df: DataFrame, id_col: str, text_col: str, unique: bool) -> DataFrame:
    content = F.lit(0).cast("bigint") if unique else F.xxhash64(text_col)
    return df.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(NO_ID))).alias("doc"), content.alias("content"), F.col(text_col).alias("text"))


def bucket_sizes(texts: DataFrame, window: int, bits: int) -> np.ndarray:
    """Windows in each of the ``2**bits`` buckets."""

    def run(batches):
        total = np.zeros(1 << bits, np.int64)
        for step in in_steps(batches, 2, STEP):
            total += np.bincount(Windows(step, window, bits).bucket, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(1 << bits, np.int64)
    for r in texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def split_plan(sizes: np.ndarray, target: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each bucket into how many it is split (0: not) and the number of the first of those, and the buckets in all."""
    parts = np.where(sizes > HOT * target, -(-sizes // target), 0)
    return parts, len(sizes) + np.cumsum(parts) - parts, len(sizes) + int(parts.sum())


_FIELDS = ["bucket", "kind", "doc", "content", "a", "b", "n", "packed"]
_SCHEMA = "bucket bigint, kind int, doc bigint, content bigint, a bigint, b bigint, n bigint, packed binary"
#: Kinds of rows: windows a to b of a document are repeats; windows from b on are, if those from a on are; packed windows.
REPEAT, SAME_AS, PACKED = 0, 1, 2


def _batch(kind, bucket, doc, content, a, b, n, packed=None):
    m = len(bucket)
    long_ = lambda x: pa.array(np.asarray(x, np.int64))
    return pa.RecordBatch.from_arrays([long_(bucket), pa.array(np.full(m, kind, np.int32)), *map(long_, (doc, content, a, b, n)),
                                       pa.nulls(m, pa.binary()) if packed is None else pa.array(packed, pa.binary())], names=_FIELDS)


def _pack(codec, doc, content, first, strings) -> bytes:
    head = np.stack([doc, content, first]).astype(np.int64).tobytes()
    body = head + b"\n".join(strings)
    return len(strings).to_bytes(4, "little") + len(body).to_bytes(8, "little") + codec.compress(body, asbytes=True)


def _unpack(codec, blob: bytes):
    n, size = int.from_bytes(blob[:4], "little"), int.from_bytes(blob[4:12], "little")
    body = codec.decompress(blob[12:], size, asbytes=True)
    return np.frombuffer(body, np.int64, 3 * n).reshape(3, n), body[24 * n :]


def _deal(window: int, bits: int, parts: np.ndarray, base: np.ndarray):
    """Texts to packed stretches of windows for their buckets, and what the step alone can decide."""

    def run(batches):
        codec = pa.Codec("zstd", compression_level=5)
        for step in in_steps(batches, 2, STEP):
            w = Windows(step, window, bits)
            if not len(w.at):
                continue
            ids, contents = step.column(0).to_numpy(), step.column(1).to_numpy()
            owner = w.words.owner[w.at]
            place = w.at - w.words.first[owner]
            doc = ids[owner]
            goes = np.ones(len(w.at), bool)
            many, groups = equal_windows(w.words.code, w.at, w.key, window)
            if len(many):
                size = np.diff(np.r_[groups, len(many)])
                low = np.repeat(np.minimum.reduceat(doc[many], groups), size)
                late = doc[many] > low
                goes[many] = False
                gone = np.sort(many[late])
                if len(gone):
                    yield _stretches(gone, owner, place, ids, contents)
                rest, group = many[~late], np.repeat(np.arange(len(groups)), size)[~late]
                lead = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (owner[rest][1:] != owner[rest][:-1])])
                goes[rest[lead]] = True
                model = np.repeat(rest[lead], np.diff(np.r_[lead, len(rest)]))
                other = rest != model
                x = np.argsort(rest[other])
                b, a = rest[other][x], model[other][x]
                if len(b):
                    cut = runs(np.diff(b) != 1, np.diff(a) != 1, np.diff(owner[b]) != 0)
                    o = owner[b[cut]]
                    yield _batch(SAME_AS, ids[o] & 0xFFFF, ids[o], contents[o], place[a[cut]], place[b[cut]], np.diff(np.r_[cut, len(b)]))
            at = np.flatnonzero(goes)
            if not len(at):
                continue
            bucket = w.bucket[at]
            split = parts[bucket]
            dest = np.where(split > 0, base[bucket] + (w.key[at] % np.maximum(split, 1).astype(np.uint64)).astype(np.int64), bucket)
            cut = runs(np.diff(dest) != 0, np.diff(w.at[at]) != 1, np.diff(owner[at]) != 0)
            first, last = w.at[at[cut]], w.at[at[np.r_[cut[1:], len(at)] - 1]] + window - 1
            order = np.argsort(dest[cut], kind="stable")
            text, ends = w.words.spaced(), w.words.ends
            i, j = (ends[first] + first)[order].tolist(), (ends[last + 1] + last)[order].tolist()
            strings = [text[x:y] for x, y in zip(i, j)]
            o = owner[at[cut]][order]
            of, head = dest[cut][order], place[at[cut]][order]
            edge = np.r_[runs(np.diff(of) != 0), len(of)]
            packed = [_pack(codec, ids[o[x:y]], contents[o[x:y]], head[x:y], strings[x:y]) for x, y in zip(edge[:-1], edge[1:])]
            zero = np.zeros(len(packed), np.int64)
            yield _batch(PACKED, of[edge[:-1]], zero, zero, zero, zero, zero, packed)

    return run


def _stretches(gone, owner, place, ids, contents):
    """Sorted windows as rows of neighbouring ones."""
    cut = runs(np.diff(place[gone]) != 1, np.diff(owner[gone]) != 0)
    o = owner[gone[cut]]
    a = place[gone[cut]]
    return _batch(REPEAT, ids[o] & 0xFFFF, ids[o], contents[o], a, a + np.diff(np.r_[cut, len(gone)]), np.zeros(len(cut)))


def _judge(window: int):
    """Rows in bucket order: packed windows of a bucket are sorted and the repeats returned; other rows pass through."""

    def run(batches):
        codec = pa.Codec("zstd")
        now, held = None, []

        def judged():
            heads, texts = zip(*(_unpack(codec, b) for b in held))
            doc, content, first = np.concatenate(heads, axis=1)
            words = words_of(pa.array([b"\n".join(texts)], pa.large_binary()).cast(pa.large_string()), LINES)
            string = np.r_[0, np.cumsum(~words.joined)]
            at = np.flatnonzero(string[: len(string) - window + 1] == string[window - 1 :])
            key = window_hashes(mixed(hashes(words.vocab))[words.code], window)[at]
            many, groups = equal_windows(words.code, at, key, window)
            if not len(many):
                return
            owner = string[at]
            begin = np.flatnonzero(np.r_[True, ~words.joined])
            place = at - begin[owner] + first[owner]
            low = np.repeat(np.minimum.reduceat(doc[owner[many]], groups), np.diff(np.r_[groups, len(many)]))
            gone = np.sort(many[doc[owner[many]] > low])
            if len(gone):
                yield _stretches(gone, owner, place, doc, content)

        for batch in batches:
            kind = batch.column(1).to_numpy()
            other = np.flatnonzero(kind != PACKED)
            if len(other):
                yield batch.take(pa.array(other))
            at = np.flatnonzero(kind == PACKED)
            buckets, blobs = batch.column(0).to_numpy()[at].tolist(), batch.column(7).take(pa.array(at)).to_pylist()
            for bucket, blob in zip(buckets, blobs):
                if bucket != now and held:
                    yield from judged()
                    held = []
                now = bucket
                held.append(blob)
        if held:
            yield from judged()

    return run


def repeats(texts: DataFrame, window: int, target: int = BUCKET) -> DataFrame:
    """``doc, content, kind, a, b, n`` (kinds above) for all windows that start in a document with a smaller id as well."""
    bounded_batches(texts.sparkSession)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = int(np.clip(np.ceil(np.log2(max(1, size / 6 / target))), 4, np.log2(MOST_BUCKETS)))
    parts, base, buckets = split_plan(bucket_sizes(texts, window, bits), target)
    dealt = texts.mapInArrow(_deal(window, bits, parts, base), _SCHEMA)
    sorted_ = dealt.repartition(max(8, min(buckets // 4, 1 << 14)), "bucket").sortWithinPartitions("bucket")
    return sorted_.mapInArrow(_judge(window), _SCHEMA).select("doc", "content", "kind", "a", "b", "n")


def covered(n: int, rows: list[tuple[int, int, int, int]], window: int) -> np.ndarray | None:
    """Which of ``n`` words lie in a repeated window; None if none."""
    hit = np.zeros(max(0, n - window + 1), bool)
    for kind, a, b, _ in rows:
        if kind == REPEAT:
            hit[a:b] = True
    for kind, a, b, m in rows:
        if kind == SAME_AS:
            hit[b : b + m] |= hit[a : a + m]
    if not hit.any():
        return None
    edge = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(hit)
    edge[: len(hit)] += hit
    np.subtract.at(edge, at + window, 1)
    return np.cumsum(edge[:-1]) > 0


def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, with_text: bool = False,
                     target: int = BUCKET) -> DataFrame:
    """Every row's text without the windows that also start in a row with a smaller id; one output row for each input row.

    Words are cut at ASCII white space and otherwise left as they are; a word goes if a window of ``window`` words over
    it also starts in a row with a smaller id, judged on the input.  Returns ``id_col, n_words, n_removed, kept_sha256``
    (of the kept words, joined by single spaces) and, ``with_text``, ``kept`` itself.

    Ids are integers.  A null id counts as larger than all others and passes through; rows with equal ids do not remove
    each other's words.  Null, empty and short texts have no window and keep their words.  Further columns are not read;
    an empty table gives an empty result.  The counting pass over the texts runs when this is called.
    """
    kind = df.schema[id_col].dataType.simpleString()
    ids = df.groupBy(F.col(id_col).alias("i")).agg(F.count(F.lit(1)).alias("n"))
    unique = ids.where("n > 1 OR i IS NULL").isEmpty()
    texts = _texts(df, id_col, text_col, unique)
    found = repeats(texts, window, target)
    if not unique:  # copies of a row give the same rows again
        found = found.distinct()
    lists = found.groupBy("doc", "content").agg(F.collect_list(F.struct("kind", "a", "b", "n")).alias("rows"))
    rows = texts.join(lists, ["doc", "content"], "left").select("doc", "text", "rows")
    back = int(NO_ID)

    def run(batch):
        out = {c: [] for c in ("n_words", "n_removed", "kept_sha256", "kept")}
        lists_ = batch.column(2)
        flat = lists_.flatten()
        cols = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(4)] if len(flat) else [np.zeros(0, np.int64)] * 4
        sizes = np.r_[0, np.cumsum(np.nan_to_num(lists_.value_lengths().to_numpy(zero_copy_only=False).astype(float)))].astype(np.int64)
        for k, text in enumerate(batch.column(1).to_pylist()):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            n, gone = len(words), 0
            i, j = sizes[k], sizes[k + 1]
            mask = covered(n, list(zip(*(c[i:j].tolist() for c in cols))), window) if j > i else None
            if mask is not None:
                gone = int(mask.sum())
                words = compress(words, (~mask).tolist())
            kept = b" ".join(words)
            out["n_words"].append(n), out["n_removed"].append(gone), out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept.decode("utf-8", "surrogatepass") if with_text else None)
        doc = [None if d == back else d for d in batch.column(0).to_pylist()]
        yield {id_col: pa.array(doc, pa.int64()), **out}

    out = map_batches(rows, run, f"`{id_col}` bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
    return out.select(F.col(id_col).cast(kind).alias(id_col), "n_words", "n_removed", "kept_sha256", *(["kept"] if with_text else []))
