"""Phrase collocations from mergeable Misra-Gries summaries.

First pass: every task hashes the n-grams (1 to ``longest`` words) of its texts, adds equal
ones up and deals them to hash partitions.  A partition's task first learns the partition's
mass (all its n-gram occurrences), then merges what it gets into one Misra-Gries summary
whose capacity is ``SLACK * mass / least``: all its decrements together stay below ``least``,
so every n-gram that occurs ``least`` times is still there, whatever the order of the merges.
N-grams whose count and decrements stay below ``least`` go.  The survivors' hashes fill a
filter of bounded size.

Second pass: the n-grams that the filter lets through, with all their parts, are counted
exactly as strings.  The filter only saves work: hash collisions and a full filter let more
n-grams through, and the exact counts decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import bounded_batches, in_steps, looked_up, pack_scratch
from panelcast.llm.words import byte_classes, hashes, mixed, words_of

CLASSES = byte_classes(b" \t", b".,;:!?\n\x0b\x0c\r")
#: Occurrences that one hash partition is meant to hold; capacity over mass / threshold.
MASS, SLACK = 1 << 22, 2
#: Bytes of the survivors' filter in all, and of one partition's slice at most.
FILTER_BYTES, SLICE_BYTES = 1 << 26, 1 << 17
#: Hashes in one row of the first shuffle; bytes of text that a task works on at a time.
CHUNK, STEP = 1 << 13, 1 << 22
#: Bits of a hash that travel, below those of its partition.
KEY_BITS = 48


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters, each too low by at most ``lost``."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = max(1, capacity), 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._held: list[tuple[np.ndarray, np.ndarray]] = []
        self._n = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Merge counters into the summary (collected until they are as many as it holds)."""
        self._held.append((keys, counts))
        self._n += len(keys)
        if self._n >= max(self.capacity, 1 << 16):
            self.settle()

    def settle(self) -> None:
        if not self._held:
            return
        keys = np.concatenate([self.keys, *(k for k, _ in self._held)])
        counts = np.concatenate([self.counts, *(c for _, c in self._held)])
        self._held, self._n = [], 0
        self.keys, self.counts = added_up(keys, counts)
        over = len(self.keys) - self.capacity
        if over > 0:
            cut = int(np.partition(self.counts, over - 1)[over - 1])
            self.counts = self.counts - cut
            keep = self.counts > 0
            self.keys, self.counts = self.keys[keep], self.counts[keep]
            self.lost += cut

    def survivors(self, least: int) -> np.ndarray:
        self.settle()
        return self.keys[self.counts + self.lost >= least]


def added_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts[:0]


def _steps(batches: Iterator[pa.RecordBatch], longest: int):
    """For each step of texts: the words, the language of each text and the hashes of the n-grams starting at each word
    with their validity, shortest first."""
    for batch in in_steps(batches, 1, STEP):
        words = words_of(batch.column(1), CLASSES, lower=True)
        lang = batch.column(0).fill_null("und").dictionary_encode()
        of = lang.indices.to_numpy(zero_copy_only=False)
        if not len(words.code):
            continue
        h = mixed(hashes(words.vocab)[words.code] ^ hashes(lang.dictionary.cast(pa.binary()), 1)[of][words.owner])
        levels, valid, gram = [], np.ones(len(h), bool), h
        for n in range(1, longest + 1):
            if n > 1:
                valid = valid[:-1] & words.joined[n - 2 :]
                gram = mixed(gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[n - 1 :])
            levels.append((gram, valid))
        yield words, lang.dictionary, of, levels


def _key(h: np.ndarray, bits: int) -> np.ndarray:
    return (h << np.uint64(bits)) >> np.uint64(64 - KEY_BITS)


def _packed(keys: np.ndarray) -> bytes:
    """Keys byte by byte, the lowest of all first: sorted keys share their high bytes, which then compress."""
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(KEY_BITS // 8, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : KEY_BITS // 8] = planes.T
    return out.view(np.uint64).ravel()


def _sized(counts: np.ndarray) -> bytes:
    top = counts.max()
    return counts.astype(np.uint8 if top < 1 << 8 else np.uint32 if top < 1 << 32 else np.int64).tobytes()


def _counted(longest: int, bits: int):
    """Texts to rows ``part, mass`` (once a step and partition) and ``part, keys, counts``."""

    def run(batches):
        for _, _, _, levels in _steps(batches, longest):
            found = np.concatenate([g[v] for g, v in levels])
            levels.clear()
            found.sort()
            at = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
            counts = np.diff(np.r_[at, len(found)])
            key = found[at]
            del found, at
            edges = np.searchsorted(key >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
            parts, mass, keys, many = [], [], [], []
            for p in np.flatnonzero(np.diff(edges)):
                i, j = edges[p], edges[p + 1]
                parts.append(p), mass.append(int(counts[i:j].sum())), keys.append(None), many.append(None)
                for c in range(i, j, CHUNK):
                    d = min(c + CHUNK, j)
                    parts.append(p), mass.append(None), keys.append(_packed(_key(key[c:d], bits))), many.append(_sized(counts[c:d]))
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(mass, pa.int64()), pa.array(keys, pa.binary()), pa.array(many, pa.binary())],
                                             names=["part", "mass", "keys", "counts"])

    return run


def _probes(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit places of each key in a slice of ``size`` bytes."""
    m = np.uint64(size * 8)
    return key % m, mixed(key) % m


def _summed(least: int, size: int):
    """Rows of a partition, its masses first, to ``part, kept, lost, filter`` (the slice of its survivors)."""

    def run(batches):
        part, mass, summary = None, 0, None

        def done():
            key = summary.survivors(least) if summary else np.zeros(0, np.uint64)
            bits = np.zeros(size * 8, np.uint8)
            for p in _probes(key, size):
                bits[p.astype(np.int64)] = 1
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([mass]), pa.array([len(key)]), pa.array([summary.lost if summary else 0]),
                 pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["part", "mass", "kept", "lost", "filter"])

        for batch in batches:
            for p, m, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    if part is not None:
                        yield done()
                    part, mass, summary = p, 0, None
                if m is not None:
                    mass += m
                    continue
                summary = summary or Summary(SLACK * mass // least + 1)
                key = _unpacked(keys)
                width = len(counts) // len(key)
                summary.add(key, np.frombuffer(counts, {1: np.uint8, 4: np.uint32, 8: np.int64}[width]).astype(np.int64))
        if part is not None:
            yield done()

    return run


def frequent_filter(texts: DataFrame, longest: int, least: int, mass: int = MASS) -> tuple[np.ndarray, int, int]:
    """The filter of all n-grams that may occur ``least`` times: its bytes, the bits of a partition number, and the
    bytes of a slice.  ``texts`` has ``lang, text``."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(20, max(6, int(np.ceil(np.log2(max(1, longest * size / 4 / mass))))))
    slice_ = max(64, min(SLICE_BYTES, FILTER_BYTES >> bits))
    counted = texts.mapInArrow(_counted(longest, bits), "part int, mass bigint, keys binary, counts binary")
    dealt = counted.repartition(1 << min(bits, 14), "part").sortWithinPartitions("part", F.col("mass").isNull())
    out = np.zeros((1 << bits) * slice_, np.uint8)
    for r in dealt.mapInArrow(_summed(least, slice_), "part int, mass bigint, kept bigint, lost bigint, filter binary").select("part", "filter").collect():
        out[r["part"] * slice_ : (r["part"] + 1) * slice_] = np.frombuffer(r["filter"], np.uint8)
    return out, bits, slice_


def _passes(h: np.ndarray, filter_: np.ndarray, bits: int, size: int) -> np.ndarray:
    base = (h >> np.uint64(64 - bits)).astype(np.int64) * (size * 8)
    ok = np.ones(len(h), bool)
    for p in _probes(_key(h, bits), size):
        p = p.astype(np.int64) + base
        ok &= (filter_[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
    return ok


def phrase_counts(texts: DataFrame, longest: int, least: int, mass: int = MASS) -> DataFrame:
    """``lang, words, phrase, f``: every phrase of 1 to ``longest`` words that occurs ``least`` times in its language,
    with its exact count, and one row a language with ``words`` 0, an empty phrase and the count of all words."""
    spark = texts.sparkSession
    bounded_batches(spark)
    filter_, bits, size = frequent_filter(texts, longest, least, mass)
    shared = spark.sparkContext.broadcast(filter_)

    def run(batches):
        for words, langs, of, levels in _steps(batches, longest):
            # a word in a language is one symbol
            pair, symbol = np.unique(words.code * len(langs) + of[words.owner], return_inverse=True)
            word, lang = words.vocab.take(pa.array(pair // len(langs))).cast(pa.large_string()), pair % len(langs)
            rows = [(np.bincount(of[words.owner], minlength=len(langs)), np.arange(len(langs)), pa.array([""] * len(langs), pa.large_string()), 0)]
            below = rank = None
            for n, (h, valid) in enumerate(levels, 1):
                ok = valid.copy()
                if n > 1:
                    ok &= below[:-1] & below[1:]  # both parts that are one word shorter
                at = np.flatnonzero(ok)
                at = at[_passes(h[at], shared.value, bits, size)]
                below = np.zeros(len(h), bool)
                below[at] = True
                code = symbol[at] if n == 1 else rank[at] * len(pair) + symbol[at + n - 1]
                each, where, dense, count = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
                rank = np.zeros(len(h), np.int64)
                rank[at] = dense
                if len(each):
                    i = at[where]
                    phrase = word.take(pa.array(symbol[i]))
                    for k in range(1, n):
                        phrase = pc.binary_join_element_wise(phrase, word.take(pa.array(symbol[i + k])), pa.scalar(" ", pa.large_string()))
                    rows.append((count, lang[symbol[i]], phrase, n))
            for count, which, phrase, n in rows:
                for i in range(0, len(count), 1 << 16):
                    j = min(i + (1 << 16), len(count))
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(pa.array(which[i:j])).cast(pa.string()), pa.array(np.full(j - i, n, np.int32)), phrase[i:j].cast(pa.string()), pa.array(count[i:j].astype(np.int64))],
                        names=["lang", "words", "phrase", "f"])

    found = texts.mapInArrow(run, "lang string, words int, phrase string, f bigint")
    return found.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("words") == 0))


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", shortest: int = 2, longest: int = 3, least: int = 10,
                 covered: int = 50, top: int = 2000, mass: int = MASS) -> DataFrame:
    """The ``top`` collocations of every language: phrases of ``shortest`` to ``longest`` words that occur ``least`` times.

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and into words at spaces and tabs; a
    phrase lies within one piece.  Returns ``lang, rank`` (from 1), ``phrase``, ``a`` (its occurrences), ``l`` and ``r``
    (those of its two parts at its lowest-scoring cut, ties to the earliest), ``n`` (all words of the language) and
    ``score = floor(1000000 a a / (l r))``, best first, ties to the larger ``a``, then to the smaller phrase in byte
    order.  A phrase that lies in a longer one with ``100 f(longer) >= covered a`` is left out.

    A null language is ``und`` (and counts with a language of that name); null, empty and blank texts have no words;
    repeated rows count as often as they stand there; further columns are not read.  A language without a phrase, and an
    empty table, give no rows.  The passes over the texts start jobs when this is called.
    """
    texts = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    counts = pack_scratch(phrase_counts(texts, longest, least, mass), "collocation-counts")
    f = counts.where("words > 0")
    long_ = F.split("phrase", " ")
    # phrases inside longer ones: the most frequent longer one decides
    inner = f.where(F.col("words") > shortest).select("lang", "f", "words", long_.alias("w")).select(
        "lang", "f", F.explode(F.expr(
            f"flatten(transform(sequence({shortest}, words - 1), k -> transform(sequence(1, words - k + 1), i -> array_join(slice(w, i, k), ' '))))"
        )).alias("phrase"))
    over = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = f.where(F.col("words") >= shortest).join(over, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * covered))
    cuts = pack_scratch(kept.select("lang", "phrase", F.col("f").alias("a"), "words", long_.alias("w"), F.explode(F.expr("sequence(1, words - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("struct(lang, array_join(slice(w, 1, k), ' ') AS phrase)").alias("left"),
        F.expr("struct(lang, array_join(slice(w, k + 1, words - k), ' ') AS phrase)").alias("right")), "collocation-cuts")
    keyed = f.select(F.struct("lang", "phrase").alias("key"), "f")
    for side, name in (("left", "l"), ("right", "r")):
        many = cuts.groupBy(F.col(side).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
        lookup = pack_scratch(keyed.join(many, "key").select(F.col("key").alias(side), F.col("f").alias(name), "rows"), f"collocation-{side}")
        cuts = looked_up(cuts, lookup, side, "rows", "inner")
    score = F.expr("CAST(1000000 AS decimal(7,0)) * CAST(a AS decimal(15,0)) * CAST(a AS decimal(15,0)) DIV (CAST(l AS decimal(15,0)) * CAST(r AS decimal(15,0)))")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    total = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
