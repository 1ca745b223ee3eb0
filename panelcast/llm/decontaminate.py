"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

The CGK embedding walks over a window of words; at every step it outputs the word it
stands on and then, by a random bit of (step, word), stays or moves on.  Two windows at a
small edit distance soon walk in step again, so their outputs have a small Hamming
distance.  A hash key is the output at a few random steps (bit sampling); several walks
with several keys each make up the tables that reach the target recall.

Windows are item-sized: a window has the largest power of two of words that an item, also
after losing as many words as may be edited, holds at every one of ``stride`` shifts.
Documents are cut at every multiple of the stride and at their last window; the items,
which are few, are cut at every shift up to their last window, so an item inside a document
always has windows whose walk starts at the same word, also where only its second half is
unedited, where words are missing, or at the end of a document.  Every collision is
verified by the exact edit distance in words between the whole item and the best-fitting
part of the document around the window; only places that hold too few of the item's words
to reach it are left out before.

Documents stay where they are: the items' tables go to the workers, in blocks of bounded
size, and there is no shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from panelcast.llm.common import bounded_batches, map_batches, pack_scratch, split_words

#: Walks, keys of each walk, and steps sampled for a key.  ``tests/llm`` holds the recall with 20 % of an item's
#: words replaced, deleted, inserted or cut off at 0.9 and above, wherever in the document the item lies.
WALKS, KEYS, SAMPLED = 3, 8, 4
#: Words of items whose tables are sent to the workers at once: 24 entries of 16 bytes for each word at most.
WORDS_PER_BLOCK = 200_000
FILTER_BITS = 22
_WORDS_PER_STEP = 1 << 18
_WINDOWS_PER_STEP = 1 << 14


def word_hashes(words: list[str]) -> np.ndarray:
    import xxhash

    h = xxhash.xxh64_intdigest
    return np.fromiter((h(w) for w in words), np.uint64, len(words))


#: ASCII letters and digits and all bytes of other characters stay, the rest become spaces.
_WORD_BYTES = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)], np.uint8)


def normalised(texts: pa.Array) -> pa.Array:
    """Lower-cased texts in which everything but letters and digits is a space (places of bytes stay)."""
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    _, offsets, data = low.buffers()
    data = _WORD_BYTES[np.frombuffer(data, np.uint8)] if data is not None else np.zeros(0, np.uint8)
    return pa.StringArray.from_buffers(len(low), offsets, pa.py_buffer(data))


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and the first word of each text and the end."""
    code, words, first = split_words(normalised(texts))
    keep = np.array([w != "" for w in words], bool)[code] if len(code) else np.zeros(0, bool)
    first = np.r_[0, np.cumsum(keep)][first]
    return word_hashes(words)[code[keep]] if len(code) else np.zeros(0, np.uint64), first


def most_edits(n: int, similarity: float) -> int:
    return int(n * (1 - similarity) + 1e-9)


def window_of(n: int, similarity: float = 1.0) -> tuple[int, int]:
    """Window and stride for an item of n words: window + stride - 1 <= the words left after all allowed deletions, and
    the window is a power of two."""
    w = 1 << max(0, int(math.log2((n - most_edits(n, similarity) + 1) / 1.5)))
    return w, max(1, w // 2)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0xD1B54A32D192ED03) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """The words' hashes for each walk and block of steps, made when first used."""

    def __init__(self, words: np.ndarray):
        self.words, self.made = words, {}

    def __call__(self, walk: int, block: int) -> np.ndarray:
        if (walk, block) not in self.made:
            self.made[walk, block] = _mix(self.words, walk * 7919 + block)
        return self.made[walk, block]


def walk_keys(hashes: Hashes, starts: np.ndarray, w: int, seed: int = 0):
    """Keys of the windows of ``w`` words at ``starts``: for each walk and key (table number, keys)."""
    steps = max(1, 3 * w // 2)
    last = starts + (w - 1)
    for r in range(WALKS):
        rng = np.random.default_rng((seed, w, r))
        picks = [set(rng.choice(steps, min(SAMPLED, steps), replace=False).tolist()) for _ in range(KEYS)]
        out = [np.full(len(starts), (w * 1009 + r * 31 + k) * 0x9E3779B1, np.uint64) for k in range(KEYS)]
        at, x, move = starts.copy(), np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
        for t in range(steps):
            np.take(hashes(r, t // 32), at, out=x, mode="clip")
            for k, p in enumerate(picks):
                if t in p:
                    np.bitwise_xor(out[k], x, out=out[k])
                    np.multiply(out[k], np.uint64(0xFF51AFD7ED558CCD), out=out[k])
            # bits 32 and up of the hash move the walk; the key takes the whole hash
            np.right_shift(x, np.uint64(32 + t % 32), out=move)
            np.bitwise_and(move, np.uint64(1), out=move)
            at += move.view(np.int64)
            if t >= w - 1:  # only from here on can a walk leave its window
                np.minimum(at, last, out=at)
        for k in range(KEYS):
            yield r * KEYS + k, out[k] ^ (out[k] >> np.uint64(29))


@dataclass
class ItemIndex:
    """The tables of a block of items, by window size."""

    ids: list
    words: list[np.ndarray]
    tables: dict  # window -> (stride, filter, sorted keys, item of each, shift of each)


def build_index(ids: list, texts: list[str | None], similarity: float = 0.8) -> ItemIndex:
    h, first = hashed_words(pa.array(texts, pa.string()))
    words = [h[i:j] for i, j in zip(first, first[1:])]
    found: dict[int, list] = {}
    for i, item in enumerate(words):
        if not len(item):
            continue  # an item without words is in no document
        w, _ = window_of(len(item), similarity)
        starts = np.arange(len(item) - w + 1)
        for _, keys in walk_keys(Hashes(item), starts, w):
            found.setdefault(w, []).append((keys, np.full(len(starts), i, np.int32), starts.astype(np.int32)))
    tables = {}
    for w, parts in found.items():
        keys, item, shift = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(keys, kind="stable")
        some = np.zeros(1 << FILTER_BITS, bool)
        some[keys >> np.uint64(64 - FILTER_BITS)] = True
        tables[w] = (max(1, w // 2), some, keys[order], item[order], shift[order])
    return ItemIndex(ids, words, tables)


def fitting_distance(item: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edit distance in words of ``item`` to its best-fitting part of each row of ``text``, and where that
    part ends (the first such end; the text before and behind it is free)."""
    c, m = text.shape
    cost = np.zeros((c, m + 1), np.int32)
    ramp = np.arange(m + 1, dtype=np.int32)
    for i, word in enumerate(item, 1):
        new = np.empty_like(cost)
        new[:, 0] = i
        np.minimum(cost[:, :-1] + (text != word), cost[:, 1:] + 1, out=new[:, 1:])
        cost = np.minimum.accumulate(new - ramp, axis=1) + ramp
    return cost.min(axis=1), cost.argmin(axis=1)


class Matcher:
    """Matches of whole documents against one block of items."""

    def __init__(self, index: ItemIndex, similarity: float):
        self.index, self.similarity = index, similarity

    def __call__(self, texts: pa.Array):
        """(document, item, edits, end word) of the best place of each matching pair."""
        h, first = hashed_words(texts)
        size = np.diff(first)
        docs, items, ats = [], [], []
        lo = 0
        while lo < len(size):  # bounded numbers of words at a time, whole documents
            hi = max(lo + 1, int(np.searchsorted(first, first[lo] + _WORDS_PER_STEP, side="right")) - 1)
            part, n = Hashes(h[first[lo] : first[hi]]), size[lo:hi]
            base = first[lo:hi] - first[lo]
            for w, table in self.index.tables.items():
                for d, i, at in self._candidates(part, base, n, w, table):
                    docs.append(d + lo), items.append(i), ats.append(at)
            lo = hi
        if not docs:
            return []
        item, doc, at = np.concatenate(items).astype(np.int64), np.concatenate(docs), np.concatenate(ats)
        low = int(at.min())
        span = int(at.max()) - low + 1
        code = np.unique((item * len(size) + doc) * span + (at - low))
        pair = code // span
        return self._verified(np.c_[pair // len(size), pair % len(size), code % span + low], h, first)

    def _candidates(self, h, base, n, w, table):
        stride, some, keys, item, shift = table
        # every stride, and the last window where the stride misses it
        count = np.where(n < w, 0, -(-(n - w) // stride) + 1)
        owner = np.repeat(np.arange(len(n)), count)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        for a in range(0, len(owner), _WINDOWS_PER_STEP):
            o = owner[a : a + _WINDOWS_PER_STEP]
            at = np.minimum(k[a : a + _WINDOWS_PER_STEP] * stride, n[o] - w)
            for _, key in walk_keys(h, base[o] + at, w):
                hit = np.flatnonzero(some[key >> np.uint64(64 - FILTER_BITS)])
                if not len(hit):
                    continue
                left = np.searchsorted(keys, key[hit], "left")
                many = np.searchsorted(keys, key[hit], "right") - left
                if not many.any():
                    continue
                src = np.repeat(hit, many)
                pos = np.repeat(left, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                yield o[src], item[pos], at[src] - shift[pos]

    def _verified(self, rows, h, first):
        best: dict[tuple[int, int], tuple[int, int]] = {}
        cut = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
        none = np.uint64(0)  # stands for places outside the document
        for s, t in zip(cut, np.r_[cut[1:], len(rows)]):
            i = int(rows[s, 0])
            item = self.index.words[i]
            most = most_edits(len(item), self.similarity)
            vocabulary = np.unique(item)
            span = np.arange(-most, len(item) + most)
            for a in range(s, t, 2048):
                d, at = rows[a : min(a + 2048, t), 1], rows[a : min(a + 2048, t), 2]
                place = at[:, None] + span
                inside = (place >= 0) & (place < (first[d + 1] - first[d])[:, None])
                text = np.where(inside, h[np.where(inside, place + first[d][:, None], 0)], none)
                # an item's word that stays needs a place with a word of the item
                known = vocabulary[np.minimum(np.searchsorted(vocabulary, text), len(vocabulary) - 1)] == text
                able = (known & inside).sum(axis=1) >= len(item) - most
                d, at, text = d[able], at[able], text[able]
                if not len(d):
                    continue
                edits, end = fitting_distance(item, text)
                for x in np.flatnonzero(edits <= most):
                    got = (int(edits[x]), int(at[x] - most + end[x]))
                    pair = (int(d[x]), i)
                    best[pair] = min(best.get(pair, got), got)
        return [(d, i, e, at) for (d, i), (e, at) in sorted(best.items())]


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, similarity: float, size: int = WORDS_PER_BLOCK):
    """Indexes of blocks of items with at most ``size`` words in all (one longer item is a block).  The benchmark is read
    to the driver block by block."""
    rows, n = [], 0
    for r in benchmark.select(id_col, text_col).toLocalIterator():
        words = len((r[1] or "").split()) + 1
        if rows and n + words > size:
            yield build_index([r[0] for r in rows], [r[1] for r in rows], similarity)
            rows, n = [], 0
        rows.append(r)
        n += words
    if rows:
        yield build_index([r[0] for r in rows], [r[1] for r in rows], similarity)


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", block: int = WORDS_PER_BLOCK) -> DataFrame:
    """Benchmark items inside documents: one row for each document and item whose best-fitting part of the
    document is at most (1 - similarity) of the item's words away in edit distance.

    Returns ``id_col, item_col, n_words`` (of the item), ``edits, similarity, end_word`` (the part's end).
    Words are lower-cased runs of letters and digits.  Null and blank texts on either side match nothing;
    null ids and repeated rows pass through; equal items each match; further columns are not read; an
    empty table on either side gives an empty result.
    """
    out = None
    kinds = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, `{item_col}` {benchmark.schema[item_col].dataType.simpleString()}"
    schema = f"{kinds}, n_words int, edits int, similarity double, end_word bigint"
    for index in item_blocks(benchmark, item_col, item_text_col, similarity, block):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batch, shared=shared):
            x = shared.value
            rows = Matcher(x, similarity)(batch.column(1))
            n = [len(x.words[i]) for _, i, _, _ in rows]
            yield {id_col: batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), item_col: [x.ids[r[1]] for r in rows],
                   "n_words": n, "edits": [r[2] for r in rows], "similarity": [1 - r[2] / m for r, m in zip(rows, n)],
                   "end_word": [r[3] for r in rows]}

        found = map_batches(docs.select(id_col, text_col), run, schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, text_col: str = "text",
                        item_col: str = "item_id", item_text_col: str = "text", block: int = WORDS_PER_BLOCK) -> DataFrame:
    """The documents (all columns) that hold no benchmark item (see ``find_leaks``).

    Documents with a null or blank text stay, as do all if the benchmark is empty; null ids and repeated rows are judged
    each by its own text; columns may have any names.  Where the benchmark has several blocks, what one block keeps is
    written to the shared scratch folder before the next, so a task holds one block's tables.
    """
    at, found = docs.columns.index(text_col), None
    for index in item_blocks(benchmark, item_col, item_text_col, similarity, block):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        if found is not None:
            docs = pack_scratch(found, "decontaminated")

        def run(batches, shared=shared):
            match = Matcher(shared.value, similarity)
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[r[0] for r in match(b.column(at))]] = False
                yield b.filter(pa.array(keep))

        bounded_batches(docs.sparkSession)
        found = docs.mapInArrow(run, docs.schema)
    return docs if found is None else found
