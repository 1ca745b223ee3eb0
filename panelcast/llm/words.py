"""Words of Arrow text arrays as NumPy arrays: cut at ASCII separators, byte by byte, whole texts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Byte classes: part of a word, between words, between pieces (word runs that never join).
WORD, GAP, CUT = 0, 1, 2


def byte_classes(gaps: bytes, cuts: bytes = b"") -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(gaps)] = GAP
    out[list(cuts)] = CUT
    return out


def _lower() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


LOWER = _lower()


@dataclass
class Words:
    """All words of some texts in order: ``code`` into the distinct words ``vocab`` (binary), the text of each
    (``owner``), the words before each text (``first``, with the end), and whether a word and the next one lie in the
    same piece (``joined``, one shorter than the words).  ``data`` holds their bytes back to back, ``ends`` where each
    begins there (with the end)."""

    code: np.ndarray
    vocab: pa.Array
    owner: np.ndarray
    first: np.ndarray
    joined: np.ndarray
    data: np.ndarray
    ends: np.ndarray

    def spaced(self) -> bytes:
        """All words, each with a space behind it; word i begins at ``ends[i] + i``."""
        n = len(self.code)
        gap = np.zeros(len(self.data) + n, bool)
        gap[self.ends[1:] + np.arange(n)] = True
        out = np.full(len(gap), 32, np.uint8)
        out[~gap] = self.data
        return out.tobytes()


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array (null: none) and the offsets of its values in them."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    at = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if data is None or not len(texts) or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def words_of(texts: pa.Array, classes: np.ndarray, lower: bool = False) -> Words:
    """The words of every text of a string array; nulls and blank texts have none."""
    data, at = _bytes_of(texts)
    kind = classes[data]
    inside = kind == WORD
    heads = at[:-1][at[:-1] < at[1:]]  # where non-empty texts begin
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    start[heads] = inside[heads]
    begin = np.flatnonzero(start)
    stop = inside
    stop = stop.copy()
    stop[:-1] &= ~inside[1:]
    stop[heads[1:] - 1] = inside[heads[1:] - 1]
    sizes = np.flatnonzero(stop) + 1 - begin
    kept = data[inside]
    offsets = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    value = LOWER[kept] if lower else kept
    words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(value))])
    coded = words.dictionary_encode()
    first = np.searchsorted(begin, at)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    joined = owner[1:] == owner[:-1]
    if (classes == CUT).any() and len(begin):
        piece = np.cumsum(kind == CUT, dtype=np.int32)[begin]
        joined &= piece[1:] == piece[:-1]
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, owner, first, joined, value, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (multiply and shift rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hashes(vocab: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hashes of distinct words."""
    from xxhash import xxh3_64_intdigest as digest

    return np.fromiter((digest(w, seed) for w in vocab.to_pylist()), np.uint64, len(vocab))
