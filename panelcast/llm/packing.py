"""Packing by concatenate-and-cut: two passes of prefix sums, then fixed windows.

Pass 1 tokenizes every document once and writes its ids, together with the number
of ids before it in its own partition, to the shared scratch folder.  The totals of
the partitions (one row each) give every partition's place in the one long stream.
Pass 2 turns a document's place in the stream into pieces: the stream is cut at
every multiple of the window, and a piece is the part of a document inside one
window.  Only the last window can be short.  No step gathers documents by a key.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import Memo, bounded_batches, in_steps, map_batches, pack_scratch, split_words, worker_state

#: Word parts kept in a generation of a worker's table (a bound on memory only).
KEPT = 300_000


def letters_ending_in_marks() -> str:
    """All letters whose lower case in composed form (NFC) ends in something else than a letter."""
    import sys
    from unicodedata import category, normalize

    ends = lambda c: category(normalize("NFC", normalize("NFC", c).lower())[-1])[0]
    return "".join(c for c in map(chr, range(sys.maxunicode + 1)) if category(c)[0] == "L" and ends(c) != "L")


class WordEncoder:
    """Ids of whole texts from a ``tokenizers`` file that drops white space, lower-cases and
    splits punctuation from letters.

    Such a tokenizer treats the parts between white space independently, so each distinct
    part is encoded once and its ids are looked up afterwards.  Only the ASCII space, tab
    and line breaks cut here, and ASCII punctuation between a letter and a space is a part
    of its own; all other white space and punctuation is left to the library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        same = (("a b", ("a", "b")), ("it's\nx", ("it's", "x")), ("é, a.", ("é", ",", "a", ".")), ("THE Cat", ("the", "cat")), ("a*$. b", ("a", "*$.", "b")))
        for part, whole in same:
            if self.ids([part])[0] != [i for w in whole for i in self.ids([w])[0]]:
                raise ValueError("the tokenizer does not treat words independently")
        self.joined = f"[{letters_ending_in_marks()}][!-/:-@\\[-`{{-~]"
        self.kind = "<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4"
        self.seen = Memo(KEPT)

    def ids(self, parts: list[str]) -> list[list[int]]:
        encode = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        return [e.ids for e in encode(parts, add_special_tokens=False)]

    def parts(self, texts: pa.Array) -> pa.Array:
        for blank in "\n\t\r":
            texts = pc.replace_substring(texts, blank, " ")
        # special strings are found before letters are lower-cased
        special = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, self.joined))
        cut = pc.replace_substring_regex(pc.ascii_lower(texts), r"(\pL)([!-/:-@\[-`{-~]+) ", r"\1 \2 ")
        return pc.if_else(special, texts, cut)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (no nulls), one after another, and how many each text has."""
        code, words, first = split_words(self.parts(texts))
        seen = self.seen
        fresh = seen.unseen(set(words))
        for i in range(0, len(fresh), 4096):
            part = fresh[i : i + 4096]
            seen.update(zip(part, (np.array(x, self.kind).tobytes() for x in self.ids(part))))
        found = [seen[w] for w in words]
        seen.forget_long(fresh)
        width = np.dtype(self.kind).itemsize
        size = np.array([len(b) // width for b in found], np.int64)
        ids = np.frombuffer(b"".join(found), self.kind)
        return _ragged(ids, np.cumsum(size) - size, size, code, first)


def _ragged(ids, start, size, code, first):
    """The id runs of a sequence of words, and the ids of each text."""
    n = size[code]
    total = np.r_[0, np.cumsum(n)]
    flat = np.repeat(start[code] - total[:-1], n) + np.arange(total[-1])
    return ids[flat], total[first[1:]] - total[first[:-1]]


def encoder(path: str) -> WordEncoder:
    return worker_state(("packing", path), lambda: WordEncoder(path))


def id_width(tokenizer: str) -> str:
    """numpy type of the stored ids."""
    return encoder(tokenizer).kind


def encoded(df: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Pass 1: ``id_col, part, before`` (ids of the partition's earlier documents),
    ``n_ids`` and ``ids`` (binary), written once to the shared scratch folder."""
    from pyspark import TaskContext

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, part int, before bigint, n_ids bigint, ids binary"
    bounded_batches(df.sparkSession)

    def run(batches):
        part, before = TaskContext.get().partitionId(), 0
        enc = encoder(tokenizer)
        width = np.dtype(enc.kind).itemsize
        for batch in in_steps(batches, 1):
            ids, n = enc(pc.fill_null(batch.column(1), ""))
            at = np.cumsum(n)
            blob = np.insert(ids, at, end_id).astype(enc.kind, copy=False).tobytes()
            n = n + 1
            stop = np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(before + stop - n), pa.array(n),
                 pa.array([blob[i * width : j * width] for i, j in zip((stop - n).tolist(), stop.tolist())], pa.binary())],
                names=[id_col, "part", "before", "n_ids", "ids"],
            )
            before += int(n.sum())

    return pack_scratch(df.select(id_col, text_col).mapInArrow(run, schema), "packing-ids")


def pack(df: DataFrame, tokenizer: str, end_id: int, window: int = 4096, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pack whole documents into windows of ``window`` ids; one row for each piece.

    Every document is its ids (no added special tokens) and ``end_id``; a null or empty
    text is ``end_id`` alone.  Returns ``id_col``, ``start`` (ids of its document before
    the piece), ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens`` (with
    the end id), ``sequence_id`` and ``offset`` (place in the window, gapless from 0).
    Pieces of a window in order of ``offset`` are the window; all windows but the last
    hold exactly ``window`` ids.  Rows with null or repeated ids are packed like any
    other, further columns are not read, and an empty table gives an empty result.
    The order of documents in the stream is that of the input's partitions.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    spark = df.sparkSession
    ids = encoded(df, tokenizer, end_id, id_col, text_col)
    # One row for each partition of the input scan, whatever the number of documents.
    totals = ids.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    base, at = {}, 0
    for r in sorted(totals, key=lambda r: r["part"]):
        base[r["part"]], at = at, at + r["n"]
    shared = spark.sparkContext.broadcast(base)
    width = id_width(tokenizer)
    kind = df.schema[id_col].dataType.simpleString()

    def pieces(batch):
        doc, part, before, n_ids, blob = (batch.column(c) for c in range(5))
        n = n_ids.to_numpy()
        g = np.array([shared.value[p] for p in part.to_pylist()], np.int64) + before.to_numpy()
        lo, hi = 0, len(n)
        while lo < hi:  # a few million ids at a time: one very long document is cut as it is
            up = max(lo + 1, lo + int(np.searchsorted(np.cumsum(n[lo:]), 4_000_000)))
            yield rows(doc, blob, n, g, lo, min(up, hi))
            lo = up

    def rows(doc, blob, n, g, lo, up):
        n, g = n[lo:up], g[lo:up]
        count = (g + n - 1) // window - g // window + 1
        d = np.repeat(np.arange(len(n)), count)
        k = np.arange(len(d)) - np.repeat(np.cumsum(count) - count, count)
        seq = g[d] // window + k
        start = np.maximum(seq * window - g[d], 0)
        length = np.minimum((seq + 1) * window - g[d], n[d]) - start
        arrays = [np.frombuffer(b, width) for b in blob.slice(lo, up - lo).to_pylist()]
        cut = [arrays[i][s : s + m].astype("<u4").tobytes() for i, s, m in zip(d.tolist(), start.tolist(), length.tolist())]
        return {id_col: doc.take(pa.array(d + lo)), "start": start, "length": length, "ids": cut, "doc_tokens": n[d],
                "sequence_id": seq, "offset": g[d] + start - seq * window}

    return map_batches(
        ids, pieces,
        f"`{id_col}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint",
    )


def padded_length(n, window: int = 4096):
    """Length to which a sequence of ``n`` ids (a column) is padded: the window, but a
    sequence whose own length is a power of two stays as it is."""
    return F.when(n.bitwiseAND(n - 1) == 0, n).otherwise(F.lit(window).cast("bigint"))


def sequences(pieces: DataFrame, window: int = 4096) -> DataFrame:
    """The fixed windows with their boundary records: one row for each sequence, its ids
    as one binary (little-endian unsigned 32-bit), its length and padded length, and the
    offsets at which pieces begin.  A group holds at most ``window`` ids.  Only the pieces' own columns are read; pieces
    of documents with null or repeated ids count like any other, and no pieces give no sequences."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    out = pieces.groupBy("sequence_id").agg(parts.alias("_p"), F.sum("length").alias("n_ids"))
    joined = F.aggregate("_p", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return out.select("sequence_id", "n_ids", padded_length(F.col("n_ids"), window).alias("padded_to"),
                      joined.alias("ids"), F.col("_p.offset").alias("boundaries"))
