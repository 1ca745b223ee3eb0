"""Token counts by rank-synchronous array merging (sentencepiece BPE models).

A text is cut where no vocabulary piece can cross: before every space that
follows a non-space and before every newline.  Each cut part ("pre-token") is an
independent merge problem, so equal parts are counted once per worker and looked
up afterwards.  The parts that a batch brings anew are held as one ragged numpy
array; in each round every part applies its lowest-rank adjacent pair, all parts
at the same time, until no pair of any part is in the vocabulary.  What is left
is counted: a symbol of the vocabulary is one token, any other character as many
tokens as it has UTF-8 bytes (byte fallback).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from panelcast.llm.common import Memo, bounded_batches, in_steps, split_words, worker_state

SPACE = "▁"
NONE = np.int64(1) << 60
#: Parts kept in a generation of a worker's table (a bound on memory only).
KEPT = 400_000
_RUNS = re.compile(r" +[^ ]*")


class MergeTable:
    """Ranks of all splittable pieces of a sentencepiece BPE model.

    ``keys[i]`` packs the two symbols of a pair, ``rank[i]`` its priority (smaller
    first; equal scores share a rank) and ``made[i]`` the symbol it makes.
    ``alone[s]`` marks symbols that can take part in a pair of equal or better rank
    than their own: such a merge is applied to the leftmost place only, all others
    to every place at once, which gives the same end state as one merge at a time.
    """

    def __init__(self, model_file: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=model_file)
        usable = [i for i in range(len(m)) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))]
        pieces = {m.id_to_piece(i): m.get_score(i) for i in usable if not m.is_unused(i)}
        chars = {c for p in pieces for c in p}
        self.symbol = {p: k for k, p in enumerate(sorted(chars | set(pieces)))}
        self.size = len(self.symbol)
        order = {s: r for r, s in enumerate(sorted(set(pieces.values()), reverse=True))}
        rows = []
        alone = np.zeros(self.size, bool)
        for p, score in pieces.items():
            for k in range(1, len(p)):
                left, right = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if left is not None and right is not None:
                    rows.append((left * self.size + right, order[score], self.symbol[p]))
            for part in {q for k in range(2, len(p)) for q in (p[:k], p[-k:])}:
                if part in pieces and pieces[part] <= score:
                    alone[self.symbol[part]] = True
        table = np.array(sorted(rows), np.int64).reshape(-1, 3)
        self.keys, self.rank, self.made = table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()
        self.alone = alone
        # tokens of a single character: 1 if it is a piece, else its bytes
        cost = np.array([len(chr(c).encode("utf-8", "surrogatepass")) for c in range(0x10000)] + [4], np.int64)
        self.char_symbol = np.full(0x110001, -1, np.int64)
        for c in chars:
            self.char_symbol[ord(c)] = self.symbol[c]
        self.char_cost = cost
        self.symbol_cost = np.ones(self.size, np.int64)
        for c in chars - set(pieces):
            self.symbol_cost[self.symbol[c]] = len(c.encode())

    def pair_rank(self, left, right):
        """Rank and made symbol of each pair; NONE where it is no piece."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        hit = (left >= 0) & (right >= 0) & (self.keys[at] == key) if len(self.keys) else np.zeros(len(key), bool)
        return np.where(hit, self.rank[at], NONE), np.where(hit, self.made[at], -1)

    def count(self, parts: list[str]) -> np.ndarray:
        """Tokens of each part (already escaped: spaces as the space mark)."""
        n = np.array([len(p) for p in parts], np.int64)
        code = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sym = self.char_symbol[code]
        # Characters outside every piece count their bytes and take part in no pair.
        cost = np.where(sym >= 0, self.symbol_cost[sym], self.char_cost[np.minimum(code, 0x10000)])
        seq = np.repeat(np.arange(len(parts)), n)
        total = np.zeros(len(parts), np.int64)
        rank = np.full(len(sym), NONE)
        made = np.full(len(sym), -1, np.int64)
        if len(sym) > 1:
            same = seq[1:] == seq[:-1]
            r, m = self.pair_rank(sym[:-1], sym[1:])
            rank[:-1], made[:-1] = np.where(same, r, NONE), m
        while len(sym):
            start = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            length = np.diff(np.r_[start, len(seq)])
            best = np.minimum.reduceat(rank, start)
            done = best == NONE
            if done.any():
                total[seq[start[done]]] += np.add.reduceat(cost, start)[done]
                live = np.repeat(~done, length)
                sym, cost, seq, rank, made = sym[live], cost[live], seq[live], rank[live], made[live]
                if not len(sym):
                    break
                best, length = best[~done], length[~done]
                start = np.r_[0, np.cumsum(length)[:-1]]
            hit = np.flatnonzero(rank == np.repeat(best, length))
            # Where only the leftmost place may merge, and in runs such as "aaaa" every second one.
            first = np.r_[True, seq[hit][1:] != seq[hit][:-1]]
            touch = np.r_[False, (hit[1:] == hit[:-1] + 1)] & ~first
            run = np.flatnonzero(~touch)
            odd = (np.arange(len(hit)) - np.repeat(run, np.diff(np.r_[run, len(hit)]))) % 2 == 1
            hit = hit[(first | ~self.alone[made[hit]]) & ~odd]
            sym[hit] = made[hit]
            cost[hit] = self.symbol_cost[made[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            at = np.cumsum(keep)[hit] - 1  # the merged symbols' new places
            sym, cost, seq, rank, made = sym[keep], cost[keep], seq[keep], rank[keep], made[keep]
            if not len(sym):
                break
            near = np.unique(np.r_[at, at - 1])
            near = near[near >= 0]
            last = near == len(sym) - 1
            nxt = np.where(last, near, near + 1)
            r, m = self.pair_rank(sym[near], sym[nxt])
            rank[near] = np.where(last | (seq[near] != seq[nxt]), NONE, r)
            made[near] = m
        return total


def escaped(key: str) -> str:
    """The part that a key of the table stands for: k spaces and a word that an implied
    space precedes, unless the word starts with a newline (the cut is then the newline)."""
    word = key.lstrip(" ")
    spaces = len(key) - len(word)
    return SPACE * (spaces + (not word.startswith("\n"))) + word


class Counter:
    """Counts the tokens of whole texts, remembering the parts seen (bounded)."""

    def __init__(self, model_file: str):
        self.table = MergeTable(model_file)
        # Cuts are only right where no piece holds a space mark behind another character, or a newline.
        inner = [p for p in self.table.symbol if SPACE in p.lstrip(SPACE) or ("\n" in p and len(p) > 1)]
        if inner:
            raise ValueError(f"{len(inner)} pieces cross a cut, such as {inner[0]!r}")
        self.seen = Memo(KEPT)

    def of_keys(self, keys: list[str]) -> np.ndarray:
        """Tokens of distinct keys."""
        seen = self.seen
        fresh = seen.unseen(set(keys))
        for i in range(0, len(fresh), 1 << 17):
            part = fresh[i : i + (1 << 17)]
            seen.update(zip(part, self.table.count([escaped(k) for k in part]).tolist()))
        out = np.fromiter((seen[k] for k in keys), np.int64, len(keys))
        seen.forget_long(fresh)
        return out

    def __call__(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text (no nulls).

        A key of the table is a part behind one space; where a text has runs of spaces, or begins or
        ends with one, a key is the further spaces of its run and the word behind them."""
        t = pc.replace_substring(pc.replace_substring(texts, SPACE, " "), "\n", " \n")
        runs = pc.or_(pc.match_substring(t, "  "), pc.or_(pc.starts_with(t, " "), pc.ends_with(t, " "))).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(runs), pa.scalar("", t.type), t)
        code, words, first = split_words(plain)
        out = np.add.reduceat(self.of_keys(words)[code], first[:-1]) if len(t) else np.zeros(0, np.int64)
        out[pc.equal(plain, "").to_numpy(zero_copy_only=False)] = 0
        for i in np.flatnonzero(runs).tolist():
            keys = [k[1:] for k in _RUNS.findall(" " + t[i].as_py())]
            distinct = list(set(keys))
            out[i] = sum(map(dict(zip(distinct, self.of_keys(distinct).tolist())).__getitem__, keys))
        return out


def counter(model_file: str) -> Counter:
    """One counter for each model and Python worker."""
    return worker_state(("tokens", model_file), lambda: Counter(model_file))


def token_counts(df: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """Tokens of every whole text, one output row for each input row, no shuffle.

    Returns ``id_col, n_bytes, n_tokens, over_limit`` (n_tokens > limit).  A null text
    counts as empty: 0 bytes, 0 tokens.  Null ids and repeated rows pass through; other
    columns of the input, whatever their names, are not read.  An empty table gives an
    empty result.  ``model_file`` must exist on the executors (a sentencepiece BPE model).
    """

    def run(batches):
        count = counter(model_file)
        for batch in in_steps(batches, 1):
            texts = pc.fill_null(batch.column(1), "")
            tokens = count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(tokens), pa.array(tokens > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    bounded_batches(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
