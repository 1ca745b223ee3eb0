import hashlib
import re

import numpy as np
import pytest

from panelcast.llm import substring_dedup as S


def brute(rows, window=13):
    words = [re.findall(rb"[^ \t-\r]+", (t or "").encode()) for _, t in rows]
    ids = [float("inf") if i is None else i for i, _ in rows]
    low = {}
    for i, w in zip(ids, words):
        for k in range(len(w) - window + 1):
            s = tuple(w[k : k + window])
            low[s] = min(low.get(s, i), i)
    out = []
    for (i, _), order, w in zip(rows, ids, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if low[tuple(w[k : k + window])] < order:
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def mine(df, **kw):
    return sorted((tuple(r) for r in S.dedup_substrings(df, **kw).collect()), key=str)


def corpus(seed, n=150, vocab=400):
    rng = np.random.default_rng(seed)
    word = [f"w{i}" for i in range(vocab)] + ["é", "a\x00", "x" * 90]
    line = lambda k: " ".join(rng.choice(word, k))
    shared = [line(int(k)) for k in rng.integers(8, 40, 6)]
    rows = []
    for i in range(n):
        parts = [line(int(rng.integers(0, 30)))]
        for s in rng.choice(len(shared), int(rng.integers(0, 4))):
            parts += [shared[s], line(int(rng.integers(0, 15)))]
        rows.append((int(i * 7919 % 1009), str(rng.choice([" ", "\n", " \t "])).join(parts)))
    rows += [(2000 + i, rows[3][1]) for i in range(40)]  # copies
    rows += [(3000, "a b " * 500), (2999, "a b " * 40 + line(20)), (3001, "b a " * 30)]  # a window again and again in one text
    rows += [(4000, None), (4001, ""), (4002, " \n"), (4003, line(12)), (4004, line(13))]
    return rows


@pytest.mark.parametrize("parts, target", [(1, S.BUCKET), (9, S.BUCKET), (5, 40)])
def test_against_brute_force(spark, parts, target):
    rows = corpus(parts)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    got = mine(df, target=target)
    assert got == brute(rows) and sum(r[2] for r in got) > 500


def test_null_and_repeated_ids(spark):
    rows = corpus(3, n=40)
    rows += [(None, rows[0][1]), (None, rows[5][1] + " tail"), (None, rows[5][1] + " tail"), *rows[2:6], (rows[1][0], rows[7][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, content string").repartition(6)
    assert mine(df) == brute(rows)


def test_small_step_and_text(spark, monkeypatch):
    monkeypatch.setattr(S, "STEP", 1)
    rows = [(2, "a b c d e"), (1, "x a b c"), (3, "a b c a b c d")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r.doc_id: r.kept for r in S.dedup_substrings(df, window=3, with_text=True).collect()}
    assert got == {1: "x a b c", 2: "d e", 3: ""}
    assert S.dedup_substrings(df.limit(0)).count() == 0


def test_minimisers_are_the_smallest():
    h = np.random.default_rng(1).integers(0, 1 << 64, 100, dtype=np.uint64)
    two = S.window_hashes(h, 2)
    assert (S.minimisers(h, 13) == [two[i : i + 12].min() for i in range(88)]).all()


def test_equal_hashes_are_compared_by_words():
    code = np.array([1, 2, 3, 4, 1, 2, 3, 4, 5, 6])
    at = np.arange(9)
    many, groups = S.equal_windows(code, at, np.zeros(9, np.uint64), 2)
    got = {tuple(sorted(g)) for g in np.split(many, groups[1:]) if len(g) > 1}
    assert got == {(0, 4), (1, 5), (2, 6)}


def test_large_buckets_are_split():
    parts, base, n = S.split_plan(np.array([10, 500, 40, 401]), 100)
    assert parts.tolist() == [0, 5, 0, 5] and base.tolist() == [4, 4, 9, 9] and n == 14
