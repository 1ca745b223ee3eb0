import re
from collections import Counter

import numpy as np
import pytest

from panelcast.llm import collocations as C


def brute(rows, shortest=2, longest=3, least=10, covered=50, top=2000):
    """Every rule of the operator over plain Python counters."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(low)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) >= shortest and a >= least}
        gone = {p[i : i + k] for p, a in cand.items() for k in range(shortest, len(p)) for i in range(len(p) - k + 1) if 100 * a >= covered * c[p[i : i + k]]}
        rows_ = []
        for p, a in cand.items():
            if p not in gone:
                s, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                rows_.append((lang, " ".join(p), a, c[p[:k]], c[p[k:]], n[lang], s))
        rows_.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i, *r[1:]) for i, r in enumerate(rows_[:top], 1)]
    return sorted(out)


def mine(df, **kw):
    return sorted(tuple(r) for r in C.collocations(df, **kw).collect())


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    vocab = ["the", "Of", "New", "york", "city", "é", "x-y", "İ", "a\x00b", "z" * 70]
    rows = []
    for i in range(600):
        t = ""
        for w in rng.choice(len(vocab), size=int(rng.integers(0, 60)), p=np.r_[np.full(8, 0.11), 0.06, 0.06]):
            t += vocab[w] + str(rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n"]))
        rows.append((t, ["en", "de", None, "und"][i % 4]))
    rows += [(None, "en"), ("", "fr"), (" \t.\n", None), ("one", "it"), ("New York City " * 3000, "es")]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    want = brute(rows)
    assert len(want) > 100 and mine(df) == want
    assert mine(df, mass=50) == want  # many hash partitions, summaries that lose counters
    assert mine(df, longest=5, least=4, covered=70, top=30) == brute(rows, longest=5, least=4, covered=70, top=30)


def test_copies_empty_tables_and_extra_columns(spark):
    df = spark.createDataFrame([("a b c. a b", "en", 1)] * 20, "text string, lang string, phrase int")
    assert mine(df) == brute([("a b c. a b", "en")] * 20)
    assert mine(df.limit(0)) == [] and mine(df.limit(3)) == []


@pytest.mark.parametrize("order", [0, 1, 2])
def test_summary_keeps_every_frequent_key(order):
    rng = np.random.default_rng(order)
    keys = np.r_[np.repeat(np.arange(300), rng.integers(10, 15, 300)), rng.integers(1000, 10**6, 30000)].astype(np.uint64)
    rng.shuffle(keys)
    s = C.Summary(C.SLACK * len(keys) // 10 + 1)
    for part in np.array_split(keys, 40):
        s.add(*np.unique(part, return_counts=True))
    true, count = np.unique(keys, return_counts=True)
    assert s.lost < 10 and set(true[count >= 10]) <= set(s.survivors(10)) and len(s.keys) <= s.capacity
    held = dict(zip(true.tolist(), count.tolist()))
    assert all(c <= held[k] <= c + s.lost for k, c in zip(s.keys.tolist(), s.counts.tolist()))


def test_keys_travel_whole():
    h = np.random.default_rng(0).integers(0, 1 << 64, 5000, dtype=np.uint64)
    k = np.sort(C._key(h, 6))
    assert (C._unpacked(C._packed(k)) == k).all()


def test_full_filter_changes_nothing(spark, monkeypatch):
    rows = [(f"w{i % 7} w{i % 3} w{i % 5} x{i}", "en") for i in range(400)]
    df = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(C, "FILTER_BYTES", 64)
    assert mine(df) == brute(rows)
