"""Shared helpers."""

import random

from pyspark.sql import functions as F

from panelcast.llm import common as C


def brute_roots(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def test_connected_components_of_paths_stars_and_random_graphs(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(1000, 1150)] + [(5000, 5000 + i) for i in range(1, 400)] + [(9, 9), (-5, 70), (70, -5)]
    edges += [(rng.randrange(20_000, 20_300), rng.randrange(20_000, 20_300)) for _ in range(160)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in C.connected_components(df, "a", "b").collect()}
    assert got == brute_roots(edges)
    assert C.connected_components(df.limit(0), "a", "b").count() == 0
    assert C.connected_components(df.where("a = b"), "a", "b").count() == 0


def test_lookup_with_hot_and_missing_keys(spark):
    rows = spark.createDataFrame([(i, i % 3 if i < 3000 else i) for i in range(5000)], "i int, k int")
    lookup = rows.groupBy("k").agg(F.count("*").alias("n")).where("k != 2 and k != 4000").withColumn("v", F.col("k") * 10)
    left = {r.i: r.v for r in C.looked_up(rows, lookup, "k", "n").collect()}
    want = {i: (i % 3 if i < 3000 else i) for i in range(5000)}
    assert left == {i: None if k in (2, 4000) else k * 10 for i, k in want.items()}
    assert C.looked_up(rows, lookup, "k", "n", "inner").count() == sum(k not in (2, 4000) for k in want.values())
    assert C.looked_up(rows, lookup.limit(0), "k", "n").count() == 5000


def test_memo_keeps_frequent_keys_and_stays_small():
    m = C.Memo(100)
    for step in range(50):
        keys = {"often", *(f"{step}-{i}" for i in range(40))}
        fresh = m.unseen(keys)
        assert ("often" in fresh) == (step == 0)
        m.update((k, len(k)) for k in fresh)
        assert all(m[k] == len(k) for k in keys)
        assert len(m) + len(m.old) <= 300
    m.update({"x" * 60: 1})
    m.forget_long(["x" * 60])
    assert "x" * 60 not in m


def test_worker_state_keeps_the_latest_only():
    made = []
    for key in ("a", "a", "b", "a"):
        C.worker_state(key, lambda key=key: made.append(key) or key)
    assert made == ["a", "b", "a"]


def test_split_words_and_steps():
    import pyarrow as pa

    code, words, first = C.split_words(pa.array(["a b  a", "", "c"]).slice(0))
    assert [[words[c] for c in code[i:j]] for i, j in zip(first, first[1:])] == [["a", "b", "", "a"], [""], ["c"]]
    batches = [pa.RecordBatch.from_arrays([pa.array(["x" * 50] * 10)], names=["t"]) for _ in range(7)]
    steps = list(C.in_steps(batches, 0, size=1000))
    assert sum(b.num_rows for b in steps) == 70 and len(steps) == 4
    assert list(C.text_pieces(["aaa", "b", "", "cccc"], 3)) == [(0, 1), (1, 4)]
