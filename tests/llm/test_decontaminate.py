"""Decontamination against brute force."""

import re

import numpy as np
import pyarrow as pa
import pytest

from panelcast.llm import decontaminate as D

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORDS.findall((t or "").lower())


def fitting(item, text):
    """Edit distance of the item to its best part of the text, plain dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text, 1):
            new.append(min(row[j - 1] + (v != w), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def brute(docs, items, similarity=0.8):
    out = set()
    for d, t in docs:
        for i, x in items:
            w = words(x)
            if w and (e := fitting(w, words(t))) <= int(len(w) * (1 - similarity) + 1e-9):
                out.add((d, i, e))
    return out


def edited(rng, item, vocabulary, edits):
    out = list(item)
    for _ in range(edits):
        at = rng.integers(len(out))
        kind = rng.integers(3)
        if kind == 0:
            out[at] = rng.choice(vocabulary)
        elif kind == 1:
            out.insert(at, rng.choice(vocabulary))
        else:
            del out[at]
    return out


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(11)
    vocabulary = ["".join(rng.choice(list("abdeinorst"), rng.integers(1, 4))) for _ in range(900)]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(12, 70)))) for i in range(30)]
    docs = []
    for d in range(240):
        before, behind = (rng.choice(vocabulary, rng.integers(0, 90)).tolist() for _ in range(2))
        item = words(items[d % 30][1])
        inner = edited(rng, item, vocabulary, int(len(item) * (d // 30 % 4) * 0.05)) if d < 210 else []
        docs.append((d, ", ".join(before + inner + behind).title()))
    return docs, items


def test_recall_and_exactness(spark, planted):
    docs, items = planted
    want = brute(docs, items)
    got = {(r.doc_id, r.item_id, r.edits) for r in D.find_leaks(
        spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id bigint, text string, item_id string"),
        spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")).collect()}
    assert got <= want and len(got) >= 0.97 * len(want) and len(want) >= 200
    exact = {x for x in want if x[2] == 0}
    assert exact <= got  # an unedited item is always found


def test_blocks_of_items_find_the_same(spark, planted):
    docs, items = planted
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    one = sorted(map(tuple, D.find_leaks(d, b).collect()))
    assert one == sorted(map(tuple, D.find_leaks(d, b, block=400).collect()))
    kept = {r.doc_id for r in D.keep_uncontaminated(d, b, block=400).collect()}
    assert kept == {i for i, _ in docs} - {r[0] for r in one}


def test_edge_cases(spark):
    items = [(1, None), (2, ""), (3, "!!"), (4, "one"), (5, "two words"), (6, "a b c d e f g h i j"), (6, "a b c d e f g h i j"), (None, "x y z x y z q r s t")]
    docs = [(1, None), (2, ""), (3, "A, b c D e f g h i j"), (3, "A, b c D e f g h i j"), (4, "the one."), (5, "two. WORDS"), (None, "x y z x y z q r s t"),
            (7, "a b c d e"), (8, "q " * 300_000 + "a b c d e x g h i j"), (9, "a b c d e f g h i")]
    d = spark.createDataFrame([(*x, 5) for x in docs], "doc_id bigint, text string, edits int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((str(r.doc_id), str(r.item_id), r.edits) for r in D.find_leaks(d, b).collect())
    assert got == sorted([("3", "6", 0)] * 4 + [("4", "4", 0), ("5", "5", 0), ("None", "None", 0)] + [("8", "6", 1)] * 2 + [("9", "6", 1)] * 2)
    kept = D.keep_uncontaminated(d, b)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 7]
    assert D.find_leaks(d, b.limit(0)).count() == 0 and D.find_leaks(d.limit(0), b).count() == 0
    assert D.keep_uncontaminated(d, b.limit(0)).count() == len(docs)


def test_whole_table_against_brute_force(spark):
    from panelcast.llm.queries import op8_decontaminate

    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    bags = {d: set(words(t)) for d, t in docs}
    near = [(d, t) for d, t in docs if any(len(bags[d] & set(words(x))) >= 0.7 * len(set(words(x))) for _, x in items)]
    got = {(r.doc_id, r.item_id, r.edits) for r in op8_decontaminate(spark, "/root/testdata/sf0.001").collect()}
    assert got == brute(near, items)


def test_fitting_distance_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(60):
        item, text = rng.integers(1, 5, rng.integers(1, 9)).astype(np.uint64), rng.integers(1, 5, (4, rng.integers(1, 14))).astype(np.uint64)
        got, end = D.fitting_distance(item, text)
        assert got.tolist() == [fitting(item.tolist(), t.tolist()) for t in text]


def test_an_item_holds_its_window_at_every_shift():
    for n in range(1, 400):
        for similarity in (1.0, 0.8):
            w, stride = D.window_of(n, similarity)
            left = n - D.most_edits(n, similarity)
            assert w + stride - 1 <= left and w & (w - 1) == 0 and 2 * w > (left + 1) / 1.5
    assert D.hashed_words(pa.array(["", None, " a  b ", "!"]))[1].tolist() == [0, 0, 0, 2, 2]


def test_edits_in_the_first_half_and_truncated_items():
    """20 % of the words edited, all of them in the first half, or the first 20 % cut off."""
    rng = np.random.default_rng(3)
    vocabulary = np.array([f"w{i}" for i in range(3000)])
    items = [rng.choice(vocabulary, n).tolist() for n in rng.integers(12, 100, 400)]
    match = D.Matcher(D.build_index(list(range(len(items))), [" ".join(x) for x in items]), 0.8)

    def recall(plant):
        docs = []
        for item in items:
            before, behind = (rng.choice(vocabulary, rng.integers(0, 90)).tolist() for _ in range(2))
            docs.append(" ".join(plant(list(item), before) + behind))
        found = {(d, i) for d, i, _, _ in match(pa.array(docs))}
        return sum((i, i) in found for i in range(len(items))) / len(items)

    def first_half(item, before):
        for p in rng.choice(len(item) // 2, int(len(item) * 0.2), replace=False):
            item[p] = f"x{p}"
        return before + item

    assert recall(first_half) >= 0.95
    assert recall(lambda item, before: before + item[int(len(item) * 0.2 + 1e-9):]) >= 0.99
    assert recall(lambda item, before: item[int(len(item) * 0.2 + 1e-9):]) == 1


@pytest.mark.parametrize("place", ["start", "middle", "end", "alone"])
@pytest.mark.parametrize("change", ["replaced", "deleted", "inserted", "deleted in the first half", "deleted in the second half", "cut"])
def test_recall_with_a_fifth_of_the_words_edited(change, place):
    rng = np.random.default_rng(17)
    vocabulary = np.array([f"w{i}" for i in range(3000)])
    items = [rng.choice(vocabulary, n).tolist() for n in rng.integers(12, 100, 500)]
    match = D.Matcher(D.build_index(list(range(len(items))), [" ".join(x) for x in items]), 0.8)
    docs = []
    for item in items:
        x, n, e = list(item), len(item), int(len(item) * 0.2 + 1e-9)
        if change == "replaced":
            for p in rng.choice(n, e, replace=False):
                x[p] = f"x{p}"
        elif change == "inserted":
            for p in sorted(rng.choice(n, e, replace=False), reverse=True):
                x.insert(p, f"x{p}")
        elif change == "cut":
            x = x[e:]
        else:
            of = {"deleted": np.arange(n), "deleted in the first half": np.arange(n // 2), "deleted in the second half": np.arange(n - n // 2, n)}[change]
            for p in sorted(rng.choice(of, min(e, len(of)), replace=False), reverse=True):
                del x[p]
        before, behind = (rng.choice(vocabulary, rng.integers(20, 90)).tolist() for _ in range(2))
        docs.append(" ".join((before if place in ("middle", "end") else []) + x + (behind if place in ("start", "middle") else [])))
    found = {(d, i) for d, i, _, _ in match(pa.array(docs))}
    assert sum((i, i) in found for i in range(len(items))) >= 0.9 * len(items)
