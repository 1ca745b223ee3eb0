"""SimHash against brute force."""

import numpy as np
import pytest
import xxhash

from panelcast.llm import simhash as S


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, most=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("node_rows", [1 << 15, 4])
def test_links_join_the_same_classes_as_brute_force(spark, node_rows):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63, 12, dtype=np.uint64) * np.uint64(2)
    fps = set(rng.integers(0, 1 << 63, 60, dtype=np.uint64).tolist()) | {0, (1 << 64) - 1, 1 << 63, 7}
    for c in centre.tolist():
        for _ in range(12):
            x = c
            for b in rng.integers(0, 64, rng.integers(0, 4)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp bigint")
    edges = S.links(df, 2, node_rows)
    got = {r.node: r.root for r in S.connected_components(edges, "a", "b").collect()}
    own = {f: int(np.uint64(f).astype(np.int64)) for f in fps}
    classes = {}
    for f in fps:
        classes.setdefault(got.get(own[f], own[f]), set()).add(f)
    want = {}
    for f, c in zip(fps, brute_components(list(range(len(fps))), fps)):
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, want.values()))


def test_groups_with_nulls_blanks_repeats_and_clashing_names(spark):
    long = "wort " * 200_000
    texts = [(3, "A b  c d"), (1, "a B c\td"), (2, None), (5, ""), (9, " \n"), (None, "one two"), (7, "one two"),
             (8, long), (8, long), (11, "é\x0bè x y z"), (12, "a b c d e f g h")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], "doc_id bigint, text string, fp int, root string")
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in S.simhash_groups(df).collect())
    fps = [brute_fingerprint(t) for _, t in texts]
    comp = brute_components([i for i, _ in texts], fps)
    assert got == sorted((str(i), f"{f:016x}", c) for (i, _), f, c in zip(texts, fps, comp))
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["None", "1", "11", "12", "2", "8"])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.simhash_groups(df).count() == 0 and S.keep_one(df).count() == 0


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    want = list(zip([r.doc_id for r in rows], [f"{f:016x}" for f in fps], brute_components([r.doc_id for r in rows], fps)))
    got = [tuple(r) for r in S.simhash_groups(docs).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(got) == sorted(want)
