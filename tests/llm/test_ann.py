"""Nearest neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from panelcast.llm import ann as A


def test_hilbert_steps_are_unit_steps():
    for dims, bits in ((2, 3), (3, 2)):
        side = 1 << bits
        cells = np.array(np.meshgrid(*[np.arange(side)] * dims, indexing="ij")).reshape(dims, -1).T
        keys = A.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(side**dims))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_full_window_is_exact_with_bad_vectors_and_copies(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 360)]  # copies of one vector, queries among them
    rows += [(360, None), (361, [0.0] * 6), (362, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (363, [float("nan")] * 6), (364, [float("inf")] * 6),
             (365, []), (366, [1.0, 2.0]), (None, [1.0] * 6), (12, rows[12][1])]
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id bigint, embedding array<double>, vk string, score double")
    q = F.col("vec_id") % 20 == 0
    got = A.neighbours(df, q, k=5, window=1.0, block=64)
    want = A.brute_force(df, q, k=5)
    key = lambda d: sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in d.collect())
    assert key(got) == key(want)
    assert {r.query_id for r in got.select("query_id").distinct().collect()} == set(range(0, 360, 20))


def test_few_candidates_and_empty(spark):
    df = spark.createDataFrame([(100, [1.0, 0.0]), (200, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id bigint, embedding array<float>")
    rows = A.neighbours(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in rows] == [(100, 1, 3), (100, 2, 200), (200, 1, 3), (200, 2, 100)]
    assert A.neighbours(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_recall_on_the_largest_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    q = F.col("vec_id") % 100 == 0
    assert A.recall(A.neighbours(df, q), A.brute_force(df, q)) >= 0.9
