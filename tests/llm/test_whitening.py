import numpy as np
import pytest

from panelcast.llm import whitening as W
from tests.conftest import SF0001


@pytest.mark.parametrize("d", [1, 2, 3, 7, 64])
def test_eigenpairs_against_numpy(d):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(d, d)) @ np.diag(np.linspace(0.1, 3, d))
    for m in (a @ a.T, np.eye(d) * 3, np.diag(np.r_[np.full(d // 2, 5.0), np.ones(d - d // 2)]), np.outer(a[:, 0], a[:, 0])):
        values, vectors = W.principal(m, 16)
        want = np.linalg.eigvalsh(m)[::-1][: len(values)]
        assert np.allclose(values, want, rtol=1e-12, atol=1e-12 * want[0])
        assert np.abs(m @ vectors - vectors * values).max() <= 1e-12 * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-12


def test_zero_matrix_has_no_components():
    assert len(W.principal(np.zeros((3, 3)), 16)[0]) == 0


def _brute(vectors, k):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    each = np.unique(x, axis=0)
    n, total = len(each), each.sum(axis=0)
    mean = total / n
    values, q = np.linalg.eigh((each - mean).T @ (each - mean) / n)
    order = np.argsort(-values)[:k]
    e = values[order]
    white = (x - mean) @ q[:, order] / np.sqrt(e)
    dev = [sum(int(v) ** 2 for v in n * row - total) for row in x.astype(object)]
    return n, e / values.sum(), white, dev


def test_query_against_brute_force(spark):
    from panelcast.llm.queries import op13_whitening

    rows = spark.read.parquet(f"{SF0001}/embeddings.parquet").orderBy("vec_id").collect()
    n, explained, white, dev = _brute([r["embedding"] for r in rows], 16)
    got = op13_whitening(spark, SF0001).orderBy("vec_id", "component").toPandas()
    assert len(got) == 16 * len(rows) and set(got.n) == {n}
    mine = got.whitened.to_numpy().reshape(-1, 16)
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white * sign).max() < 1e-8
    assert got.deviation.to_numpy().reshape(-1, 16)[:, 0].tolist() == dev
    assert np.allclose(got.explained.to_numpy()[:16], explained, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_awkward_rows(spark):
    rows = [(1, [0.5, 1.0], "a"), (1, [0.5, 1.0], "a"), (None, [2.0, -1.0], None), (3, [float("nan"), 1.0], "a"), (4, None, "a"),
            (5, [None, 1.0], "a"), (6, [1.0], "a"), (7, [], "a"), (8, [float("inf"), 0.0], "a"), (9, [3.0, 7.0], "a"), (10, [1e300, 0.0], "x")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, component string")
    out = W.whiten(df.where("vec_id != 10 OR vec_id IS NULL"), k=16).toPandas()
    assert len(out) == 2 * 4 and set(out.n) == {3}
    assert out.vec_id.isna().sum() == 2 and list(out.columns)[:2] == ["vec_id", "component"]
    far = W.whiten(df, k=1).toPandas()  # one entry beyond all longs: exact sums do not fit, nothing fails
    assert len(far) == 5 and far.deviation.isna().all()
    assert W.whiten(df.where("vec_id = 1")).count() == 0  # all equal: no component
    assert W.whiten(df.where("vec_id = -1")).count() == 0


def test_sums_beyond_64_bits(spark):
    big = (1 << 61) + 5
    df = spark.createDataFrame([(i, [big + i, -big]) for i in range(40)], "id long, x array<long>")
    n, total = W.sums(df, 2)
    assert n == 40 and total == [40 * big + sum(range(40)), -40 * big]
