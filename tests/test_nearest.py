import numpy as np
import pytest

from panelcast.operators import nearest as N


def frame(spark, x):
    names = [f"f{i}" for i in range(x.shape[1])]
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "num bigint, " + ", ".join(f"{n} double" for n in names)), names


def brute(x, k):
    d = ((x[:, None, :] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    return {i: r[: min(k, len(x) - 1)].tolist() for i, r in enumerate(np.argsort(d, axis=1, kind="stable"))}


def searched(spark, x, k, **kw):
    df, names = frame(spark, x)
    out, compared = N.nearest_rows(df, "num", names, k, **kw)
    return {r.num: list(r.near) for r in out.collect()}, compared


@pytest.mark.parametrize("block", [64, 4096])
def test_clusters_meet_few_blocks(spark, block):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 20))[rng.integers(0, 30, 2500)] * 10 + rng.normal(size=(2500, 20)) * 0.3
    got, compared = searched(spark, x, 5, block=block)
    assert got == brute(x, 5)
    assert block > 2500 or compared < 0.2 * len(x) ** 2


def test_without_structure(spark):
    x = np.random.default_rng(2).normal(size=(1200, 8))
    assert searched(spark, x, 4, block=50)[0] == brute(x, 4)


def test_equal_rows_and_ties(spark):
    x = np.random.default_rng(3).integers(0, 4, size=(1500, 3)).astype(float)
    got, compared = searched(spark, x, 5, block=16)
    assert got == brute(x, 5) and compared < 64 * 64
    assert searched(spark, np.zeros((40, 2)), 3)[0] == brute(np.zeros((40, 2)), 3)
    mixed = np.r_[np.zeros((500, 2)), np.random.default_rng(4).normal(size=(200, 2))]  # most rows are one row
    assert searched(spark, mixed, 5, block=16)[0] == brute(mixed, 5)


def test_few_rows(spark):
    assert searched(spark, np.array([[0.0, 0.0], [1.0, 1.0]]), 5)[0] == {0: [1], 1: [0]}
    assert searched(spark, np.array([[1.0, 2.0]]), 5)[0] == {}
    df, names = frame(spark, np.zeros((1, 2)))
    assert N.nearest_rows(df.limit(0), "num", names, 3)[0].count() == 0


def test_bounds_never_pass_a_nearer_row():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 6)) * [1, 5, 1, 1, 20, 1]
    pivots = N.choose_pivots(x, 12)
    d = N.distances(x, pivots)
    cell, away = d.argmin(axis=1), d.min(axis=1)
    bounds = N.Bounds(pivots, cell, away, away)  # every row a block of its own
    assert (bounds.least(x) <= N.distances(x, x) * (1 + 1e-9) + 1e-9).all()


def test_only_near_rows_are_asked_and_written(spark, monkeypatch):
    """Rows that met many blocks, and ten rows written for each meeting, filled the disks."""
    x = np.random.default_rng(6).normal(size=(6000, 4)) * [1, 2, 3, 1]
    written, real = [], N.materialize

    def seen(df, name):
        out = real(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(N, "materialize", seen)
    got, compared = searched(spark, x, 5, block=64)
    assert got == brute(x, 5)
    found = [n for name, n in written if name == "nearest-found"]
    assert len(found) == 3 and sum(found) < 3 * 5 * len(x) and compared < 0.12 * len(x) ** 2, (found, compared / len(x) ** 2)


def test_boxes_hold_their_rows_and_parts_are_even():
    x = np.random.default_rng(7).normal(size=(1000, 3))
    parts = N._halves(x, 7)
    assert sorted(np.concatenate(parts)) == list(range(1000)) and {len(p) for p in parts} <= {142, 143}
    boxes = [(a, np.array([x[p, a].min() for p in parts]), np.array([x[p, a].max() for p in parts])) for a in range(3)]
    bounds = N.Bounds(x[:1], np.zeros(7, int), np.zeros(7), np.full(7, 99.0), boxes)
    least, d = bounds.least(x), N.distances(x, x)
    assert all((least[:, i] <= d[:, p].min(axis=1) * (1 + 1e-9)).all() for i, p in enumerate(parts))
    assert (least > 0).mean() > 0.5
