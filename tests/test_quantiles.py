"""Quantiles of many columns by sketch and bracket."""

import numpy as np
import pytest

from panelcast.operators import quantiles as Q

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    n = 30_000
    cols = {
        "normal": rng.normal(size=n), "mostly zero": np.where(rng.random(n) < 0.8, 0.0, rng.random(n)), "one value": np.full(n, 3.5),
        "two": np.where(np.arange(n) < n // 2, 1.0, 2.0), "whole": rng.integers(0, 50, n).astype(float),
        "heavy": rng.pareto(0.5, n), "few": np.where(np.arange(n) < 7, np.arange(n) * 1.5, np.nan), "none": np.full(n, np.nan),
        "ends": np.where(np.arange(n) % 1000 == 0, np.inf, rng.random(n)),
    }
    import pandas as pd

    pdf = pd.DataFrame(cols)
    df = spark.createDataFrame(pdf).repartition(7)
    return pdf, df.withColumn("null", Q.F.lit(None).cast("double")).cache()


@pytest.mark.parametrize("accuracy", [10, 200, 2000])
def test_equal_to_numpy_whatever_the_sketch(table, accuracy):
    pdf, df = table
    names = [*pdf.columns, "null"]
    got = {(r["column"], r["q"]): r["value"] for r in Q.column_quantiles(df, names, PROBS, accuracy).collect()}
    assert {c for c, _ in got} == set(names) - {"none", "null"}
    for c in pdf.columns:
        v = np.sort(pdf[c].dropna().to_numpy())
        for p in PROBS if len(v) else ():
            pos = p * (len(v) - 1)
            lo, hi = v[int(np.floor(pos))], v[int(np.ceil(pos))]
            want = lo if lo == hi else lo + (pos - np.floor(pos)) * (hi - lo)
            if np.isfinite(want):
                assert got[c, p] == pytest.approx(want, rel=1e-9, abs=1e-12), (c, p)


def test_a_bracket_that_misses_is_noticed(table, monkeypatch):
    pdf, df = table
    real = Q.sketched_quantiles
    monkeypatch.setattr(Q, "sketched_quantiles", lambda d, c, p, a: real(d, c, [0.3] * len(p), a))
    got = {r["q"]: r["value"] for r in Q.column_quantiles(df, ["normal"], PROBS).collect()}
    assert all(got[p] == pytest.approx(np.quantile(pdf["normal"], p)) for p in PROBS)


def test_sketch_is_within_its_error(table):
    pdf, df = table
    got = Q.sketched_quantiles(df, ["normal", "null"], [0.1, 0.5], 500).collect()
    by = {r["column"]: r["values"] for r in got}
    rank = [np.mean(pdf["normal"] <= v) for v in by["normal"]]
    assert by["null"] is None and np.abs(np.array(rank) - [0.1, 0.5]).max() <= 1 / 500 + 1e-3


def test_empty_table(table):
    assert Q.column_quantiles(table[1].limit(0), ["normal", "two"], [0.5]).count() == 0
